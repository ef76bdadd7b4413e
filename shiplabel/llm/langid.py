"""Language identification with language-bitmask n-gram filters.

The model is a bit-sliced Bloom filter: slot i of the table is a bitmask of the languages that
set bit i. ANDing the slots of an n-gram's hashes returns at once all languages that contain it.
Over a text the set bits are counted by language; a language whose filter has a part f of its
bits set answers by chance with probability p = f ** hashes, so of N n-grams with C answers
(C - N p) / (1 - p) are taken to be real. The largest corrected count decides.

Training takes a bounded sample of labelled rows (about TRAIN_ROWS by a hash of the id, all of them
if there are fewer). A language's n-grams are those with at least 1/SHARE of the language's
occurrences, hence at most SHARE of them: long and short training texts give filters of the same
kind, and what is collected has a bound. Counting is a Spark aggregation.

n-grams run over letters in lower case; anything else is one space. A null text and a text
without a letter is ``und`` with score 0; without training rows every text is. A text that no
language knows gets the language with most training rows and score 0. Ties go to the language
first by name. Repeated rows are scored each, extra columns are not read, an empty table gives
no rows. The filter ``known_language`` goes by the share of n-grams that are explained, so it rejects
texts in languages that were not learnt, too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplabel.llm.common import at_ranks, hash_sample, id_remainder, text_or_empty, written

NGRAM = 4
HASHES = 2
SLOT_BITS = 20
SHARE = 30_000
TRAIN_ROWS = 20_000
FOLDS, HELD_OUT = 4, 2
UNDETERMINED = "und"
# A text is in no learnt language if less than MARGIN of what all but one in STRAYS labelled texts reach is explained.
STRAYS = 1000
MARGIN = 0.5
SURE = 3.0
# Code points handled at once inside a task.
CHARS = 1_000_000
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def letters() -> np.ndarray:
    """For each code point of the first plane: its lower-case letter, or a space."""
    lower = [chr(c).lower() if chr(c).isalpha() else " " for c in range(0x10000)]
    return np.array([ord(c) if len(c) == 1 else i for i, c in enumerate(lower)], np.uint64)


def grams(texts: list[str], plain: np.ndarray, n: int = NGRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-grams packed into 64 bits, number of the text of each, texts with a letter)."""
    # Space on either side of a text: its first and last words have n-grams like all others.
    joined = "".join(" " + t + " " * (n - 1) for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    # Letters beyond the first plane are rare; they keep sixteen bits of their number.
    folded = plain[points & 0xFFFF]
    beyond = points > 0xFFFF
    if beyond.any():
        folded[beyond] = [ord(c) & 0xFFFF | 0x8000 if c.isalpha() else 32 for c in map(chr, points[beyond])]
    owner = np.repeat(np.arange(len(texts)), [len(t) + n for t in texts])
    is_letter = folded != 32
    lettered = np.bincount(owner[is_letter], minlength=len(texts)) > 0
    # One space in place of several, and one before each text.
    kept = is_letter | np.concatenate([[False], is_letter])[:-1]
    kept[np.cumsum([0, *[len(t) + n for t in texts]])[:-1]] = True
    folded, owner = folded[kept], owner[kept]
    size = len(folded) - n + 1
    if size < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), lettered
    packed = np.zeros(size, np.uint64)
    for k in range(n):
        packed |= folded[k : k + size] << np.uint64(16 * k)
    # An n-gram belongs to a text if it starts and ends in it.
    inside = owner[:size] == owner[n - 1 :]
    return packed[inside], owner[:size][inside], lettered


def slots(packed: np.ndarray, hashes: int = HASHES, bits: int = SLOT_BITS) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        mixed = packed ^ (packed >> np.uint64(29))
        for k in range(hashes):
            yield (mixed * MULTIPLIERS[k]) >> np.uint64(64 - bits)


@dataclass
class Model:
    """``table`` has a column of slots for every 64 languages."""

    languages: list[str]
    table: np.ndarray
    chance: np.ndarray
    fallback: int

    def explained(self, texts: list[str], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(corrected counts by language and text, n-grams of each text, texts with a letter)."""
        packed, owner, lettered = grams(texts, plain)
        total = np.bincount(owner, minlength=len(texts)).astype(float)
        real = np.zeros((len(self.languages), len(texts)))
        for word in range(self.table.shape[0]):
            answer = None
            for slot in slots(packed):
                got = self.table[word][slot]
                answer = got if answer is None else answer & got
            for k, _ in enumerate(self.languages[64 * word : 64 * word + 64], 64 * word):
                bit = (answer >> answer.dtype.type(k % 64)) & answer.dtype.type(1)
                count = np.bincount(owner, weights=bit, minlength=len(texts))
                real[k] = np.maximum(0, (count - total * self.chance[k]) / (1 - self.chance[k]))
        return real, total, lettered

    def known(self, texts: list[str], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(n-grams of each text that its best language explains, all n-grams of each, texts with a letter)."""
        real, total, lettered = self.explained(texts, plain)
        return np.minimum(real.max(axis=0, initial=0.0), total), total, lettered

    def decide(self, texts: list[str], plain: np.ndarray) -> tuple[list[str], list[float]]:
        real, total, lettered = self.explained(texts, plain)
        names, scores = [], []
        for i in range(len(texts)):
            if not lettered[i] or not self.languages:
                names.append(UNDETERMINED)
                scores.append(0.0)
                continue
            best = int(real[:, i].argmax())
            if real[best, i] <= 0:
                names.append(self.languages[self.fallback])
                scores.append(0.0)
                continue
            # Share of the best in what the two best explain, scaled by how much the best explains.
            second = np.delete(real[:, i], best).max(initial=0.0)
            known = min(1.0, real[best, i] / total[i])
            names.append(self.languages[best])
            scores.append(float(known**0.5 * real[best, i] / (real[best, i] + second)))
        return names, scores


def chunks(texts: list[str], size: int = CHARS) -> Iterator[list[str]]:
    held, total = [], 0
    for t in texts:
        held.append(t)
        total += len(t)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def train(labelled: DataFrame, rows: int = TRAIN_ROWS, share: int = SHARE) -> Model:
    """Fit on ``labelled`` (doc_id, text, lang), about ``rows`` of it; equal rows count once."""
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    chosen = hash_sample(usable.select("doc_id", "lang", "text"), ["doc_id", "text"], rows, 7)
    sample = chosen.dropDuplicates().select("lang", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = letters()
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            texts = np.array(batch.column("text").to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                for part in chunks(list(texts[langs == lang])):
                    gram, count = np.unique(grams(part, plain)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * (len(gram) + 1), pa.string()),
                            pa.array([None, *gram.view(np.int64)], pa.int64()),
                            pa.array([len(part), *count], pa.int64()),
                        ],
                        ["lang", "gram", "n"],
                    )

    counts = (
        sample.mapInArrow(counted, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    counts = written(counts, "grams")
    sizes = {
        r["lang"]: (r["rows"], r["total"] or 0)
        for r in counts.groupBy("lang")
        .agg(F.sum(F.when(F.col("gram").isNull(), F.col("n"))).alias("rows"), F.sum(F.when(F.col("gram").isNotNull(), F.col("n"))).alias("total"))
        .collect()
    }
    names = sorted(sizes)
    words = max(1, -(-len(names) // 64))
    kind = np.uint8 if len(names) <= 8 else np.uint64
    table = np.zeros((words, 1 << SLOT_BITS), kind)
    chance = np.zeros(len(names))
    for k, name in enumerate(names):
        often = counts.where((F.col("lang") == name) & F.col("gram").isNotNull() & (F.col("n") * share >= sizes[name][1]))
        packed = often.select("gram").toPandas()["gram"].to_numpy(np.int64).view(np.uint64)
        for slot in slots(packed):
            table[k // 64][slot] |= kind(1 << (k % 64))
        chance[k] = np.mean((table[k // 64] >> kind(k % 64)) & kind(1)) ** HASHES
    fallback = max(range(len(names)), key=lambda k: (sizes[names[k]][0], -k), default=0)
    return Model(names, table, chance, fallback)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, fitted = letters(), Model(**shared.value)
        for batch in arriving:
            names: list[str] = []
            scores: list[float] = []
            for part in chunks(batch.column("text").to_pylist()):
                more = fitted.decide(part, plain)
                names += more[0]
                scores += more[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        batches, f"doc_id {kind}, lang_pred string, score double"
    )


def held_out() -> Column:
    return id_remainder(FOLDS) == HELD_OUT


def identified(docs: DataFrame) -> DataFrame:
    """Every document's predicted language, learnt from the rows that are not held out."""
    model = train(docs.where(~held_out()).select("doc_id", "text", "lang"))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def least_known(labelled: DataFrame, model: Model) -> float:
    """MARGIN of the share of n-grams that all but one in STRAYS of ``labelled`` have explained.

    Every row counts. The share at that place is found by counting, see ``at_ranks``.
    """
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text")
    shared = labelled.sparkSession.sparkContext.broadcast(vars(model))

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, fitted = letters(), Model(**shared.value)
        for batch in arriving:
            for part in chunks(batch.column("text").to_pylist()):
                best, total, _ = fitted.known(part, plain)
                some = total > 0
                # The bits of numbers that are not negative are ordered as the numbers are.
                known = np.asarray(best[some] / total[some], np.float64) + 0.0
                yield pa.RecordBatch.from_arrays([pa.array(known.view(np.int64), pa.int64())], ["known"])

    shares = written(usable.mapInArrow(batches, "known long"), "known")
    rows = shares.count()
    if not rows:
        return 0.0
    # Between two rows the share is taken in proportion.
    place = (rows - 1) / STRAYS
    lower = int(place)
    low, high = np.array(at_ranks(shares, "known", [lower, min(lower + 1, rows - 1)]), np.int64).view(np.float64)
    return float(MARGIN * (low + (place - lower) * (high - low)))


def known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is in a learnt language. All columns are kept.

    Rows without a letter go, and rows of whose n-grams the best language explains less than the
    share ``least_known`` that the held-out labelled rows give, by more than SURE standard deviations:
    a few n-grams tell nothing. Without labelled rows all rows with a letter stay.
    """
    model = train(docs.where(~held_out()).select("doc_id", "text", "lang"))
    least = least_known(docs.where(held_out()), model) if model.languages else 0.0
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, fitted = letters(), Model(**shared.value)
        for batch in arriving:
            kept: list[bool] = []
            for part in chunks([t or "" for t in batch.column("text").to_pylist()]):
                best, total, lettered = fitted.known(part, plain)
                slack = SURE * np.sqrt(total * least * (1 - least))
                kept += (lettered & (best + slack >= least * total)).tolist()
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(batches, docs.schema)
