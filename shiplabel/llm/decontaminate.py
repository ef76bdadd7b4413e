"""Benchmark decontamination by a hash set of test n-grams.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower
case. Windows of an item are its runs of ``window`` words, or the whole item if it has fewer.
All windows go into a table of 64-bit hashes, broadcast in blocks of at most BLOCK_WORDS
benchmark words (a block is a proven bound; a larger benchmark takes more blocks, all against
all rows). A task rolls the same hash over a document's words, keeps the positions whose hash
is in the table, and verifies each against the words of the window, so collisions cost nothing
but time. Hits are kept as word spans, from which counts, and cut or dropped texts follow.

Null and empty texts and items have no words. Items that share an item_id are one item; an item
without an id hits but is not listed. Repeated documents give one row each. Empty tables give no
rows, or no hits. Only doc_id, text and item_id are read for the report; the filter returns all
columns as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplabel.llm.common import text_or_empty, unused, written
from shiplabel.operators.scale import skew_join

WINDOW = 10
# Benchmark words per broadcast block: with hashes, words and postings some 60 MB.
BLOCK_WORDS = 500_000
# Document words matched at once inside a task.
DOC_WORDS = 500_000
# A document that is benchmark text for the most part goes as a whole when spans are cut.
MOSTLY = 0.5
FACTOR = np.uint64(0x9E3779B97F4A7C15)

# A-Z to lower case, all other ASCII that is no letter or digit to a space, bytes beyond ASCII as they are.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def parts_of(text: str | None, most: int, window: int) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first word, words) of parts of a text; each repeats the ``window`` - 1 words before it.

    A part has about ``most`` new words: after every 8 * ``most`` bytes it is cut where no word is.
    """
    plain = (text or "").encode("utf-8", "surrogatepass").translate(PLAIN)
    before: list[bytes] = []
    number = start = 0
    while start < len(plain):
        stop = plain.find(b" ", start + 8 * most)
        stop = len(plain) if stop < 0 else stop
        words = plain[start:stop].split()
        yield number - len(before), before + words
        number += len(words)
        before = (before + words)[-(window - 1) :] if window > 1 else []
        start = stop


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that meet united."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(PLAIN).split()


def _hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` ids from each position on."""
    out = np.zeros(len(ids) - width + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = (out ^ ids[k : len(ids) - width + 1 + k]) * FACTOR
            out ^= out >> np.uint64(29)
    return out


class Windows:
    """The windows of one block of items, by width, with the items that hold each."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.numbers: dict[bytes, int] = {}
        self.items: dict[int, dict[bytes, set[str]]] = {}
        for item_id, text in items:
            ids = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)], np.uint64)
            if not len(ids):
                continue
            width = min(window, len(ids))
            at_width = self.items.setdefault(width, {})
            for at in range(len(ids) - width + 1):
                held = at_width.setdefault(ids[at : at + width].tobytes(), set())
                if item_id is not None:
                    held.add(item_id)
        self.hashes = {
            width: np.unique(
                np.concatenate([_hashes(np.frombuffer(key, np.uint64), width) for key in at_width])
            )
            for width, at_width in self.items.items()
        }

    def hits(self, docs: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[str]]]:
        """For each document the merged word spans that are hit, and the items found."""
        found: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in docs]
        starts = np.cumsum([0, *[len(d) + 1 for d in docs]])
        ids = np.zeros(starts[-1], np.uint64)  # 0: no benchmark word, and between documents
        get = self.numbers.get
        for d, at in zip(docs, starts):
            ids[at : at + len(d)] = [get(w, 0) for w in d]
        # Length of the run of benchmark words from each position on.
        unknown = np.flatnonzero(ids == 0)
        places = np.arange(len(ids))
        run = unknown[np.searchsorted(unknown, places)] - places if len(ids) else places
        raw: dict[int, list[tuple[int, int]]] = {}
        for width, table in self.hashes.items():
            likely = np.flatnonzero(run >= width)
            if not len(likely):
                continue
            rows = ids[likely[:, None] + np.arange(width)]
            with np.errstate(over="ignore"):
                value = np.zeros(len(likely), np.uint64)
                for k in range(width):
                    value = (value ^ rows[:, k]) * FACTOR
                    value ^= value >> np.uint64(29)
            slot = np.minimum(np.searchsorted(table, value), len(table) - 1)
            for n in np.flatnonzero(table[slot] == value):
                at = int(likely[n])
                items = self.items[width].get(rows[n].tobytes())
                if items is not None:
                    d = int(np.searchsorted(starts, at, side="right")) - 1
                    raw.setdefault(d, []).append((at - int(starts[d]), at - int(starts[d]) + width))
                    found[d][1].update(items)
        for d, spans in raw.items():
            found[d][0].extend(merged(spans))
        return found


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str | None, str]]]:
    """The items in blocks of at most ``block_words`` words (or one longer item), streamed from the cluster."""
    rows = benchmark.where(F.length("text") > 0).select(F.col("item_id").cast("string").alias("i"), "text")
    held: list[tuple[str | None, str]] = []
    size = 0
    for row in rows.toLocalIterator():
        n = len(words_of(row["text"]))
        if held and size + n > block_words:
            yield held
            held, size = [], 0
        held.append((row["i"], row["text"]))
        size += n
    yield held


FOUND = "n_words long, spans array<struct<start:long,stop:long>>, items array<string>"


def _found(docs: DataFrame, items: list[tuple[str | None, str]], window: int, keys: list[str]) -> DataFrame:
    """Keys, word count, hit spans and items of each document for one block of the benchmark."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Windows(shared.value, window)
        for batch in arriving:
            counts = [0] * batch.num_rows
            hits: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in counts]
            held: list[tuple[int, int, list[bytes]]] = []

            def match():
                for (row, first, _), (spans, items) in zip(held, table.hits([part for _, _, part in held]), strict=True):
                    hits[row][0].extend((first + a, first + b) for a, b in spans)
                    hits[row][1].update(items)
                held.clear()

            size = 0
            for row, text in enumerate(batch.column("__text")):
                for first, part in parts_of(text.as_py(), DOC_WORDS, window):
                    held.append((row, first, part))
                    counts[row] = first + len(part)
                    size += len(part)
                    if size >= DOC_WORDS:
                        match()
                        size = 0
            match()
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(k) for k in keys],
                    pa.array(counts, pa.int64()),
                    pa.array([[{"start": a, "stop": b} for a, b in merged(h[0])] for h in hits], span),
                    pa.array([sorted(h[1]) for h in hits], pa.list_(pa.string())),
                ],
                [*keys, "n_words", "spans", "items"],
            )

    kinds = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, F.col("text").alias("__text")).mapInArrow(batches, f"{kinds}, {FOUND}")


def hit_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, content (a hash of the text), n_words, spans and items of every document."""
    keyed = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("content"), text_or_empty().alias("text"))
    keys = ["doc_id", "content"]
    parts = [_found(keyed, items, window, keys) for items in blocks(benchmark, block_words)]
    if len(parts) == 1:
        return parts[0]
    # Several blocks: what they found in a text is united. Copies are found alike, so one of each is united.
    united = parts[0].withColumn("block", F.lit(0))
    for k, part in enumerate(parts[1:], 1):
        united = united.union(part.withColumn("block", F.lit(k)))
    text_key = F.xxhash64(F.col("doc_id").isNull(), *keys).alias("key")
    united = written(united.select(text_key, "*", F.monotonically_increasing_id().alias("row")), "hits")
    rows = united.where("block = 0").select("key", *keys, "n_words", "row")
    hit = united.where(F.size("spans") > 0).dropDuplicates(["key", "block"])
    grouped = hit.groupBy("key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("sorted"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    # Spans sorted by start: the furthest stop before a span decides whether it opens a new one.
    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    meeting = F.aggregate(
        "sorted",
        empty,
        lambda held, s: F.when(
            (F.size(held) > 0) & (F.element_at(held, -1).stop >= s.start),
            F.concat(
                F.slice(held, 1, F.size(held) - 1),
                F.array(
                    F.struct(
                        F.element_at(held, -1).start.alias("start"),
                        F.greatest(F.element_at(held, -1).stop, s.stop).alias("stop"),
                    )
                ),
            ),
        ).otherwise(F.concat(held, F.array(s))),
    )
    found = skew_join(rows, grouped.select("key", meeting.alias("spans"), "items"), ["key"], "left", ["row"])
    none = F.array().cast("array<string>")
    return found.select(*keys, "n_words", F.coalesce("spans", empty).alias("spans"), F.coalesce("items", none).alias("items"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: words, hit words, items found and their digest, whether it is contaminated."""
    zero = F.lit(0).cast("bigint")
    n_hit = F.aggregate("spans", zero, lambda n, s: n + s.stop - s.start)
    return (
        hit_spans(docs, benchmark, window, block_words)
        .withColumn("n_hit", n_hit)
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.size("items").cast("bigint").alias("n_items"),
            F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
        )
    )


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans (and what stands between them)."""
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    out.append(text[at:])
    return "".join(out)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    remove: str = "spans",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    mostly: float = MOSTLY,
) -> DataFrame:
    """``docs`` without benchmark text: ``remove`` cuts hit ``spans`` or drops hit ``documents``.

    When cutting, a document goes as a whole if more than ``mostly`` of its words are hit. A cut
    can bring the words around a span together to a new hit, so cut texts are cut again until
    none is left. All columns are kept; n_chars follows the text.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove must be spans or documents, not {remove}")
    content = F.xxhash64(text_or_empty())
    found = hit_spans(docs, benchmark, window, block_words).where(F.size("spans") > 0).dropDuplicates(["doc_id", "content"])
    id_name, content_name, words, spans, items, own = unused(docs, "id", "content", "words", "spans", "items", "own")
    hits = written(found.toDF(id_name, content_name, words, spans, items), "hit")
    here = docs.withColumn(own, content)
    on = F.col("doc_id").eqNullSafe(F.col(id_name)) & (F.col(own) == F.col(content_name))
    clean = here.join(hits, on, "left_anti").select(*docs.columns)
    if remove == "documents" or hits.isEmpty():
        return clean
    dirty = here.join(hits.drop(items), on)
    n_hit = F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s.stop - s.start)
    schema = docs.schema

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arriving:
            texts = [
                cut(t, [(s["start"], s["stop"]) for s in found])
                for t, found in zip(batch.column("text").to_pylist(), batch.column(spans).to_pylist())
            ]
            columns = {n: batch.column(n) for n in batch.schema.names if n != spans}
            columns["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kept = dirty.where(n_hit <= mostly * F.col(words)).select(*docs.columns, spans)
    less = kept.mapInArrow(batches, schema)
    if "n_chars" in docs.columns:
        less = less.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType))
    again = decontaminate(written(less, "cut"), benchmark, remove, window, block_words, mostly)
    return clean.unionByName(again)


ORACLE_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT *, least(10, len(w)) AS width FROM item WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, width, array_to_string(w[pos:pos + width - 1], ' ') AS gram
  FROM (SELECT item_id, width, w, unnest(range(1, len(w) - width + 2)) AS pos FROM sized)),
gram AS (
  SELECT row_id, width, pos, array_to_string(w[pos:pos + width - 1], ' ') AS gram
  FROM (SELECT row_id, w, width, unnest(range(1, len(w) - width + 2)) AS pos
        FROM doc, (SELECT DISTINCT width FROM sized) WHERE len(w) >= width)),
hit AS (SELECT row_id, pos, gram.width, item_id FROM gram JOIN win ON gram.gram = win.gram AND gram.width = win.width),
word AS (SELECT row_id, count(DISTINCT place) AS n_hit
  FROM (SELECT row_id, unnest(range(pos, pos + width)) AS place FROM (SELECT DISTINCT row_id, pos, width FROM hit)) GROUP BY row_id),
named AS (SELECT row_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT row_id, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY row_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (row_id) LEFT JOIN named USING (row_id)
"""
