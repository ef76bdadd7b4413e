"""Toxicity by a weighted finite-state pattern grammar over clauses.

1. A lexical transducer turns a clause's words into classes: insult and threat words with
   weights, words for a target, negators and verbs of reported speech. Insults are a short seed
   list and what the labelled rows teach: words and word stems (prefixes) whose documents are
   labelled far more often than chance explains, in several different contexts.
2. Three pattern transducers read the classes: one remembers a target, one a negation that is
   still open, one that the clause reports what somebody said. Their composition is one machine
   whose arcs say in which circumstances an insult or a threat was read. A clause is scored by
   its path; a word alone has no score.
3. A document's matched weights by circumstance give a logistic score. Its weights are fitted to
   the labelled rows and drawn to fixed prior weights, so circumstances that no row shows keep
   their prior.

Training reads about TRAIN_ROWS labelled rows (by a hash of the id, all if fewer): the
bound of the sample. Texts are scanned whole. Null and empty texts have no match and get the
score of such a text. Rows of ``labels`` that repeat an id count once, with the higher label;
without usable labels the prior decides. Repeated documents are scored each, other columns are
not read, an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import product
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplabel.llm.common import hash_sample, id_remainder, text_or_empty, written

TRAIN_ROWS = 20_000
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
# Learnt terms: at most so many, by evidence; stems are prefixes of these lengths.
LEXICON = 5_000
STEMS = (4, 5, 6, 7)
LEAST_EVIDENCE = 24.0
LEAST_WEIGHT = 2.0
LEAST_CONTEXTS = 4
# How many words a negator reaches.
NEGATED = 3

# Seeds and closed classes of the grammar, in English, German, French and Spanish.
INSULTS = (
    "idiot idiots moron morons stupid pathetic worthless disgusting scum loser losers trash clown imbecile "
    "dumb filthy dummkopf abschaum wertlos erbärmlich trottel crétin minable ordure pourriture nul imbécile "
    "estúpido estúpida escoria basura asqueroso patético inútil"
).split()
THREATS = "kill destroy hurt beat burn stab töten umbringen vernichten tuer détruire frapper matar destruir golpear".split()
TARGETS = (
    "you your yours he she they them him her his their these those people du dich dir ihr euch sie er tu te toi "
    "vous ils elles il elle vosotros ustedes usted ellos ellas él ella"
).split()
NEGATORS = "not never no isn't aren't wasn't don't doesn't nicht kein keine nie niemals pas jamais non nunca jamás tampoco".split()
REPORTS = (
    "said says claimed claims called quoted reported wrote according sagte sagt behauptet schrieb laut dit "
    "affirme écrit selon dijo dice afirma escribió según"
).split()

INSULT, THREAT, TARGET, NEGATOR, REPORT, OTHER = range(6)
CLASSES = {w.encode(): k for k, ws in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATOR, NEGATORS), (REPORT, REPORTS)) for w in ws}
# Seeds weigh as much as a word seen in labelled documents only, some thirty to one.
SEED_WEIGHT = 3.5

CIRCUMSTANCES = ("plain", "targeted", "negated", "reported", "threat")
PRIOR = np.array([-2.5, 2.3, 2.8, 0.4, 0.6, 1.2])
PULL = 0.5

CLAUSE = re.compile(r"[.!?;:\n\r]+")
# ASCII letters, digits, apostrophes and everything beyond ASCII are kept; the rest ends a word.
PLAIN = bytes(c if c in b"'" or 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
QUOTES = str.maketrans({q: " " for q in "«»“”„‘‚…–— ¡¿"})


def words_of(text: str) -> list[bytes]:
    low = text.lower()
    if not low.isascii() and any(q in low for q in "«»“”„‘‚…–— ¡¿"):
        low = low.translate(QUOTES)
    return low.replace("’", "'").encode("utf-8", "replace").translate(PLAIN).split()


# A pattern transducer: start state and step(state, class) -> state.
def target_machine():
    return 0, lambda state, c: 1 if c == TARGET else state


def negation_machine():
    return 0, lambda state, c: NEGATED if c == NEGATOR else max(state - 1, 0)


def report_machine():
    return 0, lambda state, c: 1 if c == REPORT else state


def compose() -> tuple[dict[tuple[int, int], int], dict[int, tuple[bool, bool, bool]], int]:
    """The product of the three machines: arcs, what holds in each state, start."""
    machines = [target_machine(), negation_machine(), report_machine()]
    sizes = (range(2), range(NEGATED + 1), range(2))
    number = {s: i for i, s in enumerate(product(*sizes))}
    arcs = {
        (number[s], c): number[tuple(step(x, c) for x, (_, step) in zip(s, machines))]
        for s in number
        for c in range(6)
    }
    holds = {i: (s[0] > 0, s[1] > 0, s[2] > 0) for s, i in number.items()}
    return arcs, holds, number[tuple(m[0] for m in machines)]


class Grammar:
    """``words`` and ``stems`` map terms to weights."""

    def __init__(self, words: dict[bytes, float], stems: dict[bytes, float]):
        self.words, self.stems = words, stems
        self.heads = {s[:3] for s in stems}
        self.longest = max(STEMS)
        self.arcs, self.holds, self.start = compose()

    def weight(self, word: bytes) -> float:
        """Of an insult; 0 for any other word."""
        if word in self.words:
            return self.words[word]
        if word[:3] not in self.heads:
            return 0.0
        letters = word.decode("utf-8", "replace")
        return max((self.stems.get(letters[:k].encode(), 0.0) for k in STEMS if len(letters) >= k), default=0.0)

    def features(self, text: str) -> list[float]:
        """log(1 + matched weight) for each circumstance."""
        sums = [0.0] * len(CIRCUMSTANCES)
        distinct = set(words_of(text))
        insults = {w: x for w in distinct if (w in self.words or w[:3] in self.heads) and (x := self.weight(w))}
        threats = {w for w in distinct if CLASSES.get(w) == THREAT}
        if insults or threats:
            for clause in CLAUSE.split(text):
                self.clause(words_of(clause), insults, sums)
        return [log1p(x) for x in sums]

    def clause(self, words: list[bytes], insults: dict[bytes, float], sums: list[float]) -> None:
        classes = [INSULT if w in insults else CLASSES.get(w, OTHER) for w in words]
        if INSULT not in classes and THREAT not in classes:
            return
        # A target counts wherever it stands in the clause: the machine reads the clause twice.
        state = self.start
        for c in classes:
            state = self.arcs[state, c]
        targeted = self.holds[state][0]
        state = self.start
        for word, c in zip(words, classes):
            state = self.arcs[state, c]
            _, negated, reported = self.holds[state]
            if c == INSULT:
                at = 2 if negated else 3 if reported else 1 if targeted else 0
                sums[at] += insults[word]
            elif c == THREAT and targeted and not negated and not reported:
                sums[4] += 1.0


def score(features: list[float], theta: np.ndarray) -> float:
    return 1.0 / (1.0 + exp(-min(max(theta[0] + float(np.dot(theta[1:], features)), -500.0), 500.0)))


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights drawn to the prior, by Newton's method; circumstances never lower a score."""
    theta = PRIOR.copy()
    x = np.hstack([np.ones((len(x), 1)), x])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (p - y) + PULL * (theta - PRIOR)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + PULL * np.eye(len(theta))
        step = np.linalg.solve(hessian, gradient)
        theta = theta - step
        if np.abs(step).max() < 1e-8:
            break
    theta[1:] = np.maximum(theta[1:], 0.0)
    return theta


def held_out() -> Column:
    return id_remainder(FOLDS) == HELD_OUT


def sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of about ``rows`` labelled documents outside the held-out fold; equal rows count once."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    each = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = hash_sample(each, ["doc_id"], rows, 3)
    # About ``rows`` ids and labels: a bounded broadcast, so the texts are read in place.
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    found = written(texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(), "labelled")
    # One id may stand for any number of texts.
    return hash_sample(found, ["doc_id", "text"], rows, 4).select("text", "toxic")


def learn(labelled: DataFrame) -> tuple[dict[bytes, float], dict[bytes, float]]:
    """Words and stems with weights, from (text, toxic)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, bool], list[int]] = defaultdict(lambda: [0, 0, 0])
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = words_of(text)
                # The word before is the context: copies of one passage show a word in one context only.
                context = {}
                if toxic:
                    for before, word in zip([b"", *words], words):
                        context[word] = context.get(word, 0) | 1 << (sum(before) % 63)
                terms: dict[tuple[str, bool], int] = {}
                for word in set(words):
                    letters = word.decode("utf-8", "replace")
                    if len(letters) < 3 or letters.isnumeric():
                        continue
                    bits = context.get(word, 0)
                    for term in ((letters, False), *((letters[:k], True) for k in STEMS if len(letters) >= k)):
                        terms[term] = terms.get(term, 0) | bits
                for term, bits in terms.items():
                    row = found[term]
                    row[0 if toxic else 1] += 1
                    row[2] |= bits
            keys = list(found)
            rows = np.array([found[k] for k in keys], np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.bool_()),
                    *[pa.array(rows[:, c], pa.int64()) for c in range(3)],
                ],
                ["term", "stem", "toxic", "clean", "contexts"],
            )

    sizes = labelled.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    bad, good = sizes[0] or 0, sizes[1] or 0
    if not bad or not good:
        return {}, {}
    rate = bad / (bad + good)
    with_, without = F.col("toxic"), F.col("clean")
    # Log-likelihood ratio of the labels of a term's documents against the labels of all.
    term_rate = with_ / (with_ + without)
    part = lambda n, p, q: F.when(n > 0, n * F.log(p / q)).otherwise(0.0)
    evidence = 2 * (part(with_, term_rate, F.lit(rate)) + part(without, 1 - term_rate, F.lit(1 - rate)))
    weight = F.log((with_ + 0.5) / (bad + 1)) - F.log((without + 0.5) / (good + 1))
    terms = (
        labelled.mapInArrow(counted, "term string, stem boolean, toxic long, clean long, contexts long")
        .groupBy("term", "stem")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_count(F.bit_or("contexts")).alias("contexts"))
        .where(with_ > 0)
        .withColumn("evidence", evidence)
        .withColumn("weight", weight)
        .where((F.col("evidence") >= LEAST_EVIDENCE) & (F.col("weight") >= LEAST_WEIGHT) & (F.col("contexts") >= LEAST_CONTEXTS))
        .orderBy(F.col("evidence").desc(), "term", "stem")
        .limit(LEXICON)
        .select("term", "stem", "weight")
        .collect()
    )
    words = {r["term"].encode(): r["weight"] for r in terms if not r["stem"]}
    stems = {r["term"].encode(): r["weight"] for r in terms if r["stem"]}
    return words, stems


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict:
    """``words``, ``stems`` and ``theta``."""
    labelled = sample(docs, labels, rows)
    words, stems = learn(labelled)
    words = {w.encode(): SEED_WEIGHT for w in INSULTS} | words

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(words, stems)
        for batch in batches:
            rows_ = [grammar.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows_, pa.list_(pa.float64())), batch.column("toxic")], ["x", "toxic"]
            )

    # Six numbers for each row of the bounded sample.
    got = labelled.mapInArrow(matched, "x array<double>, toxic int").collect()
    x = np.array([r["x"] for r in got]).reshape(-1, len(CIRCUMSTANCES))
    theta = fit(x, np.array([r["toxic"] for r in got], float)) if got else PRIOR
    return {"words": words, "stems": stems, "theta": theta}


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score and the matched weight by circumstance of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        grammar = Grammar(fitted["words"], fitted["stems"])
        for batch in arriving:
            found = [grammar.features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([score(x, fitted["theta"]) for x in found], pa.float64()),
                    *[pa.array([x[k] for x in found], pa.float64()) for k in range(len(CIRCUMSTANCES))],
                ],
                ["doc_id", "score", *CIRCUMSTANCES],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    extra = ", ".join(f"{c} double" for c in CIRCUMSTANCES)
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        batches, f"doc_id {kind}, score double, {extra}"
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's score, learnt from the labels outside the held-out fold."""
    return scored(docs, train(docs, labels)).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        *CIRCUMSTANCES,
    )
