"""Ranked lexical search of all documents for a set of queries: term-at-a-time, then document-at-a-time.

1. The queries' terms are dealt to blocks of at most ``block_terms`` terms and one query more. For
   each block one pass over the documents keeps, per document, its length and how often it holds
   each of the block's terms; numbers over all documents (N, L, document frequencies) follow.
2. Each task reads these rows in shards and inverts a shard to lists of (document, impact), sorted
   by document. A query's short lists are summed term at a time into accumulators. The accumulators
   are then one more list, with its largest sum as its bound, among the long lists.
3. These lists are walked document at a time, in windows of documents. Lists whose bounds together
   stay below the query's current last place find no documents of their own: they are only probed,
   by search, for documents that the others bring and that can still get in. So no document that
   belongs to the result is skipped, ties included.
4. A task hands on its best documents of each query; the best of these are the result.

Null texts have no terms. A document without terms counts neither in N nor in any result. Rows that
repeat a doc_id are documents of their own; null doc_ids come last among equal scores. Query rows
with one item_id are one query; a null item_id is an item as well; queries without terms have no
rows, as has an empty table. Long texts are cut into pieces between terms. Only doc_id and text, and
item_id and text, are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplabel.llm.common import written
from shiplabel.operators.scale import first_in_groups, rank_in_groups, running_total

PLACES = 50
BLOCK_TERMS = 200_000
# Bytes of text that are split at once.
PIECE = 1 << 20
# Postings of a shard, documents of a window, and the share of a shard's documents that short lists hold together.
SHARD_POSTINGS = 2_000_000
WINDOW = 4_096
SHORT_SHARE = 8

# Letters A-Z become small, other ASCII characters but digits and small letters separate terms.
FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: str | None, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists that each come from about ``piece`` bytes."""
    data = (text or "").encode().translate(FOLDED)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + piece)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def query_terms(queries: DataFrame) -> DataFrame:
    """(item_id, term) of all queries, each once."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for item, text in zip(batch.column("item_id"), batch.column("text"), strict=True):
                terms = list({t for part in terms_of(text.as_py()) for t in part})
                if terms:
                    items = pa.array([item.as_py()] * len(terms), batch.schema.field("item_id").type)
                    yield pa.RecordBatch.from_arrays([items, pa.array(terms, pa.binary())], ["item_id", "term"])

    kind = queries.schema["item_id"].dataType.simpleString()
    return queries.select("item_id", "text").mapInArrow(batches, f"item_id {kind}, term binary").distinct()


def in_blocks(terms: DataFrame, block_terms: int) -> DataFrame:
    """``terms`` with ``item`` (a number for each item_id from 0) and ``block``: at most ``block_terms`` terms and one item."""
    items = terms.groupBy("item_id").agg(F.count("*").alias("n"))
    ranked = rank_in_groups(items, [], ["item_id"], "place").withColumn("item", F.col("place") - 1)
    before = running_total(ranked, "n", [], "item", "before")
    block = F.expr(f"before div {block_terms}")
    dealt = before.select(F.col("item_id").alias("id"), "item", block.alias("block"))
    return terms.join(dealt, F.col("item_id").eqNullSafe(F.col("id"))).drop("id")


def matched(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (all terms of the document), and which numbers of ``vocabulary`` it holds how often."""
    numbers = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value.get
        for batch in found:
            lengths, held, often = [], [], []
            for text in batch.column("text"):
                n, parts = 0, [np.empty(0, np.int32)]
                for terms in terms_of(text.as_py()):
                    n += len(terms)
                    parts.append(np.array([i for i in map(number, terms) if i is not None], np.int32))
                ids, times = np.unique(np.concatenate(parts), return_counts=True)
                lengths.append(n)
                held.append(ids.tobytes())
                often.append(times.astype(np.int32).tobytes())
            columns = [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(held, pa.binary()), pa.array(often, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(batches, f"doc_id {kind}, n long, terms binary, times binary")


def _joined(column: pa.Array, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def holders(rows: DataFrame, size: int) -> np.ndarray:
    """For each of ``size`` terms the number of documents that hold it."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in found:
            total += np.bincount(_joined(batch.column("terms"), np.int32), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "n"])

    out = np.zeros(size, np.int64)
    sums = rows.select("terms").mapInArrow(batches, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    out[sums["term"]] = sums["n"]
    return out


@dataclass
class Best:
    """The best documents of a query so far, by score, then by doc_id with nulls last."""

    places: int
    scores: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    none: np.ndarray = field(default_factory=lambda: np.empty(0, bool))

    @property
    def least(self) -> int:
        """The score a document needs to get in, if its doc_id is small enough."""
        return int(self.scores[-1]) if len(self.scores) == self.places else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        scores, ids, none = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.none, none)))
        order = np.lexsort((ids, none, -scores))[: self.places]
        self.scores, self.ids, self.none = scores[order], ids[order], none[order]


@dataclass
class Shard:
    """Documents by number, and for each term its documents in order with what it adds to their scores."""

    ids: np.ndarray
    none: np.ndarray
    docs: np.ndarray
    impacts: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, batches: list[pa.RecordBatch], weights: np.ndarray, documents: int, length: int) -> Shard:
        column = lambda name: pa.concat_arrays([b.column(name) for b in batches])
        n, held = column("n").to_numpy(), column("terms")
        terms, times = _joined(held, np.int32), _joined(column("times"), np.int32).astype(np.int64)
        owner = np.repeat(np.arange(len(n)), [len(t) // 4 for t in held.to_pylist()])
        m = 100 - 50 + (50 * n * documents) // length
        impacts = weights[terms] * ((1_000_000_000 * times) // (1000 * times + 20 * m[owner]))
        order = np.argsort(terms, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(weights)))])
        ids = column("doc_id")
        return cls(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(False), owner[order], impacts[order], starts)

    def lists(self, terms: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(documents, impacts) of the terms, the shortest first; terms that add nothing are left out."""
        found = [slice(self.starts[t], self.starts[t + 1]) for t in terms]
        held = [(self.docs[s], self.impacts[s]) for s in found if s.stop > s.start and self.impacts[s].any()]
        return sorted(held, key=lambda x: len(x[0]))

    def search(self, terms: np.ndarray, best: Best, window: int = WINDOW, short_share: int = SHORT_SHARE) -> None:
        lists = self.lists(terms)
        together = np.cumsum([len(d) for d, _ in lists])
        short = int(np.searchsorted(together, len(self.ids) // short_share, "right"))
        if short > 1:
            lists = [accumulated(lists[:short]), *lists[short:]]
        lists.sort(key=lambda x: int(x[1].max()))
        # What the first j lists can add together.
        bounds = np.concatenate([[0], np.cumsum([int(v.max()) for _, v in lists])]).astype(np.int64)
        for low in range(0, len(self.ids), window):
            # Lists before ``first`` alone bring no document in.
            first = int(np.searchsorted(bounds[1:], best.least))
            if first == len(lists):
                return
            sums = np.zeros(window, np.int64)
            for docs, values in lists[first:]:
                here = slice(*np.searchsorted(docs, (low, low + window)))
                sums[docs[here] - low] += values[here]
            able = np.flatnonzero(sums)
            for j in range(first - 1, -1, -1):
                able = able[sums[able] + bounds[j + 1] >= best.least]
                if not len(able):
                    break
                docs, values = lists[j]
                at = np.minimum(np.searchsorted(docs, able + low), len(docs) - 1)
                sums[able] += np.where(docs[at] == able + low, values[at], 0)
            able = able[sums[able] >= best.least]
            if len(able):
                best.add(sums[able], self.ids[able + low], self.none[able + low])


def accumulated(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: the sums of several lists as one list."""
    docs, values = np.concatenate([d for d, _ in lists]), np.concatenate([v for _, v in lists])
    order = np.argsort(docs, kind="stable")
    docs, starts = np.unique(docs[order], return_index=True)
    return docs, np.add.reduceat(values[order], starts)


def best_of_tasks(
    rows: DataFrame, items: dict[int, np.ndarray], weights: np.ndarray, documents: int, length: int, places: int, postings: int
) -> DataFrame:
    """(item, doc_id, score): the best documents that each task has seen, for every query."""
    shared = rows.sparkSession.sparkContext.broadcast((items, weights))

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        best = {item: Best(places) for item in items}
        held, size = [], 0

        def searched() -> None:
            shard = Shard.of(held, weights, documents, length)
            for item, terms in items.items():
                shard.search(terms, best[item])

        for batch in found:
            held.append(batch)
            size += batch.column("terms").nbytes // 4
            if size >= postings:
                searched()
                held, size = [], 0
        if held:
            searched()
        for item, top in best.items():
            if len(top.scores):
                ids = pa.array(top.ids, kind, mask=top.none)
                columns = [pa.array([item] * len(ids), pa.int64()), ids, pa.array(top.scores)]
                yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    kind = pa.int64()
    return rows.where("n > 0").mapInArrow(batches, "item long, doc_id long, score long")


def ranked(docs: DataFrame, queries: DataFrame, places: int = PLACES, block_terms: int = BLOCK_TERMS, postings: int = SHARD_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id and score of each query's best documents. ``doc_id`` must be a whole number."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = written(in_blocks(query_terms(queries), block_terms), "wanted")
    found = []
    for block in range((wanted.agg(F.max("block")).first()[0] or 0) + 1):
        pairs = wanted.where(F.col("block") == block).select("item", "term").collect()
        vocabulary = sorted({bytes(r["term"]) for r in pairs})
        number = {t: i for i, t in enumerate(vocabulary)}
        terms: dict[int, list[int]] = {}
        for r in pairs:
            terms.setdefault(r["item"], []).append(number[bytes(r["term"])])
        items = {item: np.array(sorted(t)) for item, t in sorted(terms.items())}
        rows = written(matched(docs, vocabulary), "matched")
        documents, length = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = holders(rows, len(vocabulary)).tolist()
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df], np.int64)
        found.append(best_of_tasks(rows, items, weights, documents, max(length, 1), places, postings))
    best = reduce(DataFrame.union, found).select("*", (-F.col("score")).alias("down"), F.col("doc_id").isNull().alias("none"))
    first = first_in_groups(best, ["item"], ["down", "none", "doc_id"], places, "rank")
    names = wanted.select("item", "item_id").distinct()
    return first.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
q AS (
  SELECT DISTINCT item_id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
postings AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, n, term
),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, s GROUP BY term, n_docs
),
scores AS (
  SELECT item_id, r, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms))))) AS BIGINT) AS score
  FROM q JOIN postings USING (term) JOIN weights USING (term), s GROUP BY item_id, r, doc_id
),
places AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS "rank", doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, "rank", doc_id, score FROM places WHERE "rank" <= 50
"""
