"""Lexical retrieval packing: sequences of lexically related documents, by a sharded BM25 index.

1. Documents are tokenised once and written as packed token ids, with a MinHash signature of
   their terms (token ids). Document frequencies are counted over all documents; the vocabulary
   bounds that table.
2. The documents are range-partitioned by signature, so like documents lie together, and a group
   of copies of any size spreads over as many partitions as it fills. A partition is read in
   shards of bounded tokens; each shard has an inverted index with BM25 weights.
3. A seed document opens a window. While the window has room, the index returns the unused
   document of the shard that scores highest against the seed, and its tokens fill the room. A
   document that does not fit is cut there, and its rest is the seed of the next window. A window
   that a shard cannot fill goes on with the next shard, so only the last window of a partition
   is padded.

Terms that more than half of all documents hold have no weight in BM25 (idf is floored at zero),
so they are left out of the index; all others are in it and in every query.

Null texts count as empty and have only the end id. Every token of every row is in exactly one
piece; rows that repeat an id are documents of their own, with pieces of their own. An empty
table gives no pieces. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shiplabel.llm.common import new_path, text_or_empty

LENGTH = 1024
END = 0
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
# The same vocabulary as ranks, for the faster library. None: the tokenizer file alone.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
K1, B = 1.2, 0.75
# Tokens and documents of a shard (one longer document makes a shard of its own), tokens of a partition.
SHARD_TOKENS = 1_000_000
SHARD_DOCS = 512
PARTITION_TOKENS = 6_000_000
# Characters of texts that are encoded together.
TOGETHER = 4_000_000


class Encoder:
    """Token ids of whole texts as packed unsigned 16-bit numbers.

    Byte-level BPE cuts a text before it merges, and in plain text it cuts at every space (which
    goes with the word after it) and at every single line break. So these pieces can be encoded
    apart: each distinct one of many texts once, all in one call, a line break between them. Texts
    with other white space, runs of it, or letters beyond Latin are encoded as a whole, by the
    tokenizer itself.
    """

    PLAIN = re.compile("[\n -~¡-¬®-ɏ]*")

    def __init__(self, tokenizer: str = TOKENIZER, ranks: str | None = RANKS):
        self.path, self.whole, self.fast = tokenizer, None, None
        if ranks is None:
            return
        import base64

        import tiktoken

        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
        (self.line,) = self.fast.encode_ordinary("\n")

    def by_tokenizer(self, text: str) -> bytes:
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
            self.whole.encode_special_tokens = True
            if self.whole.get_vocab_size() > 1 << 16:
                raise ValueError("token ids must fit into 16 bits")
        return array("H", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def plain(self, text: str) -> bool:
        return (
            self.fast is not None
            and "  " not in text
            and "\n " not in text
            and " \n" not in text
            and "\n\n\n" not in text
            and not text.endswith((" ", "\n\n"))
            and self.PLAIN.fullmatch(text) is not None
        )

    def by_pieces(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of plain texts. They hold no control characters: a zero marks the cuts, a one stands for a line break."""
        cut = pc.split_pattern(pa.array([t.replace(" ", "\0 ").replace("\n", "\0\1\0") for t in texts], pa.string()), "\0")
        words = cut.flatten().dictionary_encode()
        empty, line = pc.equal(words.dictionary, ""), pc.equal(words.dictionary, "\1")
        # No two line breaks may meet, so an empty piece is not joined as it is.
        apart = pc.if_else(empty, "\1", words.dictionary)
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(apart)], apart), "\n")[0].as_py()
        ids = np.append(self.fast.encode_to_numpy(joined).astype(np.uint16), np.uint16(self.line))
        stops = np.flatnonzero(ids == self.line)
        firsts = np.concatenate([[0], stops[:-1] + 1])
        sizes = stops - firsts
        line = line.to_numpy(zero_copy_only=False)
        firsts[line], sizes[line] = len(ids) - 1, 1
        sizes[empty.to_numpy(zero_copy_only=False)] = 0
        which = words.indices.to_numpy()
        n = sizes[which]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(ends[-1]) + np.repeat(firsts[which] - ends[:-1], n)
        found = ids[at]
        for first, last in pairwise(ends[cut.offsets.to_numpy()].tolist()):
            yield found[first:last].tobytes()

    def parts(self, text: str) -> Iterator[str]:
        """A plain text in parts of about TOGETHER characters, cut before spaces."""
        start = 0
        while len(text) - start > 2 * TOGETHER and (stop := text.find(" ", start + TOGETHER)) > 0:
            yield text[start:stop]
            start = stop
        yield text[start:]

    def __call__(self, text: str) -> bytes:
        if not self.plain(text):
            return self.by_tokenizer(text)
        return b"".join(ids for part in self.parts(text) for ids in self.by_pieces([part]))

    def each(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of every text, in order; plain ones that lie side by side are encoded together."""
        held: list[str] = []
        size = 0
        for text in texts:
            alone = len(text) > TOGETHER or not self.plain(text)
            if held and (alone or size + len(text) > TOGETHER):
                yield from self.by_pieces(held)
                held, size = [], 0
            if alone:
                yield self(text)
            else:
                held.append(text)
                size += len(text)
        if held:
            yield from self.by_pieces(held)


def distinct(ids: np.ndarray) -> np.ndarray:
    """The distinct numbers, sorted; short numbers sort by radix, which is faster than hashing them."""
    ids = np.sort(ids, kind="stable")
    first = np.ones(len(ids), bool)
    np.not_equal(ids[1:], ids[:-1], out=first[1:])
    return ids[first]


def _signature(terms: np.ndarray) -> int:
    """Two MinHash values of the terms, one above the other: like documents sort together.

    Long documents have lesser minima, so the minima are mixed once more: no range gets most of the tokens.
    """
    if not len(terms):
        return 0
    with np.errstate(over="ignore"):
        hashed = [(terms + np.uint64(s)) * np.uint64(m) for s, m in ((1, 0x9E3779B97F4A7C15), (77, 0xC2B2AE3D27D4EB4F))]
    a, b = ((int((h >> np.uint64(33)).min()) * 0x5851F42D4C957F2D >> 16) & 0x7FFFFFFF for h in hashed)
    return a << 31 | b


def tokenised(docs: DataFrame, tokenizer: str = TOKENIZER, ranks: str | None = RANKS) -> DataFrame:
    """doc_id, ids, n, signature of all documents; one more row per task holds its document frequencies."""

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer, ranks)
        held = np.zeros(1 << 16, np.int64)
        kind = None

        def rows(ids, values, signatures, counted):
            return pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(values, pa.binary()),
                    pa.array([len(v) // 2 for v in values], pa.int64()),
                    pa.array(signatures, pa.int64()),
                    pa.array([counted] * len(values), pa.bool_()),
                ],
                ["doc_id", "ids", "n", "signature", "counted"],
            )

        for batch in arriving:
            kind = batch.column("doc_id").type
            values, signatures = [], []
            for ids in encode.each(text.as_py() for text in batch.column("text")):
                terms = distinct(np.frombuffer(ids, np.uint16))
                held[terms] += 1
                signatures.append(_signature(terms.astype(np.uint64)))
                values.append(ids + END.to_bytes(2, "little"))
            yield rows(batch.column("doc_id"), values, signatures, False)
        if kind is not None:
            yield rows(pa.nulls(1, kind), [held.tobytes()], [0], True)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        batches, f"doc_id {kind}, ids binary, n long, signature long, counted boolean"
    )


def document_frequencies(tokens: DataFrame) -> np.ndarray:
    """How many documents hold each term, summed over the tasks' counts."""

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in arriving:
            for counts in batch.column("ids"):
                total += np.frombuffer(counts.as_py(), np.int64)
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(total[term], pa.int64())], ["term", "n"])

    out = np.zeros(1 << 16, np.int64)
    counts = tokens.where("counted").select("ids").mapInArrow(batches, "term long, n long")
    # One row for each token of the vocabulary.
    for row in counts.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row["term"]] = row["n"]
    return out


class Shard:
    """An inverted index over some documents: postings by term, with BM25 weights."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        flat = np.concatenate(docs)
        owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        weighty = idf[flat] > 0
        pairs, counts = np.unique((flat[weighty].astype(np.int64) << 32) | owner[weighty], return_counts=True)
        self.terms, self.docs = pairs >> 32, pairs & 0xFFFFFFFF
        size = np.array([len(d) for d in docs])[self.docs]
        self.weights = idf[self.terms] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * size / mean))
        self.size = len(docs)
        # Where a term's postings start; postings are sorted by term.
        self.starts = np.searchsorted(self.terms, np.arange((1 << 16) + 1))

    def scores(self, query: np.ndarray) -> np.ndarray:
        """BM25 of every document against the distinct terms of a query."""
        first, last = self.starts[query], self.starts[query.astype(np.int64) + 1]
        sizes = last - first
        total = int(sizes.sum())
        if not total:
            return np.zeros(self.size)
        at = np.arange(total) + np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        return np.bincount(self.docs[at], weights=self.weights[at], minlength=self.size)


class Packer:
    """Fills windows with one shard after the other; pieces are (doc, start, length, window, offset)."""

    def __init__(self, length: int, idf: np.ndarray, mean: float):
        self.length, self.idf, self.mean = length, idf, mean
        self.window, self.room = 0, length
        self.query: np.ndarray | None = None

    def add(self, docs: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        shard = Shard(docs, self.idf, self.mean)
        unused = np.ones(len(docs), bool)
        scores = None
        for _ in docs:
            if self.query is None:
                # No open window: the first unused document in signature order is the seed.
                pick = int(unused.argmax())
                self.query, scores = self.terms(docs[pick]), None
            else:
                if scores is None:
                    scores = shard.scores(self.query)
                pick = int(np.where(unused, scores, -1.0).argmax())
            unused[pick] = False
            start = 0
            while start < len(docs[pick]):
                take = min(self.room, len(docs[pick]) - start)
                yield pick, start, take, self.window, self.length - self.room
                start += take
                self.room -= take
                if not self.room:
                    self.window, self.room = self.window + 1, self.length
                    # A rest is the seed of the next window.
                    self.query, scores = (self.terms(docs[pick]) if start < len(docs[pick]) else None), None

    def terms(self, doc: np.ndarray) -> np.ndarray:
        found = distinct(doc)
        return found[self.idf[found] > 0]


def shards(arriving: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(doc_ids, token ids) of shards of bounded size."""
    keys: list = []
    docs: list[np.ndarray] = []
    size = 0
    for batch in arriving:
        for key, ids in zip(batch.column("doc_id"), batch.column("ids")):
            doc = np.frombuffer(ids.as_py(), np.uint16)
            if docs and (len(docs) >= SHARD_DOCS or size + len(doc) > SHARD_TOKENS):
                yield keys, docs
                keys, docs, size = [], [], 0
            keys.append(key.as_py())
            docs.append(doc)
            size += len(doc)
    if docs:
        yield keys, docs


def packed(docs: DataFrame, length: int = LENGTH, tokenizer: str = TOKENIZER, ranks: str | None = RANKS) -> DataFrame:
    """The pieces of all documents: which tokens lie where in which sequence."""
    spark = docs.sparkSession
    path = new_path(spark, "tokens")
    arranged = tokenised(docs, tokenizer, ranks)
    arranged.write.option("compression", "zstd").parquet(path)
    tokens = spark.read.schema(arranged.schema).parquet(path)
    rows = tokens.where(~F.col("counted"))
    count, total = rows.agg(F.count("*"), F.sum("n")).first()
    held = document_frequencies(tokens)
    idf = np.where(held > 0, np.maximum(0.0, np.log((count - held + 0.5) / (held + 0.5))), 0.0)
    idf[END] = 0.0
    mean = (total or 1) / max(count, 1)
    shared = spark.sparkContext.broadcast((idf, mean))
    key_type = docs.schema["doc_id"].dataType
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(length, *shared.value)
        base = TaskContext.get().partitionId() << 32
        for keys, ids in shards(arriving):
            wide = [d.astype("<u4") for d in ids]
            found = [
                (keys[d], start, take, zlib.crc32(wide[d][start : start + take].tobytes()), len(ids[d]), base + window, offset)
                for d, start, take, window, offset in packer.add(ids)
            ]
            columns = list(zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], key_kind), *[pa.array(c, pa.int64()) for c in columns[1:]]], names
            )

    key_kind = to_arrow_type(key_type)
    schema = T.StructType([T.StructField("doc_id", key_type), *[T.StructField(n, T.LongType()) for n in names[1:]]])
    order = ["signature", "doc_id", "n", F.xxhash64("ids")]
    parts = max(1, -(-(total or 0) // PARTITION_TOKENS))
    return (
        rows.select("doc_id", "ids", "n", "signature")
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "ids")
        .mapInArrow(batches, schema)
    )
