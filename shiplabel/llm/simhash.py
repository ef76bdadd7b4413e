"""SimHash near-duplicate groups, found with vantage-point trees over Hamming distance.

1. Each whole text gets a 64-bit fingerprint (``fingerprint``). Equal fingerprints are one node.
2. A tree of vantage points is fitted on a bounded sample of fingerprints. A node of the tree
   sends fingerprints within its radius inside and all others outside; those up to ``reach``
   beyond the radius are sent inside as well. By the triangle inequality two fingerprints at
   most ``reach`` apart then meet in some shard, so no pair is lost, whatever the sample was.
3. A shard is split again by vantage points of its own and finished by comparing blocks, exactly.
   A shard that will not split (a ball of near copies) is dealt to several tasks by pairs of
   chunks. A task returns a star for each group it sees, never its pairs.
4. Stars are contracted to components by alternating large-star and small-star steps.

``one_of_each`` with a least similarity runs steps 1 to 4, too, on fingerprints of shingle sets, and
checks each link it found on the exact sets. Two texts that share 0.8 of their shingles may differ in 20
of 64 bits, but above a reach of 2 no vantage point splits random fingerprints. So a second search adds
the pairs further apart, by bands of MinHash values: texts that share a band and are not linked yet are
compared on shingle hashes, first with the smallest of the band, then with each other where that
leaves more than one group. Texts themselves never move.

Null and empty texts have fingerprint zero and link like any other. A component is named by its
smallest doc_id; null ids belong to components but name none. Repeated rows are one node and
give one row each. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplabel.llm.common import bit_table, hash_sample, text_or_empty, unused, written
from shiplabel.operators.scale import skew_join

SHINGLE = 3
REACH = 2
SEED = 42
BITS = 64
# Sample for the vantage points (8 bytes each, on the driver) and fingerprints aimed at per shard.
SAMPLE = 65_536
SHARD = 2_048
# Largest chunk of a shard that will not split; a task compares two of them at most.
CHUNK = 8_192
# Fingerprints compared at once inside a task, and shingles counted at once.
BLOCK = 512
COUNTED = 32_768
# Near copies by exact shingle sets: words of a shingle and least Jaccard similarity; bands and the MinHash values of
# each (a pair of similarity 0.8 shares a band with probability 0.9996), shingles mixed at once, shingles of a
# comparing task, bits for the documents whose sets are compared.
SIMILAR_SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 20, 5
MIXED = 4_096
VERIFIED = 1_000_000
HELD_BITS = 1 << 24
# Most rows of the table that says which documents may go.
PARTS = 1 << 20
# A split must save this part of the comparisons, else the shard stays whole.
GAIN = 0.2
VANTAGES = 12


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority bits of the XXH64 hashes of a text's word shingles, as a signed 64-bit number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    stops = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *stops]
    digest = xxhash.xxh64_digest
    spans = zip(starts, stops[shingle - 1 :]) if len(words) > shingle else [(0, len(joined) + 1)]
    hashes = np.frombuffer(b"".join([digest(joined[a : b - 1], seed) for a, b in spans]), np.uint8)
    return majority(hashes.reshape(-1, BITS // 8))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes (a row of 8 bytes each), as a signed 64-bit number."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), COUNTED):
        counts += np.unpackbits(hashes[at : at + COUNTED], axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (a long) of every document."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values, pa.int64())], ["doc_id", "fingerprint"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(batches, f"doc_id {kind}, fingerprint long")


@dataclass(frozen=True)
class Split:
    """A tree node; a child is an index of the tree, or a shard as -1 - shard."""

    vantage: int
    radius: int
    inside: int
    outside: int


def best_split(points: np.ndarray, reach: int) -> tuple[np.uint64, int] | None:
    """The vantage point and radius that leave the fewest comparisons, or None if none saves enough."""
    n, best = len(points), None
    least = n * n * (1 - GAIN)
    for vantage in points[:: max(1, n // VANTAGES)][:VANTAGES]:
        within = np.cumsum(np.bincount(np.bitwise_count(points ^ vantage), minlength=BITS + reach + 1))
        radius = np.arange(BITS)
        work = within[radius + reach] ** 2.0 + (n - within[radius]) ** 2.0
        at = int(work.argmin())
        if work[at] < least:
            best, least = (vantage, at), work[at]
    return best


def plant(sample: np.ndarray, size: int, reach: int = REACH) -> tuple[list[Split], int]:
    """A tree whose shards hold about ``size`` of the sample each, and the number of its shards."""
    tree: list[Split] = []
    shards = 0

    def grow(points: np.ndarray) -> int:
        nonlocal shards
        split = best_split(points, reach) if len(points) > size else None
        if split is None:
            shards += 1
            return -shards
        vantage, radius = split
        distance = np.bitwise_count(points ^ vantage)
        at = len(tree)
        tree.append(Split(0, 0, 0, 0))
        children = grow(points[distance <= radius + reach]), grow(points[distance > radius])
        tree[at] = Split(int(vantage), radius, *children)
        return at

    grow(sample)
    return tree, shards


def shards_of(points: np.ndarray, tree: list[Split], reach: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, indexes of the points in it) for all shards that hold any."""
    todo = [(0 if tree else -1, np.arange(len(points)))]
    while todo:
        at, held = todo.pop()
        if not len(held):
            continue
        if at < 0:
            yield -1 - at, held
            continue
        node = tree[at]
        distance = np.bitwise_count(points[held] ^ np.uint64(node.vantage))
        todo.append((node.inside, held[distance <= node.radius + reach]))
        todo.append((node.outside, held[distance > node.radius]))


def _flat(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def groups(points: np.ndarray, reach: int) -> np.ndarray:
    """For each of the sorted distinct points the index of the first point of its group."""
    parent = np.arange(len(points))
    todo = [np.arange(len(points))]
    while todo:
        held = todo.pop()
        split = best_split(points[held], reach) if len(held) > BLOCK else None
        if split is not None:
            distance = np.bitwise_count(points[held] ^ split[0])
            todo += [held[distance <= split[1] + reach], held[distance > split[1]]]
            continue
        for i in range(0, len(held), BLOCK):
            for j in range(i, len(held), BLOCK):
                rows, cols = held[i : i + BLOCK], held[j : j + BLOCK]
                a, b = np.nonzero(np.bitwise_count(points[rows][:, None] ^ points[cols]) <= reach)
                a, b = rows[a], cols[b]
                a, b = parent[a], parent[b]
                apart = a != b
                if not apart.any():
                    continue
                for x, y in np.unique(np.stack([a[apart], b[apart]], axis=1), axis=0):
                    while parent[x] != x:
                        x = parent[x]
                    while parent[y] != y:
                        y = parent[y]
                    parent[max(x, y)] = min(x, y)
                parent = _flat(parent)
    return parent


def links(nodes: DataFrame, reach: int = REACH) -> DataFrame:
    """Stars (a, b) over the distinct longs ``fingerprint`` of ``nodes`` that join all pairs within ``reach``."""
    total = nodes.count()
    sample = hash_sample(nodes.select("fingerprint"), ["fingerprint"], SAMPLE, 5).toPandas()["fingerprint"]
    points = sample.to_numpy(np.int64).view(np.uint64)
    tree, _ = plant(points, max(16, SHARD * len(points) // max(total, 1)), reach)

    def dealt(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in found:
            held = frame["fingerprint"].to_numpy(np.int64)
            for shard, at in shards_of(held.view(np.uint64), tree, reach):
                yield pd.DataFrame({"shard": shard, "fingerprint": held[at]})

    in_shards = written(nodes.select("fingerprint").mapInPandas(dealt, "shard long, fingerprint long"), "shards")
    # One row for each shard: no more than the sample allows.
    chunks = in_shards.groupBy("shard").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    paired = (
        in_shards.join(F.broadcast(chunks), "shard")
        .withColumn("own", own)
        .withColumn("other", other)
        .select("shard", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fingerprint")
    )

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        held = np.sort(frame["fingerprint"].to_numpy(np.int64))
        first = groups(held.view(np.uint64), reach)
        linked = first != np.arange(len(held))
        return pd.DataFrame({"a": held[linked], "b": held[first[linked]]})

    return paired.groupBy("shard", "low", "high").applyInPandas(joined, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the edges (a, b): root is the smallest node reachable."""

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before, now = None, mark(edges)
    while now[0] and now != before:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(near, "a").where((F.col("b") > F.col("a"))).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = written(small.where(F.col("a") != F.col("b")).distinct(), "edges")
        before, now = now, mark(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, reach: int = REACH, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    prints = written(fingerprints(docs, shingle), "fingerprints")
    nodes = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "nodes")
    rooted = components(links(nodes, reach)).toDF("fingerprint", "root")
    named = nodes.join(rooted, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = named.join(names, "root").select("fingerprint", "component_id")
    return prints.join(classes, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def shingle_set(text: str | None, shingle: int = SIMILAR_SHINGLE, seed: int = SEED) -> np.ndarray:
    """The distinct XXH64 hashes of a text's word shingles, sorted."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    stops = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *stops]
    digest = xxhash.xxh64_digest
    spans = zip(starts, stops[shingle - 1 :]) if len(words) > shingle else [(0, len(joined) + 1)]
    return np.unique(np.frombuffer(b"".join([digest(joined[a : b - 1], seed) for a, b in spans]), np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """BANDS keys of a set: each is made of ROWS MinHash values, so similar sets share some of them."""
    first, step = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    number = np.arange(BANDS * ROWS, dtype=np.uint32)[:, None]
    least = np.full(BANDS * ROWS, 2**32 - 1, np.uint32)
    for at in range(0, len(hashes), MIXED):
        least = np.minimum(least, (first[at : at + MIXED] + number * step[at : at + MIXED]).min(axis=1))
    keys = np.zeros(BANDS, np.uint64)
    for row in least.reshape(BANDS, ROWS).T.astype(np.uint64):
        keys = (keys ^ row) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def set_bands(docs: DataFrame, shingle: int = SIMILAR_SHINGLE) -> DataFrame:
    """doc_id, content, node (a hash of the shingle set), its size, the set's fingerprint and band keys, of every document."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            nodes, sizes, prints, bands = [], [], [], []
            for text in batch.column("text"):
                hashes = shingle_set(text.as_py(), shingle)
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes()))
                sizes.append(len(hashes))
                prints.append(majority(hashes.view(np.uint8).reshape(-1, BITS // 8)))
                bands.append(band_keys(hashes))
            columns = [
                batch.column("doc_id"),
                batch.column("content"),
                pa.array(np.array(nodes, np.uint64).view(np.int64)),
                pa.array(sizes, pa.int64()),
                pa.array(prints, pa.int64()),
                pa.array(bands, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "content", "node", "size", "fingerprint", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("content"), "text")
    return rows.mapInArrow(batches, f"doc_id {kind}, content long, node long, size long, fingerprint long, bands array<long>")


def close_nodes(nodes: DataFrame, reach: int) -> DataFrame:
    """Stars (a, b) over the nodes (node, fingerprint) whose fingerprints the vantage-point search links or are equal."""
    prints = written(nodes.groupBy("fingerprint").agg(F.min("node").alias("first"), F.count("*").alias("_rows")), "prints")
    far = links(prints, reach)
    a = prints.select(F.col("fingerprint").alias("a"), F.col("first").alias("_a"))
    b = prints.select(F.col("fingerprint").alias("b"), F.col("first").alias("_b"))
    counts = far.groupBy("b").agg(F.count("*").alias("_rows"))
    far = skew_join(far.join(a, "a"), b, ["b"], spread_by=["a"], counts=counts).select("_a", "_b")
    # Different sets with one fingerprint are rare, but may be many.
    firsts = prints.where("_rows > 1")
    equal = skew_join(nodes.select("node", "fingerprint"), firsts.drop("_rows"), ["fingerprint"], spread_by=["node"], counts=firsts.drop("first"))
    equal = equal.where("node <> first").select("node", "first")
    return written(far.union(equal).toDF("a", "b"), "close")


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, centre): the nodes (node, bands) that share a band key, and the smallest node that does.

    Buckets with the same nodes, which near copies have in most bands, are one.
    """
    keyed = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    heads = keyed.groupBy("band", "key").agg(F.min("node").alias("centre"), F.count("*").alias("n")).where("n > 1")
    heads = written(heads, "heads")
    counts = heads.select("band", "key", F.col("n").alias("_rows"))
    held = skew_join(keyed, heads.drop("n"), ["band", "key"], spread_by=["node"], counts=counts)
    held = written(held.select(F.xxhash64("band", "key").alias("bucket"), "node", "centre"), "buckets")
    same = held.groupBy("bucket").agg(
        F.count("*").alias("n"), F.bit_xor("node").alias("one"), F.bit_xor(F.xxhash64("node")).alias("two")
    )
    kept = same.groupBy("n", "one", "two").agg(F.min("bucket").alias("bucket")).select("bucket")
    return written(skew_join(held, kept, ["bucket"], "left_semi", ["node"], same.select("bucket", F.col("n").alias("_rows"))), "shared")


def sets_of(docs: DataFrame, holders: DataFrame, shingle: int) -> DataFrame:
    """(node, hashes) for the nodes of ``holders`` (node, doc_id, content), a document of each.

    A bitmap of fixed size lets only these documents' texts, and a few more, be cut into shingles;
    texts themselves are not moved.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(bit_table(holders.select("content"), "content", HELD_BITS))

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            content = batch.column("content").to_numpy()
            at = pa.array(np.flatnonzero(wanted.value[content % HELD_BITS]))
            few = batch.take(at)
            sets = [shingle_set(text.as_py(), shingle).tobytes() for text in few.column("text")]
            columns = [few.column("doc_id"), few.column("content"), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "content", "hashes"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("content"), "text")
    cut = rows.mapInArrow(batches, f"doc_id {kind}, content long, hashes binary")
    held = holders.select("node", F.col("doc_id").alias("_holder"), F.col("content").alias("_content"))
    on = F.col("doc_id").eqNullSafe(F.col("_holder")) & (F.col("content") == F.col("_content"))
    # Rows that repeat the holder's id and text have the same set.
    return written(cut.join(held, on).select("node", "hashes").dropDuplicates(["node"]), "sets")


def _set(held: bytes) -> np.ndarray:
    return np.frombuffer(held, np.uint64)


def similar_pairs(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b, similar): does the Jaccard similarity of the sets of two nodes reach ``least``, exactly?"""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            out = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = _set(x.as_py()), _set(y.as_py())
                both = 0
                if min(len(x), len(y)) >= least * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(both >= least * (len(x) + len(y) - both) - 1e-9)
            columns = [batch.column("a"), batch.column("b"), pa.array(out, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "similar"])

    x = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    # The centre of a large group stands in many pairs.
    both = skew_join(pairs.join(x, "a"), y, ["b"], spread_by=["a"], counts=pairs.groupBy("b").agg(F.count("*").alias("_rows")))
    return both.mapInArrow(batches, "a long, b long, similar boolean")


def alike(sets: list[np.ndarray], least: float, joined: np.ndarray | None = None) -> np.ndarray:
    """For each of the sets the index of the first set of its group; Jaccard similarities from ``least`` link, exactly.

    ``joined`` names groups that are known: sets with the same number are in one group.
    """
    parent = np.arange(len(sets))
    if joined is not None:
        _, first, group = np.unique(joined, return_index=True, return_inverse=True)
        parent = first[group]
    size = np.array([len(s) for s in sets])
    _, terms = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    holders = owner[np.argsort(terms, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.bincount(terms))])
    place = np.concatenate([[0], np.cumsum(size)])
    for i in range(len(sets) - 1):
        # A set that is in one group with all that could link to it needs no comparison.
        able = (np.minimum(size[i], size) >= least * np.maximum(size[i], size)) & (parent != parent[i])
        able[:i] = False
        if not able.any():
            continue
        own = terms[place[i] : place[i + 1]]
        n = starts[own + 1] - starts[own]
        at = np.arange(int(n.sum())) + np.repeat(starts[own] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        both = np.bincount(holders[at], minlength=len(sets))
        found = np.flatnonzero(able & (both >= least * (size[i] + size - both) - 1e-9))
        if len(found):
            roots = np.unique(np.append(parent[found], parent[i]))
            parent[np.isin(parent, roots)] = roots[0]
    return parent


def within_buckets(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Stars (a, b) of the similar nodes of each bucket (bucket, node, known): all of them are compared, in one task.

    Nodes with the same ``known`` are linked already. A bucket above VERIFIED shingles goes to several
    tasks by pairs of chunks.
    """
    dealt = members.join(sets.select("node", (F.octet_length("hashes") / 8).alias("size")), "node")
    chunks = dealt.groupBy("bucket").agg(F.ceil(F.sum("size") / VERIFIED).cast("int").alias("chunks"))
    paired = (
        dealt.join(chunks, "bucket")
        .withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "known")
        .join(sets, "node")
    )

    def compared(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node")
        node = frame["node"].to_numpy(np.int64)
        root = alike([_set(h) for h in frame["hashes"]], least, frame["known"].to_numpy(np.int64))
        linked = root != np.arange(len(node))
        return pd.DataFrame({"a": node[linked], "b": node[root[linked]]})

    return paired.groupBy("bucket", "low", "high").applyInPandas(compared, "a long, b long")


def similar(docs: DataFrame, prints: DataFrame, least: float, shingle: int, reach: int = REACH) -> DataFrame:
    """(node, root) of all nodes of ``prints`` that exact similarities from ``least`` join to a smaller one.

    Nodes whose fingerprints the vantage-point search links are compared, and linked if similar. Then nodes
    that share a band key and are in different groups are: first all of a bucket with its smallest node, which
    settles buckets of near copies; then, in buckets with other nodes, those with each other.
    """
    by_id = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")
    firsts = [F.first(c).alias(c) for c in ("size", "fingerprint", "bands")]
    nodes = prints.groupBy("node").agg(*firsts, F.min(by_id).alias("holder"))
    # Four shingles or fewer are only as similar as that if they are equal, and equal sets are one node.
    fewest = next(n for n in range(1, 1000) if n >= least * (n + 1))
    nodes = written(nodes.where(F.col("size") >= fewest), "nodes")
    close = close_nodes(nodes.select("node", "fingerprint"), reach)
    members = shared_buckets(nodes.select("node", "bands"))
    needed = members.select("node").union(close.select("a")).union(close.select("b")).distinct()
    holders = written(nodes.select("node", "holder.doc_id", "holder.content").join(needed, "node", "left_semi"), "holders")
    sets = sets_of(docs, holders, shingle)
    settled = written(similar_pairs(close, sets, least).where("similar").select("a", "b"), "settled")
    grouped = components(settled).toDF("node", "known")
    # What fingerprints have linked is not compared again.
    placed = members.join(grouped, "node", "left").withColumn("known", F.coalesce("known", "node"))
    centres = members.groupBy("centre").agg(F.count("*").alias("_rows"))
    heads = grouped.select(F.col("node").alias("centre"), F.col("known").alias("head"))
    placed = skew_join(placed, heads, ["centre"], "left", ["node"], centres).withColumn("head", F.coalesce("head", "centre"))
    placed = written(placed, "placed")
    stars = placed.where("known <> head").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    judged = written(similar_pairs(stars, sets, least), "judged")
    # A bucket is open if some of its nodes are not in the group of its centre.
    known = placed.join(judged.toDF("node", "centre", "similar"), ["node", "centre"], "left")
    known = known.select("bucket", "node", F.when(F.col("similar"), F.col("head")).otherwise(F.col("known")).alias("known"))
    known = written(known, "known")
    open_buckets = known.groupBy("bucket").agg(F.min("known").alias("low"), F.max("known").alias("high")).where("low < high")
    rest = within_buckets(known.join(open_buckets.select("bucket"), "bucket", "left_semi"), sets, least)
    return components(settled.union(judged.where("similar").select("a", "b")).unionByName(rest))


def one_of_each(docs: DataFrame, reach: int = REACH, shingle: int = SHINGLE, least: float | None = None) -> DataFrame:
    """One row of ``docs`` for each component: of the smallest doc_id, then of the smallest hash of its text.

    Ids that are null or stand for several texts are told apart by the text's hash, so a row goes
    only if another row of its component stays. With ``least`` components link texts whose exact sets
    of shingles have at least this similarity: those of the texts within ``reach`` that have it, and those that
    bands of MinHash values find further apart.
    """
    if least is not None:
        prints = written(set_bands(docs, shingle), "prints")
        return _first_rows(docs, prints, similar(docs, prints, least, shingle, reach))
    key = F.struct("doc_id", F.xxhash64(text_or_empty()).alias("content")).alias("doc_id")
    prints = fingerprints(docs.select(key, "text"), shingle).select("doc_id.*", F.col("fingerprint").alias("node"))
    prints = written(prints, "fingerprints")
    nodes = written(prints.select(F.col("node").alias("fingerprint")).distinct(), "nodes")
    return _first_rows(docs, prints, components(links(nodes, reach)))


def _first_rows(docs: DataFrame, prints: DataFrame, rooted: DataFrame) -> DataFrame:
    """One row of ``docs`` for each root: ``prints`` has (doc_id, content, node), ``rooted`` the nodes that are no root."""
    # Null ids come last.
    name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")
    texts = prints.groupBy("doc_id", "content", "node").agg(F.count("*").alias("copies"))
    nodes = prints.groupBy("node").agg(F.min(name).alias("first"), F.count("*").alias("n"))
    named = nodes.join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = named.groupBy("root").agg(F.min("first").alias("first"))
    stays = written(named.select("node", "root", "n").join(firsts, "root").select("node", "first.*", "n"), "stays")
    stays = stays.select("node", F.struct("none", "doc_id", "content").alias("first"), "n")
    # Many texts may have one set of shingles, as copies do.
    counts = stays.select("node", F.col("n").alias("_rows"))
    hash_name, id_name, content_name = unused(docs, "hash", "id", "content")
    fate = (
        skew_join(texts, stays.drop("n"), ["node"], spread_by=["content", "doc_id"], counts=counts)
        .withColumn("stays", name.eqNullSafe(F.col("first")))
        .where(~F.col("stays") | (F.col("copies") > 1))
        .select(F.col("doc_id").alias(id_name), F.col("content").alias(content_name), "stays")
    )
    fate = written(fate, "fate")
    here = docs.withColumn(hash_name, F.xxhash64(text_or_empty()))
    gone = fate.drop("stays")
    on = F.col("doc_id").eqNullSafe(F.col(id_name)) & (F.col(hash_name) == F.col(content_name))
    # Of at most PARTS remainders it is known whether a text that goes has them; only documents with such a one are moved.
    (part,) = unused(here, "part")
    of_part = lambda name: F.pmod(F.col(name), F.lit(PARTS).cast("long"))
    parts = F.broadcast(gone.select(of_part(content_name).alias(part)).distinct())
    same_part = of_part(hash_name) == F.col(part)
    apart = here.join(parts, same_part, "left_anti").select(*docs.columns)
    moved = here.join(parts, same_part, "left_semi").join(gone, on, "left_anti").select(*docs.columns)
    kept = apart.unionByName(moved)
    repeated = fate.where("stays").drop("stays")
    if repeated.isEmpty():
        return kept
    once = here.join(parts, same_part, "left_semi").join(repeated, on, "left_semi").dropDuplicates(["doc_id", hash_name]).select(*docs.columns)
    return kept.unionByName(once)
