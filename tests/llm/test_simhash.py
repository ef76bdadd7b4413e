import re

import numpy as np
import xxhash
from helpers import clashing, documents, odd_rows, prose
from pyspark.sql import functions as F

from shiplabel.llm import simhash


def slow_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(points, reach=2):
    first = list(range(len(points)))
    for _ in points:
        for i, p in enumerate(points):
            for j in range(i):
                if (int(p) ^ int(points[j])).bit_count() <= reach:
                    first[i] = first[j] = min(first[i], first[j])
    return first


def test_against_brute_force(spark):
    import random

    rng = random.Random(4)
    rows = odd_rows()
    base = prose(rng, 400)
    rows += [(100 + i, base + f" Ending {i}.") for i in range(12)]
    rows += [(200 + i, base.replace("river", "RIVER" if i % 2 else "rivers", i)) for i in range(6)]
    got = simhash.near_duplicates(clashing(documents(spark, rows))).collect()
    prints = [slow_print(r[1]) for r in rows]
    groups = slow_groups(prints)
    ids = {}
    for g, r in zip(groups, rows):
        if r[0] is not None:
            ids[g] = min(ids.get(g, r[0]), r[0])
    want = sorted(((r[0], f"{p:016x}", ids.get(g)) for r, p, g in zip(rows, prints, groups)), key=repr)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=repr) == want


def points_with_clusters():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    one = np.uint64(1)
    near = base[:500] ^ (one << rng.integers(0, 64, 500, dtype=np.uint64))
    ball = base[0] ^ (one << rng.integers(0, 64, 900, dtype=np.uint64)) ^ (one << rng.integers(0, 64, 900, dtype=np.uint64))
    return np.unique(np.concatenate([base, near, ball]))


def slow_roots(points):
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 2
    root = np.arange(len(points))
    while True:
        new = np.where(near, root[None, :], len(points)).min(axis=1)
        if (new == root).all():
            return root
        root = new


def test_shards_lose_no_link():
    points = points_with_clusters()
    want = slow_roots(points)
    assert (simhash.groups(points, 2) == want).all()
    tree, shards = simhash.plant(points[::3], 100)
    assert shards > 4
    near = {(i, j) for i, j in zip(*np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= 2)) if i < j}
    for _, held in simhash.shards_of(points, tree, 2):
        inside = set(held.tolist())
        near = {p for p in near if not (p[0] in inside and p[1] in inside)}
    assert not near


def test_links_and_components_on_spark(spark, monkeypatch):
    points = points_with_clusters()
    monkeypatch.setattr(simhash, "SHARD", 200)
    monkeypatch.setattr(simhash, "CHUNK", 300)  # the ball is dealt by pairs of chunks
    signed = points.view(np.int64)
    nodes = spark.createDataFrame([(int(p),) for p in signed], "fingerprint long")
    rooted = {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes)).collect()}
    want = slow_roots(points)
    groups = {}
    for p, w in zip(signed.tolist(), want):
        groups.setdefault(w, []).append(p)
    for members in groups.values():
        assert all(rooted.get(p, p) == min(members) for p in members)


def test_one_of_each(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    out = simhash.one_of_each(docs)
    assert out.columns == docs.columns
    kept = [r["doc_id"] for r in out.collect()]
    # 12 repeats 1, 3 is given twice, 10 and 11 are as empty as 9
    assert sorted(k for k in kept if k is not None) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 13, 14]
    assert None in kept


def test_one_of_each_keeps_a_row_of_every_component(spark):
    import random

    rng = random.Random(12)
    texts = [prose(rng, 40) for _ in range(5)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (3, texts[3]), (None, texts[3]), (9, texts[4]), (9, texts[4])]
    got = sorted(((r["doc_id"], r["text"]) for r in simhash.one_of_each(documents(spark, rows)).collect()), key=repr)
    # Two texts without an id, text 2 of id 7 (its text 3 is id 3's), one of the repeated rows of id 9.
    assert got == sorted([(None, texts[0]), (None, texts[1]), (7, texts[2]), (3, texts[3]), (9, texts[4])], key=repr)


def jaccard(a, b):
    a, b = (set(simhash.shingle_set(t).tolist()) for t in (a, b))
    return len(a & b) / max(1, len(a | b))


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def pairs_from(rng, low, high, n):
    """Pairs of a text and an edited copy whose similarity is in the range."""
    out = []
    while len(out) < n:
        base = prose(rng, rng.choice([30, 60, 150, 400]))
        other = edited(rng, base, rng.randint(1, 12))
        if low <= jaccard(base, other) < high:
            out.append((base, other))
    return out


def test_recall_of_bands():
    import random

    pairs = pairs_from(random.Random(21), 0.8, 0.86, 1500)
    missed = 0
    for pair in pairs:
        a, b = (simhash.band_keys(simhash.shingle_set(t)) for t in pair)
        missed += not (a == b).any()
    print(f"recall of pairs of similarity 0.80 to 0.86: {1 - missed / len(pairs):.4f}")
    assert missed <= 0.005 * len(pairs)


def test_near_copies_by_exact_similarity(spark, monkeypatch):
    import random

    monkeypatch.setattr(simhash, "VERIFIED", 2000)  # the large group is dealt by pairs of chunks
    rng = random.Random(22)
    near, apart = pairs_from(rng, 0.8, 0.95, 25), pairs_from(rng, 0.55, 0.79, 25)
    base = prose(rng, 120)
    texts = [t for p in near + apart for t in p] + [base, *[edited(rng, base, 1) for _ in range(60)], "a b c", "a b d", "", None]
    rows = list(enumerate(texts))
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if jaccard(texts[i], texts[j]) >= 0.8 or not (texts[i] or texts[j]):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    docs = documents(spark, rows)
    got = simhash.one_of_each(docs, shingle=simhash.SIMILAR_SHINGLE, least=simhash.SIMILAR)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(set(root))
    import corpus_pipeline

    assert dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "").count() == len(set(root))
    assert simhash.one_of_each(docs.where("false"), shingle=simhash.SIMILAR_SHINGLE, least=simhash.SIMILAR).count() == 0


def test_vantage_points_find_near_copies_of_sets(spark, monkeypatch):
    import random

    # Without any shared band, only the vantage-point search finds links.
    monkeypatch.setattr(simhash, "shared_buckets", lambda nodes: nodes.select(F.lit(0).cast("long").alias("bucket"), "node", F.col("node").alias("centre")).where("false"))
    rng = random.Random(31)
    rows, kept = [], []
    for i in range(30):
        base = prose(rng, 1500)
        rows += [(10 * i, base), (10 * i + 1, base + " Ending.")]
    texts = dict(rows)
    prints = {i: simhash.majority(simhash.shingle_set(t).view(np.uint8).reshape(-1, 8)) for i, t in rows}
    for i in texts:
        twin = i % 10 == 1 and ((prints[i] ^ prints[i - 1]) & (2**64 - 1)).bit_count() <= simhash.REACH
        kept += [] if twin else [i]
    assert len(kept) < 40
    got = simhash.one_of_each(documents(spark, rows), shingle=simhash.SIMILAR_SHINGLE, least=simhash.SIMILAR)
    assert sorted(r["doc_id"] for r in got.collect()) == kept


def test_close_fingerprints_are_checked_on_sets(spark, monkeypatch):
    # All fingerprints are equal, and still only similar texts are linked.
    import random

    monkeypatch.setattr(simhash, "majority", lambda hashes: 5)
    rng = random.Random(32)
    near, apart = pairs_from(rng, 0.8, 0.95, 5), pairs_from(rng, 0.55, 0.79, 5)
    rows = list(enumerate(t for p in near + apart for t in p))
    got = simhash.one_of_each(documents(spark, rows), shingle=simhash.SIMILAR_SHINGLE, least=simhash.SIMILAR)
    assert sorted(r["doc_id"] for r in got.collect()) == [0, 2, 4, 6, 8, *range(10, 20)]


def test_empty(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_chain(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["root"] for r in simhash.components(edges).collect()} == {0}
