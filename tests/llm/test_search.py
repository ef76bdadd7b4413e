import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import clashing, documents, odd_rows, prose

from shiplabel.llm import search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, places):
    counted = [(r[0], Counter(terms(r[1])), len(terms(r[1]))) for r in rows]
    n_docs, n_terms = sum(n > 0 for _, _, n in counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    queries = {}
    for item, text in items:
        queries.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in queries.items():
        scores = []
        for doc_id, held, n in counted:
            m = 50 + (50 * n * n_docs) // n_terms if n_terms else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * held[t]) // (1000 * held[t] + 20 * m)) for t in wanted if t in held)
            if s > 0:
                scores.append((-s, doc_id is None, doc_id or 0, doc_id))
        out += [(item, i, s[3], -s[0]) for i, s in enumerate(sorted(scores)[:places], 1)]
    return sorted(out, key=repr)


def tables(spark, seed=5):
    rng = random.Random(seed)
    rows = odd_rows(seed) + [(20 + i, prose(rng, rng.choice([3, 30, 200]))) for i in range(150)]
    rows += [(500 + i, rows[0][1]) for i in range(30)] + [(600, "ÄRGER ärger Ärger\x00x_1 Straße"), (None, rows[0][1])]
    items = [(i, prose(rng, rng.choice([1, 8, 40]))) for i in range(15)]
    items += [(50, rows[0][1]), (50, "ärger straße"), (51, None), (52, " .,"), (None, "river 1 x"), (53, "nowhere")]
    return rows, items, documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize(("places", "block_terms", "postings"), [(50, 200_000, 2_000_000), (5, 25, 300), (1, 1, 1)])
def test_against_brute_force(spark, places, block_terms, postings):
    rows, items, docs, benchmark = tables(spark)
    if block_terms == 1:
        items = items[:3]
        benchmark = benchmark.where("item_id < 3")
    got = search.ranked(clashing(docs).repartition(3), benchmark, places, block_terms, postings)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, items, places)


def test_windows_and_short_lists():
    """Any split into short and long lists and any window give the scores of a plain sum."""
    rng = np.random.default_rng(7)
    for case in range(60):
        n, size = int(rng.integers(1, 200)), 12
        held = rng.random((size, n)) < rng.random((size, 1))
        values = np.where(held, rng.integers(0, 6 if case % 2 else 1000, (size, n)), 0)
        starts = np.concatenate([[0], np.cumsum(held.sum(axis=1))])
        docs = np.concatenate([np.flatnonzero(h) for h in held])
        shard = search.Shard(rng.permutation(n), np.zeros(n, bool), docs, values[held], starts)
        asked = np.flatnonzero(rng.random(size) < 0.7)
        total = values[asked].sum(axis=0)
        want = sorted((-s, i) for s, i in zip(total.tolist(), shard.ids.tolist(), strict=True) if s > 0)
        for places, window, share in [(3, 1, 1), (10, 16, 4), (500, 64, 8), (5, 4096, 10**9)]:
            best = search.Best(places)
            shard.search(asked, best, window, share)
            assert list(zip((-best.scores).tolist(), best.ids.tolist(), strict=True)) == want[:places]


def test_pieces_of_a_long_text():
    text = prose(random.Random(1), 3000) + " " + "x" * 50
    for piece in (1, 7, 100):
        assert [t.decode() for part in search.terms_of(text, piece) for t in part] == terms(text)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")]])
def test_empty(spark, rows):
    items = spark.createDataFrame([(1, "river")], "item_id long, text string")
    assert search.ranked(documents(spark, rows), items).count() == 0
    assert search.ranked(documents(spark, [(1, "river")]), items.limit(0)).count() == 0
