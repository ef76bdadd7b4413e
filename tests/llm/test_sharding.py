import zlib

import pytest
from helpers import clashing, documents, odd_rows
from pyspark.sql import functions as F

from shiplabel.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 7, 16, 1000])
def test_permutation_and_way_back(spark, n):
    placed = sharding.permuted(spark.range(n), "id", n, "place").cache()
    assert sorted(r.place for r in placed.collect()) == list(range(n))
    back = sharding.row_at(placed.selectExpr("id", "place % 3 AS shard", "place div 3 AS slot"), "shard", "slot", n, 3, "row")
    assert back.where("row <> id").count() == 0


def test_shards(spark):
    rows = odd_rows()
    got = sharding.shard_documents(clashing(documents(spark, rows)), shards=4).collect()
    want = sorted(((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == want
    counts = [sorted(r["slot"] for r in got if r["shard"] == s) for s in range(4)]
    assert all(c == list(range(len(c))) for c in counts)
    assert max(map(len, counts)) - min(map(len, counts)) <= 1
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}


def test_same_at_any_partitioning(spark):
    docs = documents(spark, odd_rows())
    a = sharding.shard_documents(docs).select("doc_id", "text_crc32", "shard", "slot")
    b = sharding.shard_documents(docs.repartition(5, F.rand(3))).select("doc_id", "text_crc32", "shard", "slot")
    assert a.exceptAll(b).isEmpty()


def test_empty(spark):
    assert sharding.shard_documents(documents(spark, [])).count() == 0
