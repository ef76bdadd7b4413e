"""Numbering, running totals, lists and joins against plain windows and joins."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shiplabel.operators import scale


@pytest.fixture(scope="module")
def skewed(spark):
    """1,000 rows, two thirds of them in one group."""
    n = F.col("id")
    return (
        spark.range(1000)
        .select(
            F.when(n % 3 == 0, (n % 11).cast("string")).otherwise("hot").alias("g"),
            F.format_string("%04d", (n * 7919) % 1000).alias("ord"),
            n.alias("v"),
        )
        .repartition(5)
    )


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("groups", [["g"], []])
def test_rank_equals_row_number(spark, skewed, groups):
    window = Window.partitionBy(*groups).orderBy("ord")
    plain = skewed.withColumn("k", F.row_number().over(window).cast("bigint"))
    assert rows(scale.rank_in_groups(skewed, groups, ["ord"], "k", slices=6)) == rows(plain)


@pytest.mark.parametrize("n", [1, 7, 100, 2000])
@pytest.mark.parametrize("measured", [False, True])
def test_first_in_groups_equals_row_number(spark, skewed, n, measured, monkeypatch):
    monkeypatch.setattr(scale, "NODE_ROWS", 10)
    window = Window.partitionBy("g").orderBy("ord")
    plain = skewed.withColumn("k", F.row_number().over(window).cast("bigint")).where(F.col("k") <= n)
    largest = scale.largest_group(skewed, ["g"]) if measured else None
    assert largest in (None, 666)
    assert rows(scale.first_in_groups(skewed, ["g"], ["ord"], n, "k", largest)) == rows(plain)


@pytest.mark.parametrize("n, largest", [(1_000_000, 70_000_000), (8, 3_000_000_000), (120, 99), (1, 0), (300_000, 10**12)])
def test_no_slice_takes_more_than_its_room(n, largest):
    """Slices that meet bring n rows each; the first ones share the group."""
    fan, levels = scale.tree_of_slices(n, largest)
    room = max(2 * n, scale.NODE_ROWS)
    assert largest / (levels or [1])[0] <= 0.75 * room or largest <= 0.75 * room
    for below, above in zip(levels, [*levels[1:], 1]):
        assert fan * n <= room and -(-below // fan) == above
    assert len(levels) <= 25


def test_first_million_of_one_group(spark):
    """The measured slices of a group of 3 million rows hold at most 2 n rows at every level."""
    n, all_rows = 1_000_000, spark.range(3_000_000).select((F.col("id") * 7919 % 3_000_017).alias("ord"))
    fan, levels = scale.tree_of_slices(n, 3_000_000)
    first = all_rows.groupBy(F.pmod(F.xxhash64("ord"), F.lit(levels[0]))).count().agg(F.max("count")).first()[0]
    assert first <= 2 * n and fan * n <= 2 * n
    got = scale.first_in_groups(all_rows, [], ["ord"], n, "k", 3_000_000)
    want = all_rows.orderBy("ord").limit(n).agg(F.count("*"), F.sum("ord"), F.max("ord")).first()
    assert got.agg(F.count("*"), F.sum("ord"), F.max("ord")).first() == want
    assert got.where("k = 1").first()["ord"] == all_rows.agg(F.min("ord")).first()[0]


@pytest.mark.parametrize("n", [1, 30, 5000])
def test_smallest_hashes(spark, n):
    """Every row among the n smallest is kept, hardly any other one, in groups of all sizes and without one."""
    hashed = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, (F.col("id") % 50).cast("string")).alias("g"),
        F.md5(F.col("id").cast("string")).alias("h"),
    )
    place = Window.partitionBy("g").orderBy("h")
    first = hashed.withColumn("k", F.row_number().over(place)).where(F.col("k") <= n)
    want = {(r["g"], r["h"]) for r in first.collect()}
    got = [(r["g"], r["h"]) for r in scale.smallest_in_groups(hashed, ["g"], "h", n).collect()]
    assert want <= set(got) and len(got) <= len(want) + 3 and len(got) == len(set(got))


def test_a_hot_group_spans_several_slices(spark, skewed):
    cut = skewed.repartitionByRange(6, "g", "ord").withColumn("s", F.spark_partition_id())
    assert cut.where("g = 'hot'").select("s").distinct().count() > 2


def test_running_total_equals_window(spark):
    batches = spark.range(300).select(
        (F.col("id") % 3).alias("g"), F.floor(F.col("id") / 3).alias("pos"), (F.col("id") % 5).alias("c")
    )
    before = Window.orderBy("g", "pos").rowsBetween(Window.unboundedPreceding, -1)
    plain = batches.withColumn("t", F.coalesce(F.sum("c").over(before), F.lit(0)))
    assert rows(scale.running_total(batches, "c", ["g"], "pos", "t", block=8)) == rows(plain)


def test_parts_join_to_the_whole_list(spark, skewed):
    parts = scale.lists_in_parts(skewed, ["g"], ["ord"], "v", "vs", part_size=50).collect()
    assert max(len(r["vs"]) for r in parts) == 50
    got = {}
    for r in sorted(parts, key=lambda r: (r["g"], r["part"])):
        got.setdefault(r["g"], []).extend(r["vs"])
    want = {}
    for r in sorted(skewed.collect(), key=lambda r: (r["g"], r["ord"])):
        want.setdefault(r["g"], []).append(r["v"])
    assert got == want


def test_only_rows_of_large_groups_are_numbered_for_lists(spark, skewed, monkeypatch):
    seen = []
    original = scale.rank_in_groups
    monkeypatch.setattr(scale, "rank_in_groups", lambda df, *a: seen.append(df) or original(df, *a))
    lists = lambda: sorted(map(str, scale.lists_in_parts(skewed, ["g"], ["ord"], "v", "vs", part_size=7).collect()))
    gathered = lists()
    assert not seen
    monkeypatch.setattr(scale, "NODE_ROWS", 40)
    assert lists() == gathered
    assert {r["g"] for r in seen[0].select("g").distinct().collect()} == {"hot"}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("known_counts", [False, True])
def test_skew_join_equals_join(spark, skewed, how, known_counts):
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("3", 3), ("x", 4)], "g string, w int")
    counts = skewed.groupBy("g").agg(F.count("*").alias("_rows")) if known_counts else None
    joined = scale.skew_join(skewed, right, ["g"], how, counts=counts, floor=40)
    assert rows(joined) == rows(skewed.join(right, "g", how))


def test_hot_rows_get_several_salts(spark, skewed):
    """The plan must spread the hot key: its rows meet in more than one partition."""
    right = spark.createDataFrame([("hot", 1)], "g string, w int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        joined = scale.skew_join(skewed, right, ["g"], floor=40)
        assert joined.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rows_without_a_partner_mostly_go(spark):
    """All rows that have a partner stay, whatever the number of bits; a filter with enough of them drops nearly all others."""
    wide = spark.range(40_000).selectExpr("id", "IF(id % 50 = 7, NULL, 'x' || id) AS g", "id % 3 AS h")
    some = wide.where("id % 40 = 0").select("g", "h").union(wide.where("id % 400 = 0").select("g", "h"))
    partners = {r["id"] for r in wide.join(some, ["g", "h"], "left_semi").collect()}
    kept = lambda **more: scale.with_possible_partner(wide, some, ["g", "h"], **more)
    assert kept().columns == wide.columns and kept().schema == wide.schema
    ids = [r["id"] for r in kept().collect()]
    assert len(ids) == len(set(ids)) and partners <= set(ids) and len(ids) < len(partners) + 6000
    assert partners <= {r["id"] for r in kept(most_bits=scale.FILTER_ROW_BITS).collect()}
    assert kept().join(some, ["g", "h"]).count() == wide.join(some, ["g", "h"]).count()
    assert scale.with_possible_partner(wide, some.limit(0), ["g", "h"]).isEmpty()
