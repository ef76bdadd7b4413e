"""Building blocks that keep hot groups off a single task.

One description, product or shipment may hold a third of all rows. A window or a
``collect_list`` keyed by it would run in one task, so numbering, running totals,
lists and joins over such keys go through the functions below.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot when it holds more than 1/HOT_KEYS of all rows, hence there are
# never more than HOT_KEYS of them and the list of hot keys is safe to broadcast.
HOT_KEYS = 1024
# Below this many rows a key is never worth salting.
HOT_FLOOR = 100_000
# A key above this many rows is always split, however small its share of all rows is.
HOT_ROWS = 5_000_000
# Slices of a group that a first-n report is taken from.
FIRST_SLICES = 32
# Rows of a group that one task sorts for a first-n report of a measured group, if 2 n is less.
NODE_ROWS = 100_000
# Hexadecimal digits of a hash by which rows are counted at a time: 4,096 counts for a group.
COUNTED_DIGITS = 3
# Bits of a filter for each key it is made of, and of all of a filter: 128 MB are broadcast at most.
FILTER_BITS_PER_KEY = 16
FILTER_BITS = 1 << 30
# Bits of one row of a filter, as bitmap_construct_agg makes them.
FILTER_ROW_BITS = 1 << 15
# Most items one list-valued cell takes; longer lists continue in the next part.
PART_SIZE = 10_000


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints; only a local session may go without setting one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows to the cluster's shared folder and read them from there.

    Columns are compressed (Parquet), which takes a fraction of what a checkpoint of rows does. The
    table lies below the checkpoint folder and can go with it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/durable-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rank_in_groups(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str, slices: int | None = None
) -> DataFrame:
    """``row_number`` within ``groups`` by ``order``, with no task per group.

    The rows are range-partitioned by group and order, so a hot group spans many
    slices. Rows are numbered inside their slice and shifted by the size of the
    group's earlier slices. The slices are checkpointed because both steps must
    see the same ones. With no groups the numbering is global.
    """
    groups, order = list(groups), list(order)
    slices = slices or shuffle_width(df.sparkSession)
    cut = durable(
        df.repartitionByRange(slices, *groups, *order).withColumn(
            "_slice", F.spark_partition_id()
        )
    )
    earlier = (
        Window.partitionBy(*groups)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        cut.groupBy(*groups, "_slice")
        .agg(F.count("*").alias("_size"))
        .select(*groups, "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*groups, "_slice").orderBy(*order)
    return (
        cut.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, [*groups, "_slice"])
        .withColumn(name, (F.col("_before") + F.col("_inside")).cast("bigint"))
        .drop("_slice", "_inside", "_before")
    )


def first_in_groups(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], n: int | None, name: str, largest: int | None = None
) -> DataFrame:
    """The first ``n`` rows of each group by ``order``, numbered from 1 as ``name``; all for None.

    Rows are cut to ``n`` within hash slices of a group first, so no task sorts a whole
    hot group, whatever ``n`` is. Give the rows of the ``largest`` group (``largest_group``, or any
    bound above it): slices are then as many as it needs, and they meet level by level, so that none
    holds more than 2 n rows (or NODE_ROWS, if that is more). Without it there is one level of
    FIRST_SLICES, and the last step sees at most FIRST_SLICES * n rows of a group.
    """
    if n is None:
        return rank_in_groups(df, groups, order, name)
    groups, order = list(groups), list(order)
    fan, levels = (FIRST_SLICES, [FIRST_SLICES]) if largest is None else tree_of_slices(n, largest)
    few = df
    if levels:
        few = few.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(levels[0])))
        inside = F.row_number().over(Window.partitionBy(*groups, "_slice").orderBy(*order))
        for _ in levels:
            few = few.withColumn("_inside", inside).where(F.col("_inside") <= n).drop("_inside")
            few = few.withColumn("_slice", F.floor(F.col("_slice") / fan))
        few = few.drop("_slice")
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return few.withColumn(name, place.cast("bigint")).where(F.col(name) <= n)


def tree_of_slices(n: int, largest: int) -> tuple[int, list[int]]:
    """How many slices meet in one, and the number of slices at each level, for a group of ``largest`` rows.

    A slice of the first level is filled to three quarters on average, because hashes do not
    spread evenly; a later one takes ``n`` rows at most from each of those that meet in it.
    """
    room = max(2 * n, NODE_ROWS)
    fan = max(2, room // max(n, 1))
    levels = []
    slices = math.ceil(4 * largest / (3 * room))
    while slices > 1:
        levels.append(slices)
        slices = math.ceil(slices / fan)
    return fan, levels


def largest_group(df: DataFrame, groups: Sequence[str]) -> int:
    """Rows of the largest group; one job that reads the ``groups`` columns alone."""
    sizes = df.groupBy(*groups).agg(F.count("*").alias("_rows"))
    return sizes.agg(F.coalesce(F.max("_rows"), F.lit(0))).first()[0]


def smallest_in_groups(df: DataFrame, groups: Sequence[str], key: str, n: int) -> DataFrame:
    """The rows of each group with its ``n`` smallest ``key`` values, and a few more; ``key`` is a hash in hexadecimal.

    Nothing is sorted: rows are counted by the first digits of the hash, then the bucket that holds the
    n-th one by its next digits, and what lies behind is filtered out. A group keeps about ``n`` rows and
    a 16-millionth of its own; the caller cuts those exactly. The two counts and the filter
    read ``df`` three times, so give them a written table.
    """
    # Rows without a group are a group, too; as text it joins like any other.
    df, groups = df.withColumn("_group", F.to_json(F.struct(*groups))), ["_group"]
    last = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)

    def cut(rows: DataFrame, digits: int, wanted: str | int) -> tuple[DataFrame, DataFrame]:
        bucket = F.substring(key, 1, digits)
        wanted = F.lit(wanted) if isinstance(wanted, int) else F.col(wanted)
        counts = rows.groupBy(*groups, bucket.alias("_bucket")).agg(
            F.count("*").alias("_rows"), F.max(wanted).alias("_wanted")
        )
        before = F.coalesce(F.sum("_rows").over(last), F.lit(0))
        found = counts.withColumn("_before", before).where(
            (F.col("_before") < F.col("_wanted")) & (F.col("_before") + F.col("_rows") >= F.col("_wanted"))
        )
        return counts, found.select(*groups, "_bucket", (F.col("_wanted") - F.col("_before")).alias("_left"))

    counts, coarse = cut(df, COUNTED_DIGITS, n)
    # One row for each group of n rows or more; the bucket spreads a hot group over as many keys.
    bordering = (
        df.withColumn("_bucket", F.substring(key, 1, COUNTED_DIGITS)).join(coarse, [*groups, "_bucket"]).drop("_bucket")
    )
    _, fine = cut(bordering, 2 * COUNTED_DIGITS, "_left")
    border = fine.select(*groups, F.col("_bucket").alias("_border"))
    sizes = counts.groupBy(*groups).agg(F.sum("_rows").alias("_rows"))
    bounded = skew_join(df, border, groups, "left", spread_by=[key], counts=sizes)
    inside = F.col("_border").isNull() | (F.substring(key, 1, 2 * COUNTED_DIGITS) <= F.col("_border"))
    return bounded.where(inside).drop("_border", "_group")


def running_total(
    df: DataFrame,
    value: str,
    groups: Sequence[str],
    position: str,
    name: str,
    block: int = 4096,
) -> DataFrame:
    """Sum of ``value`` over all earlier rows in (groups, position) order.

    ``position`` numbers the rows of a group from 0 without gaps. Blocks of
    consecutive positions are summed first; only the block sums pass through the
    global window, one row for every ``block`` rows.
    """
    groups = list(groups)
    blocked = df.withColumn("_block", F.floor(F.col(position) / block))
    everything_before = Window.orderBy(*groups, "_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        blocked.groupBy(*groups, "_block")
        .agg(F.sum(value).alias("_sum"))
        .select(
            *groups,
            "_block",
            F.coalesce(F.sum("_sum").over(everything_before), F.lit(0)).alias("_before"),
        )
    )
    inside = (
        Window.partitionBy(*groups, "_block")
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        blocked.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(offsets, [*groups, "_block"])
        .withColumn(name, (F.col("_before") + F.col("_inside")).cast("bigint"))
        .drop("_block", "_before", "_inside")
    )


def lists_in_parts(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    item: str | Column,
    name: str,
    part_size: int = PART_SIZE,
) -> DataFrame:
    """One ordered list per group, continued in further rows after ``part_size`` items.

    ``part`` counts from 0; joining the parts of a group gives the whole list. A group of NODE_ROWS rows at
    most is gathered and cut where it lies. Only the rows of larger ones are numbered first, so that
    none of these meets in one task; they are found by one job over the ``groups`` columns.
    """
    groups = list(groups)
    value = F.col(item) if isinstance(item, str) else item
    rows = df.select(*groups, *order, value.alias("_item"))
    sizes = rows.groupBy(*groups).agg(F.count("*").alias("_rows"))
    large = durable(sizes.where(F.col("_rows") > NODE_ROWS).select(*groups))
    if large.isEmpty():
        return _gathered_parts(rows, groups, order, name, part_size)
    # At most one for every NODE_ROWS rows.
    side = lambda how: rows.join(F.broadcast(large), groups, how)
    ranked = rank_in_groups(side("left_semi"), groups, order, "_rn")
    numbered = (
        ranked.withColumn("part", F.floor((F.col("_rn") - 1) / part_size).cast("bigint"))
        .groupBy(*groups, "part")
        .agg(F.array_sort(F.collect_list(F.struct("_rn", "_item"))).alias("_list"))
        .select(*groups, "part", F.col("_list._item").alias(name))
    )
    return numbered.unionByName(_gathered_parts(side("left_anti"), groups, order, name, part_size))


def _gathered_parts(rows: DataFrame, groups: list[str], order: Sequence[str], name: str, part_size: int) -> DataFrame:
    """Lists of groups that fit a task, in parts."""
    whole = rows.groupBy(*groups).agg(F.sort_array(F.collect_list(F.struct(*order, "_item")))["_item"].alias("_list"))
    firsts = F.sequence(F.lit(1), F.size("_list"), F.lit(part_size))
    parts = F.transform(firsts, lambda i: F.slice("_list", i, F.lit(part_size)))
    return whole.select(*groups, F.posexplode(parts).alias("part", name)).withColumn("part", F.col("part").cast("bigint"))


def hot_keys(counts: DataFrame, on: Sequence[str], floor: int = HOT_FLOOR) -> list[tuple[int, int]]:
    """(key hash, number of salts) of the keys that hold more than their share of rows.

    ``counts`` has the ``on`` columns and ``_rows``. A key is hot above ``floor`` rows if
    it also holds more than 1/HOT_KEYS of all rows or more than HOT_ROWS, so the list
    fetched here has at most HOT_KEYS entries and one for every HOT_ROWS rows. A salt of
    such a key takes no more than HOT_ROWS rows on average.
    """
    per_key = counts.groupBy(F.xxhash64(*on).alias("key")).agg(F.sum("_rows").alias("rows"))
    share = per_key.agg((F.sum("rows") / HOT_KEYS).cast("bigint")).scalar()
    salts = F.greatest(
        F.least(F.ceil(F.col("rows") / floor), F.lit(HOT_KEYS)), F.ceil(F.col("rows") / HOT_ROWS)
    ).cast("int")
    above = F.greatest(F.least(share, F.lit(HOT_ROWS)), F.lit(floor))
    hot = per_key.where(F.col("rows") > above).select("key", salts)
    return [tuple(r) for r in hot.collect()]


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] | None = None,
    counts: DataFrame | None = None,
    floor: int = HOT_FLOOR,
) -> DataFrame:
    """Equi-join whose ``left`` side may hold very many rows of one key.

    One job finds the hot keys; without any this is a plain join. Else left rows
    of hot keys get a salt and the right rows of these keys are repeated, once per
    salt. ``how`` may be ``inner``, ``left``, ``left_semi`` or ``left_anti``. The
    salt is a hash of the ``spread_by`` columns (all hashable ones by default), so
    a recomputed task salts its rows as before. ``counts`` (the ``on`` columns and
    ``_rows``) saves the pass over ``left``.
    """
    on = list(on)
    if counts is None:
        counts = left.groupBy(*on).agg(F.count("*").alias("_rows"))
    found = hot_keys(counts, on, floor)
    if not found:
        return left.join(right, on, how)
    spread_by = spread_by or [
        f.name
        for f in left.schema
        if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)
    ]
    hot = left.sparkSession.createDataFrame(found, "_key long, _salts int")
    salt = F.pmod(F.xxhash64(F.lit("salt"), *spread_by), F.col("_salts")).cast("int")
    spread = (
        left.withColumn("_key", F.xxhash64(*on))
        .join(F.broadcast(hot), "_key", "left")
        .withColumn("_salt", F.coalesce(salt, F.lit(0)))
        .drop("_key", "_salts")
    )
    repeated = (
        right.withColumn("_key", F.xxhash64(*on))
        .join(F.broadcast(hot), "_key", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_key", "_salts")
    )
    return spread.join(repeated, [*on, "_salt"], how).drop("_salt")


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], spread_by: Sequence[str], salts: int
) -> DataFrame:
    """Inner join with every right row repeated ``salts`` times, without a counting pass.

    For a left side that is dear to compute twice and a right side that is small
    in comparison.
    """
    salt = F.pmod(F.xxhash64(F.lit("salt"), *spread_by), F.lit(salts)).cast("int")
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", salt).join(repeated, [*on, "_salt"]).drop("_salt")


def with_possible_partner(df: DataFrame, other: DataFrame, on: Sequence[str], most_bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``df`` whose ``on`` columns may be in ``other``: all that are, and few that are not.

    For the large side of an inner join of which most rows have no partner: they go before the shuffle. A bit
    is set for each key of ``other`` at the place its hash says; the bits are made by an aggregation and
    broadcast. One key in FILTER_BITS_PER_KEY without a partner stays, more if that takes more than ``most_bits``.
    """
    on = list(on)
    keys = other.select(F.xxhash64(*on).alias("_key"))
    distinct = keys.agg(F.approx_count_distinct("_key")).first()[0]
    wanted = max(FILTER_ROW_BITS, FILTER_BITS_PER_KEY * distinct)
    bits = min(1 << (wanted - 1).bit_length(), most_bits)
    place = lambda key: F.pmod(key, F.lit(bits).cast("bigint"))
    # Bits and rows count from 1.
    counted = keys.select((place(F.col("_key")) + 1).alias("_place"))
    held = counted.groupBy((F.bitmap_bucket_number("_place") - 1).alias("_row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_held")
    )
    # Eight bytes as one number, the first byte on top; of an array nothing is copied to look at one of them.
    word = lambda i: F.conv(F.hex(F.substring("_held", 8 * i + 1, F.lit(8))), 16, -10).cast("bigint")
    table = held.select("_row", F.transform(F.sequence(F.lit(0), F.lit(FILTER_ROW_BITS // 64 - 1)), word).alias("_words"))
    inside = F.col("_place").bitwiseAND(F.lit(FILTER_ROW_BITS - 1)).cast("int")
    bit = inside.bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56))
    return (
        df.withColumn("_place", place(F.xxhash64(*on)))
        .withColumn("_row", F.floor(F.col("_place") / FILTER_ROW_BITS))
        .join(F.broadcast(table), "_row")
        .where(F.getbit(F.get("_words", F.shiftright(inside, 6)).cast("bigint"), bit) == 1)
        .drop("_place", "_row", "_words")
    )
