"""Grouping descriptions into request batches, and spending a token budget on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplabel.operators.dictionary import KEY
from shiplabel.operators.scale import first_in_groups, largest_group, rank_in_groups, running_total, skew_join

# --- fixed values -----------------------------------------------------------
BATCH_SIZE = 10
TOKEN_BUDGET = 20_000_000
# ----------------------------------------------------------------------------


def number_batches(
    goods: DataFrame,
    size: int = BATCH_SIZE,
    groups: Sequence[str] = tuple(KEY),
    order: Sequence[str] = ("goods_shipped",),
) -> DataFrame:
    """Add ``batch_no`` and ``pos`` (both from 0): consecutive runs of ``size`` per group."""
    ranked = rank_in_groups(goods, groups, order, "_rank")
    step = F.col("_rank") - 1
    return (
        ranked.withColumn("batch_no", F.floor(step / size).cast("bigint"))
        .withColumn("pos", F.pmod(step, F.lit(size)).cast("bigint"))
        .drop("_rank")
    )


def batch_table(
    items: DataFrame, groups: Sequence[str] = tuple(KEY), beside: DataFrame | None = None
) -> DataFrame:
    """One row per batch: its numbered lines, its size and the number of batches of its group.

    ``beside`` has one row for some groups; its columns come along, batches of other groups go.
    """
    groups = list(groups)
    line = F.struct("pos", F.concat((F.col("pos") + 1).cast("string"), F.lit(". "), "goods_shipped"))
    batches = items.groupBy(*groups, "batch_no").agg(
        F.count("*").alias("batch_size"),
        F.array_join(F.array_sort(F.collect_list(line))["col2"], "\n").alias("lines"),
    )
    if not groups:
        total = batches.agg(F.count("*")).scalar()
        return batches.withColumn("total_batches", total)
    # Lines are not needed for the totals, so they are counted from the items alone.
    totals = items.select(*groups, "batch_no").distinct().groupBy(*groups).agg(F.count("*").alias("total_batches"))
    of_group = totals if beside is None else totals.join(beside, groups)
    counts = totals.withColumnRenamed("total_batches", "_rows")
    return skew_join(batches, of_group, groups, spread_by=["batch_no"], counts=counts)


def first_goods(rows: DataFrame, n: int | None, ord_column: str = "ord") -> DataFrame:
    """The first ``n`` distinct descriptions of each (heading, product) in row order."""
    seen = rows.groupBy(*KEY, "goods_shipped").agg(F.min(ord_column).alias("first_ord"))
    largest = None if n is None else largest_group(rows, KEY)
    return first_in_groups(seen, KEY, ["first_ord", "goods_shipped"], n, "place", largest)


def within_budget(
    batches: DataFrame,
    budget: int = TOKEN_BUDGET,
    used: int = 0,
    groups: Sequence[str] = tuple(KEY),
) -> DataFrame:
    """Add ``used_before`` and ``runs``: a batch runs while the tokens used are below budget.

    ``batches`` has a ``cost`` per batch; ``used`` is what earlier runs have spent.
    """
    spent = running_total(batches, "cost", groups, "batch_no", "_spent")
    return (
        spent.withColumn("used_before", F.col("_spent") + F.lit(used).cast("bigint"))
        .withColumn("runs", F.col("used_before") < budget)
        .drop("_spent")
    )
