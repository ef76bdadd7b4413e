"""Profiles that add up: each delivery leaves its counts, sketches and distinct values, and a profile adds those.

``record`` reads the rows of one delivery, once for each of two tables below ``folder``:

* ``counts``: one row with the number of rows, the filled cells and a sketch of the distinct values of each column,
* ``values``: how often each distinct value occurs, under a hash of 128 bits; the text stays only for ``listed`` columns.

Profiles, ratios and distributions over all deliveries read these tables and never the rows again. They
do not depend on the order of deliveries; recording one again replaces it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplabel.operators.publish import write_table
from shiplabel.sources.shipments import REQUIRED

# What the required columns are called in a profile.
NAMES = {"hs_code": "hs_codes", "goods_shipped": "goods", "shipment_id": "shipments", "category": "categories"}
# Sketches of 2^14 registers: about 0.8 % standard error in 16 KB at most.
SKETCH_BITS = 14


def counts_of(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``rows``, and ``filled_`` and ``sketch_`` of each column."""
    filled = lambda c: F.count_if(F.col(c).isNotNull() & (F.col(c) != ""))
    return rows.agg(
        F.count("*").alias("rows"),
        *(filled(c).alias(f"filled_{c}") for c in columns),
        *(F.hll_sketch_agg(c, SKETCH_BITS).alias(f"sketch_{c}") for c in columns),
    )


def values_of(rows: DataFrame, columns: Sequence[str], listed: Sequence[str] = ()) -> DataFrame:
    """``column, key, value, n``: how often each distinct value of each column occurs; NULL is none.

    All columns are counted in one pass, partially before the shuffle, so a value that a third of
    the rows hold is one row of a task when it is moved.
    """
    cells = F.array(
        *(
            F.struct(
                F.lit(c).alias("column"),
                F.unhex(F.md5(c)).alias("key"),
                (F.col(c) if c in listed else F.lit(None).cast("string")).alias("value"),
            )
            for c in columns
        )
    )
    present = F.filter(cells, lambda cell: cell["key"].isNotNull())
    melted = rows.select(F.inline(present))
    return melted.groupBy("column", "key").agg(F.any_value("value").alias("value"), F.count("*").alias("n"))


def record(
    rows: DataFrame, folder: str, delivery: str, columns: Sequence[str] = REQUIRED, listed: Sequence[str] = ()
) -> None:
    """Write what a delivery adds to the profile. ``listed`` columns are counted value by value as well.

    All deliveries of a folder take the same columns. The counts are written last: a new delivery
    whose recording stopped before has no part in a profile. If recording one again stops, repeat it.
    """
    if delivery == "" or "/" in delivery:
        raise ValueError(f"a delivery's name is part of a path, not {delivery!r}")
    every = list(dict.fromkeys([*columns, *listed]))
    text = rows.select(*(F.col(c).cast("string").alias(c) for c in every))
    # Prefixed, so that a name is never read back as a number or a date.
    write_table(values_of(text, every, listed), f"{folder}/values/delivery=id-{delivery}")
    write_table(counts_of(text, every), f"{folder}/counts/delivery=id-{delivery}")


def _tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    counts = spark.read.parquet(f"{folder}/counts")
    values = spark.read.parquet(f"{folder}/values")
    # One name for each delivery; the driver lists their folders anyway.
    return counts, values.join(F.broadcast(counts.select("delivery")), "delivery", "left_semi")


def _distinct(values: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col("column") == c).alias(NAMES.get(c, f"distinct_{c}")) for c in columns]


def profile(spark: SparkSession, folder: str, approximate: bool = False) -> DataFrame:
    """One row over all deliveries: rows, distinct values and filled cells of each column.

    Exact distinct counts read the stored hashes; approximate ones only the sketches, one row per delivery.
    """
    counts, values = _tables(spark, folder)
    columns = [c.removeprefix("filled_") for c in counts.columns if c.startswith("filled_")]
    sums = [
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *(F.coalesce(F.sum(f"filled_{c}"), F.lit(0)).alias(f"filled_{NAMES.get(c, c)}") for c in columns),
    ]
    if approximate:
        estimates = (F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{c}")).alias(NAMES.get(c, f"distinct_{c}")) for c in columns)
        return counts.agg(*sums, *estimates)
    distinct = values.select("column", "key").distinct().agg(*_distinct(values, columns))
    # Two tables of one row each.
    return counts.agg(*sums).withColumn("_one", F.lit(1)).join(distinct.withColumn("_one", F.lit(1)), "_one").drop("_one")


def dedup_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, distinct descriptions and categories over all deliveries, and descriptions per row."""
    whole = profile(spark, folder)
    return whole.select("rows", "goods", "categories", F.round(F.try_divide("goods", "rows"), 6).alias("ratio"))


def distribution(spark: SparkSession, folder: str, column: str = "category") -> DataFrame:
    """``category, rows, percent`` (one decimal) of a listed column over all deliveries; NULL has its own row."""
    counts, values = _tables(spark, folder)
    listed = values.where(F.col("column") == column).groupBy("key").agg(
        F.any_value("value").alias("category"), F.sum("n").alias("rows")
    )
    if listed.where(F.col("category").isNull()).limit(1).count():
        raise ValueError(f"the values of {column!r} were not listed when deliveries were recorded")
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    missing = listed.agg((F.lit(total) - F.coalesce(F.sum("rows"), F.lit(0))).alias("rows")).where("rows > 0")
    every = listed.select("category", "rows").unionByName(missing.select(F.lit(None).cast("string").alias("category"), "rows"))
    return every.withColumn("percent", F.round(100 * F.col("rows") / F.lit(total), 1))
