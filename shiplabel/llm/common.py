"""What the corpus operators share: tables in the shared folder, row numbers, crc filters."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiplabel.operators.scale import checkpoint_folder

# monotonically_increasing_id keeps a row's place in its partition in the low 33 bits.
PLACE_BITS = 33


def run_folder(spark: SparkSession) -> str:
    """This application's tables, below the folder that all executors share."""
    return f"{checkpoint_folder(spark)}/llm-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: later plans start there, also after lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_tables(spark: SparkSession) -> None:
    """Delete the tables of this application, once no result that reads them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_remainder(parts: int) -> Column:
    """crc32 of doc_id as text, modulo ``parts``; the folds of labelled rows. Null ids count as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts


def hash_sample(df: DataFrame, keys: Sequence[str], rows: int, salt: int) -> DataFrame:
    """About ``rows`` rows of ``df`` (all, if it has no more), those whose keys hash low: the same at every run.

    A filter, so nothing is sorted or moved; the number is binomial around ``rows`` if rows differ in
    their keys. Rows with equal keys are in the sample together or not at all.
    """
    total = df.count()
    if total <= rows:
        return df
    span = 1 << 40
    return df.where(F.pmod(F.xxhash64(*keys, F.lit(salt)), F.lit(span)) < span * rows // total)


def at_ranks(df: DataFrame, name: str, ranks: Sequence[int]) -> list[int]:
    """The values of column ``name`` at these places (from 0) of their order; longs that are not negative.

    Rows are counted by their first 16 bits, those that share them with a wanted value by the next 16, and so on: four
    passes, nothing is sorted, and 65,536 counts for each place are fetched at most. Give it a written table.
    """
    found = [(0, rank) for rank in ranks]
    for shift in (48, 32, 16, 0):
        digits = F.shiftright(name, shift)
        if shift < 48:
            df = df.where(F.shiftright(name, shift + 16).isin(sorted({p for p, _ in found})))
        counts = sorted((r["digits"], r["count"]) for r in df.groupBy(digits.alias("digits")).count().collect())
        for i, (prefix, left) in enumerate(found):
            for value, n in counts:
                if value >> 16 == prefix:
                    if left < n:
                        found[i] = (value, left)
                        break
                    left -= n
    return [value for value, _ in found]


def bit_table(df: DataFrame, name: str, bits: int) -> np.ndarray:
    """``bits`` truth values: is there a row whose column ``name`` (a hash) has this remainder? ``bits`` / 8 bytes are fetched."""
    # Bits and buckets count from 1.
    place = df.select((F.pmod(F.col(name), F.lit(bits).cast("long")) + 1).alias("place"))
    rows = (
        place.groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("held"))
        .collect()
    )
    out = np.zeros(bits, bool)
    for r in rows:
        held = np.unpackbits(np.frombuffer(r["held"], np.uint8), bitorder="little")
        at = (r["bucket"] - 1) * len(held) + np.flatnonzero(held)
        out[at[at < bits]] = True
    return out


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name)
    return out


def numbered(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Add a gapless ``name`` from 0 in the given order, without a window over all rows.

    The rows are range-partitioned and sorted, each keeps its place in its slice, and the
    written slices are shifted by the number of rows before them: one row for each slice.
    """
    placed = written(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    )
    slice_of = F.shiftright("_place", PLACE_BITS)
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        placed.groupBy(slice_of.alias("_slice"))
        .agg(F.count("*").alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (
        placed.withColumn("_slice", slice_of)
        .join(F.broadcast(before), "_slice")
        .withColumn(name, F.col("_before") + inside)
        .drop("_slice", "_before", "_place")
    )
