"""Reproducible shuffle into shards: a Feistel permutation of global row numbers, with cycle walking.

Rows are numbered 0 to n-1 in the order of (doc_id, crc32, size). A keyed Feistel network
permutes the numbers below a*b, the smallest near-square product not below n; a number that
lands at n or beyond walks on until it is below n, so the result permutes 0 to n-1. Shard and
slot follow from the permuted number alone (remainder and quotient by the shard count), and
``row_at`` computes the way back. Shard counts differ by at most one row.

Walks pass only through the at most sqrt(n)+1 surplus numbers, so their ends are computed
beforehand, to the last one, and joined by broadcast: no row is left outside whatever n is.

Null texts have size 1 and crc32 0; null ids sort first; repeated rows get numbers of their
own (which of two identical rows gets which is immaterial); an empty table gives no rows. Only
doc_id and text are read, so further columns cannot clash.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplabel.llm.common import numbered, text_or_empty, written

SEED = 20240117
ROUNDS = 6


def domain(rows: int) -> tuple[int, int]:
    """Widths a, b of the two halves: a*b >= rows, with fewer than a numbers to spare."""
    a = max(1, isqrt(max(rows - 1, 0)) + 1)
    return a, max(1, -(-rows // a))


def _passed(df: DataFrame, x: str, rows: int, seed: int, sign: int) -> DataFrame:
    """``df`` with column ``x`` sent once through the network; ``sign`` -1 sends it back.

    Each round changes one half by a keyed hash of the other. Rounds are projections over
    plain columns, so all of them are generated code.
    """
    a, b = domain(rows)
    others = [c for c in df.columns if c != x]
    out = df.select(
        *others,
        F.expr(f"`{x}` % {a}").cast("bigint").alias("_l"),
        F.expr(f"`{x}` div {a}").cast("bigint").alias("_r"),
    )
    for j in range(ROUNDS) if sign > 0 else reversed(range(ROUNDS)):
        to, by, width = ("_l", "_r", a) if j % 2 == 0 else ("_r", "_l", b)
        mixed = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(j), F.col(by)), 1) % F.lit(width)
        moved = F.col(to) + mixed if sign > 0 else F.col(to) - mixed + F.lit(width)
        out = out.withColumn(to, moved % F.lit(width))
    return out.select(*others, (F.col("_l") + F.col("_r") * F.lit(a)).alias(x))


def walks(spark: SparkSession, rows: int, seed: int, sign: int) -> DataFrame:
    """(start, stop) of the walks: where each surplus number at last comes below ``rows``.

    There are at most sqrt(rows) + 1 surplus numbers. Few lead to another one, so the loop ends
    after a few passes; a number that meets itself lies on a cycle that no row can enter.
    """
    a, b = domain(rows)
    walking = spark.range(rows, a * b).select(F.col("id").alias("start"), F.col("id").alias("stop"))
    arrived = walking.limit(0)
    while not walking.isEmpty():
        moved = written(_passed(walking, "stop", rows, seed, sign), "walk")
        arrived = arrived.union(moved.where(F.col("stop") < rows))
        walking = moved.where((F.col("stop") >= rows) & (F.col("stop") != F.col("start")))
    return arrived


def _walked(df: DataFrame, x: str, rows: int, seed: int, sign: int) -> DataFrame:
    ends = walks(df.sparkSession, rows, seed, sign).toDF("_start", "_stop")
    return (
        _passed(df, x, rows, seed, sign)
        .join(F.broadcast(ends), F.col(x) == F.col("_start"), "left")
        .withColumn(x, F.coalesce("_stop", x))
        .drop("_start", "_stop")
    )


def permuted(df: DataFrame, number: str, rows: int, name: str, seed: int = SEED) -> DataFrame:
    """Add ``name``: the place of row ``number`` in the shuffled order of ``rows`` rows."""
    return _walked(df.withColumn(name, F.col(number).cast("bigint")), name, rows, seed, 1)


def row_at(
    df: DataFrame, shard: str, slot: str, rows: int, shards: int, name: str, seed: int = SEED
) -> DataFrame:
    """Add ``name``: the row number that lies at a shard's slot."""
    place = (F.col(slot) * shards + F.col(shard)).cast("bigint")
    return _walked(df.withColumn(name, place), name, rows, seed, -1)


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, row_number, law, shard, slot and grown_shard of every document."""
    text = text_or_empty()
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    ordered = numbered(rows, ["doc_id", "text_crc32", "size"], "row_number")
    n = ordered.count()
    return permuted(ordered, "row_number", n, "_to", seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod("_to", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"_to div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
