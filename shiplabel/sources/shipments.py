"""Reading, cleaning, checking and profiling shipment tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shiplabel.functions import text as X
from shiplabel.operators.scale import rank_in_groups

# --- fixed values -----------------------------------------------------------
REQUIRED = ["hs_code", "goods_shipped", "shipment_id"]
REQUIRED_CLASSIFIED = ["hs_code", "goods_shipped", "category"]
# Cells that count as missing when a CSV file is read.
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# ----------------------------------------------------------------------------


def missing_as_null(df: DataFrame) -> DataFrame:
    """Turn the spellings of a missing cell into NULL in every string column."""
    strings = {f.name for f in df.schema if f.dataType.simpleString() == "string"}
    return df.select(
        *(
            F.when(~F.col(f"`{c}`").isin(CSV_MISSING), F.col(f"`{c}`")).alias(c)
            if c in strings
            else F.col(f"`{c}`")
            for c in df.columns
        )
    )


def read_csv(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """CSV with a header; every cell stays text, so codes keep their leading zeros.

    A file whose cells may hold line breaks is read by one task. For large files without
    such cells pass ``multi_line=False``, and they are split.
    """
    raw = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return missing_as_null(raw)


def require_columns(df: DataFrame, columns: Iterable[str] = REQUIRED) -> DataFrame:
    """Fail at analysis time, without a job, if a column is absent."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"table is missing required columns: {absent}")
    return df


def standardise(df: DataFrame) -> DataFrame:
    """The three required columns as trimmed text; a missing description becomes ''."""
    require_columns(df)
    return df.withColumns(
        {
            "hs_code": X.strip(F.col("hs_code").cast("string")),
            "goods_shipped": X.strip(F.coalesce(F.col("goods_shipped").cast("string"), F.lit(""))),
            "shipment_id": X.strip(F.col("shipment_id").cast("string")),
        }
    )


def clean(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Standardised rows with a description.

    ``observation`` receives ``rows_in`` and ``rows_removed`` when the plan runs,
    so counting the removed rows needs no scan of its own.
    """
    rows = standardise(df)
    if observation is not None:
        rows = rows.observe(
            observation,
            F.count("*").alias("rows_in"),
            F.count_if(F.col("goods_shipped") == "").alias("rows_removed"),
        )
    return rows.where(F.col("goods_shipped") != "")


def load_table(
    source: DataFrame, filters: Mapping[str, object] | None = None
) -> DataFrame:
    """Rows of a table that equal all ``filters``, with four-character codes and trimmed text.

    ``source`` is any DataFrame (``spark.table``, ``spark.sql``, parquet, JDBC …);
    the comparisons are plain predicates that reach the scan.
    """
    rows = source
    for column, value in (filters or {}).items():
        rows = rows.where(F.col(column) == F.lit(value))
    return rows.withColumns(
        {
            "hs_code": F.substring(F.col("hs_code").cast("string"), 1, 4),
            "goods_shipped": X.strip(F.coalesce(F.col("goods_shipped"), F.lit(""))),
            "shipment_id": F.col("shipment_id").cast("string"),
        }
    )


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: rows, distinct values and non-empty cells of the required columns."""
    require_columns(df)
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    filled = lambda c: F.count_if(F.col(c).isNotNull() & (F.col(c) != ""))
    return df.agg(
        F.count("*").alias("rows"),
        distinct("hs_code").alias("hs_codes"),
        distinct("goods_shipped").alias("goods"),
        distinct("shipment_id").alias("shipments"),
        filled("hs_code").alias("filled_hs_codes"),
        filled("goods_shipped").alias("filled_goods"),
        filled("shipment_id").alias("filled_shipments"),
    )


def validate(df: DataFrame) -> dict:
    """The profile as a dict; fails if a required column is entirely empty."""
    numbers = profile(df).first().asDict()
    for column, filled in [
        ("goods_shipped", "filled_goods"),
        ("shipment_id", "filled_shipments"),
        ("hs_code", "filled_hs_codes"),
    ]:
        if not numbers[filled]:
            raise ValueError(f"{column!r} column is entirely empty")
    return numbers


def heading(c, rule: str = "digits", numeric_hs: bool = False) -> Column:
    """Four-digit heading by ``digits`` or ``trunc``; see the text functions of that name.

    ``numeric_hs`` first drops leading zeros, as if the code had been a number.
    """
    code = X.drop_leading_zeros(c) if numeric_hs else c
    rules = {"digits": X.hs4_digits, "trunc": X.hs4_trunc}
    if rule not in rules:
        raise ValueError(f"rule must be one of {sorted(rules)}, not {rule!r}")
    return rules[rule](code)


def classified_input(
    df: DataFrame, hs_rule: str = "digits", numeric_hs: bool = False, ord_column: str = "ord"
) -> DataFrame:
    """``hs_code, product, goods_shipped, shipment_id`` (and the order column) of labelled rows.

    Without a ``shipment_id`` column the 1-based row number in ``ord`` order is used.
    """
    require_columns(df, REQUIRED_CLASSIFIED)
    if "shipment_id" not in df.columns:
        numbered = rank_in_groups(df, [], [ord_column], "shipment_id")
        df = numbered.withColumn("shipment_id", F.col("shipment_id").cast("string"))
    order = [ord_column] if ord_column in df.columns else []
    return df.select(
        heading("hs_code", hs_rule, numeric_hs).alias("hs_code"),
        X.strip("category").alias("product"),
        X.strip("goods_shipped").alias("goods_shipped"),
        F.coalesce(X.strip("shipment_id"), F.lit("")).alias("shipment_id"),
        *order,
    ).where(F.col("goods_shipped").isNotNull())


def with_goods(df: DataFrame) -> DataFrame:
    """Rows that have a description to label."""
    return df.where(X.strip("goods_shipped") != "")


def hs_filter(df: DataFrame, codes: Iterable[str]) -> DataFrame:
    """Rows of the given headings (first four characters of each code)."""
    return df.where(F.col("hs_code").isin(sorted({str(c)[:4] for c in codes})))


def with_dictionary(df: DataFrame, attr_dict: DataFrame) -> DataFrame:
    """Rows whose heading has any dictionary.

    A heading is four digits, so there are few: they go to the rows, which stay where they are. Dealt by
    heading, all rows would meet in as many tasks as there are headings.
    """
    return df.join(F.broadcast(attr_dict.select("hs_code").distinct()), "hs_code", "left_semi")


def of_heading(df: DataFrame, code: str) -> DataFrame:
    """Rows of one heading by the digits rule; ``code`` is normalised likewise."""
    return df.where(X.hs4_digits("hs_code") == X.hs4_strict(F.lit(code)))


def available_headings(df: DataFrame) -> DataFrame:
    """The headings a table holds, by the digits rule."""
    return df.select(X.hs4_digits("hs_code").alias("hs4")).where("hs4 <> ''").distinct()
