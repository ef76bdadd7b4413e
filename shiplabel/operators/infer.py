"""Inferring products and attributes: samples, column summaries, replies, fallbacks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplabel.functions import text as X
from shiplabel.operators.scale import durable, first_in_groups, largest_group, smallest_in_groups

# --- fixed values -----------------------------------------------------------
MAX_SAMPLES = 120
SAMPLE_SEED = 42
MIN_ATTRIBUTES = 3
# A summary is a report of a column's first values.
SUMMARY_VALUES = 8
# Rows of a table that are read first for its first values.
HEAD_ROWS = 200_000
# Rows of a table that is always sent whole to every task.
FEW_ROWS = 100_000
# Cuts of the surveyed code. They are arguments here and off (None) unless a caller
# passes these numbers for identical results.
PARITY_VALUES = 30
PARITY_REPRESENTATIVES = 4
SUMMARY_COLUMNS = [
    "shipment_origin",
    "shipment_destination",
    "port_of_lading_country",
    "port_of_unlading_country",
    "transport_method",
    "is_containerized",
    "industry_gics",
    "shipper_profile",
    "consignee_profile",
    "value_of_goods_usd",
    "weight_in_kg",
    "volume_teu",
]
KEYWORDS = [
    "grade",
    "variety",
    "process",
    "pack",
    "form",
    "moisture",
    "screen",
    "mesh",
    "quality",
    "color",
    "size",
    "type",
]
KEYWORD_LINE = "Detected dynamic attribute hints: "
# Attribute, source column, definition; tried in this order.
FALLBACKS = [
    ("Origin_Country", "shipment_origin", "Country where the shipment originated."),
    ("Destination_Country", "shipment_destination", "Country where the shipment is delivered."),
    ("Port_Of_Lading_Country", "port_of_lading_country", "Country corresponding to the port of lading."),
    ("Port_Of_Unlading_Country", "port_of_unlading_country", "Country corresponding to the port of unlading."),
    ("Transport_Method", "transport_method", "Primary transport mode used for the shipment."),
    ("Containerization_Status", "is_containerized", "Whether the shipment travelled in containers (True/False)."),
    ("Industry_Gics", "industry_gics", "GICS industry classification associated with the shipment."),
    ("Value_Of_Goods_Usd", "value_of_goods_usd", "Declared value of the goods in USD."),
    ("Weight_In_Kg", "weight_in_kg", "Reported weight of the shipment in kilograms."),
    ("Volume_Teu", "volume_teu", "Shipment volume expressed in twenty-foot equivalent units (TEU)."),
]
KEYWORD_DEFINITION = "Values observed for column '{}' among shipments in this category."
# ----------------------------------------------------------------------------


def keyword_columns(columns: Sequence[str]) -> list[str]:
    """Columns outside the fixed summary columns whose name holds a keyword."""
    return [
        c for c in columns
        if c not in SUMMARY_COLUMNS and any(k in c.lower() for k in KEYWORDS)
    ]


def cell_text(df: DataFrame, column: str) -> Column:
    """A cell as text: plain decimals for numbers, capitalised truth values."""
    c = F.col(f"`{column}`")
    kind = df.schema[column].dataType.simpleString()
    if kind == "boolean":
        return F.initcap(c.cast("string"))
    if kind in ("double", "float"):
        plain = F.regexp_replace(c.cast("decimal(38,10)").cast("string"), r"(\.\d+?)0+$", "$1")
        return F.when((F.abs(c) >= 1e7) & (F.abs(c) < 1e16), plain).otherwise(c.cast("string"))
    return c.cast("string")


def _melted(df: DataFrame, columns: Sequence[str], by: str, ord_column: str) -> DataFrame:
    """``by, ord, column, value, _key``: one row for each filled cell; cells with the same ``_key`` are one value."""
    pairs = F.array(
        *(F.struct(F.lit(c).alias("column"), X.strip(cell_text(df, c)).alias("value")) for c in columns)
    )
    filled = F.filter(pairs, lambda p: p["value"].isNotNull() & (p["value"] != ""))
    return df.select(by, ord_column, F.inline(filled)).withColumn("_key", F.lower("value"))


def _first_seen(melted: DataFrame, by: str, ord_column: str) -> DataFrame:
    return melted.groupBy(by, "column", "_key").agg(F.min(F.struct(ord_column, "value")).alias("_first"))


def _head_bound(df: DataFrame, ord_column: str, rows: int):
    """A value of the order column with about ``HEAD_ROWS`` of the ``rows`` up to it, from a sample; None: take all rows."""
    if rows <= 4 * HEAD_ROWS:
        return None
    every = max(1, HEAD_ROWS // 100)
    sampled = df.where(F.col(ord_column).isNotNull() & (F.pmod(F.xxhash64(ord_column), F.lit(every)) == 0)).select(ord_column)
    # A hundred values.
    found = sampled.orderBy(ord_column).limit(HEAD_ROWS // every).agg(F.max(ord_column)).first()[0]
    return found


def first_values(
    df: DataFrame,
    columns: Sequence[str],
    limit: int | None,
    by: str = "category",
    ord_column: str = "ord",
) -> DataFrame:
    """``by, column, place, value``: each column's first ``limit`` (None: all) distinct values in row order.

    Distinctness ignores case and outer blanks; the first spelling is kept. With a ``limit`` the rows are
    written once, and the first HEAD_ROWS of them are read first: a column of a group that shows ``limit``
    values there is settled, and of the others only values that are new after those rows go on. So hardly any
    row of a large table is sorted or moved, and the result is that of all rows.
    """
    if limit is None:
        first_seen = _first_seen(_melted(df, columns, by, ord_column), by, ord_column)
        return _placed(first_seen, by, ord_column, limit, None)
    own = {c: cell_text(df, c) for c in columns}
    df = durable(df.select(F.col(by), F.col(ord_column), *(v.alias(c) for c, v in own.items() if c not in (by, ord_column))))
    bound = _head_bound(df, ord_column, df.count())
    if bound is None:
        return _placed(_first_seen(_melted(df, columns, by, ord_column), by, ord_column), by, ord_column, limit, largest_group(df, [by]))
    # A row without an order comes first.
    in_head = F.coalesce(F.col(ord_column) <= F.lit(bound), F.lit(True))
    head = durable(_first_seen(_melted(df.where(in_head), columns, by, ord_column), by, ord_column))
    shown = head.groupBy(by, "column").agg(F.count("*").alias("_shown"))
    # Fewer than limit rows for each column of a group.
    few = F.broadcast if shown.count() * limit <= FEW_ROWS else lambda rows: rows
    pair = [F.col(by).eqNullSafe(F.col("_by")), F.col("column") == F.col("_column")]
    settled = shown.where(F.col("_shown") >= limit).select(F.col(by).alias("_by"), F.col("column").alias("_column"))
    opened = head.join(settled, pair, "left_anti")
    known = opened.select(F.col(by).alias("_by"), F.col("column").alias("_column"), F.col("_key").alias("_known"))
    later = _melted(df.where(~in_head), columns, by, ord_column)
    fresh = later.join(few(settled), pair, "left_anti").join(few(known), [*pair, F.col("_key") == F.col("_known")], "left_anti")
    first_seen = head.unionByName(_first_seen(fresh, by, ord_column))
    return _placed(first_seen, by, ord_column, limit, largest_group(df, [by]))


def _placed(first_seen: DataFrame, by: str, ord_column: str, limit: int | None, largest: int | None) -> DataFrame:
    # A column of a group has no more distinct values than the group has rows.
    seen = first_seen.select(by, "column", "_first.*")
    placed = first_in_groups(seen, [by, "column"], [ord_column, "value"], limit, "place", largest)
    return placed.select(by, "column", "place", "value")


def category_summary(
    df: DataFrame, by: str = "category", ord_column: str = "ord", values: int | None = SUMMARY_VALUES
) -> DataFrame:
    """``by, summary``: lines ``column: v1, v2…`` (the first ``values``, or all) and a line of the keywords met."""
    fixed = [c for c in SUMMARY_COLUMNS if c in df.columns]
    dynamic = [c for c in keyword_columns(df.columns) if c not in (by, ord_column)]
    places = {c: i for i, c in enumerate([*fixed, *dynamic])}
    if not places:
        return df.select(by).distinct().withColumn("summary", F.lit(""))
    listed = (
        first_values(df, list(places), values, by, ord_column)
        .groupBy(by, "column")
        .agg(F.array_sort(F.collect_list(F.struct("place", "value")))["value"].alias("values"))
    )
    rank = F.create_map(*(F.lit(x) for pair in places.items() for x in pair))
    met = F.create_map(
        F.lit(""), F.array().cast("array<string>"),
        *(x for c in dynamic for x in (F.lit(c), F.array(*(F.lit(k) for k in KEYWORDS if k in c.lower())))),
    )
    lines = listed.select(
        by,
        rank[F.col("column")].alias("rank"),
        F.concat("column", F.lit(": "), F.array_join("values", ", ")).alias("line"),
        F.coalesce(met[F.col("column")], met[F.lit("")]).alias("met"),
    )
    whole = lines.groupBy(by).agg(
        F.array_sort(F.collect_list(F.struct("rank", "line")))["line"].alias("lines"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("met")))).alias("met"),
    )
    hint = F.when(F.size("met") > 0, F.concat(F.lit(KEYWORD_LINE), F.array_join("met", ", ")))
    return whole.select(by, F.concat_ws("\n", F.array_join("lines", "\n"), hint).alias("summary"))


def sample_goods(
    rows: DataFrame,
    by: str,
    limit: int = MAX_SAMPLES,
    seed: int = SAMPLE_SEED,
    ord_column: str = "ord",
) -> DataFrame:
    """``by, place, goods_shipped``: distinct descriptions of each group, at most ``limit``.

    Small groups come whole in first-seen order, larger ones as a seeded sample
    that does not depend on partitioning: the descriptions with the smallest
    seeded hashes. Which hashes are small enough is read off counts of their first digits, so
    no group is sorted; only about ``limit`` rows of each are.
    """
    described = rows.where(F.col("goods_shipped").isNotNull()).select(by, X.strip("goods_shipped").alias("goods_shipped"), ord_column)
    # Without an order column this is a hash aggregation: nothing is sorted.
    goods = durable(
        described.select(by, "goods_shipped").distinct().withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}|"), "goods_shipped")))
    )
    near = smallest_in_groups(goods, [by], "_hash", limit + 1)
    drawn = F.row_number().over(Window.partitionBy(by).orderBy("_hash", "goods_shipped"))
    kept = near.withColumn("_drawn", drawn).where(F.col("_drawn") <= limit + 1)
    group = Window.partitionBy(by)
    sampled = F.max("_drawn").over(group) > limit
    kept = durable(kept.withColumn("_sampled", sampled).where(F.col("_drawn") <= limit))
    # Only groups that come whole are put into first-seen order.
    whole = kept.where(~F.col("_sampled")).select(F.col(by).alias("_by"), F.col("goods_shipped").alias("_goods"))
    same = F.col(by).eqNullSafe(F.col("_by")) & (F.col("goods_shipped") == F.col("_goods"))
    seen = described.join(whole, same, "left_semi") if not whole.isEmpty() else described.where("false")
    first = seen.groupBy(by, "goods_shipped").agg(F.min(ord_column).alias("first_ord")).toDF("_by", "_goods", "first_ord")
    by_hash = F.when(F.col("_sampled"), F.col("_hash"))
    place = F.row_number().over(group.orderBy(by_hash, "first_ord", "goods_shipped"))
    return (
        kept.join(first, same, "left")
        .withColumn("place", place.cast("bigint"))
        .select(by, "place", "goods_shipped")
    )


def _cut(values: Column, most: int | None) -> Column:
    return values if most is None else F.slice(values, 1, most)


def _text_at(entry: Column, key: str) -> Column:
    return X.strip(F.coalesce(F.from_json(entry, f"{key} string")[key], F.lit("")))


def _checked(reply: Column, key: str) -> Column:
    """The entries under ``key`` of a reply as texts; a reply without readable JSON fails the query."""
    entries = X.reply_list(X.json_payload(reply), key)
    none = F.when(X.json_object(reply).isNotNull(), F.array().cast("array<string>"))
    return F.coalesce(entries, none, F.raise_error(F.lit("reply holds no JSON payload")).cast("array<string>"))


def _texts_at(entry: Column, key: str) -> Column:
    """The strings of a list, without its numbers and other values; NaN and Infinity count as numbers, quoted or not."""
    typed = F.from_json(entry, f"{key} array<variant>")[key]
    strings = F.transform(F.filter(typed, lambda x: F.schema_of_variant(x) == "STRING"), lambda x: x.cast("string"))
    return F.filter(F.coalesce(strings, F.array().cast("array<string>")), lambda x: ~x.isin("NaN", "Infinity", "-Infinity"))


def inferred_products(replies: DataFrame, max_representatives: int | None = None) -> DataFrame:
    """``hs_code, ord, category, description, representatives`` from ``hs4, reply``."""
    entries = replies.select(
        F.col("hs4").alias("hs_code"),
        F.posexplode(_checked(F.col("reply"), "product_categories")).alias("pos", "v"),
    ).where(F.startswith("v", F.lit("{")))
    listed = F.from_json("v", "representative_goods array<string>")["representative_goods"]
    reps = F.filter(
        F.transform(F.coalesce(listed, F.array().cast("array<string>")), lambda r: X.strip(r)), lambda r: r != ""
    )
    named = entries.select(
        "hs_code",
        "pos",
        _text_at(F.col("v"), "name").alias("category"),
        F.nullif(_text_at(F.col("v"), "description"), F.lit("")).alias("description"),
        _cut(reps, max_representatives).alias("representatives"),
    ).where("category <> ''")
    first = named.groupBy("hs_code", "category").agg(
        F.min(F.struct("pos", "description", "representatives")).alias("e")
    )
    order = F.row_number().over(Window.partitionBy("hs_code").orderBy("e.pos"))
    return first.select(
        "hs_code",
        (order - 1).cast("int").alias("ord"),
        "category",
        F.col("e.description"),
        F.col("e.representatives"),
    )


def read_attribute_replies(replies: DataFrame, max_values: int | None = None) -> DataFrame:
    """``category, attr, attr_ord, definition, values`` from ``category, reply``; first name wins."""
    entries = replies.select(
        "category", F.posexplode(_checked(F.col("reply"), "attributes")).alias("attr_ord", "v")
    ).where(F.startswith("v", F.lit("{")))
    named = entries.select(
        "category",
        "attr_ord",
        F.from_json("v", "name string")["name"].alias("name"),
        F.nullif(_text_at(F.col("v"), "definition"), F.lit("")).alias("definition"),
        _cut(X.title_values(_texts_at(F.col("v"), "values")), max_values).alias("values"),
    ).where("name IS NOT NULL AND name <> ''")
    per_name = named.withColumn("attr", X.attr_name("name")).groupBy("category", "attr")
    # the values of the first mention count; a later mention adds nothing
    return per_name.agg(F.min(F.struct("attr_ord", "definition", "values")).alias("e")).select(
        "category", "attr", "e.attr_ord", "e.definition", "e.values"
    )


def _candidates(df: DataFrame, by: str, ord_column: str) -> list[tuple[str, str | Column, str]]:
    """(column, attribute, definition) of the columns that can stand in for an attribute, in the order they are tried."""
    fixed = [(c, a, d) for a, c, d in FALLBACKS if c in df.columns]
    derived = [c for c in keyword_columns(df.columns) if c not in (by, ord_column)]
    return fixed + [(c, X.attr_name(F.lit(c)), KEYWORD_DEFINITION.format(c)) for c in derived]


def fallback_candidates(df: DataFrame, by: str = "category", ord_column: str = "ord") -> DataFrame:
    """``by, column, attr, rank, definition`` of the columns with values, in the order they are tried; no value is listed."""
    candidates = _candidates(df, by, ord_column)
    if not candidates:
        return df.sparkSession.createDataFrame([], f"{by} string, column string, attr string, rank int, definition string")
    columns = list(dict.fromkeys(c for c, _, _ in candidates))
    has_title = lambda c: F.size(X.title_values(F.array(X.strip(cell_text(df, c))))) > 0
    filled = df.groupBy(by).agg(*(F.coalesce(F.max(has_title(c)), F.lit(False)).alias(f"_{i}") for i, c in enumerate(columns)))
    known = F.array(
        *(
            F.struct(
                F.lit(c).alias("column"),
                (F.lit(a) if isinstance(a, str) else a).alias("attr"),
                F.lit(i).alias("rank"),
                F.lit(d).alias("definition"),
                F.col(f"_{columns.index(c)}").alias("filled"),
            )
            for i, (c, a, d) in enumerate(candidates)
        )
    )
    return filled.select(by, F.inline(known)).where("filled").drop("filled")


def fallback_choices(
    df: DataFrame, existing: DataFrame, by: str = "category", ord_column: str = "ord", minimum: int = MIN_ATTRIBUTES
) -> DataFrame:
    """``by, column, attr, rank, definition``: which columns stand in for categories with fewer than ``minimum`` attributes."""
    filled = existing.where(F.size("values") > 0)
    have = filled.groupBy(by).agg(F.count("*").alias("_have"))
    fresh = fallback_candidates(df, by, ord_column).join(filled.select(by, "attr"), [by, "attr"], "left_anti")
    once = fresh.groupBy(by, "attr").agg(F.min(F.struct("rank", "definition", "column")).alias("c")).select(by, "attr", "c.*")
    nth = F.row_number().over(Window.partitionBy(by).orderBy("rank"))
    return (
        once.withColumn("_nth", nth)
        .join(have, by, "left")
        .where(F.col("_nth") <= minimum - F.coalesce("_have", F.lit(0)))
        .select(by, "column", "attr", "rank", "definition")
    )


def fallback_attributes(
    df: DataFrame,
    existing: DataFrame,
    by: str = "category",
    ord_column: str = "ord",
    minimum: int = MIN_ATTRIBUTES,
    max_values: int | None = None,
) -> DataFrame:
    """Attributes taken from columns for categories with fewer than ``minimum`` from a reply.

    ``existing`` holds ``by, attr, values``; only its non-empty attributes count. Which columns are taken
    is settled first, from whether they have values at all; only these are listed.
    """
    candidates = _candidates(df, by, ord_column)
    columns = list(dict.fromkeys(c for c, _, _ in candidates))
    chosen = fallback_choices(df, existing, by, ord_column, minimum)
    if not columns:
        return chosen.select(by, "attr", "rank", "definition", F.array().cast("array<string>").alias("values"))
    chosen = durable(chosen)
    taken = chosen.groupBy(by).agg(F.collect_set("column").alias("_taken"))
    cell = lambda c: F.when(F.array_contains("_taken", c), cell_text(df, c)).alias(c)
    # One row for each category.
    wanted = df.join(F.broadcast(taken), by).select(by, ord_column, *(cell(c) for c in columns))
    observed = (
        first_values(wanted, columns, max_values, by, ord_column)
        .groupBy(by, "column")
        .agg(F.array_sort(F.collect_list(F.struct("place", "value")))["value"].alias("values"))
    )
    # Without the values (which every chosen column has) the lists need not be made.
    return chosen.join(observed, [by, "column"], "left").select(by, "attr", "rank", "definition", X.title_values("values").alias("values"))


def inferred_schema(
    df: DataFrame,
    replies: DataFrame,
    by: str = "category",
    ord_column: str = "ord",
    max_values: int | None = None,
) -> DataFrame:
    """``category, attr, attr_ord, definition, values, source`` of every category with rows.

    Replied attributes come first, then fallbacks; an attribute nobody has values
    for is dropped, but its replied place is kept when a fallback fills it.
    """
    read = read_attribute_replies(replies, max_values).withColumnRenamed("category", by)
    read = read.join(df.select(by).distinct(), by, "left_semi")
    extra = fallback_attributes(df, read, by, ord_column, max_values=max_values).select(
        by, "attr", F.col("rank").alias("_rank"), F.col("definition").alias("_def"), F.col("values").alias("_values")
    )
    both = read.join(extra, [by, "attr"], "full")
    replied = F.size(F.coalesce("values", F.array())) > 0
    chosen = both.select(
        by,
        "attr",
        F.struct(
            F.col("attr_ord").isNull().alias("late"), F.coalesce("attr_ord", "_rank").alias("place")
        ).alias("_place"),
        F.coalesce("definition", "_def").alias("definition"),
        F.when(replied, F.col("values")).otherwise(F.col("_values")).alias("values"),
        F.when(replied, "reply").otherwise("fallback").alias("source"),
        (replied | F.col("_rank").isNotNull()).alias("_listed"),
    ).where("_listed")
    order = F.row_number().over(Window.partitionBy(by).orderBy("_place"))
    return chosen.select(
        by, "attr", (order - 1).cast("int").alias("attr_ord"), "definition", "values", "source"
    )


def inferred_dictionary(schema: DataFrame, by: str = "category") -> DataFrame:
    """An inferred schema (with its ``hs_code``) as an attribute dictionary."""
    return schema.select(
        "hs_code",
        F.col(by).alias("product"),
        "attr",
        "attr_ord",
        F.posexplode("values").alias("value_ord", "value"),
    ).select("hs_code", "product", "attr", "attr_ord", "value", "value_ord")


def inferred_definitions(schema: DataFrame, categories: Sequence[str], by: str = "category") -> DataFrame:
    """``attr_key, definition``; a later category overrides an earlier one."""
    place = F.array_position(F.array(*(F.lit(c) for c in categories)), F.col(by))
    return (
        schema.where("definition IS NOT NULL")
        .groupBy(X.attr_key("attr").alias("attr_key"))
        .agg(F.max_by("definition", place).alias("definition"))
    )


def telemetry(schema: DataFrame, by: str = "category") -> DataFrame:
    """How many attributes each category got from the reply, and the fallbacks used."""
    return schema.groupBy(by).agg(
        F.count_if(F.col("source") == "reply").alias("model_attribute_count"),
        F.array_sort(F.collect_list(F.when(F.col("source") == "fallback", F.struct("attr_ord", "attr"))))["attr"].alias("fallback_attributes"),
        F.count("*").alias("final_attribute_count"),
    )
