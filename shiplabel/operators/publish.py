"""Published tables: wide and flat rows, nested records, summaries, shipment map.

The input is classified rows: ``hs_code, product, goods_shipped, shipment_id`` and
``attributes`` (map), optionally ``custom_attributes`` and an order column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplabel.functions import text as X
from shiplabel.operators.dictionary import KEY
from shiplabel.operators.scale import PART_SIZE, durable, lists_in_parts, rank_in_groups, skew_join

GOODS = [*KEY, "goods_shipped"]
FILE_ITSELF = -1
# Most rows of one file of a per-product folder.
FILE_ROWS = 200_000

# --- fixed values -----------------------------------------------------------
PREFIX = "attr_"
FLAG_SUFFIX = "_is_custom"
# ----------------------------------------------------------------------------


def attribute_names(attr_dict: DataFrame) -> list[str]:
    """The attributes of a dictionary by first mention; they become columns."""
    rows = attr_dict.groupBy("attr").agg(F.min("attr_ord").alias("o")).orderBy("o", "attr")
    return [r["attr"] for r in rows.collect()]


def flat_attributes(rows: DataFrame, attrs: Sequence[str], flags: bool = False) -> DataFrame:
    """One ``attr_<name>`` column per attribute, empty where the product has none.

    ``rows`` may also be descriptions without shipments. A projection: the column list comes from the dictionary, so no pivot job and
    no shuffle are needed. ``flags`` adds ``attr_<name>_is_custom`` columns of 0/1.
    """
    columns = []
    for a in attrs:
        value = F.col("attributes")[F.lit(a)]
        columns.append(value.alias(f"{PREFIX}{a}"))
        if flags:
            custom = F.array_contains("custom_attributes", F.lit(a)).cast("int")
            columns.append(
                F.when(value.isNotNull(), F.coalesce(custom, F.lit(0))).alias(f"{PREFIX}{a}{FLAG_SUFFIX}")
            )
    kept = [c for c in ("shipment_id", "goods_shipped", "ord") if c in rows.columns]
    return rows.select(*KEY, *kept, *columns)


def with_shipments(classified: DataFrame, shipments: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """One row per description and shipment; a description without any gets a blank one.

    ``order`` names columns of ``shipments`` to carry along; they are NULL without a shipment.
    """
    pairs = shipments.select(*GOODS, "shipment_id", *order)
    known = skew_join(pairs, classified, GOODS, spread_by=["shipment_id"])
    alone = classified.join(pairs.select(*GOODS).distinct(), GOODS, "left_anti")
    return known.unionByName(alone.withColumn("shipment_id", F.lit("")), allowMissingColumns=True)


def goods_shipments(rows: DataFrame) -> DataFrame:
    """Every description with a shipment it occurs in, duplicates kept, blanks skipped."""
    return rows.where(X.strip("goods_shipped") != "").withColumn(
        "shipment_id",
        F.when(X.strip(F.coalesce("shipment_id", F.lit(""))) == "", "").otherwise(F.col("shipment_id")),
    )


def goods_to_shipments(
    rows: DataFrame, ord_column: str = "ord", part_size: int = PART_SIZE
) -> DataFrame:
    """The shipments of each description as lists in row order, in parts of bounded length."""
    return lists_in_parts(goods_shipments(rows), GOODS, [ord_column], "shipment_id", "shipment_ids", part_size)


def per_product(rows: DataFrame, attrs: Sequence[str], flags: bool = False) -> DataFrame:
    """Flat rows with the name of the per-product file each belongs to."""
    return flat_attributes(rows, attrs, flags).withColumn(
        "file", X.product_file("hs_code", "product")
    )


def nested_records(classified: DataFrame, lists: DataFrame, raw: bool = False) -> DataFrame:
    """One JSON record per description (and part of its shipment list).

    ``key`` is ``heading::product``; the records of a key form its classification
    list. No product is ever gathered into one document. ``raw`` adds ``raw_attributes``: values as
    the reply gave them, before they were normalised; what is no JSON value there stays a text.
    """
    spelled = F.transform_values(
        "raw_attributes", lambda _, v: F.coalesce(F.try_parse_json(v), v.cast("variant"))
    )
    as_replied = [spelled.alias("raw_attributes")] if raw else []
    record = F.struct(
        "goods_shipped",
        "attributes",
        F.when(F.size("custom_attributes") > 0, F.col("custom_attributes")).alias("custom_attributes"),
        F.when(F.size("heuristic_filled") > 0, F.col("heuristic_filled")).alias("heuristic_filled"),
        *as_replied,
        "shipment_ids",
    )
    joined = classified.join(lists, GOODS, "left").withColumn(
        "shipment_ids", F.coalesce("shipment_ids", F.array().cast("array<string>"))
    )
    return joined.select(
        F.concat("hs_code", F.lit("::"), "product").alias("key"),
        "goods_shipped",
        F.coalesce("part", F.lit(0)).cast("bigint").alias("part"),
        F.to_json(record).alias("record"),
    )


def placed_descriptions(classified: DataFrame, attrs: Sequence[str], flags: bool = False) -> DataFrame:
    """Classified descriptions in the shape of flat rows, with their place among all: ``_at`` and ``_shared``.

    Names of files and columns are made once for each description, not for each of its rows. ``_at`` follows
    (file, run, description); products whose names make the same file may share one.
    """
    wide = per_product(classified.withColumn("ord", F.col("run_no")), attrs, flags)
    order = ["file", "ord", "goods_shipped"]
    same = Window.partitionBy(*order)
    numbered = rank_in_groups(wide, [], order, "_at")
    return durable(
        numbered.withColumns({"_at": F.min("_at").over(same), "_shared": F.count("*").over(same) > 1}).drop("ord")
    )


def completed_products(classified: DataFrame) -> DataFrame:
    """``key, completed``: how many descriptions of each product are classified."""
    return classified.groupBy(F.concat("hs_code", F.lit("::"), "product").alias("key")).agg(
        F.count("*").alias("completed")
    )


def run_metadata(classified: DataFrame, costs: DataFrame, budget: int, batch_size: int) -> DataFrame:
    """One row about a run: products, headings, tokens used and left."""
    used = F.coalesce(costs.agg(F.sum("cost")).scalar(), F.lit(0)).cast("bigint")
    products = classified.select(*KEY).distinct()
    return (
        products.agg(
            F.count("*").alias("products_processed"),
            F.array_join(F.array_sort(F.collect_set("hs_code")), ",").alias("hs_codes_processed"),
        )
        .withColumn("token_usage", used)
        .withColumn("token_remaining", F.greatest(F.lit(budget) - F.col("token_usage"), F.lit(0)).cast("bigint"))
        .withColumn("items_per_call", F.lit(batch_size).cast("bigint"))
    )


def attribute_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(PREFIX)]


def observed_values(wide: DataFrame, ord_column: str = "ord", file_column: str = "file") -> DataFrame:
    """``file, c, attr, value, first_ord``: distinct cleaned values of each attribute column.

    Case is ignored, the first spelling in row order is kept. ``c`` is the place of
    the column among the attribute columns; a further row with ``FILE_ITSELF`` there
    keeps files without any value. An empty value tells that the file has the column
    (a cell that is not NULL), whatever values it takes. Rows with the same cells become one before
    their cells are unfolded.
    """
    columns = [F.col(f"`{c}`") for c in attribute_columns(wide)]
    wide = wide.groupBy(file_column, *columns).agg(F.min(ord_column).alias(ord_column))
    cells = F.array(
        *(
            F.struct(
                F.lit(i).alias("c"),
                X.attr_to_snake(F.lit(c)).alias("attr"),
                F.when(
                    F.col(f"`{c}`").isNotNull(),
                    F.coalesce(X.clean_value(F.col(f"`{c}`")), F.lit("")),
                ).alias("value"),
            )
            for i, c in enumerate(attribute_columns(wide))
        ),
        F.struct(F.lit(FILE_ITSELF).alias("c"), F.lit("").alias("attr"), F.lit("").alias("value")),
    )
    present = F.filter(cells, lambda x: x["value"].isNotNull())
    return (
        wide.select(file_column, ord_column, F.inline(present))
        .groupBy(file_column, "c", "attr", F.lower(X.strip("value")).alias("_key"))
        .agg(F.min(F.struct(F.col(ord_column).alias("first_ord"), "value")).alias("_first"))
        .select(file_column, "c", "attr", "_first.value", "_first.first_ord")
    )


def _constants(df: DataFrame, values: Sequence[Column]) -> list:
    """Values of constant expressions (here: column names run through a text function)."""
    if not values:
        return []
    return list(df.sparkSession.range(1).select(*(v.alias(str(i)) for i, v in enumerate(values))).first())


def schema_master(
    wide: DataFrame, ord_column: str = "ord", part_size: int = PART_SIZE
) -> DataFrame:
    """``product, file, part, schema_json``: the values each attribute of a file takes.

    An attribute all of whose cells are NULL is none of the file's; one that only
    spells "no value" is listed as empty. A file whose values exceed ``part_size`` for an attribute continues in further
    parts; joining the lists of the parts gives the whole schema.
    """
    names = _constants(wide, [X.attr_to_snake(F.lit(c)) for c in attribute_columns(wide)])
    # of columns with the same snake-case name the last one counts
    counted = sorted({name: i for i, name in enumerate(names)}.values())
    values = observed_values(wide, ord_column).where(F.col("c").isin([FILE_ITSELF, *counted]))
    ranked = rank_in_groups(
        values.withColumn("empty", F.col("value") == ""),
        ["file", "c", "attr", "empty"],
        ["first_ord", "value"],
        "_rn",
    )
    value = F.when(~F.col("empty"), F.struct("_rn", "value"))
    per_part = (
        ranked.where(F.col("c") != FILE_ITSELF)
        .withColumn("part", F.floor((F.col("_rn") - 1) / part_size).cast("bigint"))
        .groupBy("file", "part", "attr")
        .agg(F.array_sort(F.collect_list(value))["value"].alias("values"))
        .groupBy("file", "part")
        .agg(F.map_from_entries(F.collect_list(F.struct("attr", "values"))).alias("seen"))
    )
    files = (
        ranked.where(F.col("c") == FILE_ITSELF)
        .select("file")
        .join(per_part, "file", "left")
        .withColumn("part", F.coalesce("part", F.lit(0)).cast("bigint"))
    )
    # in the order of the columns
    listed = [F.lit(n) for n in dict.fromkeys(names)]
    whole = F.map_from_arrays(F.array(*listed), F.array(*(F.col("seen")[n] for n in listed)))
    own = F.map_filter(whole, lambda k, v: v.isNotNull())
    schema = F.coalesce(own, F.create_map().cast("map<string,array<string>>"))
    return files.select(
        X.product_from_file("file").alias("product"),
        "file",
        "part",
        F.to_json(schema).alias("schema_json"),
    )


def shipment_attributes(
    wide: DataFrame, order: Sequence[str] = ("file", "ord"), id_column: str = "shipment_id"
) -> DataFrame:
    """``shipment_id, product, attrs`` (map): per key the last non-missing value in row order.

    One aggregation, whose partial results are at most one value per attribute and
    shipment, however many rows a shipment has.
    """
    names = attribute_columns(wide)
    keys = _constants(wide, [X.snake_simple(F.lit(c.removeprefix(PREFIX))) for c in names])
    by_key: dict[str, list[str]] = {}
    for c, key in zip(names, keys):
        if key:
            by_key.setdefault(key, []).append(c)
    place = F.struct(*order)
    last_in_row = {
        key: F.coalesce(*(X.clean_value_map(F.col(f"`{c}`")) for c in reversed(columns)))
        for key, columns in by_key.items()
    }
    product = F.nullif(X.strip("product"), F.lit("")) if "product" in wide.columns else F.lit(None).cast("string")
    rows = wide.select(
        X.strip(F.coalesce(id_column, F.lit(""))).alias("shipment_id"),
        place.alias("_place"),
        product.alias("_product"),
        *(v.alias(f"_{i}") for i, v in enumerate(last_in_row.values())),
    ).where("shipment_id <> ''")
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_place")))
    grouped = rows.groupBy("shipment_id").agg(
        latest("_product").alias("_product"), *(latest(f"_{i}").alias(f"_{i}") for i in range(len(last_in_row)))
    )
    entries = F.array(
        *(F.struct(F.lit(k).alias("key"), F.col(f"_{i}").alias("value")) for i, k in enumerate(last_in_row))
    )
    attrs = (
        F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
        if last_in_row
        else F.create_map().cast("map<string,string>")
    )
    return grouped.select("shipment_id", F.coalesce("_product", F.lit("")).alias("product"), attrs.alias("attrs"))


def new_shipments(
    stored: DataFrame, incoming: DataFrame, ord_column: str | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """The (description, shipment) rows that ``incoming`` adds to ``stored``, with their ``ord_column`` if named.

    New descriptions keep all their rows; a description already stored gains each
    unseen shipment once. Pairs are joined as rows, so no list grows with a
    description's popularity. ``counts`` (a description's rows of ``incoming``, or more, as ``_rows``)
    saves the passes that count them.
    """
    pair = [*GOODS, "shipment_id"]
    done = stored.select(*GOODS).distinct()
    order = [ord_column] if ord_column else []
    arrived = incoming.select(*pair, *order)
    fresh = skew_join(arrived, done, GOODS, "left_anti", ["shipment_id", *order], counts)
    known = skew_join(arrived, done, GOODS, "left_semi", ["shipment_id", *order], counts)
    # Joined first, rows are sorted by pair once, for the join and for what makes them one.
    unseen = known.join(stored.select(*pair), pair, "left_anti")
    more = unseen.groupBy(*pair).agg(F.min(ord_column).alias(ord_column)) if order else unseen.distinct()
    return fresh.unionByName(more)


def merge_shipments(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored (description, shipment) rows and those new rows add to them."""
    return stored.select(*GOODS, "shipment_id").unionByName(new_shipments(stored, incoming))


def pending_goods(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct descriptions no earlier run has classified."""
    return rows.select(*GOODS).distinct().join(stored.select(*GOODS), GOODS, "left_anti")


def write_table(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    rows_per_file: int = 0,
) -> None:
    """Parquet as the main copy; CSV comes with a header, JSON as lines. ``rows_per_file`` bounds a file (0: it does not)."""
    writer = df.write.mode(mode).partitionBy(*partition_by).option("maxRecordsPerFile", rows_per_file)
    if format == "csv":
        # As they are: without these options Spark trims values.
        for side in ("Leading", "Trailing"):
            writer = writer.option(f"ignore{side}WhiteSpace", False)
        writer.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    elif format in ("json", "parquet"):
        getattr(writer, format)(path)
    else:
        raise ValueError(f"format must be csv, json or parquet, not {format!r}")


def export_per_product(flat: DataFrame, attr_dict: DataFrame, folder: str) -> list[str]:
    """A CSV file folder ``hs_<heading>_<product>.csv`` per product, with its own columns.

    Products with the same columns are written together: one scan of ``flat`` and one write for each
    distinct list of columns, however many products there are; then every product's part of
    the output takes its name. With an ``ord`` column the rows of a product follow it. A file of the
    folder holds FILE_ROWS rows at most, because whoever reads it takes a file to a task.
    """
    listed = durable(
        attr_dict.groupBy(*KEY, "attr")
        .agg(F.min("attr_ord").alias("attr_ord"))
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_list(F.struct("attr_ord", "attr")))["attr"].alias("attrs"))
        .withColumn("file", X.product_file("hs_code", "product"))
    )
    spark = flat.sparkSession
    rows = flat.drop("file")
    order = [c for c in ("ord",) if c in flat.columns]
    files = []
    # Both lists come from the dictionary, which is configuration.
    for number, row in enumerate(listed.select("attrs").distinct().orderBy("attrs").collect()):
        own = [f"{PREFIX}{a}" for a in row["attrs"]]
        flags = [f"{c}{FLAG_SUFFIX}" for c in own if f"{c}{FLAG_SUFFIX}" in flat.columns]
        same = listed.where(F.col("attrs") == F.array(*(F.lit(a) for a in row["attrs"]))).select(*KEY, "file")
        columns = [*KEY, "shipment_id", "goods_shipped", *own, *flags]
        mine = rows.join(same, KEY).repartitionByRange("file", *order).sortWithinPartitions("file", *order)
        target = f"{folder}/.columns-{number}"
        write_table(mine.select("file", *(f"`{c}`" for c in columns)), target, "csv", ["file"], rows_per_file=FILE_ROWS)
        names = [r["file"] for r in same.select("file").distinct().collect()]
        _take_names(spark, target, folder, names, mine.select(*(f"`{c}`" for c in columns)))
        files += names
    return sorted(files)


def _take_names(spark: SparkSession, written: str, folder: str, names: Sequence[str], shape: DataFrame) -> None:
    """Rename the parts ``file=<name>`` of a partitioned output to ``<name>``; a product without rows gets a header only."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in names:
        source, target = path(f"{written}/file={name}"), path(f"{folder}/{name}")
        fs.delete(target, True)
        if fs.exists(source):
            fs.rename(source, target)
        else:
            write_table(shape.limit(0), f"{folder}/{name}", "csv")
    fs.delete(path(written), True)


def write_shipment_map(merged: DataFrame, path: str) -> None:
    """Sorted by shipment; ``.json`` gets lines of id and attributes, else CSV with JSON text."""
    ordered = merged.orderBy("shipment_id")
    if path.endswith(".json"):
        write_table(ordered.select("shipment_id", "attrs"), path, "json")
    else:
        text = ordered.select("shipment_id", "product", F.to_json("attrs").alias("attrs_json"))
        write_table(text, path, "csv")
