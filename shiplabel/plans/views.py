"""Shipment-shaped views over the test tables, shared by queries, tests and bench."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplabel.operators.scale import durable

ATTR_DICT_SCHEMA = (
    "hs_code string, product string, attr string, attr_ord int, value string, value_ord int"
)
# The dictionary every (heading, product) of the test shipments shares; LARGE has none.
HEADINGS = ["9011", "0901", "0904"]
PRODUCTS = ["ECONOMY", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
ATTRIBUTES = {
    "Color": ["Red", "Blue"],
    "Condition": ["Old", "New", "Hot", "Cold"],
    "Size": ["Small", "Large"],
    "Item": ["Widget", "Ring", "Rod", "Bolt", "Gear", "Gizmo", "Plate", "Anvil", "Hot Ring"],
    "Density": ["500 G/L"],
    "Short": ["Ab"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores on a scan with fewer splits than cores, as of one small file.

    A larger scan has more splits than that and stays as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def shipments(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Line items as shipment records: all HS code shapes, negation, densities, blanks."""
    t = lambda name: table(spark, sf_dir, name)
    key, name = F.col("l_partkey"), F.col("p_name")
    text = lambda c, width: F.lpad(F.col(c).cast("string"), width, "0")
    shape, code = key % 7, key % 4
    return (
        spread(lineitem if lineitem is not None else t("lineitem"), "l_orderkey", "l_linenumber")
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat_ws(
                "|",
                text("l_orderkey", 10),
                F.col("l_linenumber").cast("string"),
                text("l_partkey", 10),
                text("l_suppkey", 10),
                F.lpad(F.col("l_quantity").cast("bigint").cast("string"), 3, "0"),
                "l_returnflag",
                "l_linestatus",
            ).alias("ord"),
            F.col("l_orderkey").cast("string").alias("shipment_id"),
            F.when(code == 0, "9011")
            .when(code == 1, "0901.11")
            .when(code == 2, "904")
            .otherwise("901110000")
            .alias("hs_code"),
            F.when(shape == 0, F.upper(name))
            .when(shape == 1, F.concat(F.lit("not "), name))
            .when(shape == 2, F.concat(name, F.lit(", 500 G/L")))
            .when(shape == 3, F.concat(F.lit("  "), "p_type", F.lit("   "), name, F.lit(" ")))
            .when(shape == 4, F.concat(name, F.lit("s")))
            .when(shape == 5, " ")
            .otherwise(F.concat(name, F.lit(" ("), "p_brand", F.lit(")")))
            .alias("goods_shipped"),
            F.col("p_type").alias("category"),
            F.col("n_name").alias("shipment_origin"),
            F.col("l_returnflag").alias("transport_method"),
            F.col("l_quantity").alias("weight_in_kg"),
            F.col("l_extendedprice").alias("value_of_goods_usd"),
        )
    )


def attr_dict(spark: SparkSession, only: tuple[str, ...] = tuple(ATTRIBUTES)) -> DataFrame:
    rows = [
        (hs, product, attr, a, value, v)
        for hs in HEADINGS
        for product in PRODUCTS
        for a, (attr, values) in enumerate(ATTRIBUTES.items())
        for v, value in enumerate(values)
        if attr in only and (product, attr) not in LACKING
    ]
    return spark.createDataFrame(rows, ATTR_DICT_SCHEMA)


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary of heading 9011 and, as values of each of its products, a lot for every line item but each fifth."""
    known = attr_dict(spark).where("hs_code = '9011'")
    # The lines are written, because several steps read the dictionary.
    line = durable(table(spark, sf_dir, "lineitem").where("l_orderkey % 5 <> 0").select("l_orderkey", "l_linenumber").distinct())
    lot = line.select(
        F.concat_ws(" ", F.lit("Lot"), "l_orderkey", "l_linenumber").alias("value"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("int").alias("value_ord"),
    )
    listed = lot.withColumn("product", F.explode(F.array(*(F.lit(p) for p in PRODUCTS)))).select(
        F.lit("9011").alias("hs_code"), "product", F.lit("Lot").alias("attr"), F.lit(99).alias("attr_ord"), "value", "value_ord"
    )
    return known.unionByName(listed)


# Attributes some products do not have, so that published tables get empty cells.
LACKING = {("SMALL", "Density"), ("PROMO", "Short")}
DEFINITION = [
    ("ECONOMY", "red and small goods"),
    ("MEDIUM", "rings, rods and a bolt"),
    ("PROMO", "hot or cold widget"),
    ("SMALL", "small parts such as gear"),
    ("STANDARD", "old plate"),
    ("LARGE", None),
]
DEFINITIONS = [
    ("attr_Color", "Colour named in the text."),
    ("attr_Item", "What the goods are."),
    ("attr_Size", ""),
]


def definitions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFINITIONS, "attr_key string, definition string")


def detailed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments with two columns whose names hold keywords."""
    kg = F.col("weight_in_kg")
    return shipments(spark, sf_dir).withColumns(
        {
            "packaging_type": F.when(kg < 10, "bag").when(kg < 20, "BAG").when(kg < 35, "wooden  box").otherwise(" "),
            "Screen-grade": F.concat(F.lit("grade "), (kg.cast("bigint") % 12).cast("string")),
        }
    )


def attribute_replies(items: DataFrame) -> DataFrame:
    """One model reply per batch, in every shape replies come in."""
    shape, kind = (F.col("batch_no") + F.col("pos")) % 7, F.col("batch_no") % 8
    answers = [
        '"Color":"Red","Item":{"value":"Ring"}',
        '"Color":{"value":"Blue"},"Condition":{"custom":"Worn"}',
        '"Color":{"custom":"Crimson"},"Size":"Huge"',
        '"Color":null,"Density":{"custom":"450 G/L"}',
        '"Color":5,"Short":true',
        '"Color":"Unlisted","Size":{"other":1},"Item":"None"',
        '"Color":{"custom":"Red"},"Condition":{"value":3,"custom":"Old"}',
    ]
    attributes = F.get(F.array(*(F.lit("{" + a + "}") for a in answers)), shape.cast("int"))
    item = (
        F.when((kind == 4) & (F.col("pos") == 1), '"skip"')
        .when(F.length("goods_shipped") == 13, '{"item_preview":"zzz","attributes":"none"}')
        .otherwise(
            F.concat(
                F.lit('{"item_preview":"'), F.substring("goods_shipped", 1, 30),
                F.lit('","attributes":'), attributes, F.lit("}"),
            )
        )
    )
    batch = items.groupBy("hs_code", "product", "batch_no").agg(
        F.array_sort(F.collect_list(F.struct("pos", item.alias("item"))))["item"].alias("all")
    )
    shown = (
        F.when(kind == 2, F.slice("all", F.lit(1), F.size("all") - 1))
        .when(kind == 3, F.array_append("all", F.lit('{"attributes":{}}')))
        .otherwise(F.col("all"))
    )
    body = F.concat(F.lit('{"items":['), F.array_join(shown, ","), F.lit("]}"))
    reply = (
        F.when(kind == 5, "no answer {")
        .when(kind == 6, F.concat(F.lit("Sure: "), body, F.lit(" done")))
        .otherwise(body)
    )
    return batch.where(kind != 7).select("hs_code", "product", "batch_no", reply.alias("reply"))


def label_replies(items: DataFrame) -> DataFrame:
    """One label reply per batch: whole, short, long, broken, of another shape, or none."""
    kind = F.col("batch_no") % 7
    choice = F.get(
        F.array(*(F.lit(f'"{c}"') for c, _ in DEFINITION)), ((F.col("batch_no") + F.col("pos")) % 6).cast("int")
    )
    batch = items.groupBy("batch_no").agg(
        F.array_sort(F.collect_list(F.struct("pos", choice.alias("label"))))["label"].alias("all")
    )
    shown = (
        F.when(kind == 2, F.slice("all", F.lit(1), F.size("all") - 1))
        .when(kind == 3, F.array_append("all", F.lit('"SURPLUS"')))
        .otherwise(F.col("all"))
    )
    reply = (
        F.when(kind == 4, "sorry")
        .when(kind == 5, '{"classifications":7}')
        .otherwise(F.concat(F.lit('{"classifications":['), F.array_join(shown, ","), F.lit("]}")))
    )
    return batch.where(kind != 6).select("batch_no", reply.alias("reply"))


def schema_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One attribute-inference reply per category, built from its parts."""
    nouns = F.substring_index("p_name", " ", -1)
    per_type = table(spark, sf_dir, "part").groupBy("p_type").agg(
        F.array_join(F.array_sort(F.collect_set(F.concat(F.lit('"'), nouns, F.lit('"')))), ",").alias("n"),
        F.array_join(F.array_sort(F.collect_set(F.concat(F.lit('" '), F.upper("p_brand"), F.lit('"')))), ",").alias("b"),
    )
    first = F.concat(F.lit('{"name":"item kind","definition":" Kind of item. ","values":['), "n", F.lit(',7,"RING"]}'))
    second = F.concat(F.lit('{"name":"Brand-name","definition":"","values":['), "b", F.lit("]}"))
    again = F.lit('{"name":"Item_Kind","definition":"Repeated.","values":["x"]}')
    empty = F.lit('{"name":"transport method","definition":"How it travels.","values":[]}')
    listed = (
        F.when(F.col("p_type") == "LARGE", F.lit(""))
        .when(F.col("p_type") == "SMALL", F.concat_ws(",", first, again, empty))
        .when(F.col("p_type") == "PROMO", F.concat_ws(",", F.lit('"junk"'), second))
        .otherwise(F.concat_ws(",", first, second, F.lit('{"name":""}')))
    )
    reply = F.concat(F.lit('{"attributes":['), listed, F.lit("]}"))
    return per_type.select(F.col("p_type").alias("category"), reply.alias("reply"))


def product_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product-inference reply per brand, listing its part types and some noise."""
    entry = F.concat(
        F.lit('{"name":" '), "p_type", F.lit('","description":"'),
        F.when(F.col("p_type") == "SMALL", "").otherwise(F.concat(F.lit("Goods of type "), "p_type")),
        F.lit('","representative_goods":["a","b"," ","c","d","'), "p_type", F.lit('"]}'),
    )
    per_brand = table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.array_join(F.array_sort(F.collect_set(entry)), ",").alias("e")
    )
    reply = F.concat(
        F.lit('Here: {"product_categories":["junk",{"name":" "},'), "e", F.lit(",{\"name\":\"ECONOMY\"}]}")
    )
    return per_brand.select(F.col("p_brand").alias("hs4"), reply.alias("reply"))


def definition_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product-definition document per brand."""
    per_brand = table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.array_sort(F.collect_set("p_type")).alias("types")
    )
    quoted = F.array_join(F.transform("types", lambda t: F.concat(F.lit('" '), t, F.lit('"'))), ",")
    described = F.array_join(
        F.transform("types", lambda t: F.concat(F.lit('"'), t, F.lit(' ":"Goods of type '), t, F.lit('"'))), ","
    )
    return per_brand.select(
        F.concat(
            F.lit('{"hs_code":" '), "p_brand", F.lit('","product_categories":['), quoted,
            F.lit(',"  "],"category_descriptions":{'), described, F.lit('},"_note":{"a":1}}'),
        ).alias("json")
    )


def schema_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An attribute-schema document per brand, with siblings of other shapes at each level."""
    part = table(spark, sf_dir, "part")
    sizes = part.groupBy("p_brand", "p_type").agg(F.array_sort(F.collect_set("p_size")).alias("s"))
    product = F.concat(
        F.lit('" '), "p_type", F.lit('":{"attributes":{"Size":['), F.array_join(F.col("s").cast("array<string>"), ","),
        F.lit('],"Broken":"x","Brand":["'), "p_brand", F.lit('"," "],"Nothing":[]},"note":1}'),
    )
    per_brand = sizes.groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_list(product)), ",").alias("p"))
    return per_brand.select(
        F.concat(
            F.lit('{"'), "p_brand", F.lit('":{"version":"1","products":{'), "p",
            F.lit(',"bad":[1],"none":{"attributes":{"x":"y"}}},"_x":{"products":{}}},"_comment":"c"}'),
        ).alias("json")
    )
