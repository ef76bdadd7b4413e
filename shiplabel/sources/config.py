"""Configuration documents (JSON) as long tables.

Each function takes a table of documents, one JSON text per row in ``json``, as
:func:`read_documents` returns it. Objects are opened level by level as
``map<string, string>``: this keeps their order and tolerates mixed shapes.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplabel.functions import text as X

logger = logging.getLogger(__name__)

# --- fixed values -----------------------------------------------------------
DEFINITION_KEYS = ["hs_code", "product_categories", "category_descriptions"]
SCHEMA_KEYS = ["version", "products"]
ATTRIBUTE_PREFIX = "attr_"
# ----------------------------------------------------------------------------


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "json")


def _object(c) -> Column:
    return F.from_json(c, "map<string,string>")


def _list(c) -> Column:
    return F.from_json(c, "array<string>")


def _is_object(c) -> Column:
    return F.startswith(F.ltrim(c), F.lit("{"))


def _is_list(c) -> Column:
    return F.startswith(F.ltrim(c), F.lit("["))


def _texts(c) -> Column:
    """Non-blank members of a list, stripped."""
    return F.filter(F.transform(_list(c), X.strip), lambda v: v.isNotNull() & (v != ""))


def product_definitions(docs: DataFrame) -> DataFrame:
    """``hs_code, ord, category, description`` (NULL: no description)."""
    doc = docs.select(_object("json").alias("d")).select(
        X.strip(F.coalesce(F.col("d")["hs_code"], F.lit(""))).alias("hs_code"),
        _texts(F.col("d")["product_categories"]).alias("categories"),
        F.map_entries(_object(F.col("d")["category_descriptions"])).alias("descriptions"),
    )
    same = F.filter("descriptions", lambda e: X.strip(e["key"]) == F.col("category"))
    return doc.select("hs_code", "descriptions", F.posexplode("categories").alias("ord", "category")).select(
        "hs_code",
        "ord",
        "category",
        X.strip(F.get(F.reverse(same), F.lit(0))["value"]).alias("description"),
    )


def product_metadata(docs: DataFrame) -> DataFrame:
    """The free-form remainder of product definitions: ``hs_code, key, value``."""
    return docs.select(_object("json").alias("d")).select(
        X.strip(F.coalesce(F.col("d")["hs_code"], F.lit(""))).alias("hs_code"),
        F.explode(F.map_filter("d", lambda k, v: ~k.isin(DEFINITION_KEYS))),
    )


def attribute_dictionary(docs: DataFrame) -> DataFrame:
    """``hs_code, product, attr, attr_ord, value, value_ord``; see the dictionary operator."""
    products = (
        docs.select(F.explode(_object("json")).alias("hs_code", "block"))
        .where(_is_object("block"))
        .select("hs_code", F.explode(_object(_object("block")["products"])).alias("product", "body"))
        .where(_is_object("body"))
    )
    lists = F.filter(
        F.map_entries(_object(_object("body")["attributes"])), lambda e: _is_list(e["value"])
    )
    return (
        products.select("hs_code", "product", F.posexplode(lists).alias("attr_ord", "e"))
        .select(
            "hs_code",
            "product",
            "attr_ord",
            F.col("e")["key"].alias("attr"),
            F.posexplode_outer(_texts(F.col("e")["value"])).alias("value_ord", "value"),
        )
        .select(
            X.strip("hs_code").alias("hs_code"),
            X.strip("product").alias("product"),
            X.strip("attr").alias("attr"),
            "attr_ord",
            "value",
            "value_ord",
        )
    )


def dictionary_versions(docs: DataFrame) -> DataFrame:
    """``hs_code, version, metadata`` of each heading; a missing version is the present time."""
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return (
        docs.select(F.explode(_object("json")).alias("hs_code", "block"))
        .where(_is_object("block"))
        .select("hs_code", _object("block").alias("b"))
        .select(
            X.strip("hs_code").alias("hs_code"),
            F.coalesce(F.nullif(X.strip(F.col("b")["version"]), F.lit("")), now).alias("version"),
            F.map_filter("b", lambda k, v: ~k.isin(SCHEMA_KEYS)).alias("metadata"),
        )
    )


def attribute_definitions(docs: DataFrame) -> DataFrame:
    """``attr_key, definition`` of the keys that name an attribute."""
    return docs.select(F.explode(_object("json")).alias("attr_key", "definition")).where(
        F.startswith("attr_key", F.lit(ATTRIBUTE_PREFIX))
    )


def read_attribute_definitions(spark: SparkSession, path: str) -> DataFrame:
    """:func:`attribute_definitions` of a file; an absent or broken file defines nothing."""
    try:
        docs = read_documents(spark, path)
    except AnalysisException as problem:
        logger.warning("no attribute definitions read from %s: %s", path, problem)
        return spark.createDataFrame([], "attr_key string, definition string")
    return attribute_definitions(docs)
