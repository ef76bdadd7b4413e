"""Request tables: one row per batch, ready for any batch-inference job."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplabel.functions import text as X
from shiplabel.operators.batches import batch_table
from shiplabel.operators.dictionary import KEY
from shiplabel.operators.scale import skew_join

# --- fixed values -----------------------------------------------------------
VALUE_PREVIEW = 25
NO_DEFINITION = "[Definition not available]"
NO_GOODS = "1. (the table holds no description)"
NO_SUMMARY = "(none of the columns has a value)"
# ----------------------------------------------------------------------------

LABEL_TASK = "Assign each numbered description to exactly one of these categories:"
LABEL_ANSWER = 'Answer with JSON only: {"classifications": [...]}, one category per line, in order.'
ATTRIBUTE_TASK = (
    "For each numbered description give one value per attribute: an allowed value as "
    '{"value": ...}, a better one that is not listed as {"custom": ...}, or "None".'
)
ATTRIBUTE_ANSWER = (
    'Answer with JSON only: {"items": [{"item_preview": first 30 characters, '
    '"attributes": {...}}, ...]}, in order.'
)
# What the reply holds for an item, and for an attribute beside its name.
REPLY_ITEM = '{"item_preview": "' + 30 * "." + '", "attributes": {}}, '
REPLY_VALUE = '"": {"value": ""}, '
PRODUCT_INFERENCE_TASK = "Propose product categories for the sampled descriptions of heading "
ATTRIBUTE_INFERENCE_TASK = "Propose attributes and their values for the product "


def lines(*parts) -> Column:
    return F.concat_ws("\n", *(F.lit(p) if isinstance(p, str) else p for p in parts))


def _label_schema(categories: Sequence[str]) -> str:
    labels = {"type": "string", "enum": list(categories)}
    return json.dumps(
        {
            "type": "object",
            "properties": {"classifications": {"type": "array", "items": labels}},
            "required": ["classifications"],
        }
    )


def label_requests(
    items: DataFrame, definition: Sequence[tuple[str, str | None]]
) -> DataFrame:
    """``batch_no, batch_size, total_batches, prompt, tokens, reply_schema`` per label batch."""
    categories = "\n".join(f"- {c}: {d}" if d else f"- {c}" for c, d in definition)
    prompt = lines(LABEL_TASK, categories, "Descriptions:", F.col("lines"), LABEL_ANSWER)
    return (
        batch_table(items, groups=())
        .withColumn("prompt", prompt)
        .withColumn("tokens", X.token_estimate("prompt"))
        .withColumn("reply_schema", F.lit(_label_schema([c for c, _ in definition])))
        .drop("lines")
    )


def product_guides(
    attr_dict: DataFrame,
    attr_defs: DataFrame,
    *,
    preview: int = VALUE_PREVIEW,
    open_list: bool = True,
) -> DataFrame:
    """``hs_code, product, definitions, previews, reply_schema, reply_chars`` for every product.

    ``reply_chars`` is the length of an item's reply with empty values.
    """
    place = Window.partitionBy(*KEY, "attr").orderBy("value_ord")
    previewed = (
        attr_dict.withColumn("_nth", F.row_number().over(place))
        .groupBy(*KEY, "attr")
        .agg(
            F.min("attr_ord").alias("attr_ord"),
            F.count("value").alias("_n"),
            F.array_sort(
                F.collect_list(F.when(F.col("_nth") <= preview, F.struct("value_ord", "value")))
            )["value"].alias("_shown"),
            # the closed list itself is the contract of the reply
            (F.lit(None) if open_list else F.array_sort(F.collect_set("value"))).alias("_all"),
        )
    )
    keyed = previewed.withColumn("attr_key", X.attr_key("attr")).join(attr_defs, "attr_key", "left")
    shown = F.concat(
        F.lit("- "), "attr", F.lit(": "), F.array_join("_shown", ", "),
        F.when(F.col("_n") > preview, F.lit(" ...")).otherwise(""),
    )
    meaning = F.coalesce(F.nullif("definition", F.lit("")), F.lit(NO_DEFINITION))
    if open_list:
        value_type = F.lit('{"type":"string"}')
    else:
        closed = F.array_union(F.array_compact("_all"), F.array(F.lit(X.NO_VALUE)))
        value_type = F.concat(F.lit('{"type":"string","enum":'), F.to_json(closed), F.lit("}"))
    property_ = F.concat(F.lit('"'), "attr", F.lit('":'), value_type)
    rows = keyed.select(
        *KEY,
        F.struct(
            "attr_ord",
            F.concat(F.lit("- "), "attr", F.lit(": "), meaning).alias("definition"),
            shown.alias("preview"),
            property_.alias("property"),
            "attr",
        ).alias("g"),
    )
    whole = rows.groupBy(*KEY).agg(F.array_sort(F.collect_list("g")).alias("g"))
    lengths = F.transform("g.attr", lambda a: F.length(a) + len(REPLY_VALUE))
    return whole.select(
        *KEY,
        (F.aggregate(lengths, F.lit(0), lambda total, n: total + n) + len(REPLY_ITEM)).alias("reply_chars"),
        F.array_join("g.definition", "\n").alias("definitions"),
        F.array_join("g.preview", "\n").alias("previews"),
        F.concat(
            F.lit('{"type":"object","properties":{"items":{"type":"array","items":{"type":"object",'
                  '"properties":{"item_preview":{"type":"string"},"attributes":{"type":"object",'
                  '"properties":{'),
            F.array_join("g.property", ","),
            F.lit('},"required":[]}},"required":["item_preview","attributes"]}}},"required":["items"]}'),
        ).alias("reply_schema"),
    )


def attribute_request_tables(
    items: DataFrame,
    attr_dict: DataFrame,
    attr_defs: DataFrame | None = None,
    *,
    open_list: bool = True,
    preview: int = VALUE_PREVIEW,
) -> tuple[DataFrame, DataFrame]:
    """Requests that name their guide, and the guides: what a product's batches share is stored once.

    Requests are one short row per batch: ``hs_code, product, batch_no, batch_size, total_batches, lines,
    guide_key, prompt_chars, tokens, reply_chars``. Guides are ``guide_key, guide, reply_schema``, with the
    hash of text and schema as their key, so products with the same attributes share one.
    """
    no_defs = attr_defs is None
    if no_defs:
        attr_defs = attr_dict.sparkSession.createDataFrame([], "attr_key string, definition string")
    meaning = [] if no_defs else ["Attributes:", F.col("definitions")]
    texts = product_guides(attr_dict, attr_defs, preview=preview, open_list=open_list).withColumn(
        "guide", lines(*meaning, "Allowed values:", F.col("previews"))
    )
    # A line of a guide never starts with a brace, the schema always does.
    keyed = texts.withColumn("guide_key", F.sha2(F.concat_ws("\n", "guide", "reply_schema"), 256))
    beside = keyed.select(*KEY, "guide_key", "reply_chars", F.length("guide").alias("_guide"))
    chars = F.length(_prompt(F.lit(""))) + F.col("_guide")
    asked = (
        batch_table(items, beside=beside)
        .withColumn("prompt_chars", chars)
        .withColumn("tokens", F.floor(F.col("prompt_chars") / 4).cast("bigint"))
        .select(*KEY, "batch_no", "batch_size", "total_batches", "lines", "guide_key", "prompt_chars", "tokens", "reply_chars")
    )
    return asked, keyed.select("guide_key", "guide", "reply_schema").dropDuplicates(["guide_key"])


def _prompt(guide: Column) -> Column:
    head = F.concat(
        F.lit("Heading "), "hs_code", F.lit(" | Product "), "product", F.lit(" | Batch "),
        (F.col("batch_no") + 1).cast("string"), F.lit("/"), F.col("total_batches").cast("string"),
    )
    return lines(ATTRIBUTE_TASK, head, guide, "Descriptions:", F.col("lines"), ATTRIBUTE_ANSWER)


def rendered(asked: DataFrame, guides: DataFrame) -> DataFrame:
    """Requests with ``prompt`` and ``reply_schema``, as a model reads them; further columns stay."""
    whole = skew_join(asked, guides, ["guide_key"], spread_by=[*KEY, "batch_no"])
    return whole.withColumn("prompt", _prompt(F.col("guide"))).drop(
        "guide", "guide_key", "lines", "prompt_chars", "reply_chars"
    )


def attribute_requests(
    items: DataFrame,
    attr_dict: DataFrame,
    attr_defs: DataFrame | None = None,
    *,
    open_list: bool = True,
    preview: int = VALUE_PREVIEW,
) -> DataFrame:
    """One request per attribute batch, whole; give it the items of unresolved batches only."""
    tables = attribute_request_tables(items, attr_dict, attr_defs, open_list=open_list, preview=preview)
    return rendered(*tables).select(
        *KEY, "batch_no", "batch_size", "total_batches", "prompt", "tokens", "reply_schema"
    )


def cost_of(prompt_chars: Column, reply: Column) -> Column:
    return F.floor((prompt_chars + F.coalesce(F.length(reply), F.lit(0))) / 4).cast("bigint")


def request_cost(prompt, reply) -> Column:
    """Tokens of a request and its reply where the service reports none."""
    return cost_of(F.length(prompt), reply)


def numbered(goods: Column) -> Column:
    """``1. text`` lines of an array of descriptions."""
    return F.array_join(
        F.transform(
            goods, lambda g, i: F.concat((i + 1).cast("string"), F.lit(". "), g)
        ),
        "\n",
    )


def product_inference_requests(samples: DataFrame) -> DataFrame:
    """``hs4, prompt, tokens`` from sampled descriptions ``hs4, place, goods_shipped``."""
    rolled = samples.groupBy("hs4").agg(
        F.array_sort(F.collect_list(F.struct("place", "goods_shipped")))["goods_shipped"].alias("g")
    )
    prompt = lines(
        F.concat(F.lit(PRODUCT_INFERENCE_TASK), "hs4"), "Descriptions:", numbered(F.col("g"))
    )
    return rolled.select("hs4", prompt.alias("prompt")).withColumn(
        "tokens", X.token_estimate("prompt")
    )


def attribute_inference_requests(
    samples: DataFrame, summaries: DataFrame, hs4: str
) -> DataFrame:
    """``category, prompt, tokens`` from samples and column summaries of each category."""
    rolled = samples.groupBy("category").agg(
        F.array_sort(F.collect_list(F.struct("place", "goods_shipped")))["goods_shipped"].alias("g")
    )
    both = rolled.join(summaries, "category", "full")
    goods = F.coalesce(F.nullif(numbered(F.col("g")), F.lit("")), F.lit(NO_GOODS))
    summary = F.coalesce(F.nullif(X.strip("summary"), F.lit("")), F.lit(NO_SUMMARY))
    prompt = lines(
        F.concat(F.lit(ATTRIBUTE_INFERENCE_TASK), "category", F.lit(f" of heading {hs4}")),
        "Descriptions:", goods, "Columns:", summary,
    )
    return both.select("category", prompt.alias("prompt")).withColumn(
        "tokens", X.token_estimate("prompt")
    )
