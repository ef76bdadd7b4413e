"""From model replies to one value per attribute.

Items are the rows of ``number_batches`` with ``attrs`` (the dictionary) and
``found`` (what the text states) next to them; replies are a table
``hs_code, product, batch_no, reply``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplabel.functions import text as X
from shiplabel.operators.dictionary import KEY
from shiplabel.operators.matching import complete, heuristic_value

BATCH = [*KEY, "batch_no"]

# How an item fared: answered by its position in the reply; answered by nothing
# usable; not answered; or settled by the dictionary alone.
ANSWERED, UNUSABLE, PENDING, RESOLVED = "answered", "unusable", "pending", "resolved"


def gate_batches(items: DataFrame, dictionary_only: bool = False) -> DataFrame:
    """Add ``resolved``: every item of the batch states every attribute.

    Such batches need no model. ``dictionary_only`` settles all batches that way.
    """
    if dictionary_only:
        return items.withColumn("resolved", F.lit(True))
    whole_batch = Window.partitionBy(*BATCH)
    return items.withColumn("resolved", F.bool_and(complete()).over(whole_batch))


def _is_object(v: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False))


def _is_string(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def _is_item(text: Column) -> Column:
    return F.coalesce(F.startswith(text, F.lit("{")), F.lit(False))


def align_replies(items: DataFrame, replies: DataFrame) -> DataFrame:
    """Add ``status``, ``item`` (JSON text) and ``preview_ok`` by position in the batch.

    Surplus reply items are ignored; an item that is no object leaves its place
    pending; a reply without any usable item is unusable for the whole batch.
    """
    answers = replies.where("reply IS NOT NULL").select(
        *BATCH, F.lit(True).alias("_answered"), X.reply_items("reply").alias("_items")
    )
    sized = items.withColumn("_size", F.count("*").over(Window.partitionBy(*BATCH)))
    item = F.get("_items", F.col("pos").cast("int"))
    usable = F.exists(
        F.slice(F.coalesce("_items", F.array().cast("array<string>")), F.lit(1), F.col("_size").cast("int")),
        _is_item,
    )
    preview = F.from_json("item", "item_preview string")["item_preview"]
    return (
        sized.join(answers, BATCH, "left")
        .withColumn("item", F.when(_is_item(item), item))
        .withColumn(
            "status",
            F.when(F.col("_answered").isNull(), PENDING)
            .when(~usable, UNUSABLE)
            .when(F.col("item").isNull(), PENDING)
            .otherwise(ANSWERED),
        )
        .withColumn(
            "preview_ok",
            F.when(F.col("item").isNotNull(), F.coalesce(X.preview_ok(preview, "goods_shipped"), F.lit(True))),
        )
        .drop("_answered", "_items", "_size")
    )


def _given(item: Column) -> Column:
    """The values of a reply item: ``array<struct<attr, kind, text>>`` in the order given.

    ``kind`` is the value as VARIANT, ``text`` its own spelling. An item whose nested objects
    repeat keys has no variants; its texts still tell the values.
    """
    kinds = F.map_entries(F.from_json(item, "attributes map<string,variant>")["attributes"])
    texts = F.map_entries(F.from_json(item, "attributes map<string,string>")["attributes"])
    none = F.array().cast("array<struct<key:string,value:variant>>")
    return F.zip_with(
        F.coalesce(texts, F.array().cast("array<struct<key:string,value:string>>")),
        F.coalesce(kinds, none),
        lambda t, k: F.struct(t["key"].alias("attr"), k["value"].alias("kind"), t["value"].alias("text")),
    )


def replied_texts(item: Column) -> Column:
    """All texts a reply item could mean as values, for dictionaries joined by anchor."""
    inside = lambda g, key: F.get_json_object(g["text"], f"$.{key}")
    return F.array_distinct(
        F.filter(
            F.flatten(
                F.transform(_given(item), lambda g: F.array(g["text"], inside(g, "value"), inside(g, "custom")))
            ),
            lambda t: t.isNotNull(),
        )
    )


def _one_value(g: Column, values: Column, open_list: bool) -> Column:
    """Judge one replied value: ``struct<value, custom, out_of_schema, invalid>``."""
    v = g["kind"]
    inner = F.try_variant_get(v, "$.value", "variant")
    custom = F.try_variant_get(v, "$.custom", "variant")
    nested_custom = _is_object(v) & ~_is_string(inner) & _is_string(custom)
    # an object that repeats keys: the last value counts
    untyped = v.isNull() & F.startswith(g["text"], F.lit("{"))
    text = (
        F.when(g.isNull() | g["text"].isNull() | F.coalesce(F.is_variant_null(v), F.lit(False)), X.NO_VALUE)
        .when(_is_object(v) & _is_string(inner), inner.cast("string"))
        .when(nested_custom, custom.cast("string"))
        .when(_is_object(v), X.NO_VALUE)
        .when(untyped, F.coalesce(F.from_json(g["text"], "value string")["value"], F.lit(X.NO_VALUE)))
        # truth values in the spelling of the published tables, all others as they were given
        .when(F.schema_of_variant(v) == "BOOLEAN", F.initcap(g["text"]))
        .otherwise(g["text"])
    )

    def judge(t):
        foreign = ~F.exists(values, lambda a: a["value"] == t["text"]) & (t["text"] != X.NO_VALUE)
        kept = foreign & (t["nested_custom"] | F.lit(open_list))
        return F.struct(
            F.when(foreign & ~kept, X.NO_VALUE).otherwise(t["text"]).alias("value"),
            kept.alias("custom"),
            # a closed list has nothing outside it to report; what it refuses is invalid
            (kept & F.lit(open_list)).alias("out_of_schema"),
            (foreign & ~kept).alias("invalid"),
        )

    return X.let(
        F.struct(text.alias("text"), F.coalesce(nested_custom, F.lit(False)).alias("nested_custom")),
        judge,
    )


def normalise_replies(aligned: DataFrame, open_list: bool = True) -> DataFrame:
    """Add ``replied``: one judged value per attribute of each answered or unusable item.

    A value may come plain, as ``{"value": …}`` or as ``{"custom": …}``; of a repeated
    attribute the last counts. Numbers and lists keep the text of the reply. With
    ``open_list`` a value outside the dictionary is kept and flagged, else it is
    invalid; a nested custom value is always kept.
    """
    answered = X.let(
        _given(F.col("item")),
        lambda given: F.transform(
            "attrs",
            lambda a: X.let(
                F.get(F.reverse(F.filter(given, lambda g: g["attr"] == a["attr"])), F.lit(0)),
                lambda g: F.struct(
                    a["attr"].alias("attr"),
                    _one_value(g, a["values"], open_list).alias("judged"),
                    F.coalesce(
                        F.to_json(g["kind"]), F.when(g.isNotNull(), F.coalesce(g["text"], F.lit("null")))
                    ).alias("raw"),
                ),
            ),
        ),
    )
    nothing = F.transform(
        "attrs",
        lambda a: F.struct(
            a["attr"].alias("attr"),
            F.struct(
                F.lit(X.NO_VALUE).alias("value"),
                F.lit(False).alias("custom"),
                F.lit(False).alias("out_of_schema"),
                F.lit(False).alias("invalid"),
            ).alias("judged"),
            F.lit(None).cast("string").alias("raw"),
        ),
    )

    def flat(r):
        judged = ["value", "custom", "out_of_schema", "invalid"]
        return F.struct(r["attr"], *(r["judged"][f].alias(f) for f in judged), r["raw"].alias("raw"))

    return aligned.withColumn(
        "replied",
        F.transform(
            F.when(F.col("status") == ANSWERED, answered).when(F.col("status") == UNUSABLE, nothing),
            flat,
        ),
    )


def merge_values(normalised: DataFrame) -> DataFrame:
    """What the text states replaces a differing answer and clears its custom flag."""

    def merged(r, i):
        stated = F.get("found", i)["value"]
        return r.withField("value", F.coalesce(stated, r["value"])).withField(
            "custom", r["custom"] & stated.isNull()
        )

    return normalised.withColumn(
        "replied",
        F.when(F.col("status") == ANSWERED, F.transform("replied", merged)).otherwise(
            F.col("replied")
        ),
    )


def fill_missing(merged: DataFrame, enabled: bool = True) -> DataFrame:
    """Add ``filled`` to each value: what the substring heuristic puts where nothing was found."""

    def fill(soft, r, i):
        guess = (
            F.when(r["value"] == X.NO_VALUE, heuristic_value(F.get("attrs", i)["values"], soft))
            if enabled
            else F.lit(None).cast("string")
        )
        return X.let(
            guess,
            lambda g: r.withField("value", F.coalesce(g, r["value"])).withField(
                "filled", g.isNotNull()
            ),
        )

    return merged.withColumn(
        "replied",
        X.let(
            X.soft_text("goods_shipped"),
            lambda soft: F.transform("replied", lambda r, i: fill(soft, r, i)),
        ),
    )


def _names(flag: str) -> Column:
    return F.transform(F.filter("replied", lambda r: r[flag]), lambda r: r["attr"])


def records(filled: DataFrame) -> DataFrame:
    """Classification records: ``attributes`` map, flagged and filled names, counters."""
    count = lambda flag: F.size(F.filter("replied", lambda r: r[flag])).cast("bigint")
    return filled.where("replied IS NOT NULL").select(
        *BATCH,
        "pos",
        "goods_shipped",
        "status",
        F.map_from_entries(
            F.transform("replied", lambda r: F.struct(r["attr"], r["value"]))
        ).alias("attributes"),
        _names("custom").alias("custom_attributes"),
        _names("filled").alias("heuristic_filled"),
        F.map_from_entries(
            F.transform("replied", lambda r: F.struct(r["attr"], r["raw"]))
        ).alias("raw_attributes"),
        count("invalid").alias("invalid"),
        count("out_of_schema").alias("out_of_schema"),
        F.size("replied").cast("bigint").alias("total"),
    )


def resolved_records(items: DataFrame) -> DataFrame:
    """Records of batches the dictionary settled; only their first item carries the total."""
    no_names = F.array().cast("array<string>")
    zero = F.lit(0).cast("bigint")
    return items.where("resolved").select(
        *BATCH,
        "pos",
        "goods_shipped",
        F.lit(RESOLVED).alias("status"),
        F.map_from_entries(
            F.transform(
                "found",
                lambda f: F.struct(f["attr"], F.coalesce(f["value"], F.lit(X.NO_VALUE))),
            )
        ).alias("attributes"),
        no_names.alias("custom_attributes"),
        no_names.alias("heuristic_filled"),
        F.lit(None).cast("map<string,string>").alias("raw_attributes"),
        zero.alias("invalid"),
        zero.alias("out_of_schema"),
        F.when(F.col("pos") == 0, F.size("found")).otherwise(0).cast("bigint").alias("total"),
    )


def validation_stats(classified: DataFrame) -> DataFrame:
    """One row: invalid and all assignments, their ratio, values outside the list, fills."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return classified.agg(
        total("invalid").alias("invalid"),
        total("total").alias("total_assignments"),
        F.round(total("invalid") / F.greatest(total("total"), F.lit(1)), 6).alias("invalid_ratio"),
        total("out_of_schema").alias("out_of_schema"),
        total(F.size("heuristic_filled")).alias("heuristic_fills"),
    )
