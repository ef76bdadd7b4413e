"""Finding dictionary values in free text, without a model."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplabel.functions import text as X
from shiplabel.operators.dictionary import (
    GRAM,
    MIN_VALUE_LENGTH,
    TEXT_ID,
    anchored_pairs,
    attach_dictionary,
    bounded,
    fits_broadcast,
    match_anchors,
    occurs,
    text_anchors,
    text_forms,
    value_norm,
    value_pattern,
    with_names,
    with_text_id,
)
from shiplabel.operators.scale import durable, skew_join

GOODS_KEY = ["hs_code", "product", "goods_shipped"]

# --- fixed values -----------------------------------------------------------
# Words that negate the value right after them, and how far back they may start.
NEGATORS = ["not", "no", "without", "w/o", "minus", "excluding", "free of", "free-from", "non"]
NEGATION_WINDOW = 28
# ----------------------------------------------------------------------------

# Negators normalised like the text before a match: no punctuation, single blanks.
NEGATED = "(?:^| )(?:" + "|".join(n.replace("/", " ").replace("-", " ") for n in NEGATORS) + ")$"


def _negated(text: Column, pattern: Column, window: int) -> Column:
    """Is the first occurrence of the pattern directly preceded by a negator?"""
    # Plain values are located in the marked text, which needs no regex per value.
    marked_before = F.substring(
        text["marked"], F.lit(1), F.instr(text["marked"], pattern["mark"]) - 1
    )
    before = F.when(
        pattern["plain"] & ~pattern["density"], F.translate(marked_before, "\x01\x02", "")
    ).otherwise(
        F.substring(text["norm"], F.lit(1), F.regexp_instr(text["norm"], pattern["regex"]) - 1)
    )
    words = F.trim(F.regexp_replace(F.right(before, F.lit(window)), "[^a-z0-9]+", " "))
    return F.rlike(words, F.lit(NEGATED))


def stated(
    attrs: Column, goods: Column, negation: str = "documented", window: int = NEGATION_WINDOW
) -> Column:
    """``array<struct<attr, value, blocked>>``: what a text states for each attribute.

    The longest value wins, the smallest of equally long ones. ``documented``
    passes over values a negator stands in front of and counts them in
    ``blocked``; ``inert`` accepts them.
    """
    if negation not in ("documented", "inert"):
        raise ValueError(f"negation must be 'documented' or 'inert', not {negation!r}")

    def per_attr(text, a):
        hits = F.filter(a["values"], lambda v: occurs(text, v["pattern"]))
        if negation == "inert":
            return F.struct(
                a["attr"].alias("attr"),
                F.get(hits["value"], F.lit(0)).alias("value"),
                F.lit(0).alias("blocked"),
            )
        judged = F.transform(
            hits,
            lambda v: F.struct(
                v["value"].alias("value"), _negated(text, v["pattern"], window).alias("negated")
            ),
        )
        return X.let(
            judged,
            lambda j: F.struct(
                a["attr"].alias("attr"),
                F.get(F.filter(j, lambda v: ~v["negated"])["value"], F.lit(0)).alias("value"),
                F.coalesce(
                    F.nullif(F.array_position(j["negated"], F.lit(False)), F.lit(0)) - 1,
                    F.size(j),
                )
                .cast("int")
                .alias("blocked"),
            ),
        )

    return X.let(text_forms(goods), lambda text: F.transform(attrs, lambda a: per_attr(text, a)))


def match_rows(
    rows: DataFrame,
    attr_dict: DataFrame,
    *,
    negation: str = "documented",
    min_len: int = MIN_VALUE_LENGTH,
    window: int = NEGATION_WINDOW,
    strategy: str = "auto",
    derive: Mapping[str, Column] | None = None,
) -> DataFrame:
    """:func:`match_goods` for tables in which descriptions repeat.

    Each distinct description is matched once and the result joined back; a
    description that holds a large share of the rows is spread over many tasks.
    ``derive`` names columns computed from ``found`` that are joined instead of it.
    """
    goods = durable(rows.groupBy(GOODS_KEY).agg(F.count("*").alias("_rows")))
    matched = match_goods(
        goods, attr_dict, negation=negation, min_len=min_len, window=window, strategy=strategy, distinct=True
    )
    results = {"found": F.col("found")} if derive is None else derive
    narrow = matched.select(*GOODS_KEY, *(c.alias(name) for name, c in results.items()))
    return skew_join(rows, narrow, GOODS_KEY, counts=goods)


def match_goods(
    goods: DataFrame,
    attr_dict: DataFrame,
    *,
    negation: str = "documented",
    min_len: int = MIN_VALUE_LENGTH,
    window: int = NEGATION_WINDOW,
    strategy: str = "auto",
    distinct: bool = False,
) -> DataFrame:
    """Add ``found`` (see :func:`stated`) to goods; products without dictionary vanish.

    ``broadcast`` ships the dictionary to the rows, ``anchored`` is :func:`match_by_tokens`,
    ``auto`` measures the dictionary and decides. ``distinct``: goods are a written table without repeats.
    """
    if strategy == "auto":
        strategy = "broadcast" if fits_broadcast(attr_dict) else "anchored"
    if strategy == "anchored":
        return match_by_tokens(goods, attr_dict, negation=negation, min_len=min_len, window=window, distinct=distinct)
    return (
        attach_dictionary(goods, attr_dict, min_len=min_len, strategy=strategy, heuristic=False)
        .withColumn("found", stated(F.col("attrs"), F.col("goods_shipped"), negation, window))
        .drop("attrs")
    )


def match_by_tokens(
    goods: DataFrame,
    attr_dict: DataFrame,
    *,
    negation: str = "documented",
    min_len: int = MIN_VALUE_LENGTH,
    window: int = NEGATION_WINDOW,
    distinct: bool = False,
) -> DataFrame:
    """``found`` by a join, for dictionaries of any size.

    Texts and values meet on tokens a matching text must contain; each pair is verified
    against the text, and an aggregation keeps the best value of each text and attribute.
    What it holds are verified hits, partially reduced to one before the shuffle: a minimum, and
    the refused values, of which a text has no more than negators. ``distinct`` goods are
    not made so, nor written, again.
    """
    if negation not in ("documented", "inert"):
        raise ValueError(f"negation must be 'documented' or 'inert', not {negation!r}")
    gram = min(min_len, GRAM)
    keyed = with_text_id(goods)
    texts = keyed.select(*TEXT_ID, *GOODS_KEY)
    texts = texts if distinct else durable(texts.dropDuplicates(TEXT_ID))
    values = match_anchors(attr_dict, gram, min_len)
    pairs = anchored_pairs(texts, text_anchors(F.col("goods_shipped"), gram, heuristic=False), values)
    text = F.col("_text")
    # Texts are moved as they are; what is derived from them and from values is not.
    read = texts.select(*TEXT_ID, "goods_shipped").repartition(*TEXT_ID).select(*TEXT_ID, text_forms(F.col("goods_shipped")).alias("_text"))

    def judge(pattern: Column) -> Column:
        negated = _negated(text, pattern, window) if negation == "documented" else F.lit(False)
        stated = occurs(text, pattern)
        return F.when(stated, F.struct(pattern["norm"].alias("norm"), negated.alias("negated")))

    # One expression, so that a pattern is made once for a pair, not once for each of its parts.
    judged = X.let(value_norm(F.col("value"), min_len), lambda norm: X.let(value_pattern(norm), judge))
    stated_values = (
        pairs.select(*TEXT_ID, "attr", "value_ord", "value")
        .join(read, TEXT_ID)
        .select(*TEXT_ID, "attr", "value_ord", "value", judged.alias("_judged"))
        .where("_judged IS NOT NULL")
        .select(*TEXT_ID, "attr", F.col("_judged.norm").alias("_norm"), F.struct("value_ord", "value", "_judged.negated").alias("_v"))
    )
    # Of several spellings of a value the first one counts; few pairs are left here.
    hits = stated_values.groupBy(*TEXT_ID, "attr", "_norm").agg(F.min("_v").alias("_v")).select(
        *TEXT_ID, "attr", F.struct((-F.length("_v.value")).alias("rank"), F.col("_v.value").alias("value")).alias("place"), "_v.negated"
    )
    best = hits.groupBy(*TEXT_ID, "attr").agg(
        F.min(F.when(~F.col("negated"), F.col("place"))).alias("best"),
        F.array_distinct(F.collect_list(F.when(F.col("negated"), F.col("place")))).alias("refused"),
    )
    before = F.filter("refused", lambda r: F.col("best").isNull() | (r < F.col("best")))
    result = F.struct(F.col("best.value").alias("value"), F.size(before).alias("blocked"))
    found = best.groupBy(*TEXT_ID).agg(F.map_from_entries(F.collect_list(F.struct("attr", result.alias("result")))).alias("_found"))
    of_attr = lambda n: F.struct(
        n["attr"].alias("attr"),
        F.col("_found")[n["attr"]]["value"].alias("value"),
        F.coalesce(F.col("_found")[n["attr"]]["blocked"], F.lit(0)).alias("blocked"),
    )
    return (
        with_names(keyed, attr_dict)
        .join(found, TEXT_ID, "left")
        .withColumn("found", F.transform("_names", of_attr))
        .drop(*TEXT_ID, "_names", "_found")
    )


def found_values(found: str = "found") -> Column:
    """``array<struct<attr, value>>`` of the attributes a text states."""
    hits = F.filter(found, lambda f: f["value"].isNotNull())
    return F.transform(
        hits, lambda f: F.struct(f["attr"].alias("attr"), f["value"].alias("value"))
    )


def found_map(found: str = "found") -> Column:
    """The stated values as a map; attributes without one are absent."""
    return F.map_from_entries(found_values(found))


def full_map(found: str = "found") -> Column:
    """The stated values as a map over all attributes, missing ones spelled out."""
    return F.map_from_entries(
        F.transform(
            found, lambda f: F.struct(f["attr"], F.coalesce(f["value"], F.lit(X.NO_VALUE)))
        )
    )


def complete(found: str = "found") -> Column:
    """Does the text state a value for every attribute?"""
    return F.forall(found, lambda f: f["value"].isNotNull())


def coverage(matched: DataFrame) -> DataFrame:
    """One row of match statistics."""
    hits = F.size(F.filter("found", lambda f: f["value"].isNotNull()))
    blocked = F.aggregate("found", F.lit(0), lambda s, f: s + f["blocked"])
    counts = matched.select(
        hits.alias("hits"), F.size("found").alias("tried"), blocked.alias("blocked")
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return counts.agg(
        total((F.col("hits") > 0).cast("int")).alias("rows_with_any_match"),
        F.count("*").alias("rows_total"),
        total(F.col("hits")).alias("attribute_matches"),
        total(F.col("tried")).alias("attribute_attempted"),
        F.round(
            total(F.col("hits")) / F.greatest(total(F.col("tried")), F.lit(1)), 6
        ).alias("attribute_match_rate"),
        total(F.col("blocked")).alias("negation_blocked"),
    )


def heuristic_value(values: Column, soft: Column) -> Column:
    """Best value whose first occurrence in a soft text is bounded by whitespace, or NULL."""

    return F.get(F.filter(values, lambda v: bounded(v["lower"], soft))["value"], F.lit(0))
