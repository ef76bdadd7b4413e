"""Attribute dictionaries: compiling values into patterns, attaching them to rows.

An attribute dictionary is a long table

    hs_code, product, attr, attr_ord, value, value_ord

(``value`` NULL: the attribute exists but lists nothing). ``attach_dictionary``
puts the part of it that matters for a row next to the row, as

    attrs: array<struct<attr_ord, attr, values: array<struct<rank, value, lower, pattern>>>>

with ``values`` in order of precedence: longest first, then smallest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplabel.functions import text as X
from shiplabel.operators.scale import durable, skew_join, with_possible_partner

KEY = ["hs_code", "product"]

# --- fixed values -----------------------------------------------------------
# Shortest value that is matched in a text.
MIN_VALUE_LENGTH = 3
# A match may not touch an ASCII letter or digit on either side.
NOT_AFTER = "(?<![a-z0-9])"
NOT_BEFORE = "(?![a-z0-9])"
RUN = "[a-z0-9]+"
# What follows the number of a density: grams per litre in several spellings.
DENSITY_UNIT = r"\s*(?:g|gr|grams)\s*/?\s*(?:l|liter)"
# ----------------------------------------------------------------------------

DENSITY_MENTION = f"{NOT_AFTER}([0-9]+){DENSITY_UNIT}{NOT_BEFORE}"
# A dictionary is broadcast only below both limits; else it is joined by anchor.
BROADCAST_BYTES = 64 << 20
VALUES_PER_PRODUCT = 2_000
GRAM = 3
# A word that more values than this hold is common; so many of the commonest are known by their hashes, in buckets.
COMMON_USES = 100
HEAT_WORDS = 1 << 13
HEAT_BUCKETS = 1 << 13
TEXT_ID = ["_text_id", "_text_id2"]


def mark_runs(c: Column) -> Column:
    """Wrap each run of ASCII letters and digits in two marks.

    A value that starts and ends with such a run occurs in a text on run
    boundaries exactly if its marked form is contained in the text's marked form.
    """
    return F.regexp_replace(c, RUN, "\x01$0\x02")


def text_forms(goods: Column) -> Column:
    """The forms of a text that patterns are looked for in."""
    return X.let(
        X.norm_text(goods),
        lambda norm: F.struct(
            norm.alias("norm"),
            mark_runs(norm).alias("marked"),
            F.regexp_extract_all(norm, F.lit(DENSITY_MENTION), F.lit(1)).alias("densities"),
        ),
    )


def occurs(text: Column, pattern: Column) -> Column:
    """Does a text (``text_forms``) state the value with this pattern?"""
    as_density = F.when(F.size(pattern["numbers"]) > 0, F.arrays_overlap(pattern["numbers"], text["densities"])).otherwise(
        F.size(text["densities"]) > 0
    )
    as_words = F.contains(text["marked"], pattern["mark"]) & (
        pattern["plain"] | F.rlike(text["norm"], pattern["regex"])
    )
    return pattern.isNotNull() & F.when(pattern["density"], as_density).otherwise(as_words)


def bounded(lower: Column, soft: Column) -> Column:
    """Is the first occurrence of a value in a soft text bounded by whitespace?"""
    start = F.position(lower, soft)
    after = start + F.length(lower)
    left_ok = (start == 1) | F.rlike(F.substring(soft, start - 1, F.lit(1)), F.lit(X.WS))
    right_ok = (after > F.length(soft)) | F.rlike(F.substring(soft, after, F.lit(1)), F.lit(X.WS))
    return (lower != "") & (start > 0) & left_ok & right_ok


def value_norm(value: Column, min_len: int = MIN_VALUE_LENGTH) -> Column:
    """The form of a value that is looked for; NULL if it is too short to be."""
    return F.when(F.length(X.strip(value)) >= min_len, X.norm_value(value))


def _numbers(norm: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(norm, F.lit("[0-9]+"), F.lit(0)))


def value_pattern(norm: Column) -> Column:
    """What ``occurs`` looks for, from the normalised value."""
    density, numbers = X.is_density(norm), _numbers(norm)
    number = F.when(
        F.size(numbers) > 0, F.concat(F.lit("(?:"), F.array_join(numbers, "|"), F.lit(")"))
    ).otherwise("[0-9]+")
    quoted = F.concat(
        F.lit(r"\Q"), F.replace(norm, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")
    )
    body = F.when(density, F.concat(number, F.lit(DENSITY_UNIT))).otherwise(quoted)
    return F.struct(
        norm.alias("norm"),
        mark_runs(norm).alias("mark"),
        F.rlike(norm, F.lit(r"\A[a-z0-9](?s:.*[a-z0-9])?\z")).alias("plain"),
        F.concat(F.lit(NOT_AFTER), body, F.lit(NOT_BEFORE)).alias("regex"),
        density.alias("density"),
        numbers.alias("numbers"),
    )


def compile_values(attr_dict: DataFrame, min_len: int = MIN_VALUE_LENGTH) -> DataFrame:
    """Add what matching needs: ``rank``, ``lower`` and ``pattern`` (NULL: never matched)."""
    spelling = Window.partitionBy(*KEY, "attr", "_norm").orderBy("value_ord")
    return (
        attr_dict.withColumn("_norm", value_norm(F.col("value"), min_len))
        .withColumn("_nth", F.row_number().over(spelling))
        .select(
            *attr_dict.columns,
            (-F.length("value")).alias("rank"),
            F.lower("value").alias("lower"),
            F.when(F.col("_norm").isNotNull() & (F.col("_nth") == 1), value_pattern(F.col("_norm"))).alias("pattern"),
        )
    )


def _value_struct() -> Column:
    return F.struct("rank", "value", "lower", "pattern")


def roll_dictionary(compiled: DataFrame) -> DataFrame:
    """One row per (heading, product) that carries its whole dictionary."""
    per_attr = compiled.groupBy(*KEY, "attr").agg(
        F.min("attr_ord").alias("attr_ord"),
        F.array_sort(
            F.collect_list(F.when(F.col("value").isNotNull(), _value_struct()))
        ).alias("values"),
    )
    return per_attr.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct("attr_ord", "attr", "values"))).alias("attrs")
    )


def fits_broadcast(attr_dict: DataFrame) -> bool:
    """Is the dictionary small enough to ship whole to every task? (One small job.)"""
    sizes = (
        attr_dict.groupBy(*KEY)
        .agg(
            F.count("*").alias("n"),
            F.sum(4 * F.octet_length(F.concat_ws("|", *KEY, "attr", "value")) + 200).alias("b"),
        )
        .agg(F.max("n"), F.sum("b"))
        .first()
    )
    most_values, total_bytes = sizes
    return (most_values or 0) <= VALUES_PER_PRODUCT and (total_bytes or 0) <= BROADCAST_BYTES


def attach_dictionary(
    goods: DataFrame,
    attr_dict: DataFrame,
    *,
    min_len: int = MIN_VALUE_LENGTH,
    strategy: str = "auto",
    replied: Column | None = None,
    heuristic: bool = True,
    how: str = "inner",
) -> DataFrame:
    """Add ``attrs`` to every row of ``goods`` (``hs_code, product, goods_shipped, …``).

    ``broadcast`` ships the rolled dictionary to the rows: no shuffle of the goods.
    ``anchored`` serves dictionaries of any size: rows and values meet in an
    equi-join on tokens a matching text must contain, pairs are verified there, and
    ``attrs`` holds only values that the row states (or the substring rule or a reply
    brings); it wants distinct descriptions (see ``match_rows``). ``auto`` measures and decides.
    ``heuristic`` also brings the values the substring rule may find; matching needs none.
    ``replied`` (array of strings) names further values whose membership matters.
    Rows of products without a dictionary are dropped by ``how="inner"``.
    """
    if strategy == "auto":
        strategy = "broadcast" if fits_broadcast(attr_dict) else "anchored"
    compiled = compile_values(attr_dict, min_len)
    if strategy == "broadcast":
        return goods.join(F.broadcast(roll_dictionary(compiled)), KEY, how)
    return _attach_by_anchor(goods, compiled, min(min_len, GRAM), replied, heuristic, how)


def _prefixed(prefix: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.concat(F.lit(prefix), v))


def text_anchors(goods: Column, gram: int, heuristic: bool = True) -> Column:
    """Tokens of a text that a value found in it can be anchored at; ``heuristic``: also by the substring rule."""
    norm = X.norm_text(goods)
    densities = F.regexp_extract_all(norm, F.lit(DENSITY_MENTION), F.lit(1))
    stretches = F.regexp_extract_all(norm, F.lit(rf"[^a-z0-9]{{{gram},}}"), F.lit(0))
    grams = F.flatten(
        F.transform(
            stretches,
            lambda s: F.transform(
                F.sequence(F.lit(1), F.length(s) - (gram - 1)), lambda i: F.substring(s, i, gram)
            ),
        )
    )
    soft = [_prefixed("s:", F.split(X.soft_text(goods), f"{X.WS}+"))] if heuristic else []
    return F.array_distinct(
        F.concat(
            _prefixed("t:", F.regexp_extract_all(norm, F.lit(RUN), F.lit(0))),
            _prefixed("d:", densities),
            F.when(F.size(densities) > 0, F.array(F.lit("d:*"))).otherwise(F.array().cast("array<string>")),
            _prefixed("g:", grams),
            *soft,
        )
    )


def _heat(words: DataFrame) -> Column:
    """How many values share a common word, from rows of ``_words``: by bucket of its hash, see ``_uses``.

    It only chooses between the words of a value. Each word has its own number: a rare word that took over that of a
    common one would lose to it, and values anchored at a common word meet nearly all texts. HEAT_WORDS numbers at
    most are fetched, the largest ones, so a word without a number is no commoner than any that has one.
    """
    # An outer explode: the other one has Spark evaluate the words a second time, in a filter.
    each = words.select(F.explode_outer("_words").alias("_word")).where("_word IS NOT NULL")
    uses = each.groupBy("_word").agg(F.count("*").alias("_uses")).where(F.col("_uses") > COMMON_USES)
    hottest = uses.select(F.xxhash64("_word").alias("_hash"), "_uses").orderBy(F.desc("_uses"), "_hash").limit(HEAT_WORDS)
    first, others = {}, [{} for _ in range(HEAT_BUCKETS)]
    for word, n in hottest.collect():
        bucket = word % HEAT_BUCKETS
        if first.setdefault(bucket, (word, n))[0] != word:
            others[bucket][word] = n
    numbers = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    pairs = [first.get(b, (0, 0)) for b in range(HEAT_BUCKETS)]
    listed = F.split(F.lit(",".join(";".join(f"{w}={n}" for w, n in o.items()) for o in others)), ",")
    return F.struct(numbers(p[0] for p in pairs).alias("word"), numbers(p[1] for p in pairs).alias("uses"), listed.alias("others"))


def _uses(word: Column, heat: Column) -> Column:
    """The number that ``_heat`` has for a word, 0 if it has none."""
    place = F.xxhash64(word)
    bucket = F.pmod(place, F.lit(HEAT_BUCKETS)).cast("int")
    of_others = F.str_to_map(F.get(heat["others"], bucket), F.lit(";"), F.lit("="))[place.cast("string")].cast("bigint")
    return (
        F.when(F.get(heat["word"], bucket) == place, F.get(heat["uses"], bucket))
        .when(F.get(heat["others"], bucket) == "", F.lit(0).cast("bigint"))
        .otherwise(F.coalesce(of_others, F.lit(0).cast("bigint")))
    )


def _rarest(words: Column, heat: Column) -> Column:
    """The word of an array that the fewest values share, then the longest one."""
    places = F.transform(words, lambda w: F.struct(_uses(w, heat), -F.length(w), w.alias("word")))
    return F.array_min(places)["word"]


def _other_anchors(norm: Column, runs: Column, gram: int) -> Column:
    """Anchors of densities and of values without a run."""
    density, numbers = X.is_density(norm), _numbers(norm)
    return (
        F.when(density & (F.size(numbers) > 0), _prefixed("d:", numbers))
        .when(density, F.array(F.lit("d:*")))
        .when(norm.isNotNull() & (F.size(runs) == 0), F.array(F.concat(F.lit("g:"), F.substring(norm, 1, gram))))
    )


def _runs(norm: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(norm, F.lit(RUN), F.lit(0)))


def match_anchors(attr_dict: DataFrame, gram: int, min_len: int = MIN_VALUE_LENGTH) -> DataFrame:
    """``hs_code, product, attr, value_ord, value, anchor``: one row per value that matching looks for, and anchor.

    Nothing else of a value is moved: its pattern follows from it (``value_pattern``), and of several
    spellings the caller takes the first where a text states them.
    """
    norm = F.col("_norm")
    listed = attr_dict.select(*KEY, "attr", "value_ord", "value", value_norm(F.col("value"), min_len).alias("_norm")).where("_norm IS NOT NULL")
    listed = listed.withColumn("_words", F.when(~X.is_density(norm), _runs(norm)))
    by_run = F.array(F.concat(F.lit("t:"), _rarest(F.col("_words"), _heat(listed))))
    anchors = F.coalesce(_other_anchors(norm, _runs(norm), gram), by_run)
    # A column first and an outer explode: see _heat, and a generator shares no parts of its expression.
    listed = listed.select(*KEY, "attr", "value_ord", "value", F.array_distinct(anchors).alias("_anchors"))
    return listed.select(*KEY, "attr", "value_ord", "value", F.explode_outer("_anchors").alias("anchor")).where("anchor IS NOT NULL")


def value_anchors(compiled: DataFrame, gram: int) -> DataFrame:
    """One row per value and anchor; the rarest run of a plain value is its anchor.

    For the substring rule a value is also anchored at its rarest word between blanks: all
    its words stand between blanks in a text that rule finds it in.
    """
    empty = F.array().cast("array<string>")
    norm = F.col("pattern.norm")
    columns = [*KEY, "attr", "value_ord", "rank", "value", "lower", "pattern"]
    listed = compiled.where("value IS NOT NULL").select(*columns)
    by_run = listed.withColumn("_words", F.when(F.col("pattern").isNotNull() & ~F.col("pattern.density"), _runs(norm)))
    rarest_run = F.array_compact(F.array(F.concat(F.lit("t:"), _rarest(F.col("_words"), _heat(by_run)))))
    spoken = F.filter(F.split("lower", f"{X.WS}+"), lambda w: w != "")
    words = F.when(F.size(spoken) > 0, F.array_distinct(spoken)).otherwise(F.array(F.lit("")))
    by_word = listed.withColumn("_words", words)
    rarest_word = F.array(F.concat(F.lit("s:"), _rarest(words, _heat(by_word))))
    anchors = F.concat(
        F.array(F.concat(F.lit("v:"), F.col("value"))),
        F.coalesce(_other_anchors(norm, _runs(norm), gram), empty),
        rarest_run,
        rarest_word,
    )
    return by_run.select(*columns, F.explode(F.array_distinct(anchors)).alias("anchor"))


def anchored_pairs(texts: DataFrame, anchors: Column, values: DataFrame) -> DataFrame:
    """Texts (``TEXT_ID`` and more) and values (``value_anchors``) that share an anchor; a pair may come twice.

    How many texts hold an anchor is counted first: those of a common one are dealt to as many
    tasks as their number asks for. Values whose anchor no text holds are left where they are.
    """
    on = [*KEY, "anchor"]
    tokens = durable(texts.select(*KEY, *TEXT_ID, anchors.alias("_anchors"))).select(
        *KEY, *TEXT_ID, F.explode("_anchors").alias("anchor")
    )
    return skew_join(tokens, with_possible_partner(values, tokens, on), on, spread_by=[TEXT_ID[0]])


def with_text_id(goods: DataFrame, *more: Column) -> DataFrame:
    """``goods`` with ``TEXT_ID``, 128 bits that stand for product and description (and ``more``)."""
    identity = [*KEY, "goods_shipped", *more]
    return goods.withColumns(
        {TEXT_ID[0]: F.xxhash64(*identity), TEXT_ID[1]: F.xxhash64(F.lit("second"), *identity)}
    )


def with_names(goods: DataFrame, compiled: DataFrame, how: str = "inner") -> DataFrame:
    """``goods`` (with ``TEXT_ID``) and ``_names``, the attributes of their product in order."""
    names = (
        compiled.groupBy(*KEY, "attr")
        .agg(F.min("attr_ord").alias("attr_ord"))
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_list(F.struct("attr_ord", "attr"))).alias("_names"))
    )
    return skew_join(goods, names, KEY, how, spread_by=[TEXT_ID[0]])


def _attach_by_anchor(
    goods: DataFrame, compiled: DataFrame, gram: int, replied: Column | None, heuristic: bool, how: str
) -> DataFrame:
    anchors = text_anchors(F.col("goods_shipped"), gram, heuristic)
    more = []
    if replied is not None:
        anchors = F.concat(anchors, _prefixed("v:", F.coalesce(replied, F.array())))
        more = [replied]
    keyed = with_text_id(goods, *more)
    texts = durable(keyed.dropDuplicates(TEXT_ID))
    pairs = anchored_pairs(texts, anchors, value_anchors(compiled, gram))
    # Only what the text states, the substring rule finds or a reply names goes on.
    by_reply = F.startswith("anchor", F.lit("v:"))
    states = by_reply | occurs(F.col("_text"), F.col("pattern"))
    if heuristic:
        states |= bounded(F.col("lower"), F.col("_soft"))
    read = texts.select(*TEXT_ID, text_forms(F.col("goods_shipped")).alias("_text"), X.soft_text("goods_shipped").alias("_soft"))
    found = (
        pairs.join(read, TEXT_ID)
        .where(states)
        .groupBy(*TEXT_ID, "attr", "rank", "value")
        .agg(F.min_by(_value_struct(), "value_ord").alias("_value"))
        .groupBy(*TEXT_ID)
        .agg(F.collect_list(F.struct("attr", F.col("_value").alias("value"))).alias("_found"))
    )
    attrs = F.transform(
        "_names",
        lambda n: F.struct(
            n["attr_ord"].alias("attr_ord"),
            n["attr"].alias("attr"),
            F.array_sort(
                F.transform(
                    F.filter(
                        F.coalesce("_found", F.array()), lambda f: f["attr"] == n["attr"]
                    ),
                    lambda f: f["value"],
                )
            ).alias("values"),
        ),
    )
    return (
        with_names(keyed, compiled, how)
        .join(found, TEXT_ID, "left")
        .withColumn("attrs", attrs)
        .drop(*TEXT_ID, "_names", "_found")
    )
