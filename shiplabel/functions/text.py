"""Scalar text functions. Each takes a column (or its name) and returns a Column.

All of them are built-in expressions, so they stay in the JVM and can be pushed
around by the optimizer like any other projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Characters that count as whitespace, as a string and as a regex class.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WS = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# Spellings of "no value" in published tables (schema summary / shipment map).
MISSING_IN_SUMMARY = ["", "none", "null", "nan", "na", "n/a", "undefined"]
MISSING_IN_SHIPMENT_MAP = ["", "nan", "none", "null"]
# Characters blanked before the substring heuristic looks at a text.
SOFT_PUNCTUATION = "#,;/\\()"
# What makes a dictionary value a density ("500 G/L").
DENSITY_COMPACT = r"\b\d{3,4}g/?l\b"
DENSITY_PARTS = ["g/l", "gr/l", "grams/liter"]
# Longest file name stem, and the stem of a name with nothing left.
FILE_STEM_LIMIT = 120
EMPTY_FILE_STEM = "product"
# Where a name changes case: the end of an acronym, and a capital after a small letter or digit.
ACRONYM_END = "([A-Z]+)([A-Z][a-z])"
CASE_CHANGE = "([a-z0-9])([A-Z])"
# The published spelling of "no value".
NO_VALUE = "None"
# ----------------------------------------------------------------------------

# Hexadecimal digits that tell files of products apart whose names are cut.
FILE_HASH_DIGITS = 12


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove whitespace of any kind from both ends."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def collapse(c) -> Column:
    """One blank for each run of whitespace, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), rf"{WS}+", " "))


def hs4_trunc(c) -> Column:
    """Heading by truncation: first four characters, zero-filled on the left."""
    return F.lpad(F.substring(strip(c), 1, 4), 4, "0")


def hs4_digits(c) -> Column:
    """Heading by digits: ``0901.11`` and ``901110000`` are both ``0901``; '' without digits."""
    digits = F.regexp_replace(_col(c).cast("string"), "[^0-9]", "")
    size = F.length(digits)
    filled = (
        F.when(size == 9, F.lpad(digits, 10, "0"))
        .when((size > 0) & (size < 4), F.lpad(digits, 4, "0"))
        .otherwise(digits)
    )
    return F.substring(filled, 1, 4)


def hs4_strict(c) -> Column:
    """Like :func:`hs4_digits`, but a code without any digit fails the query."""
    code = hs4_digits(c)
    message = F.concat(F.lit("no digit in HS code "), _col(c).cast("string"))
    return F.when(code != "", code).otherwise(F.raise_error(message))


def drop_leading_zeros(c) -> Column:
    """The spelling an HS code has after a loader has read it as a number."""
    return F.regexp_replace(_col(c), r"^0+(?=[0-9])", "")


def norm_text(c) -> Column:
    """Lower case, single blanks, one blank before and after: the form matching works on."""
    return F.concat(F.lit(" "), norm_value(c), F.lit(" "))


def norm_value(c) -> Column:
    """Dictionary-value form of :func:`norm_text`, without the outer blanks."""
    return collapse(F.lower(_col(c)))


def soft_text(c) -> Column:
    """Lower case with light punctuation blanked; whitespace is *not* collapsed."""
    return F.translate(F.lower(_col(c)), SOFT_PUNCTUATION, " " * len(SOFT_PUNCTUATION))


def _file_stem(c) -> Column:
    safe = F.regexp_replace(_col(c), r"[^\p{L}\p{N} _-]", "_")
    return F.regexp_replace(F.trim(safe), " +", "_")


def sanitize_filename(c) -> Column:
    stem = F.substring(_file_stem(c), 1, FILE_STEM_LIMIT)
    return F.when(stem == "", EMPTY_FILE_STEM).otherwise(stem)


def product_file(hs, product) -> Column:
    """Name of the per-product file of a (heading, product).

    Of a product whose name is cut, the last characters give way to a hash of the whole
    name, so products that begin alike keep files of their own.
    """
    mark = F.concat(F.lit("_"), F.substring(F.sha2(_col(product), 256), 1, FILE_HASH_DIGITS))
    own = F.concat(F.substring(sanitize_filename(product), 1, FILE_STEM_LIMIT - FILE_HASH_DIGITS - 1), mark)
    cut = F.length(_file_stem(product)) > FILE_STEM_LIMIT
    stem = F.when(cut, own).otherwise(sanitize_filename(product))
    return F.concat(F.lit("hs_"), _col(hs), F.lit("_"), stem, F.lit(".csv"))


def product_from_file(c) -> Column:
    """Product name as far as a per-product file name still tells it."""
    base = F.regexp_replace(_col(c), r"\A.*/", "")
    stem = F.regexp_replace(base, r"\A(\.*[^.].*)\.[^.]*\z", "$1")
    parts = F.split(stem, "_")
    named = F.when(F.size(parts) > 2, F.slice(parts, 3, F.size(parts))).otherwise(parts)
    joined = F.replace(F.array_join(named, " "), F.lit("  "), F.lit(" "))
    return strip(joined)


def snake_acronym(c) -> Column:
    """``HTTPServer`` and ``Http-Server`` both become ``http_server``."""
    s = F.regexp_replace(_col(c), rf"(?:-|{WS})+", "_")
    s = F.regexp_replace(s, ACRONYM_END, "$1_$2")
    s = F.regexp_replace(s, CASE_CHANGE, "$1_$2")
    s = F.regexp_replace(s, "_+", "_")
    return F.trim(F.lower(s), F.lit("_"))


def attr_to_snake(c, drop_prefix: bool = True) -> Column:
    """:func:`snake_acronym` of a column name, minus (or keeping) its ``attr_`` prefix."""
    name = _col(c)
    suffix = snake_acronym(F.substring(name, 6, 1 << 30))
    inner = suffix if drop_prefix else F.concat(F.lit("attr_"), suffix)
    return F.when(F.startswith(name, F.lit("attr_")), inner).otherwise(snake_acronym(name))


def snake_simple(c) -> Column:
    """Plain rule of the shipment map: ``HTTPServer`` becomes ``httpserver``."""
    s = F.regexp_replace(strip(c), CASE_CHANGE, "$1_$2")
    s = F.regexp_replace(s, "[^A-Za-z0-9]+", "_")
    return F.lower(F.trim(s, F.lit("_")))


def clean_value(c) -> Column:
    """Published cell without outer blanks and quotes; NULL if it spells "no value"."""
    s = F.trim(F.trim(strip(_col(c).cast("string")), F.lit('"')), F.lit("'"))
    return F.when(~F.lower(strip(s)).isin(MISSING_IN_SUMMARY), s)


def clean_value_map(c) -> Column:
    """Cell cleaning of the shipment map: quotes stay, fewer spellings of "no value"."""
    s = strip(_col(c).cast("string"))
    return F.when(~F.lower(s).isin(MISSING_IN_SHIPMENT_MAP), s)


def attr_name(c) -> Column:
    """``processing method`` becomes ``Processing_Method``; other letters keep their case."""
    parts = F.filter(F.split(F.translate(strip(c), " -", "__"), "_"), lambda p: p != "")
    upper = F.transform(
        parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))
    )
    return F.array_join(upper, "_")


def title_value(c) -> Column:
    """Every word capitalised, its rest in lower case: ``AA-AB  PLUS`` becomes ``Aa-ab Plus``."""
    return F.initcap(collapse(c))


def title_values(c) -> Column:
    """Title form of an array's non-blank values, first of each kept in place."""
    titles = F.filter(F.transform(_col(c), title_value), lambda v: v.isNotNull() & (v != ""))
    return F.array_distinct(titles)


def token_estimate(c) -> Column:
    """Four characters are counted as one token."""
    return F.floor(F.length(_col(c)) / 4).cast("bigint")


def json_payload(c) -> Column:
    """Text from the first ``{`` to the last ``}``; NULL if there is none."""
    found = F.regexp_extract(_col(c), r"(?s)\{.*\}", 0)
    return F.when(found != "", found)


def json_object(c) -> Column:
    """Payload of a reply as VARIANT; NULL when it is missing or cannot be parsed."""
    return F.try_parse_json(json_payload(c))


def reply_list(text, key: str) -> Column:
    """The entries under ``key`` of the one JSON object in a text, each as text: objects as JSON, others as they read.

    Read as leniently as common readers do: the last of repeated keys counts, and NaN and
    Infinity are taken as texts. Numbers keep their digits (``85.0``). NULL for a text that is
    no JSON object or has no list there. Text before, between or after objects makes a reply unreadable,
    hence the brackets: there must be one value in them.
    """
    whole = F.concat(F.lit("["), _col(text), F.lit("]"))
    read = F.from_json(whole, f"array<struct<{key}:array<string>>>")
    entries = F.get(read, F.lit(0))[key]
    # Spark quotes them.
    plain = F.transform(entries, lambda e: F.regexp_replace(e, r'\A"(NaN|-?Infinity)"\z', "$1"))
    return F.when(F.size(read) == 1, plain)


def reply_items(c) -> Column:
    """The entries under ``items`` of a reply (:func:`reply_list` of its payload); NULL for an unreadable reply."""
    return reply_list(json_payload(c), "items")


def preview_ok(preview, goods) -> Column:
    """Does the echoed beginning of a description agree with the description?"""
    head = F.substring(_col(preview), 1, 15)
    return F.startswith(F.substring(_col(goods), 1, 30), head)


def attr_key(c) -> Column:
    name = _col(c)
    return F.when(F.startswith(name, F.lit("attr_")), name).otherwise(
        F.concat(F.lit("attr_"), name)
    )


def is_density(norm) -> Column:
    """Is this (normalised) dictionary value a density such as ``500 g/l``?"""
    value = _col(norm)
    test = F.rlike(F.replace(value, F.lit(" "), F.lit("")), F.lit(DENSITY_COMPACT))
    for part in DENSITY_PARTS:
        test = test | F.contains(value, F.lit(part))
    return test


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once per row and use it many times inside ``fn``."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))
