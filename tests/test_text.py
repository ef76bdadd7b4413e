"""Scalar functions on literal cases."""

import pytest
from pyspark.sql import functions as F

from shiplabel.functions import text as X


def one(spark, column):
    return spark.range(1).select(column).first()[0]


CASES = [
    (X.hs4_trunc, "0901.11", "0901"),
    (X.hs4_trunc, "904", "0904"),
    (X.hs4_trunc, "901110000", "9011"),
    (X.hs4_trunc, "9.01", "9.01"),
    (X.hs4_trunc, "x", "000x"),
    (X.hs4_digits, "0901.11", "0901"),
    (X.hs4_digits, "904", "0904"),
    (X.hs4_digits, "901110000", "0901"),
    (X.hs4_digits, "9.01", "0901"),
    (X.hs4_digits, "x", ""),
    (X.hs4_digits, "0901110000", "0901"),
    (X.drop_leading_zeros, "090111", "90111"),
    (X.drop_leading_zeros, "0", "0"),
    (X.norm_text, "  Green\tCOFFEE \x1c beans\xa0", " green coffee beans "),
    (X.norm_text, "", "  "),
    (X.soft_text, "Beans, (Washed)/Dry  A\\B;#1", "beans   washed  dry  a b  1"),
    (X.strip, "  a b \x1f", "a b"),
    (X.sanitize_filename, "Not a Coffee/Bean Product", "Not_a_Coffee_Bean_Product"),
    (X.sanitize_filename, "Crème  brûlée (2)", "Crème_brûlée_2_".replace("_2_", "__2_")),
    (X.sanitize_filename, "   ", "product"),
    (X.sanitize_filename, "x" * 130, "x" * 120),
    (X.product_from_file, "hs_9011_Not_a_Coffee_Bean_Product.csv", "Not a Coffee Bean Product"),
    (X.product_from_file, "/tmp/out_x/two_parts.csv", "two parts"),
    (X.product_from_file, "a_b_c.tar.gz", "c.tar"),
    (X.product_from_file, ".csv", ".csv"),
    (X.snake_acronym, "HTTPServer", "http_server"),
    (X.snake_acronym, "Origin-Country", "origin_country"),
    (X.snake_acronym, "_Already__snake_", "already_snake"),
    (X.snake_simple, "HTTPServer", "httpserver"),
    (X.snake_simple, "Origin-Country", "origin_country"),
    (X.snake_simple, " Price (USD)/kg ", "price_usd_kg"),
    (X.attr_to_snake, "attr_OriginCountry", "origin_country"),
    (X.attr_to_snake, "OriginCountry", "origin_country"),
    (X.clean_value, "n/a", None),
    (X.clean_value, '"None"', None),
    (X.clean_value, " Arabica ", "Arabica"),
    (X.clean_value, "\"'Red'\"", "Red"),
    (X.clean_value_map, "n/a", "n/a"),
    (X.clean_value_map, '"None"', '"None"'),
    (X.clean_value_map, " NULL ", None),
    (X.attr_name, "processing method", "Processing_Method"),
    (X.attr_name, " -hs-CODE__x", "Hs_CODE_X"),
    (X.title_value, "AA-AB  PLUS", "Aa-ab Plus"),
    (X.token_estimate, "123456789", 2),
    (X.json_payload, 'so: {"a": {"b": 1}} done', '{"a": {"b": 1}}'),
    (X.json_payload, "none", None),
    (X.attr_key, "Color", "attr_Color"),
    (X.attr_key, "attr_Color", "attr_Color"),
    (X.is_density, "500 g/l", True),
    (X.is_density, "500 gl", True),
    (X.is_density, "5 kg", False),
    (X.is_density, "in grams/liter", True),
]


def test_scalars(spark):
    row = spark.range(1).select(*(f(F.lit(v)).alias(str(i)) for i, (f, v, _) in enumerate(CASES))).first()
    wrong = [(f.__name__, v, got, want) for (f, v, want), got in zip(CASES, row) if got != want]
    assert wrong == []


def test_prefix_can_be_kept(spark):
    kept = X.attr_to_snake(F.lit("attr_OriginCountry"), drop_prefix=False)
    assert one(spark, kept) == "attr_origin_country"


def test_title_values_keep_first_of_each(spark):
    values = F.array(*(F.lit(v) for v in ["low GRADE", " ", "Low grade", "AB", "ab", "x"]))
    assert one(spark, X.title_values(values)) == ["Low Grade", "Ab", "X"]


def test_strict_heading_needs_a_digit(spark):
    assert one(spark, X.hs4_strict(F.lit("9.01"))) == "0901"
    with pytest.raises(Exception, match="no digit in HS code"):
        one(spark, X.hs4_strict(F.lit("none")))


@pytest.mark.parametrize(
    "preview, goods, expected",
    [("green coffee", "green coffee beans", True), ("Green", "green coffee", False), ("", "x", True)],
)
def test_preview(spark, preview, goods, expected):
    assert one(spark, X.preview_ok(F.lit(preview), F.lit(goods))) is expected


def test_broken_json_is_null(spark):
    assert one(spark, X.json_object(F.lit("{oops}")).isNull())
    assert not one(spark, X.json_object(F.lit('x {"a":1} y')).isNull())
