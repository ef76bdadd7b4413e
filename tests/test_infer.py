"""Samples, column summaries, reply reading and fallbacks."""

import json

import pytest
from pyspark.sql import functions as F

from shiplabel.operators import infer as I
from shiplabel.operators import requests as Q


def rows(spark, values, columns):
    return spark.createDataFrame([(i, *v) for i, v in enumerate(values)], f"ord long, {columns}")


def test_first_values_follow_row_order_not_frequency(spark):
    df = rows(spark, [("c", v) for v in ["b", "B", " a ", "c", "c", "c", "", None]], "category string, x string")
    got = I.first_values(df.repartition(4), ["x"], 2).orderBy("place").collect()
    assert [(r["place"], r["value"]) for r in got] == [(1, "b"), (2, "a")]


def test_cells_as_text(spark):
    df = rows(spark, [("c", 23.0, True, 12345678.5, 7)], "category string, a double, b boolean, d double, e int")
    got = {r["column"]: r["value"] for r in I.first_values(df, ["a", "b", "d", "e"], 5).collect()}
    assert got == {"a": "23.0", "b": "True", "d": "12345678.5", "e": "7"}


def test_summary(spark):
    df = rows(
        spark,
        [("c", "Peru", "sea", "A"), ("c", "Chad", "sea", "b"), ("d", None, " ", None)],
        "category string, shipment_origin string, transport_method string, `Screen Grade` string",
    )
    got = {r["category"]: r["summary"] for r in I.category_summary(df).collect()}
    assert got == {
        "c": "shipment_origin: Peru, Chad\ntransport_method: sea\nScreen Grade: A, b\n"
        "Detected dynamic attribute hints: grade, screen"
    }


def test_summary_limits_values(spark):
    df = rows(spark, [("c", f"v{i}") for i in range(20)], "category string, pack string")
    line = I.category_summary(df).first()["summary"].splitlines()[0]
    assert line == "pack: " + ", ".join(f"v{i}" for i in range(8))


def test_samples(spark):
    df = rows(spark, [("small", g) for g in ["b", "a", "b "]] + [("large", f"g{i}") for i in range(50)], "category string, goods_shipped string")
    small = I.sample_goods(df, "category", 10).where("category = 'small'").orderBy("place")
    assert [r["goods_shipped"] for r in small.collect()] == ["b", "a"]
    draw = lambda d, **o: [
        r["goods_shipped"] for r in I.sample_goods(d, "category", 10, **o).where("category = 'large'").orderBy("place").collect()
    ]
    one = draw(df)
    assert len(set(one)) == 10 and one == draw(df.repartition(7)) and one != draw(df, seed=1)


def test_products_from_replies(spark):
    reply = {
        "product_categories": [
            "junk", {"name": " A ", "description": " x ", "representative_goods": ["1", " ", 2, "3", "4", "5"]},
            {"name": "A", "description": "again"}, {"name": ""}, {"name": "B"},
        ]
    }
    got = I.inferred_products(spark.createDataFrame([("0901", "so " + json.dumps(reply))], "hs4 string, reply string"))
    assert [tuple(r) for r in got.orderBy("ord").collect()] == [
        ("0901", 0, "A", "x", ["1", "2", "3", "4", "5"]), ("0901", 1, "B", None, []),
    ]
    cut = I.inferred_products(
        spark.createDataFrame([("0901", json.dumps(reply))], "hs4 string, reply string"), I.PARITY_REPRESENTATIVES
    )
    assert cut.orderBy("ord").first()["representatives"] == ["1", "2", "3", "4"]
    broken = spark.createDataFrame([("0901", "sorry")], "hs4 string, reply string")
    with pytest.raises(Exception, match="no JSON payload"):
        I.inferred_products(broken).collect()


REPLY = {
    "attributes": [
        {"name": "origin-country", "definition": "", "values": []},
        {"name": "bean size", "definition": " Size. ", "values": ["aa-ab PLUS", "AA-AB plus", 7, " ", "b"]},
        {"name": "Bean_Size", "definition": "Later.", "values": ["x"]},
        {"name": "empty", "definition": "E.", "values": "text"},
        {"definition": "no name"},
    ]
}


def schema(spark):
    df = rows(
        spark,
        [("c", "peru", "sea", "A", 5.0), ("c", "PERU", "air", "b", None), ("d", None, None, None, None), ("e", "x", "y", "z", 1.0)],
        "category string, shipment_origin string, transport_method string, `pack-type` string, weight_in_kg double",
    )
    answers = spark.createDataFrame(
        [("c", json.dumps(REPLY)), ("d", '{"attributes":[]}'), ("gone", json.dumps(REPLY)), ("e", '{"attributes":null}')],
        "category string, reply string",
    )
    return I.inferred_schema(df, answers)


def test_schema_of_replies_and_fallbacks(spark):
    got = [tuple(r)[1:] for r in schema(spark).where("category = 'c'").orderBy("attr_ord").collect()]
    assert got == [
        # replied without values: keeps its place, gets values and meaning from the column
        ("Origin_Country", 0, "Country where the shipment originated.", ["Peru"], "fallback"),
        ("Bean_Size", 1, "Size.", ["Aa-ab Plus", "B"], "reply"),
        ("Transport_Method", 2, "Primary transport mode used for the shipment.", ["Sea", "Air"], "fallback"),
    ]
    # no reply and nothing in the columns: the category is left out
    assert schema(spark).where("category IN ('d', 'gone')").count() == 0
    only_columns = [r["attr"] for r in schema(spark).where("category = 'e'").orderBy("attr_ord").collect()]
    assert only_columns == ["Origin_Country", "Transport_Method", "Weight_In_Kg"]


def test_keyword_columns_come_last(spark):
    df = rows(spark, [("c", "A", "sea")], "category string, `pack-type` string, transport_method string")
    none = spark.createDataFrame([], "category string, attr string, values array<string>")
    got = I.fallback_attributes(df, none).orderBy("rank").collect()
    assert [(r["attr"], r["definition"]) for r in got] == [
        ("Transport_Method", "Primary transport mode used for the shipment."),
        ("Pack_Type", "Values observed for column 'pack-type' among shipments in this category."),
    ]


def test_telemetry_dictionary_and_definitions(spark):
    inferred = schema(spark)
    told = {r["category"]: tuple(r)[1:] for r in I.telemetry(inferred).collect()}
    assert told["c"] == (1, ["Origin_Country", "Transport_Method"], 3)
    known = I.inferred_dictionary(inferred.withColumn("hs_code", F.lit("0901")))
    assert [r["value"] for r in known.where("attr = 'Bean_Size'").orderBy("value_ord").collect()] == ["Aa-ab Plus", "B"]
    meanings = {r[0]: r[1] for r in I.inferred_definitions(inferred, ["c", "d", "e"]).collect()}
    assert meanings["attr_Bean_Size"] == "Size." and len(meanings) == 4


def test_requests(spark):
    samples = spark.createDataFrame([("c", 2, "b"), ("c", 1, "a")], "category string, place long, goods_shipped string")
    summaries = spark.createDataFrame([("d", "x: 1")], "category string, summary string")
    got = {r["category"]: r["prompt"] for r in Q.attribute_inference_requests(samples, summaries, "0901").collect()}
    assert "1. a\n2. b\nColumns:\n(none of the columns has a value)" in got["c"]
    assert "1. (the table holds no description)\nColumns:\nx: 1" in got["d"]


def test_replies_with_repeated_keys_and_nan_are_read(spark):
    reply = 'Sure: {"product_categories":[],"product_categories":[{"name":"x","name":"Tea","score":NaN,"representative_goods":["a",1,NaN]},"junk"]}'
    got = I.inferred_products(spark.createDataFrame([("0901", reply)], "hs4 string, reply string")).collect()
    assert [(r["category"], r["representatives"]) for r in got] == [("Tea", ["a", "1", "NaN"])]
    reply = '{"attributes":[{"name":"Grade","weight":-Infinity,"values":["aa",7,true,"bb"],"values":["b c",85.5,"d"]},{"name":"Odd","values":["e",NaN,4]}]}'
    got = I.read_attribute_replies(spark.createDataFrame([("Tea", reply)], "category string, reply string")).orderBy("attr_ord").collect()
    assert [(r["attr"], r["values"]) for r in got] == [("Grade", ["B C", "D"]), ("Odd", ["E"])]
    for broken in ("no payload", "{oops}", '{"attributes":[{"name":"x"}'):
        with pytest.raises(Exception, match="no JSON payload"):
            I.read_attribute_replies(spark.createDataFrame([("Tea", broken)], "category string, reply string")).collect()
    assert I.read_attribute_replies(spark.createDataFrame([("Tea", '{"attributes":7}')], "category string, reply string")).count() == 0


def test_label_replies_with_repeated_keys_and_nan_are_read(spark):
    from shiplabel.operators import labels as L

    items = spark.createDataFrame([(b, p) for b in range(6) for p in range(2)], "batch_no long, pos long")
    replies = ['{"classifications":["x"],"classifications":["a","b"]}', '{"score":NaN,"classifications":["a",NaN]}', '{"classifications":["a","b"]} done', '{"classifications":[7,null]}', "{oops", '{"classifications":["a"']
    table = spark.createDataFrame(list(enumerate(replies)), "batch_no long, reply string")
    got = [r["category"] for r in L.read_label_replies(items, table).orderBy("batch_no", "pos").collect()]
    failed = ["Unclassified"] * 2
    assert got == ["a", "b", "a", "NaN", *failed, "7", "", *failed, *failed]


@pytest.mark.parametrize("limit", [1, 3, 50])
def test_first_values_of_a_large_table_are_those_of_all_rows(spark, limit, monkeypatch):
    """The first rows settle what shows enough values there; late, rare and differently spelled values still count."""
    monkeypatch.setattr(I, "HEAD_ROWS", 100)
    n = F.col("id")
    df = spark.range(5000).select(
        F.when(n % 11 == 0, None).when(n % 2 == 0, "a").otherwise("b").alias("category"),
        F.when(n == 4990, None).otherwise(F.format_string("%05d", n * 7 % 5003)).alias("ord"),
        F.when(n % 3 == 0, F.concat(F.lit("V"), n % 40)).otherwise(F.concat(F.lit(" v"), n % 40)).alias("many"),
        F.when(n * 7 % 5003 > 4000, "late").otherwise("early").alias("few"),
        (n / 8).alias("number"),
    )
    columns = ["many", "few", "number"]
    melted = I._melted(df, columns, "category", "ord")
    want = I._placed(I._first_seen(melted, "category", "ord"), "category", "ord", limit, None)
    rows = lambda d: sorted((str(r["category"]), r["column"], r["place"], r["value"]) for r in d.collect())
    assert I._head_bound(df, "ord", 5000) is not None
    got = rows(I.first_values(df, columns, limit))
    assert got == rows(want) and (limit == 1 or ("b", "few", 2, "late") in got)


def test_lists_are_made_only_for_columns_that_are_taken(spark):
    """Telemetry needs no list of values, and the plan makes none."""
    df = spark.createDataFrame([("a", 1, "x", 2.0), ("b", 2, "y", 3.0)], "category string, ord int, shipment_origin string, weight_in_kg double")
    replies = spark.createDataFrame([("a", '{"attributes":[]}')], "category string, reply string")
    schema = I.inferred_schema(df, replies)
    assert {r["attr"] for r in schema.where("category = 'b'").collect()} == {"Origin_Country", "Weight_In_Kg"}
    plan = I.telemetry(schema)._jdf.queryExecution().optimizedPlan().toString()
    assert "_first" not in plan
