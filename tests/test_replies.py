"""Replies of every shape, merged with the dictionary and filled by the heuristic."""

import json

import pytest
from pyspark.sql import functions as F

from shiplabel.operators import batches as B
from shiplabel.operators import labels as L
from shiplabel.operators import matching as M
from shiplabel.operators import replies as R
from shiplabel.operators import requests as Q
from shiplabel.operators.dictionary import attach_dictionary
from shiplabel.plans.views import ATTR_DICT_SCHEMA

KEY = ["hs_code", "product"]


def dictionary(spark, attributes):
    return spark.createDataFrame(
        [("0901", "P", a, i, v, j) for i, (a, vs) in enumerate(attributes.items()) for j, v in enumerate(vs)],
        ATTR_DICT_SCHEMA,
    )


def items(spark, texts, known, size=10):
    goods = spark.createDataFrame([("0901", "P", t) for t in texts], "hs_code string, product string, goods_shipped string")
    return R.gate_batches(M.match_goods(B.number_batches(goods, size), known))


def replies(spark, *texts):
    return spark.createDataFrame(
        [("0901", "P", i, t) for i, t in enumerate(texts)],
        "hs_code string, product string, batch_no long, reply string",
    )


def judged(spark, texts, known, reply, open_list=True, strategy="broadcast", fill=True):
    aligned = R.align_replies(items(spark, texts, known), replies(spark, *reply))
    attached = attach_dictionary(
        aligned, known, strategy=strategy, replied=R.replied_texts(F.col("item"))
    )
    merged = R.merge_values(R.normalise_replies(attached, open_list))
    return R.records(R.fill_missing(merged, fill))


# reply value, open list, -> value, flagged, invalid
SHAPES = [
    ('{"custom":"A"}', True, "A", False, 0),
    ('{"custom":"Z"}', True, "Z", True, 0),
    ('{"custom":"Z"}', False, "Z", True, 0),  # a nested custom value passes a closed list
    ('"Z"', False, "None", False, 1),
    ('"Z"', True, "Z", True, 0),
    ("5", True, "5", True, 0),
    ("2.50", True, "2.5", True, 0),
    ("true", True, "True", True, 0),
    ("null", True, "None", False, 0),
    ('"None"', False, "None", False, 0),
    ('{"value":"A"}', False, "A", False, 0),
    ('{"value":"Z"}', False, "None", False, 1),
    ('{"value":5,"custom":"Z"}', True, "Z", True, 0),
    ('{"value":5}', True, "None", False, 0),
    ('{"other":"A"}', True, "None", False, 0),
    ('{"custom":"None"}', True, "None", False, 0),
    ('"A"', True, "A", False, 0),
]


@pytest.mark.parametrize("strategy", ["broadcast", "anchored"])
@pytest.mark.parametrize("open_list", [True, False])
def test_value_shapes(spark, strategy, open_list):
    cases = [c for c in SHAPES if c[1] is open_list]
    texts = [f"text {i:02d}" for i in range(len(cases))]
    entries = ",".join(f'{{"attributes":{{"X":{c[0]}}}}}' for c in cases)
    known = dictionary(spark, {"X": ["A"]})
    batch = items(spark, texts, known, size=50)
    aligned = R.align_replies(batch, replies(spark, f'{{"items":[{entries}]}}'))
    attached = attach_dictionary(aligned, known, strategy=strategy, replied=R.replied_texts(F.col("item")))
    done = R.records(R.fill_missing(R.merge_values(R.normalise_replies(attached, open_list))))
    got = [
        (r["attributes"]["X"], r["custom_attributes"] == ["X"], r["invalid"])
        for r in done.orderBy("goods_shipped").collect()
    ]
    assert got == [c[2:] for c in cases]


def test_absent_key_and_unusual_attributes(spark):
    known = dictionary(spark, {"X": ["Abc"], "Y": ["Def"]})
    reply = json.dumps({"items": [{"attributes": {"Y": "Def"}}, {"attributes": 7}, {}]})
    rows = judged(spark, ["a", "b", "c"], known, [reply]).orderBy("goods_shipped").collect()
    assert [r["attributes"] for r in rows] == [{"X": "None", "Y": "Def"}] + [{"X": "None", "Y": "None"}] * 2
    assert rows[0]["raw_attributes"] == {"X": None, "Y": '"Def"'}


def test_alignment(spark):
    """Surplus ignored, non-objects consume their place, unusable replies answer nothing."""
    known = dictionary(spark, {"X": ["Abc"]})
    batch = items(spark, [f"{i}" for i in range(8)], known, size=2)
    answers = replies(
        spark,
        '{"items":[{"item_preview":"0"},{"item_preview":"?"},{"item_preview":"9"}]}',
        '{"items":["skip",{}]}',
        '{"items":[1,2,{}]}',
    )
    got = R.align_replies(batch, answers).orderBy("goods_shipped").collect()
    assert [(r["status"], r["preview_ok"]) for r in got] == [
        ("answered", True), ("answered", False), ("pending", None), ("answered", True),
        ("unusable", None), ("unusable", None), ("pending", None), ("pending", None),
    ]


def test_stated_value_replaces_the_answer_but_stays_counted(spark):
    known = dictionary(spark, {"X": ["Red", "Blue"]})
    row = judged(spark, ["red ring"], known, ['{"items":[{"attributes":{"X":"Crimson"}}]}']).first()
    assert row["attributes"] == {"X": "Red"} and row["custom_attributes"] == []
    assert row["out_of_schema"] == 1  # the counter is not taken back


def test_unusable_reply_gets_no_stated_value_but_the_heuristic(spark):
    known = dictionary(spark, {"X": ["Red"], "Y": ["Ab"]})
    row = judged(spark, ["red ab"], known, ["no json"]).first()
    assert row["attributes"] == {"X": "Red", "Y": "Ab"} and row["heuristic_filled"] == ["X", "Y"]
    bare = judged(spark, ["red ab"], known, ["no json"], fill=False).first()
    assert bare["attributes"] == {"X": "None", "Y": "None"}


def test_gate_settles_whole_batches_only(spark):
    known = dictionary(spark, {"X": ["Red"], "Y": ["Ring"]})
    batch = items(spark, ["a red ring", "b red ring", "c red ring", "d red"], known, size=2)
    assert [r["resolved"] for r in batch.orderBy("goods_shipped").collect()] == [True, True, False, False]
    settled = R.resolved_records(batch).orderBy("pos").collect()
    assert [r["attributes"] for r in settled] == [{"X": "Red", "Y": "Ring"}] * 2
    assert [r["total"] for r in settled] == [2, 0]  # a settled batch counts once
    forced = R.gate_batches(batch.drop("resolved"), dictionary_only=True)
    assert forced.where("resolved").count() == 4


@pytest.mark.parametrize("budget, runs", [(8, [True, True, False]), (9, [True, True, True]), (0, [False] * 3)])
def test_budget(spark, budget, runs):
    costs = spark.createDataFrame([("0901", "P", i, 4) for i in range(3)], "hs_code string, product string, batch_no long, cost long")
    got = B.within_budget(costs, budget).orderBy("batch_no").collect()
    assert [r["runs"] for r in got] == runs
    resumed = B.within_budget(costs, 12, used=8).where("runs").count()
    assert resumed == 1


def test_batches_are_consecutive_in_sorted_order(spark):
    goods = spark.createDataFrame([("0901", "P", f"{i:02d}") for i in range(23)], "hs_code string, product string, goods_shipped string")
    table = B.batch_table(B.number_batches(goods.repartition(4))).orderBy("batch_no").collect()
    assert [(r["batch_size"], r["total_batches"]) for r in table] == [(10, 3), (10, 3), (3, 3)]
    assert table[2]["lines"] == "1. 20\n2. 21\n3. 22"


def test_label_replies(spark):
    goods = spark.createDataFrame([(f"g{i}", i) for i in range(9)], "goods_shipped string, first_ord long")
    batch = L.label_batches(goods, 2)
    answers = spark.createDataFrame(
        [
            (0, '{"classifications":["A","B","C"]}'),
            (1, '{"classifications":["A"]}'),
            (2, "oops"),
            (3, None),
        ],
        "batch_no long, reply string",
    )
    got = [r["category"] for r in L.read_label_replies(batch, answers).orderBy("goods_shipped").collect()]
    assert got == ["A", "B", "A", "", "Unclassified", "Unclassified", "Unclassified", "Unclassified", ""]
    strict = L.read_label_replies(batch, answers, ["A"]).orderBy("goods_shipped").first()
    assert strict["category"] == "A"
    assert L.read_label_replies(batch, answers, ["A"]).where("category = 'B'").count() == 0


def test_labels_reach_every_row(spark):
    rows = spark.createDataFrame([(i, f"g{i % 3}", "old") for i in range(9)], "ord long, goods_shipped string, category string")
    labels = spark.createDataFrame([("g0", "A"), ("g1", "B")], "goods_shipped string, category string")
    got = [r["category"] for r in L.propagate_labels(rows, labels).orderBy("ord").collect()]
    assert got == ["A", "B", ""] * 3


def test_scorer_fails_per_batch(spark):
    goods = spark.range(6).select(F.concat(F.lit("g"), F.col("id").cast("string")).alias("goods_shipped")).coalesce(1)

    def scorer(texts):
        if "g3" in texts:
            raise RuntimeError("down")
        return [t.upper() for t in texts][:2]

    failures = spark.sparkContext.accumulator(0)
    got = {r[0]: r[1] for r in L.label_by_scorer(goods, scorer, size=3, failures=failures).collect()}
    assert failures.value == sum(label == L.UNCLASSIFIED for label in got.values()) > 0
    assert got == {"g0": "G0", "g1": "G1", "g2": ""} | {f"g{i}": "Unclassified" for i in (3, 4, 5)}


def test_lexical_label(spark):
    definition = [("Tea", "green leaves"), ("Green Coffee", None), ("Other", "")]
    texts = ["green coffee beans", "GREEN", "tea", "steel"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(L.lexical_label("t", definition)).collect()]
    assert got == ["Green Coffee", "Tea", "Tea", "Unclassified"]


def test_requests_show_previews_and_definitions(spark):
    known = dictionary(spark, {"X": [f"v{i:02d}" for i in range(30)], "Y": ["One"]})
    meanings = spark.createDataFrame([("attr_X", "An X.")], "attr_key string, definition string")
    batch = items(spark, ["some text"], known)
    open_request = Q.attribute_requests(batch, known, meanings).first()
    assert "- X: An X.\n- Y: [Definition not available]" in open_request["prompt"]
    assert "v24 ...\n- Y: One" in open_request["prompt"] and "v25" not in open_request["prompt"]
    assert "1. some text" in open_request["prompt"] and "Batch 1/1" in open_request["prompt"]
    assert open_request["tokens"] == len(open_request["prompt"]) // 4
    properties = lambda r: json.loads(r["reply_schema"])["properties"]["items"]["items"]["properties"]["attributes"]["properties"]  # noqa: E731, E501
    assert properties(open_request) == {"X": {"type": "string"}, "Y": {"type": "string"}}
    closed = Q.attribute_requests(batch, known, open_list=False).first()
    assert properties(closed)["Y"]["enum"] == ["One", "None"]
    assert "Definition" not in closed["prompt"]


def test_guides_are_stored_once(spark):
    """Batch rows hold no guide; products with the same attributes share one; rendering gives the whole prompts."""
    known = dictionary(spark, {"X": [f"v{i:02d}" for i in range(30)], "Y": ["One"]})
    twin = known.withColumn("product", F.lit("Twin"))
    batch = items(spark, ["some text", "more of it"], known)
    both = batch.unionByName(batch.withColumn("product", F.lit("Twin")))
    asked, guides = Q.attribute_request_tables(both, known.unionByName(twin), preview=3)
    assert guides.count() == 1 and asked.select("guide_key").distinct().count() == 1
    stored = asked.drop("hs_code", "product").collect()
    assert not any("v00" in str(value) for row in stored for value in row)
    assert "v02 ..." in guides.first()["guide"] and "v03" not in guides.first()["guide"]
    whole = Q.rendered(asked, guides).collect()
    assert len(whole) == len(stored) == 2
    for row in whole:
        assert row["tokens"] == len(row["prompt"]) // 4 and "- X: v00, v01, v02 ..." in row["prompt"]
    empty = json.dumps({"item_preview": 30 * ".", "attributes": {a: {"value": ""} for a in "XY"}})
    assert all(len(empty) <= r["reply_chars"] <= len(empty) + 4 for r in stored)


def test_lenient_reading(spark):
    """Repeated keys, values that are no JSON numbers, exact number texts, lists, trailing text."""
    items = spark.createDataFrame(
        [("9011", "P", b, i, f"goods {i}") for b in range(4) for i in range(2)],
        "hs_code string, product string, batch_no long, pos long, goods_shipped string",
    )
    replies = spark.createDataFrame(
        [
            ("9011", "P", 0, '{"items":[{"attributes":{"X":"Blue","X":"Red","Y":85.0,"Z":1.5e3,"L":["a","b"]}},'
                             '{"attributes":{"X":NaN,"Y":null,"Z":{"value":"q","value":"r"}}}]}'),
            ("9011", "P", 1, 'Sure {"items":[{"attributes":{"X":"Red"}}]} or {"items":[]}'),
            ("9011", "P", 2, '{"items":[],"items":[{"attributes":{"X":"5"}},"skip"]}'),
            ("9011", "P", 3, '[{"items":[{"attributes":{"X":"Red"}}]}, 2]'),
        ],
        "hs_code string, product string, batch_no long, reply string",
    )
    known = [(i, a, [(0, "85.0", "85.0", None), (0, "Red", "red", None)]) for i, a in enumerate("XYZL")]
    kinds = "attrs array<struct<attr_ord:int,attr:string,values:array<struct<rank:int,value:string,lower:string,pattern:string>>>>"
    attrs = spark.createDataFrame([(known,)], kinds).first()["attrs"]
    aligned = R.align_replies(items, replies)
    listed = aligned.join(spark.createDataFrame([("P", attrs)], f"product string, {kinds}"), "product")
    got = {
        (r["batch_no"], r["pos"]): (r["status"], r["replied"] and {v["attr"]: (v["value"], v["custom"]) for v in r["replied"]})
        for r in R.normalise_replies(listed).collect()
    }
    assert got[0, 0] == (
        "answered", {"X": ("Red", False), "Y": ("85.0", False), "Z": ("1500.0", True), "L": ('["a","b"]', True)},
    )
    assert got[0, 1] == (
        "answered", {"X": ("NaN", True), "Y": ("None", False), "Z": ("r", True), "L": ("None", False)},
    )
    assert got[1, 0][0] == got[1, 1][0] == "unusable"
    assert got[2, 0] == ("answered", {"X": ("5", True), "Y": ("None", False), "Z": ("None", False), "L": ("None", False)})
    assert got[2, 1] == ("pending", None)
    assert got[3, 0][0] == "answered"
