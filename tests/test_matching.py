"""Dictionary matching: literal cases, brute force, and independence of the strategy."""

import random
import re

import pytest
from pyspark.sql import functions as F

from shiplabel.functions import text as X
from shiplabel.operators import matching as M
from shiplabel.operators.dictionary import attach_dictionary, compile_values, fits_broadcast
from shiplabel.plans.views import ATTR_DICT_SCHEMA

GOODS_SCHEMA = "hs_code string, product string, goods_shipped string"


def dictionary(spark, attributes, products=("P",)):
    return spark.createDataFrame(
        [
            ("0901", p, attr, i, value, j)
            for p in products
            for i, (attr, values) in enumerate(attributes.items())
            for j, value in enumerate(values or [None])
        ],
        ATTR_DICT_SCHEMA,
    )


def goods(spark, texts, product="P"):
    return spark.createDataFrame([("0901", product, t) for t in texts], GOODS_SCHEMA)


VALUE_CASES = [
    ("dark red ring", ["Red", "Dark Red"], "Dark Red"),
    ("widgets", ["Widget"], None),
    ("Ab ab", ["Ab"], None),
    ("coffee 500 gr/l", ["500 G/L"], "500 G/L"),
    ("coffee 500gl.", ["500 G/L"], "500 G/L"),
    ("coffee 1500 g/l", ["500 G/L"], None),
    ("coffee 500 grams / liter", ["500 G/L", "550 G/L"], "500 G/L"),
    ("CUP   SCORE 85+ lot", ["Cup Score 85+"], "Cup Score 85+"),
    ("cup score 85+a", ["Cup Score 85+"], None),
    ("cup score 85", ["Cup Score 85+"], None),
    ("+85 net", ["+85"], "+85"),
    ("x+85 net", ["+85"], None),
    ("x +85 net", ["+85"], "+85"),
    ("semi-washed", ["Semi-washed", "Washed"], "Semi-washed"),
    ("чай зелёный", ["чай"], "чай"),
    ("a.b*c\\Ed", ["b*c\\Ed"], "b*c\\Ed"),
    ("red blue", ["Tea", "Red", "Fox"], "Red"),
    ("fox red", ["Red", "Fox"], "Fox"),
    ("any g/l here", ["g/l"], None),
    ("any 7 g/l here", ["g/l"], "g/l"),
]


def by_case(spark, cases):
    """Each case becomes a product of its own, so that one job runs them all."""
    texts = [("0901", f"case {i}", c[0]) for i, c in enumerate(cases)]
    values = [
        ("0901", f"case {i}", "A", 0, v, j) for i, c in enumerate(cases) for j, v in enumerate(c[1])
    ]
    return spark.createDataFrame(texts, GOODS_SCHEMA), spark.createDataFrame(values, ATTR_DICT_SCHEMA)


def results(df, column):
    rows = df.select("product", column.alias("v")).collect()
    return [r["v"] for r in sorted(rows, key=lambda r: int(r["product"].split()[1]))]


@pytest.mark.parametrize("strategy", ["broadcast", "anchored"])
def test_values(spark, strategy):
    matched = M.match_goods(*by_case(spark, VALUE_CASES), strategy=strategy)
    assert results(matched, F.col("found")[0]["value"]) == [c[2] for c in VALUE_CASES]


NEGATION_CASES = [
    ("not red ring", None, "Red"),
    ("piano red", "Red", "Red"),
    ("w/o red", None, "Red"),
    ("free-from: red", None, "Red"),
    ("red, not red", "Red", "Red"),
    ("not very red", "Red", "Red"),
    ("no " + "." * 40 + " red", "Red", "Red"),
    ("without 500 g/l, red", "Red", "Red"),
]


@pytest.mark.parametrize("mode, expected", [("documented", 1), ("inert", 2)])
def test_negation(spark, mode, expected):
    cases = [(text, ["Red"]) for text, *_ in NEGATION_CASES]
    matched = M.match_goods(*by_case(spark, cases), negation=mode)
    assert results(matched, F.col("found")[0]["value"]) == [c[expected] for c in NEGATION_CASES]


def test_blocked_values_before_the_chosen_one_are_counted(spark):
    known = dictionary(spark, {"A": ["Dark Red", "Red", "Blue"], "B": ["500 G/L"]})
    matched = M.match_goods(goods(spark, ["not dark red, no blue, no 500 g/l", "plain"]), known)
    stats = M.coverage(matched).first()
    # tried by length: "Dark Red" and "Blue" are blocked, "Red" stands after "dark"
    states = {r["goods_shipped"]: r["found"] for r in matched.collect()}
    assert states["not dark red, no blue, no 500 g/l"] == [("A", "Red", 2), ("B", None, 1)]
    assert stats["negation_blocked"] == 3
    assert (stats["rows_with_any_match"], stats["rows_total"]) == (1, 2)
    assert stats["attribute_match_rate"] == 0.25


def test_unknown_products_vanish_and_empty_attributes_stay(spark):
    known = dictionary(spark, {"A": ["Red"], "Empty": []})
    both = goods(spark, ["red"]).unionByName(goods(spark, ["red"], "Unclassified"))
    rows = M.match_goods(both, known).select(M.full_map().alias("m")).collect()
    assert [r["m"] for r in rows] == [{"A": "Red", "Empty": "None"}]


def test_first_spelling_of_a_value_wins(spark):
    known = dictionary(spark, {"A": ["dark  red", "Dark Red", "DARK RED"]})
    used = compile_values(known).where("pattern IS NOT NULL").select("value").collect()
    assert [r[0] for r in used] == ["dark  red"]


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError, match="negation"):
        M.match_goods(goods(spark, ["red"]), dictionary(spark, {"A": ["Red"]}), negation="maybe")


def brute_force(text, values, min_len=3):
    """Longest value on ASCII run boundaries, by plain string search."""
    norm = " " + " ".join(text.lower().split()) + " "
    best = None
    for v in values:
        n = " ".join(v.lower().split())
        if len(v.strip()) < min_len:
            continue
        hit = any(
            not re.match("[a-z0-9]", norm[i - 1 : i]) and not re.match("[a-z0-9]", norm[i + len(n) : i + len(n) + 1])
            for i in range(len(norm))
            if norm.startswith(n, i)
        )
        if hit and (best is None or (-len(v), v) < (-len(best), best)):
            best = v
    return best


@pytest.mark.parametrize("strategy", ["broadcast", "anchored"])
def test_against_brute_force(spark, strategy):
    rng = random.Random(5)
    words = ["red", "dark", "tea", "t-a", "85+", "+x", "été", "ab", "grade", "aa/ab", "чай", "no.1", "(s)"]
    phrase = lambda n: rng.choice([" ", " ", ", ", "-", ""]).join(rng.choice(words) for _ in range(n))
    values = sorted({phrase(rng.randint(1, 3)) for _ in range(120)})
    seen, unique = set(), []
    for v in values:  # one spelling of each
        if " ".join(v.lower().split()) not in seen and not re.search("g/?l", v):
            seen.add(" ".join(v.lower().split()))
            unique.append(v)
    texts = sorted({phrase(rng.randint(2, 9)) for _ in range(300)})
    matched = M.match_goods(
        goods(spark, texts), dictionary(spark, {"A": unique}), negation="inert", strategy=strategy
    )
    got = {r[0]: r[1] for r in matched.select("goods_shipped", F.col("found")[0]["value"]).collect()}
    assert got == {t: brute_force(t, unique) for t in texts}


def test_match_rows_equals_match_goods_whatever_the_partitioning(spark):
    known = dictionary(spark, {"A": ["Red", "Blue"], "B": ["Ring"]})
    texts = ["red ring", "blue", "not red", "ring"] * 50
    rows = goods(spark, texts).withColumn("id", F.monotonically_increasing_id())
    shape = lambda df: sorted(
        (r["goods_shipped"], str(r["found"])) for r in df.select("goods_shipped", "found").collect()
    )
    once = shape(M.match_goods(rows, known))
    assert shape(M.match_rows(rows, known)) == once
    assert shape(M.match_rows(rows.repartition(7), known, strategy="anchored")) == once


def test_size_of_a_dictionary_decides_the_strategy(spark):
    small = dictionary(spark, {"A": ["Red"]})
    large = spark.range(2500).select(
        F.lit("0901").alias("hs_code"), F.lit("P").alias("product"), F.lit("A").alias("attr"),
        F.lit(0).alias("attr_ord"), F.concat(F.lit("value "), F.col("id").cast("string")).alias("value"),
        F.col("id").cast("int").alias("value_ord"),
    )
    assert fits_broadcast(small) and not fits_broadcast(large)
    matched = M.match_goods(goods(spark, ["a value 17 item", "value 170", "value x"]), large)
    got = {r[0]: r[1] for r in matched.select("goods_shipped", F.col("found")[0]["value"]).collect()}
    assert got == {"a value 17 item": "value 17", "value 170": "value 170", "value x": None}


HEURISTIC_CASES = [
    ("beans, washed", ["Washed"], "Washed"),
    ("beans 500 g/l", ["500 G/L"], None),
    ("semi-washed", ["Washed"], None),
    ("unwashed washed", ["Washed"], None),  # only the first occurrence counts
    ("ab", ["Ab"], "Ab"),
    ("dark  red", ["Dark Red"], None),  # blanks are not collapsed here
    ("red tea", ["Tea", "Red"], "Red"),
]


@pytest.mark.parametrize("strategy", ["broadcast", "anchored"])
def test_heuristic(spark, strategy):
    texts, known = by_case(spark, HEURISTIC_CASES)
    attached = attach_dictionary(texts, known, strategy=strategy)
    guess = M.heuristic_value(F.col("attrs")[0]["values"], X.soft_text("goods_shipped"))
    assert results(attached, guess) == [c[2] for c in HEURISTIC_CASES]


def test_anchors_of_values_that_share_words(spark):
    """Thousands of values begin with one word; a text that holds it meets only the values it can state."""
    from shiplabel.operators.dictionary import attach_dictionary

    known = spark.createDataFrame(
        [("0901", "P", "Kind", 0, f"model x{i}", i) for i in range(3000)],
        "hs_code string, product string, attr string, attr_ord int, value string, value_ord int",
    )
    goods = spark.createDataFrame([("0901", "P", f"new model x{i * 7} boxed") for i in range(50)], "hs_code string, product string, goods_shipped string")
    for replied in (None, F.array(F.lit("model x1"))):
        attached = attach_dictionary(goods, known, strategy="anchored", replied=replied)
        sizes = [r["n"] for r in attached.select(F.size(F.col("attrs")[0]["values"]).alias("n")).collect()]
        assert len(sizes) == 50 and max(sizes) <= 2
    found = M.match_goods(goods, known, strategy="anchored").select("goods_shipped", F.col("found")[0]["value"].alias("v"))
    assert all(r["v"] in r["goods_shipped"] for r in found.collect())


def test_only_verified_values_are_kept(spark):
    """Values that share words with a text, but are not stated in it, do not reach the row."""
    values = [f"ring {a} {b}" for a in ("red", "blue", "old") for b in range(100, 140)]
    texts = ["ring red 101", "red 101 ring", "old ring blue 139", "blue 120 ring red 120"]
    attached = attach_dictionary(
        goods(spark, texts), dictionary(spark, {"A": values}), strategy="anchored", heuristic=False
    )
    kept = {r["goods_shipped"]: [v["value"] for v in r["attrs"][0]["values"]] for r in attached.collect()}
    assert kept == {t: [v for v in values if v in t] for t in texts}


@pytest.mark.parametrize("mode", ["documented", "inert"])
def test_strategies_agree_on_refused_values_and_common_words(spark, monkeypatch, mode):
    """A word that most texts hold is dealt to several tasks; counts of refused values stay the same."""
    from shiplabel.operators import scale

    monkeypatch.setattr(scale.skew_join, "__defaults__", (*scale.skew_join.__defaults__[:-1], 20))
    rng = random.Random(9)
    words = ["no", "without", "red", "dark red", "ring", "old ring", "500 g/l", "non", "tea"]
    texts = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 7))) for _ in range(400)})
    known = dictionary(spark, {"A": ["Red", "Dark Red"], "B": ["Ring", "Old Ring", "Red Ring"], "C": ["500 G/L", "Tea"], "D": None})
    both = [
        {r["goods_shipped"]: r["found"] for r in M.match_goods(goods(spark, texts), known, negation=mode, strategy=s).collect()}
        for s in ("broadcast", "anchored")
    ]
    assert both[0] == both[1] and len(both[0]) == len(texts)
    assert mode == "inert" or any(f["blocked"] for found in both[1].values() for f in found)


def test_values_are_moved_without_patterns(spark):
    """A value travels as itself with one anchor, its rarest run; of several spellings the first one is stated."""
    from shiplabel.operators.dictionary import match_anchors

    listed = [("9011", "P", "Lot", 0, f"Lot {i} {i % 3}", i) for i in range(400)]
    listed += [("9011", "P", "Color", 1, v, i) for i, v in enumerate(["dark-red", "Dark Red", "DARK-RED", "x"])]
    known = spark.createDataFrame(listed, "hs_code string, product string, attr string, attr_ord int, value string, value_ord int")
    anchors = match_anchors(known, 3)
    assert anchors.columns == ["hs_code", "product", "attr", "value_ord", "value", "anchor"]
    of_lots = anchors.where("attr = 'Lot'").collect()
    # "lot" is common; a number that is longer than the line number is not
    assert len(of_lots) == 400 and all(r["anchor"] != "t:lot" for r in of_lots)
    assert all(r["anchor"] == f"t:{r['value_ord']}" for r in of_lots if r["value_ord"] >= 10)
    texts = [("9011", "P", t) for t in ("a dark-red lot 7 1", "not DARK RED, lot 399 0", "lot 12", "lot 3 0 and lot 30 0")]
    goods = spark.createDataFrame(texts, "hs_code string, product string, goods_shipped string")
    found = lambda how: {
        r["goods_shipped"]: sorted((f["attr"], f["value"], f["blocked"]) for f in r["found"])
        for r in M.match_goods(goods, known, strategy=how).collect()
    }
    assert found("anchored") == found("broadcast")
    assert found("anchored")["a dark-red lot 7 1"] == [("Color", "dark-red", 0), ("Lot", "Lot 7 1", 0)]


@pytest.mark.parametrize("buckets", [1, 8192])
def test_rare_words_keep_their_own_number_beside_common_ones(spark, monkeypatch, buckets):
    """A rare word whose hash falls in the bucket of a common one stays the anchor: few texts meet its value."""
    from shiplabel.operators import dictionary as D

    monkeypatch.setattr(D, "HEAT_BUCKETS", buckets)
    listed = [("9011", "P", "Lot", 0, f"lot k{i} position{i % 3}", i) for i in range(600)]
    known = spark.createDataFrame(listed, "hs_code string, product string, attr string, attr_ord int, value string, value_ord int")
    assert all(r["anchor"] == f"t:k{r['value_ord']}" for r in D.match_anchors(known, 3).collect())
    texts = spark.createDataFrame([("9011", "P", f"tea lot k{i} position{i % 3}") for i in range(0, 900, 3)], GOODS_SCHEMA)
    keyed = D.with_text_id(texts)
    pairs = D.anchored_pairs(keyed, D.text_anchors(F.col("goods_shipped"), 3, heuristic=False), D.match_anchors(known, 3))
    assert pairs.count() == 200
    compiled = compile_values(known)
    by_rule = D.anchored_pairs(keyed, D.text_anchors(F.col("goods_shipped"), 3), D.value_anchors(compiled, 3))
    assert by_rule.count() == 400  # by its run and, for the substring rule, by its word
    found = M.match_goods(texts, known, strategy="anchored").select("goods_shipped", F.col("found")[0]["value"].alias("v"))
    assert sorted(r["v"] for r in found.collect() if r["v"]) == sorted(f"lot k{i} position{i % 3}" for i in range(0, 600, 3))
