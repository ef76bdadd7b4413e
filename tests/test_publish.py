"""Published tables, files and their way back."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shiplabel.functions import text as X
from shiplabel.operators import publish as P
from shiplabel.plans.views import ATTR_DICT_SCHEMA
from shiplabel.sources import config as C
from shiplabel.sources import published
from shiplabel.sources import shipments as S

WIDE = "file string, ord long, shipment_id string, product string, attr_OriginCountry string, `attr_Origin-Country` string, attr_X string"


@pytest.fixture(scope="module")
def wide(spark):
    return spark.createDataFrame(
        [
            ("a.csv", 1, "s1", "P", "Peru", None, "1"),
            ("a.csv", 2, "s1", "P", "None", "Chad", "n/a"),
            ("b.csv", 1, "s1", "Q", None, "peru", "2"),
            ("b.csv", 2, "s1", " ", None, "Peru", "none"),
            ("b.csv", 3, " ", "Q", "x", "x", "x"),
            ("c.csv", 1, "s2", "R", None, None, "None"),
        ],
        WIDE,
    )


def test_schema_master(spark, wide):
    rows = P.schema_master(wide).orderBy("file").collect()
    got = {r["file"]: (r["product"], json.loads(r["schema_json"])) for r in rows}
    # of the two columns with one snake-case name the later counts
    assert got == {
        "a.csv": ("a", {"origin_country": ["Chad"], "x": ["1"]}),
        "b.csv": ("b", {"origin_country": ["peru", "x"], "x": ["2", "x"]}),
        # a column without any cell is none of the file's
        "c.csv": ("c", {"x": []}),
    }


def test_schema_master_in_parts(spark):
    rows = spark.range(25).select(
        F.lit("a.csv").alias("file"), F.col("id").alias("ord"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("attr_A"),
        F.lit("one").alias("attr_B"),
    )
    parts = P.schema_master(rows, part_size=10).orderBy("part").collect()
    schemas = [json.loads(r["schema_json"]) for r in parts]
    assert [len(s["a"]) for s in schemas] == [10, 10, 5]
    assert sum((s["a"] for s in schemas), []) == [f"v{i}" for i in range(25)]
    assert [s.get("b") for s in schemas] == [["one"], None, None]


def test_equal_rows_are_one_before_cells_are_unfolded(spark):
    rows = spark.range(1000).select(
        F.lit("a.csv").alias("file"), (1000 - F.col("id")).alias("ord"), F.concat(F.lit("v"), F.col("id") % 3).alias("attr_A"),
        F.concat(F.lit("W"), F.col("id") % 2).alias("attr_B"),
    )
    found = P.observed_values(rows)
    firsts = {(r["attr"], r["value"]): r["first_ord"] for r in found.collect()}
    assert firsts == {("a", "v0"): 1, ("a", "v2"): 2, ("a", "v1"): 3, ("b", "W1"): 1, ("b", "W0"): 2, ("", ""): 1}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("Generate") :]


def test_shipment_map_last_write_wins(spark, wide):
    got = {r["shipment_id"]: (r["product"], r["attrs"]) for r in P.shipment_attributes(wide).collect()}
    assert got == {
        "s1": ("Q", {"origin_country": "Peru", "x": "2"}),
        "s2": ("R", {}),
    }
    # "n/a" is a value here, so without the second file it stands
    first_file = P.shipment_attributes(wide.where("file = 'a.csv'")).first()
    assert first_file["attrs"] == {"origin_country": "Chad", "x": "n/a"}


@pytest.fixture(scope="module")
def classified(spark):
    return spark.createDataFrame(
        [
            ("0901", "Tea/Green", "a", {"X": "1", "Y": "None"}, ["X"], []),
            ("0901", "Tea/Green", "b", {"X": "None", "Y": "2"}, [], ["Y"]),
            ("0901", "Mate", "a", {"X": "3"}, [], []),
        ],
        "hs_code string, product string, goods_shipped string, attributes map<string,string>, custom_attributes array<string>, heuristic_filled array<string>",
    )


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [("0901", "Tea/Green", "a", s, i) for i, s in enumerate(["s2", "s1", "s2"])]
    return spark.createDataFrame(
        rows + [("0901", "Mate", "a", "s1", 9)],
        "hs_code string, product string, goods_shipped string, shipment_id string, ord long",
    )


KNOWN = [("0901", "Tea/Green", "X", 0, "1", 0), ("0901", "Tea/Green", "Y", 1, "2", 0), ("0901", "Mate", "X", 0, "3", 0)]


def test_flat_rows(spark, classified, pairs):
    known = spark.createDataFrame(KNOWN, ATTR_DICT_SCHEMA)
    assert P.attribute_names(known) == ["X", "Y"]
    flat = P.per_product(P.with_shipments(classified, pairs), ["X", "Y"], flags=True)
    columns = ["product", "goods_shipped", "shipment_id", "attr_X", "attr_X_is_custom", "attr_Y", "attr_Y_is_custom"]
    got = sorted(map(tuple, flat.select(*columns).collect()), key=str)
    tea = ("Tea/Green", "a")
    assert got == sorted(
        [
            ("Mate", "a", "s1", "3", 0, None, None),
            (*tea, "s1", "1", 1, "None", 0),
            (*tea, "s2", "1", 1, "None", 0),
            (*tea, "s2", "1", 1, "None", 0),
            ("Tea/Green", "b", "", "None", 0, "2", 0),
        ],
        key=str,
    )
    assert {r["file"] for r in flat.collect()} == {"hs_0901_Mate.csv", "hs_0901_Tea_Green.csv"}


def test_lists_and_nested_records(spark, classified, pairs):
    lists = P.goods_to_shipments(pairs, part_size=2)
    got = {(r["product"], r["part"]): r["shipment_ids"] for r in lists.collect()}
    assert got == {("Tea/Green", 0): ["s2", "s1"], ("Tea/Green", 1): ["s2"], ("Mate", 0): ["s1"]}
    records = P.nested_records(classified, lists).orderBy("key", "goods_shipped", "part").collect()
    assert [(r["key"], r["part"]) for r in records] == [
        ("0901::Mate", 0), ("0901::Tea/Green", 0), ("0901::Tea/Green", 1), ("0901::Tea/Green", 0),
    ]
    assert json.loads(records[1]["record"]) == {
        "goods_shipped": "a", "attributes": {"X": "1", "Y": "None"}, "custom_attributes": ["X"], "shipment_ids": ["s2", "s1"],
    }
    assert json.loads(records[3]["record"])["shipment_ids"] == []
    done = {r["key"]: r["completed"] for r in P.completed_products(classified).collect()}
    assert done == {"0901::Mate": 1, "0901::Tea/Green": 2}


def test_blank_shipments_and_goods(spark):
    rows = spark.createDataFrame(
        [("0901", "P", "a", None), ("0901", "P", "a", "  "), ("0901", "P", "  ", "s"), ("0901", "P", "b", "s")],
        "hs_code string, product string, goods_shipped string, shipment_id string",
    )
    got = sorted((r["goods_shipped"], r["shipment_id"]) for r in P.goods_shipments(rows).collect())
    assert got == [("a", ""), ("a", ""), ("b", "s")]


def test_per_product_files_and_back(spark, classified, pairs, tmp_path):
    known = spark.createDataFrame(KNOWN, ATTR_DICT_SCHEMA)
    flat = P.flat_attributes(P.with_shipments(classified, pairs), ["X", "Y"])
    folder = f"{tmp_path}/per product"
    files = P.export_per_product(flat, known, folder)
    assert files == ["hs_0901_Mate.csv", "hs_0901_Tea_Green.csv"]
    back = published.read_folder(spark, folder)
    assert sorted(back.columns) == sorted(["hs_code", "product", "shipment_id", "goods_shipped", "attr_X", "attr_Y", "file", "ord"])
    assert {(r["file"], r["product"], r["hs_code"]) for r in back.collect()} == {
        ("hs_0901_Mate.csv", "Mate", "0901"), ("hs_0901_Tea_Green.csv", "Tea/Green", "0901"),
    }
    summary = P.schema_master(published.for_schema_master(back)).orderBy("file").collect()
    assert [r["product"] for r in summary] == ["Mate", "Tea Green"]
    assert json.loads(summary[0]["schema_json"]) == {"x": ["3"]}  # only the file's own columns
    assert json.loads(summary[1]["schema_json"]) == {"x": ["1"], "y": ["2"]}
    merged = P.shipment_attributes(published.for_shipment_map(back))
    P.write_shipment_map(merged, f"{tmp_path}/map.json")
    lines = {r["shipment_id"]: r["attrs"].asDict() for r in spark.read.json(f"{tmp_path}/map.json").collect()}
    assert lines["s1"] == {"x": "1"}  # the tea file comes after the mate file
    P.write_shipment_map(merged, f"{tmp_path}/map")
    ids = [r[0] for r in spark.read.option("header", True).csv(f"{tmp_path}/map").collect()]
    assert ids == ["s1", "s2"]
    with pytest.raises(FileNotFoundError):
        published.read_folder(spark, folder, skip=files)
    only = published.read_folder(spark, folder, skip=files[:1])
    assert {r["file"] for r in only.collect()} == set(files[1:])


def test_plain_files_keep_row_order(spark, tmp_path):
    (tmp_path / "hs_1_A.csv").write_text('shipment_id,attr_X\ns,"1\n2"\ns,3\n')
    (tmp_path / "hs_1_B.csv").write_text("attr_Y,shipment_id\n5,s\n,s\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.csv").write_text("shipment_id,attr_Z\ns,9\n")
    back = published.read_folder(spark, str(tmp_path))
    assert P.shipment_attributes(back).first()["attrs"] == {"x": "3", "y": "5"}
    (tmp_path / "hs_1_Empty.csv").write_text("")
    (tmp_path / "hs_1_NA.csv").write_text("attr_X,attr_Y\nNA,\n")
    master = {r["product"]: json.loads(r["schema_json"]) for r in published.folder_schema_master(spark, str(tmp_path)).collect()}
    assert master == {
        "A": {"x": ["1\n2", "3"]}, "B": {"y": ["5"]}, "NA": {"x": [], "y": []},
        "Empty": {"__error__": ["No columns to parse from file"]},
    }
    with pytest.raises(ValueError, match="missing required"):
        published.for_shipment_map(back.drop("shipment_id"))


# Beyond 32 files Spark lists them in a job of its own.
@pytest.mark.parametrize("n", [40, 120])
def test_a_folder_is_read_in_the_same_number_of_jobs(spark, tmp_path, n):
    for i in range(n):
        (tmp_path / f"hs_1_P{i:03}.csv").write_text(f'shipment_id,attr_A{i},attr_A{i},,x y\ns{i}," v,{i}",w\n\ns,"a ""b""",c,d,e,f\n')
    spark.sparkContext.setJobGroup(f"folder-{n}", "")
    rows = published.read_folder(spark, str(tmp_path)).collect()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"folder-{n}"))
    spark.sparkContext.setJobGroup("", "")
    JOBS.setdefault("folder", jobs)
    assert jobs == JOBS["folder"]
    assert len(rows) == 2 * n
    one = sorted((r for r in rows if r["file"] == "hs_1_P001.csv"), key=lambda r: r["ord"])
    assert [(r["shipment_id"], r["attr_A11"], r["attr_A12"], r["_c3"], r["x y"], r["attr_A21"]) for r in one] == [
        ("s1", " v,1", "w", "", "", None), ("s", 'a "b"', "c", "d", "e", None),
    ]


JOBS: dict = {}


def test_products_with_the_same_columns_are_written_together(spark, tmp_path, monkeypatch):
    known = spark.createDataFrame([("0901", f"P{i}", "X" if i % 2 else "Y", 0, "1", 0) for i in range(12)], ATTR_DICT_SCHEMA)
    flat = spark.createDataFrame(
        [("0901", f"P{i % 11}", f"s{i}", " outer blanks ", f"{i:03}", "1", "2") for i in range(200)],
        "hs_code string, product string, shipment_id string, goods_shipped string, ord string, attr_X string, attr_Y string",
    )
    writes = []
    plain = P.write_table
    monkeypatch.setattr(P, "write_table", lambda df, path, *a, **k: (writes.append(path), plain(df, path, *a, **k)))
    files = P.export_per_product(flat, known, str(tmp_path))
    assert files == sorted(f"hs_0901_P{i}.csv" for i in range(12))
    assert len(writes) == 3  # two lists of columns, and the product without rows
    back = published.read_folder(spark, str(tmp_path))
    assert back.count() == 200
    mine = [(r["shipment_id"], r["goods_shipped"], r["attr_X"]) for r in back.where("file = 'hs_0901_P3.csv'").orderBy("ord").collect()]
    assert mine == [(f"s{i}", " outer blanks ", "1") for i in range(200) if i % 11 == 3]


def test_merge_shipments(spark):
    cols = "hs_code string, product string, goods_shipped string, shipment_id string"
    row = lambda g, s: ("0901", "P", g, s)
    stored = spark.createDataFrame([row("a", "1"), row("a", "1"), row("b", "2")], cols)
    new = spark.createDataFrame([row("a", "1"), row("a", "3"), row("a", "3"), row("c", "4"), row("c", "4")], cols)
    got = sorted((r["goods_shipped"], r["shipment_id"]) for r in P.merge_shipments(stored, new).collect())
    assert got == [("a", "1"), ("a", "1"), ("a", "3"), ("b", "2"), ("c", "4"), ("c", "4")]
    assert [r["goods_shipped"] for r in P.pending_goods(new, stored).collect()] == ["c"]


# --- sources -----------------------------------------------------------------


def test_new_shipments_by_known_counts(spark, monkeypatch):
    from shiplabel.operators import scale

    schema = "hs_code string, product string, goods_shipped string, shipment_id string, ord long"
    goods = ("9011", "P", "red ring")
    stored = spark.createDataFrame([(*goods, "1", 0), (*goods, "2", 1)], schema)
    rows = [(*goods, str(i % 50), i) for i in range(300)] + [("9011", "P", "rod", "7", 400), ("9011", "P", "rod", "7", 401)]
    arrived = spark.createDataFrame(rows, schema)
    counts = arrived.groupBy("hs_code", "product", "goods_shipped").agg(F.count("*").alias("_rows"))
    want = sorted([(*goods, str(i), i) for i in range(50) if i not in (1, 2)] + [("9011", "P", "rod", "7", 400), ("9011", "P", "rod", "7", 401)])
    monkeypatch.setattr(scale, "hot_keys", lambda counts, on, floor: [(r[0], 4) for r in counts.select(F.xxhash64(*on)).collect()])
    for known in (None, counts):
        got = P.new_shipments(stored, arrived, "ord", known)
        assert sorted(tuple(r) for r in got.select(*arrived.columns).collect()) == want


def test_csv_keeps_codes_and_nulls(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(
        'hs_code,goods_shipped,shipment_id,note\n090111," Tea, ""green""\nleaf ",1,NA\n9011,None,2,x\n904,   ,3,\n'
    )
    raw = S.read_csv(spark, str(path))
    seen = Observation("load")
    rows = S.clean(raw, seen).collect()
    assert [(r["hs_code"], r["goods_shipped"], r["note"]) for r in rows] == [("090111", 'Tea, "green"\nleaf', None)]
    assert seen.get == {"rows_in": 3, "rows_removed": 2}
    with pytest.raises(ValueError, match="shipment_id"):
        S.clean(raw.drop("shipment_id"))


def test_validation(spark):
    cols = "hs_code string, goods_shipped string, shipment_id string"
    good = spark.createDataFrame([("1", "a", "x"), ("1", "b", "")], cols)
    assert S.validate(good)["goods"] == 2
    with pytest.raises(ValueError, match="shipment_id"):
        S.validate(spark.createDataFrame([("1", "a", "")], cols))


def test_filters_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([("9011", "a", "1")], "hs_code string, goods_shipped string, shipment_id string").write.parquet(f"{tmp_path}/t")
    loaded = S.load_table(spark.read.parquet(f"{tmp_path}/t"), {"hs_code": "9011"})
    plan = loaded.select("goods_shipped")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(hs_code,9011)" in plan and "shipment_id" not in plan.split("ReadSchema")[1]


def test_heading_rules(spark):
    rows = spark.createDataFrame([("0901.11", "a", "c", "1"), ("090111", " ", "c", "2")], "hs_code string, goods_shipped string, category string, shipment_id string")
    codes = lambda **o: [r["hs_code"] for r in S.classified_input(rows, **o).collect()]
    assert codes() == ["0901", "0901"]
    assert codes(hs_rule="trunc", numeric_hs=True) == ["901.", "9011"]
    with pytest.raises(ValueError, match="rule"):
        codes(hs_rule="other")


def documents(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "json string")


def test_product_definition(spark):
    doc = {"hs_code": " 9011 ", "product_categories": [" A ", "", "B"], "category_descriptions": {" A": " x "}, "_n": {"k": 1}}
    rows = C.product_definitions(documents(spark, json.dumps(doc))).collect()
    assert [tuple(r) for r in rows] == [("9011", 0, "A", "x"), ("9011", 1, "B", None)]
    assert [tuple(r) for r in C.product_metadata(documents(spark, json.dumps(doc))).collect()] == [("9011", "_n", '{"k":1}')]


def test_attribute_schema(spark):
    doc = {
        "9011": {
            "products": {
                "P": {"attributes": {"Z": ["b", " a ", "", 5], "Bad": "x", "A": []}},
                "Q": {"attributes": {"Bad": 1}},
                "R": "text",
            },
            "_note": "n",
        },
        "_comment": "c",
        "_list": [1],
    }
    docs = documents(spark, json.dumps(doc))
    rows = C.attribute_dictionary(docs).collect()
    assert [tuple(r)[1:] for r in rows] == [
        ("P", "Z", 0, "b", 0), ("P", "Z", 0, "a", 1), ("P", "Z", 0, "5", 2), ("P", "A", 1, None, None),
    ]
    version = C.dictionary_versions(docs).first()
    assert version["version"].endswith("Z") and version["metadata"] == {"_note": "n"}


def test_attribute_definitions(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text('{"attr_X": "An X.", "_note": "n"}')
    assert [tuple(r) for r in C.read_attribute_definitions(spark, str(path)).collect()] == [("attr_X", "An X.")]
    path.write_text("{broken")
    assert C.read_attribute_definitions(spark, str(path)).collect() == []
    assert C.read_attribute_definitions(spark, str(tmp_path / "none.json")).collect() == []


def test_raw_values_are_published_on_demand(spark):
    """Numbers, truth values and objects keep their form; a text that is no JSON value stays one; settled rows have none."""
    raw = {"X": '"Red"', "N": "85.5", "T": "true", "O": '{"value":"q"}', "W": "no json", "E": None}
    classified = spark.createDataFrame(
        [("0901", "Tea", "a", {"X": "Red"}, ["X"], [], raw), ("0901", "Tea", "b", {"X": "Red"}, [], [], None)],
        "hs_code string, product string, goods_shipped string, attributes map<string,string>, "
        "custom_attributes array<string>, heuristic_filled array<string>, raw_attributes map<string,string>",
    )
    pairs = spark.createDataFrame(
        [("0901", "Tea", "a", 0, ["s1"])],
        "hs_code string, product string, goods_shipped string, part long, shipment_ids array<string>",
    )
    read = lambda **o: {
        r["goods_shipped"]: json.loads(r["record"]) for r in P.nested_records(classified, pairs, **o).collect()
    }
    whole = read(raw=True)
    spelled = whole["a"].pop("raw_attributes")
    assert (spelled["X"], spelled["N"], spelled["T"], spelled["O"]) == ("Red", 85.5, True, {"value": "q"})
    assert spelled["W"] == "no json" and spelled.get("E") is None
    assert "raw_attributes" not in whole["b"] and whole == read()
    assert whole["a"]["custom_attributes"] == ["X"] and whole["a"]["shipment_ids"] == ["s1"]


def test_products_that_begin_alike_keep_their_files(spark):
    long = "x" * 120
    names = [long, long + "a", long + "b", "y" * 119 + "  z", "  ", "Tea/Green"]
    rows = spark.createDataFrame([("0901", n) for n in names], "hs string, product string")
    files = [r[0] for r in rows.select(X.product_file("hs", "product")).collect()]
    assert len(set(files)) == len(names)
    assert files[0] == f"hs_0901_{long}.csv" and files[4:] == ["hs_0901_product.csv", "hs_0901_Tea_Green.csv"]
    assert all(len(f) <= len("hs_0901_.csv") + 120 for f in files)
    again = [r[0] for r in rows.select(X.product_file("hs", "product")).collect()]
    assert again == files


def test_files_of_a_product_are_bounded(spark, tmp_path, monkeypatch):
    """A file is read by one task, so a large product has several; together they are what one file was."""
    rows = [("9011", "P", str(i), f"g{i:03d}", f"{i:03d}", {"Color": ["red", "Blue", "RED"][i % 3]}) for i in range(100)]
    kind = "hs_code string, product string, shipment_id string, goods_shipped string, ord string, attributes map<string,string>"
    known = spark.createDataFrame([("9011", "P", "Color", 0, "red", 0)], ATTR_DICT_SCHEMA)
    flat = P.per_product(spark.createDataFrame(rows, kind), ["Color"])
    summaries = {}
    for most in (1000, 9):
        monkeypatch.setattr(P, "FILE_ROWS", most)
        (name,) = P.export_per_product(flat, known, f"{tmp_path}/{most}")
        sizes = [f.read_text().count("\n") - 1 for f in (tmp_path / str(most) / name).glob("part-*")]
        assert sum(sizes) == 100 and max(sizes) <= most
        summaries[most] = [tuple(r) for r in published.folder_schema_master(spark, f"{tmp_path}/{most}").collect()]
        # rows in order, file after file
        got = published.read_folder(spark, f"{tmp_path}/{most}").orderBy("ord").collect()
        assert [r["goods_shipped"] for r in got] == [f"g{i:03d}" for i in range(100)]
    assert summaries[9] == summaries[1000]
