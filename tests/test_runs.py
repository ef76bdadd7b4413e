"""Whole runs: two deliveries equal one, inferred configurations, streams."""

import json

import pytest
from pyspark.sql import functions as F

from shiplabel.operators import publish as P
from shiplabel.plans import runs
from shiplabel.plans import views as V
from shiplabel.sources import shipments as S
from shiplabel.sources.shipments import clean as S_clean
from shiplabel.streaming import incremental

SF = "/root/testdata/sf0.001"
KEY = ["hs_code", "product", "goods_shipped"]


def options(**o):
    return runs.Options(dictionary_only=True, **o)


def content(df, columns):
    texts = [F.to_json(c).alias(c) if c == "attributes" else F.col(c) for c in columns]
    return sorted(map(str, df.select(*texts).collect()))


FLAT = [*KEY, "shipment_id", "attr_Color", "attr_Item", "attr_Density"]


def test_two_deliveries_equal_one(spark, tmp_path):
    raw = V.shipments(spark, SF)
    known = V.attr_dict(spark)
    halves = [raw.where(F.substring("ord", 1, 10) < "0000000700"), raw.where(F.substring("ord", 1, 10) >= "0000000700")]
    for i, half in enumerate(halves):
        both = runs.run(
            spark, half, f"{tmp_path}/two", run_id=str(i), attr_dict=known, definition=V.DEFINITION, options=options()
        )
    once = runs.run(
        spark, raw, f"{tmp_path}/one", run_id="0", attr_dict=known, definition=V.DEFINITION, options=options()
    )
    # a description known from the first delivery gains each unseen shipment once
    assert content(both["flat"].distinct(), FLAT) == content(once["flat"].distinct(), FLAT)
    assert values(both["schema_master"]) == values(once["schema_master"])
    assert both["shipment_attributes"].count() == once["shipment_attributes"].count() > 1000
    # repeating the last run changes nothing
    before = content(both["flat"], FLAT)
    again = runs.run(
        spark, halves[1], f"{tmp_path}/two", run_id="1", attr_dict=known, definition=V.DEFINITION, options=options()
    )
    assert content(again["flat"], FLAT) == before
    assert once["flat"].count() == spark.read.parquet(f"{tmp_path}/one/goods_shipments").count()


def values(master):
    """The values of each file and attribute; their order tells which run met them first."""
    return {
        r["file"]: {k: sorted(v) for k, v in json.loads(r["schema_json"]).items()} for r in master.collect()
    }


def test_order_of_rows_and_runs(spark, tmp_path):
    """Shipments are listed as they were read; of two runs the later one has the last word."""
    known = spark.createDataFrame(
        [("9011", "ECONOMY", "Color", 0, "Red", 0), ("9011", "ECONOMY", "Color", 0, "Blue", 1)], V.ATTR_DICT_SCHEMA
    )

    def deliver(number, rows):
        raw = spark.createDataFrame(rows, "ord long, hs_code string, goods_shipped string, shipment_id string")
        return runs.run(
            spark, raw, f"{tmp_path}/out", run_id=f"r{number}", attr_dict=known,
            definition=[("ECONOMY", "red blue z a")], options=options(),
        )

    def lists(tables):
        found = [json.loads(r["record"]) for r in tables["nested"].collect()]
        return {f["goods_shipped"]: f["shipment_ids"] for f in found}

    def colours(tables):
        return {r["shipment_id"]: r["attrs"]["color"] for r in tables["shipment_attributes"].collect()}

    first = deliver(9, [(0, "9011", "red z", "9"), (1, "9011", "red z", "10"), (2, "9011", "red z", "2")])
    assert lists(first) == {"red z": ["9", "10", "2"]} and set(colours(first).values()) == {"Red"}
    # r10 comes after r9, though its name sorts before
    both = deliver(10, [(0, "9011", "blue a", "10"), (1, "9011", "red z", "1"), (2, "9011", "red z", "9")])
    assert lists(both) == {"red z": ["9", "10", "2", "1"], "blue a": ["10"]}
    assert colours(both) == {"9": "Red", "10": "Blue", "2": "Red", "1": "Red"}


def test_scorer_sees_each_description_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def scorer(goods):
        seen.add(len(goods))
        return ["ECONOMY"] * len(goods)

    raw = V.shipments(spark, SF)
    runs.run(
        spark, raw, f"{tmp_path}/out", run_id="0", attr_dict=V.attr_dict(spark), definition=V.DEFINITION, scorer=scorer,
        options=options(stages=("load", "label")),
    )
    distinct = spark.read.parquet(f"{tmp_path}/out/shipments").where("trim(goods_shipped) <> ''").select("goods_shipped").distinct()
    assert seen.value == distinct.count()


def answer_everything(asked):
    """A stand-in for a model: the same values for every item of a batch."""
    item = F.lit('{"attributes":{"Color":{"value":"Red"},"Size":{"custom":"Tiny"}}}')
    listed = F.array_join(F.array_repeat(item, F.col("batch_size").cast("int")), ",")
    return asked.select(
        "hs_code", "product", "batch_no", F.concat(F.lit('{"items":['), listed, F.lit("]}")).alias("reply")
    )


def test_run_with_answers(spark, tmp_path):
    done = runs.run(
        spark, V.shipments(spark, SF).drop("ord"), str(tmp_path), run_id="a", attr_dict=V.attr_dict(spark),
        attr_defs=V.definitions(spark), definition=V.DEFINITION, answer=answer_everything,
        scorer=lambda texts: ["SMALL" if "s" in t else "LARGE" for t in texts],
        options=runs.Options(custom_flags=True),
    )
    flat = done["flat"]
    assert {r[0] for r in flat.select("product").distinct().collect()} == {"SMALL"}  # LARGE has no dictionary
    blue = flat.where("goods_shipped LIKE '%blue%' AND goods_shipped NOT LIKE 'not %'")
    assert {r[0] for r in blue.select("attr_Color").distinct().collect()} == {"Blue"}
    tiny = flat.where("attr_Size = 'Tiny'")
    assert tiny.count() and tiny.where("attr_Size_is_custom = 0").count() == 0
    assert flat.where("attr_Density IS NOT NULL").count() == 0  # SMALL lacks the attribute
    meta, stats = done["metadata"].first(), done["validation"].first()
    assert meta["token_usage"] > 0 and meta["products_processed"] == 3
    assert stats["out_of_schema"] > 0 and stats["invalid"] == 0
    assert done["nested"].count() == spark.read.parquet(f"{tmp_path}/classified").count()
    # the budget is used up: a second run asks nothing and adds nothing
    more = runs.run(
        spark, V.shipments(spark, SF), str(tmp_path), run_id="b", attr_dict=V.attr_dict(spark),
        definition=V.DEFINITION, answer=answer_everything, scorer=lambda texts: ["PROMO"] * len(texts),
        options=runs.Options(token_budget=meta["token_usage"], stages=("extract", "publish")),
    )
    assert more["metadata"].first()["token_usage"] == meta["token_usage"]


def test_options_of_requests_and_records(spark, tmp_path):
    """Stored requests name their guide; shipments are listed once and raw values published on demand; replies count."""
    known = spark.createDataFrame(
        [("9011", "ECONOMY", "Color", 0, v, i) for i, v in enumerate(["Red", "Blue", "Green"])], V.ATTR_DICT_SCHEMA
    )
    raw = spark.createDataFrame(
        [(i, "9011", f"economy box {i % 2}", f"s{i % 3}") for i in range(12)],
        "ord long, hs_code string, goods_shipped string, shipment_id string",
    )
    item = '{"attributes":{"Color":{"custom":"Teal"}}}'

    def answer(asked):
        assert {"prompt", "reply_schema", "tokens"} <= set(asked.columns) and "guide_key" not in asked.columns
        assert "- Color: Red, Blue ..." in asked.first()["prompt"]
        return asked.select("hs_code", "product", "batch_no", F.lit('{"items":[' + item + "," + item + "]}").alias("reply"))

    chosen = runs.Options(preview=2, dedup_shipments=True, raw_values=True)
    tables = runs.run(
        spark, raw, f"{tmp_path}/out", run_id="r", attr_dict=known, definition=[("ECONOMY", "box")], answer=answer, options=chosen
    )
    stored = spark.read.parquet(f"{tmp_path}/out/requests/run=id-r")
    assert "prompt" not in stored.columns and spark.read.parquet(f"{tmp_path}/out/guides/run=id-r").count() == 1
    row = stored.first()
    assert row["cost"] == row["tokens"] + -(-2 * row["reply_chars"] // 4)
    records = [json.loads(r["record"]) for r in tables["nested"].orderBy("goods_shipped").collect()]
    assert [r["shipment_ids"] for r in records] == [["s0", "s2", "s1"], ["s1", "s0", "s2"]]
    assert all(r["raw_attributes"] == {"Color": {"custom": "Teal"}} for r in records), records
    spent = spark.read.parquet(f"{tmp_path}/out/token_usage/run=id-r").first()["cost"]
    assert spent == (row["prompt_chars"] + len('{"items":[,]}') + 2 * len(item)) // 4


def test_inferred_run(spark, tmp_path):
    kinds = {"product_categories": [{"name": "Red Goods", "description": "red"}, {"name": "Blue Goods", "description": "blue"}]}
    kind = {"attributes": [{"name": "item", "definition": "What.", "values": ["ring", "rod", "gear", "bolt"]}]}
    done = runs.run(
        spark, V.shipments(spark, SF), str(tmp_path), run_id="a", infer_hs="901",
        answer_products=lambda asked: asked.select("hs4", F.lit(json.dumps(kinds)).alias("reply")),
        answer_attributes=lambda asked: asked.select("category", F.lit(json.dumps(kind)).alias("reply")),
        options=options(),
    )
    inferred = spark.read.parquet(f"{tmp_path}/inferred_schema")
    assert {r[0] for r in inferred.select("category").distinct().collect()} == {"Red Goods", "Blue Goods"}
    assert {"attr_Item", "attr_Origin_Country", "attr_Transport_Method"} <= set(done["flat"].columns)
    assert {r[0] for r in done["flat"].select("hs_code").distinct().collect()} == {"0901"}


def test_errors_end_a_run(spark, tmp_path):
    raw = V.shipments(spark, SF)
    with pytest.raises(ValueError, match="at least one product"):
        runs.run(spark, raw, str(tmp_path), run_id="a", options=options(stages=("load", "label")))
    with pytest.raises(ValueError, match="label stage"):
        runs.run(spark, raw, str(tmp_path), run_id="a", infer_hs="901", options=options(stages=("load",)))
    with pytest.raises(ValueError, match="no descriptions of heading 1234"):
        runs.infer_definition(raw, "1234", lambda asked: asked)


def test_a_failing_helper_is_recorded(spark, tmp_path, monkeypatch):
    labelled = S_clean(V.shipments(spark, SF).limit(60))
    P.write_table(labelled, f"{tmp_path}/labelled")
    only = options(stages=("extract", "publish"))
    known = V.attr_dict(spark)
    first = runs.run(spark, None, str(tmp_path), run_id="a", attr_dict=known, options=only)
    assert first["status"].where("error IS NOT NULL").count() == 0 and first["schema_master"].count() > 0
    plain = P.schema_master
    monkeypatch.setattr(P, "schema_master", lambda *a, **k: 1 / 0)
    second = runs.run(spark, None, str(tmp_path), run_id="b", attr_dict=known, options=only)
    assert [(r["name"], r["error"]) for r in second["status"].where("error IS NOT NULL").collect()] == [("schema_master", "division by zero")]
    assert "schema_master" not in second and second["nested"].count() > 0
    assert content(second["flat"], FLAT) == content(first["flat"], FLAT)
    monkeypatch.setattr(P, "schema_master", plain)
    monkeypatch.setattr(P, "nested_records", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        runs.run(spark, None, str(tmp_path), run_id="c", attr_dict=known, options=only)
    still = runs.published(spark, str(tmp_path))
    assert {r["version"] for r in still["status"].collect()} == {1} and still["nested"].count() == second["nested"].count()


def test_goods_per_product_and_heading_filter(spark):
    labelled = V.shipments(spark, SF)
    few = runs.extraction_rows(labelled, V.attr_dict(spark), options(hs_filter=["0904"], goods_per_product=2))
    goods = few.select(*KEY).distinct()
    assert {r[0] for r in goods.select("hs_code").distinct().collect()} == {"0904"}
    assert goods.groupBy("product").count().agg(F.max("count")).first()[0] == 2


def test_rows_stay_where_they_are_for_the_dictionary(spark):
    rows = spark.range(600, numPartitions=6).select(F.when(F.col("id") < 500, "9011").otherwise("1234").alias("hs_code"), "id")
    kept = S.with_dictionary(rows, V.attr_dict(spark))
    assert kept.count() == 500
    # One heading, and still as many tasks as before.
    assert kept.select(F.spark_partition_id()).distinct().count() == 5


def test_a_run_normalises_each_row_once(spark, tmp_path, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    original = runs.extraction_rows

    def counted(*args):
        def batches(found):
            for batch in found:
                seen.add(batch.num_rows)
                yield batch

        rows = original(*args)
        return rows.mapInArrow(batches, rows.schema)

    monkeypatch.setattr(runs, "extraction_rows", counted)
    raw, known = V.shipments(spark, SF), V.attr_dict(spark)
    for run in range(2):
        before = seen.value
        mine = raw.where(F.col("shipment_id").cast("bigint") % 2 == run)
        runs.run(
            spark, mine, f"{tmp_path}/out", run_id=str(run), attr_dict=known, definition=V.DEFINITION,
            options=options(stages=("load", "label", "extract")),
        )
        labelled = spark.read.parquet(f"{tmp_path}/out/labelled")
        assert seen.value - before == original(labelled, known, options()).count() > 1000


def test_descriptions_are_named_once_and_share_a_place_in_the_order_of_rows(spark, tmp_path, monkeypatch):
    """Names of files are made for descriptions, not rows; two products of one file come as their rows were read."""
    named = []
    original = P.per_product
    monkeypatch.setattr(P, "per_product", lambda rows, *a: named.append(rows.count()) or original(rows, *a))
    known = spark.createDataFrame(
        [("9011", "A/B", "Color", 0, "Red", 0), ("9011", "A_B", "Color", 0, "Blue", 0)], V.ATTR_DICT_SCHEMA
    )
    rows = [(0, "s1", "A/B"), (1, "s1", "A_B"), (2, "s2", "A_B"), (3, "s2", "A/B"), (4, "s3", "A_B")]
    labelled = spark.createDataFrame(
        [(o, "9011", "red blue z", s, c) for o, s, c in rows],
        "ord long, hs_code string, goods_shipped string, shipment_id string, category string",
    )
    P.write_table(labelled, f"{tmp_path}/labelled")
    tables = runs.run(spark, None, str(tmp_path), run_id="a", attr_dict=known, options=options(stages=("extract", "publish")))
    assert named == [2]
    got = {r["shipment_id"]: (r["product"], r["attrs"]["color"]) for r in tables["shipment_attributes"].collect()}
    assert got == {"s1": ("A_B", "Blue"), "s2": ("A/B", "Red"), "s3": ("A_B", "Blue")}
    (master,) = tables["schema_master"].collect()
    assert json.loads(master["schema_json"]) == {"color": ["Red", "Blue"]}
    assert tables["flat"].count() == 5


def test_incremental_stream(spark, tmp_path):
    rows = V.shipments(spark, SF).select(
        F.lit("0901").alias("hs_code"), F.col("category").alias("product"), F.trim("goods_shipped").alias("goods_shipped"), "shipment_id"
    )
    schema = rows.schema
    rows.where("shipment_id < '5'").write.parquet(f"{tmp_path}/in/a")
    rows.where("shipment_id >= '5'").write.parquet(f"{tmp_path}/in/b")
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    )
    known = V.attr_dict(spark)
    query = incremental.run_incrementally(stream, known, f"{tmp_path}/out", f"{tmp_path}/cp")
    query.awaitTermination()
    classified = spark.read.parquet(f"{tmp_path}/out/classified")
    assert spark.read.parquet(f"{tmp_path}/out/goods_shipments").select("batch").distinct().count() > 1
    expected = rows.where("goods_shipped <> ''").join(known.select("hs_code", "product").distinct(), ["hs_code", "product"], "left_semi")
    assert classified.count() == expected.select(*KEY).distinct().count()
    pairs = spark.read.parquet(f"{tmp_path}/out/goods_shipments")
    assert content(pairs.drop("batch"), [*KEY, "shipment_id"]) == content(expected.distinct(), [*KEY, "shipment_id"])


def test_no_batch_reads_what_earlier_ones_wrote(spark, tmp_path, monkeypatch):
    """20 batches, one product and description throughout: each costs its own rows, the twentieth like the second."""
    from pyspark.sql.readwriter import DataFrameReader

    lines = [("0901", "PROMO", "red ring" if i % 3 else f"blue bolt {i}", f"s{i % 40}") for i in range(20 * 30)]
    names = "hs_code string, product string, goods_shipped string, shipment_id string"
    rows = spark.createDataFrame(lines, names)
    for k in range(20):
        spark.createDataFrame(lines[30 * k : 30 * k + 30], names).coalesce(1).write.parquet(f"{tmp_path}/in/{k:02}")
    known = V.attr_dict(spark)
    stream = spark.readStream.schema(names).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    monkeypatch.setattr(DataFrameReader, "parquet", lambda *a, **k: pytest.fail("a batch reads a table"))
    runs_of = incremental.run_incrementally(stream, known, f"{tmp_path}/out", f"{tmp_path}/cp")
    runs_of.awaitTermination()
    monkeypatch.undo()
    done = [p["numInputRows"] for p in runs_of.goods.recentProgress if p["numInputRows"]]
    assert done == [30] * 20
    classified = spark.read.parquet(f"{tmp_path}/out/classified")
    assert classified.count() == rows.select("goods_shipped").distinct().count()
    pairs = spark.read.parquet(f"{tmp_path}/out/goods_shipments").drop("batch")
    assert content(pairs, [*KEY, "shipment_id"]) == content(rows.distinct(), [*KEY, "shipment_id"])


def test_dictionary_of_any_size_on_a_stream(spark, monkeypatch):
    from shiplabel.operators.matching import found_values
    from shiplabel.sources import shipments as S

    rows = S.with_goods(S.classified_input(V.shipments(spark, SF)))
    known = V.attr_dict(spark)
    long = lambda df: df.select("ord", F.inline(found_values()))
    small = long(incremental.match_stream(rows, known))
    monkeypatch.setattr(incremental, "fits_broadcast", lambda d: False)
    large = long(incremental.match_stream(rows, known))
    assert large.count() > 1000 and large.exceptAll(small).isEmpty() and small.exceptAll(large).isEmpty()


def test_formats(spark, tmp_path):
    with pytest.raises(ValueError, match="format"):
        P.write_table(spark.range(1), f"{tmp_path}/x", "orc2")
