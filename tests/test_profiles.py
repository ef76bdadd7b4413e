"""Profiles of deliveries against profiles of all rows."""

import pytest
from pyspark.sql import functions as F

from shiplabel.operators import profiles
from shiplabel.sources import shipments as S

COLUMNS = "hs_code string, goods_shipped string, shipment_id string, category string"


def deliveries(spark):
    first = [("0901", f"g{i % 40}", str(i), "a" if i % 3 else None) for i in range(400)] + [(None, "", None, "")]
    second = [("0902", f"g{i % 60}", str(i), "b") for i in range(300, 500)]
    return [spark.createDataFrame(rows, COLUMNS) for rows in (first, second)]


@pytest.fixture(scope="module")
def recorded(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("profiles"))
    first, second = deliveries(spark)
    profiles.record(second, folder, "1", listed=["category"])
    profiles.record(second, folder, "0", listed=["category"])
    profiles.record(first, folder, "1", listed=["category"])  # replaces what "1" was
    return folder


def test_profile_equals_that_of_all_rows(spark, recorded):
    first, second = deliveries(spark)
    both = first.unionByName(second)
    want = S.profile(both).first().asDict()
    got = profiles.profile(spark, recorded).first().asDict()
    assert {k: got[k] for k in want} == want and got["categories"] == 3
    near = profiles.profile(spark, recorded, approximate=True).first().asDict()
    assert all(abs(near[k] - want[k]) <= 0.05 * want[k] for k in want)
    assert near["rows"] == want["rows"]


def test_distribution_and_ratio(spark, recorded):
    got = {r["category"]: (r["rows"], r["percent"]) for r in profiles.distribution(spark, recorded).collect()}
    assert got == {"a": (266, 44.3), None: (134, 22.3), "": (1, 0.2), "b": (200, 33.3)}
    assert profiles.dedup_stats(spark, recorded).first()["goods"] == 61
    with pytest.raises(ValueError):
        profiles.distribution(spark, recorded, "goods_shipped")


def test_no_delivery_is_read_again(spark, recorded):
    files = profiles.profile(spark, recorded).inputFiles()
    assert files and all("/values/delivery=" in f or "/counts/delivery=" in f for f in files)
    sizes = spark.read.parquet(f"{recorded}/values").groupBy("delivery").agg(F.count("*").alias("n")).collect()
    assert len(sizes) == 2


def test_an_unfinished_delivery_has_no_part(spark, tmp_path):
    first, second = deliveries(spark)
    profiles.record(first, str(tmp_path), "a")
    text = second.select("hs_code", "goods_shipped", "shipment_id")
    profiles.write_table(profiles.values_of(text, text.columns), f"{tmp_path}/values/delivery=id-b")
    assert profiles.profile(spark, str(tmp_path)).first()["goods"] == 41


def test_empty_deliveries(spark, tmp_path):
    none = deliveries(spark)[0].where("false")
    profiles.record(none, str(tmp_path), "a", listed=["category"])
    assert set(profiles.profile(spark, str(tmp_path)).first().asDict().values()) == {0}
    assert profiles.distribution(spark, str(tmp_path)).count() == 0
    with pytest.raises(ValueError):
        profiles.record(none, str(tmp_path), "a/b")


def test_deliveries_read_what_was_joined_once(spark, tmp_path, monkeypatch):
    """Each delivery reads a written table, so the tables that shipments are made of are not joined again."""
    from shiplabel.plans import queries

    read = []
    monkeypatch.setattr(queries.profiles, "record", lambda rows, *_, **__: read.append(set(rows.inputFiles())))
    rows = deliveries(spark)[0]
    rows.write.parquet(f"{tmp_path}/rows")
    queries._recorded(spark, spark.read.parquet(f"{tmp_path}/rows"), ("category",))
    assert len(read) == 4 and all(files == read[0] for files in read)
    assert read[0] and not any(str(tmp_path) in file for file in read[0])
