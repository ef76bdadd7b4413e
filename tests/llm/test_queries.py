"""The registered queries: SQL counterparts, whole tables, and the pipeline against its stages by brute force."""

import oracle_check
import pytest
from helpers import clashing
from test_decontaminate import words
from test_secrets import brute as secret_spans

import corpus_pipeline
from shiplabel.llm import decontaminate, queries, simhash

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    assert oracle_check.compare(queries.QUERIES[name](spark, SF), oracle_check.connect(SF), queries.ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(n for n in queries.QUERIES if n.split("_")[0] not in ("op1", "op12", "op13")))
def test_one_row_for_each_row(spark, name):
    table = "pages" if name.startswith(("op2_", "op11_")) else "documents"
    assert queries.QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_pipeline_stages(spark, tmp_path):
    docs = clashing(spark.read.parquet(f"{SF}/documents.parquet"))
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in before.collect()}
            continue
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    everything = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(kept["language"]) == {i for i, t in everything.items() if any(c.isalpha() for c in t)}
    sets = {i: set(simhash.shingle_set(t).tolist()) for i, t in kept["language"].items()}
    group = {i: i for i in sets}
    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and group[i] != group[j] and (a == b or len(a & b) >= 0.8 * len(a | b)):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = {k: new if g == old else g for k, g in group.items()}
    assert set(kept["near_duplicates"]) == set(group.values())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    table = decontaminate.Windows([(str(i), t) for i, t in items], 10)
    for i, t in kept["near_duplicates"].items():
        spans = table.hits([decontaminate.words_of(t)])[0][0]
        if not spans:
            assert kept["benchmark"][i] == t
        elif i in kept["benchmark"]:
            assert len(words(kept["benchmark"][i])) < len(words(t))
    for i, t in kept["secrets"].items():
        assert not secret_spans(t)
        assert secret_spans(kept["benchmark"][i]) or t == kept["benchmark"][i]
