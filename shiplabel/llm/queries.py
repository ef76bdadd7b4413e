"""The corpus operators as queries over the given tables, with SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shiplabel.llm import (
    collocations,
    decontaminate,
    fingerprints,
    html_extract,
    langid,
    licenses,
    packing,
    search,
    secrets,
    sharding,
    simhash,
    toxicity,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op2_html_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op3_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_license_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licences(_table(spark, sf_dir, "documents"))


def op5_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(_table(spark, sf_dir, "documents"))


def op6_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(_table(spark, sf_dir, "documents"))


def op7_simhash_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_one_permutation_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(_table(spark, sf_dir, "documents"))


def op9_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_warc_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages"))


def op12_tiled_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_retrieval_packing": op1_retrieval_packing,
    "op2_html_field": op2_html_field,
    "op3_toxicity_grammar": op3_toxicity_grammar,
    "op4_license_paragraphs": op4_license_paragraphs,
    "op5_secret_ledger": op5_secret_ledger,
    "op6_language_bitmask": op6_language_bitmask,
    "op7_simhash_vantage_points": op7_simhash_vantage_points,
    "op8_one_permutation_minhash": op8_one_permutation_minhash,
    "op9_feistel_shards": op9_feistel_shards,
    "op10_decontamination": op10_decontamination,
    "op11_warc_ranges": op11_warc_ranges,
    "op12_tiled_collocations": op12_tiled_collocations,
    "op13_hybrid_search": op13_hybrid_search,
}

ORACLES: dict[str, str] = {
    "op5_secret_ledger": secrets.ORACLE_SQL,
    "op10_decontamination": decontaminate.ORACLE_SQL,
    "op11_warc_ranges": warc.ORACLE_SQL,
    "op12_tiled_collocations": collocations.ORACLE_SQL,
    "op13_hybrid_search": search.ORACLE_SQL,
}
