"""Small corpora for the corpus operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the and of to in that with river house garden winter light bread stone market people window".split(),
    "de": "der und die das nicht mit haus garten straße fenster brücke wasser himmel freund zeitung schule".split(),
}


def prose(rng: random.Random, n: int, lang: str = "en") -> str:
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "", "s", "er", "ing"]) for _ in range(n)).capitalize() + "."


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text[, lang])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows(seed: int = 1) -> list[tuple]:
    """Null and empty texts, a null id, repeated rows, a very long text, and some prose."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, 40)) for i in range(1, 9)]
    return [*rows, (9, None), (10, ""), (11, " \n\t "), (12, rows[0][1]), (3, rows[2][1]), (None, prose(rng, 30)), (13, prose(rng, 30_000)), (14, "…")]


def clashing(docs: DataFrame) -> DataFrame:
    """``docs`` with further columns named like those that operators work with."""
    from pyspark.sql import functions as F

    names = ["score", "blob", "fingerprint", "shard", "size", "ids", "n", "signature", "spans", "items", "content", "path", "id", "hash", "own", "words", "rules", "node", "bands", "_id", "_hash", "__id", "__content", "__hash", "__rules"]
    return docs.select("*", *[F.lit("x").alias(n) for n in names])
