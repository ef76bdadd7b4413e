"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its UTF-8 text). The ledger keeps
which (blob, rule version) pairs were scanned and what they yielded; a scan reads only unseen
pairs, one copy of each blob, and findings are joined back to all paths that hold the blob.

A ledger folder has ``seen`` (blob, rules) and ``findings`` (blob, rule, start, end), both
appended. Findings are written before the pairs are marked as seen, and read as a set: a scan
that died in between is repeated without harm.

Rules are regular expressions with a least length of the match or of its value. A rule takes
leftmost non-overlapping matches, of which those too short are dropped. Positions are code
points, end exclusive; they follow from the lengths of a text's matches and of the pieces
between them, so everything is built-in expressions.

Null texts count as empty, null ids are ordinary ids, repeated rows are one blob with the same
findings for each row, an empty table gives no rows. Texts are scanned whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiplabel.llm.common import new_path, text_or_empty, unused


@dataclass(frozen=True)
class Rule:
    """``value`` is the group whose length must reach ``least``; 0 is the whole match."""

    kind: str
    pattern: str
    value: int
    least: int
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Runs are maximal, so asking for 24 at once drops the same runs as a later filter.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Public formats of tokens that carry their own prefix.
EXTRA = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    # It starts where a run of its characters starts: a long run is read once, not from every "eyJ" in it.
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]++", 0, 1, version=2),
)
RULES = BASE + EXTRA
# What is masked: of a private key all lines, to the END line or, without one, to the end of the base64 lines. It goes
# first, because a mask inside the key would end its base64 lines. The report keeps the rules of its SQL counterpart.
# Possessive loops: Java's others need stack for each line.
GAP = r"""(?:[\s"',#>*|]|\\[rnt])++"""
HEADERS = rf"(?:{GAP}[A-Za-z-]++:[^\n\\]*+)*+"
PEM_BLOCK = Rule(
    "pem",
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
    rf"""(?:{HEADERS}[A-Za-z0-9+/=\s\\"',#>*|]*+-----END [A-Z ]*PRIVATE KEY-----"""
    rf"|{HEADERS}(?:{GAP}[A-Za-z0-9+/=]{{16,}}+)++(?:{GAP}[A-Za-z0-9+/=]++)?)?",
    0,
    1,
    version=2,
)
MASKED = (PEM_BLOCK, *[r for r in RULES if r.kind != "pem"])

FINDING = "blob string, rule string, start bigint, end bigint"
SEEN = "blob string, rules array<string>"


def blob_id(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def seen_pairs(spark: SparkSession, ledger: str) -> DataFrame:
    """blob and all rule versions it was scanned with."""
    return (
        _read(spark, f"{ledger}/seen", SEEN)
        .select("blob", F.explode("rules").alias("rule"))
        .groupBy("blob")
        .agg(F.collect_set("rule").alias("rules"))
    )


def findings(spark: SparkSession, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    keys = [r.key for r in rules]
    return _read(spark, f"{ledger}/findings", FINDING).where(F.col("rule").isin(keys)).distinct()


def unseen(blobs: DataFrame, ledger: str, rules: Sequence[Rule]) -> DataFrame:
    """``blobs`` (with column blob) that lack a rule, with the rules to run as ``todo``."""
    keys = F.array(*[F.lit(r.key) for r in rules])
    known = seen_pairs(blobs.sparkSession, ledger)
    return (
        blobs.join(known, "blob", "left")
        .withColumn("todo", F.array_except(keys, F.coalesce("rules", F.array().cast("array<string>"))))
        .drop("rules")
        .where(F.size("todo") > 0)
    )


def _matches(rule: Rule) -> Column:
    """Matches of a text that has any, as (length of the piece before, of the match, of the value)."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    lengths = lambda c: F.transform(c, lambda x: F.length(x))
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(rule.value)) if rule.value else found
    parts = F.arrays_zip(
        lengths(F.split(text, rule.pattern, -1)).alias("gap"),
        lengths(found).alias("whole"),
        lengths(values).alias("value"),
    )
    return F.when(F.array_contains("todo", rule.key) & text.rlike(rule.pattern), parts)


def _positions(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, rule, start, end) of texts with blob, text and todo."""
    each = F.array(
        *[
            F.struct(
                F.lit(r.key).alias("rule"), F.lit(r.least).alias("least"), _matches(r).alias("parts")
            )
            for r in rules
        ]
    )
    matched = (
        texts.select("blob", F.explode(F.filter(each, lambda x: x.parts.isNotNull())).alias("r"))
        .select("blob", "r.rule", "r.least", F.posexplode("r.parts").alias("at", "part"))
        .select("blob", "rule", "least", "at", "part.*")
    )
    past = Window.partitionBy("blob", "rule").orderBy("at")
    upto = past.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.coalesce("whole", F.lit(0))).over(upto)
    return (
        matched.distinct()  # repeated rows of one blob
        .withColumn("end", end)
        .where(F.col("whole").isNotNull() & (F.col("value") >= F.col("least")))
        .select("blob", "rule", (F.col("end") - F.col("whole")).alias("start"), "end")
    )


def scan(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> None:
    """Scan what the ledger has not seen of ``versions`` (path, text) and append it to the ledger."""
    keyed = versions.select("path", text_or_empty().alias("text")).withColumn("blob", blob_id(F.col("text")))
    # The path that stands for a blob; a null path must not get lost in min().
    holder = F.min(F.struct(F.col("path").isNull().alias("none"), F.col("path"))).alias("holder")
    todo = unseen(keyed.groupBy("blob").agg(holder), ledger, rules)
    one_copy = keyed.join(
        # Texts only stream past the hashed side: they are moved once and never sorted.
        todo.select(F.col("blob").alias("held_blob"), F.col("holder.path").alias("held_path"), "todo").hint(
            "shuffle_hash"
        ),
        F.col("path").eqNullSafe(F.col("held_path")) & (F.col("blob") == F.col("held_blob")),
    ).select("blob", "text", "todo")
    _positions(one_copy, rules).write.mode("append").parquet(f"{ledger}/findings")
    todo.select("blob", F.col("todo").alias("rules")).write.mode("append").parquet(f"{ledger}/seen")


def joined_back(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """path, blob and the sorted findings (start, rank, kind, end) of every version."""
    spark = versions.sparkSession
    rank = reduce(
        lambda c, r: c.when(F.col("rule") == r[1].key, r[0]), enumerate(rules), F.when(F.lit(False), -1)
    )
    # A blob's findings are no more than its own text holds.
    per_blob = (
        findings(spark, ledger, rules)
        .withColumn("kind", F.substring_index("rule", "@", 1))
        .groupBy("blob")
        .agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("found"))
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return (
        versions.select("path", blob_id(text_or_empty()).alias("blob"))
        .join(per_blob, "blob", "left")
        .withColumn("found", F.coalesce("found", none))
    )


def secret_spans(docs: DataFrame, ledger: str | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per document: counts of the base kinds, digest of the base spans, all spans; a new ledger unless one is given."""
    ledger = ledger or new_path(docs.sparkSession, "ledger")
    versions = docs.select(F.col("doc_id").alias("path"), "text")
    scan(versions, ledger, rules)
    base = [r.kind for r in BASE]
    count = lambda kind: F.size(F.filter("found", lambda x: x.kind == kind)).cast("bigint")
    spelt = lambda c: F.array_join(
        F.transform(c, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ","
    )
    return joined_back(versions, ledger, rules).select(
        F.col("path").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(spelt(F.filter("found", lambda x: x.kind.isin(base))).cast("binary"), 256).alias("base_sha256"),
        spelt(F.col("found")).alias("spans"),
        "blob",
    )


def _masked(text: Column, rule: Rule) -> Column:
    """``text`` with the matches of one rule replaced by the rule's name, in one pass over the pieces."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.value))
    kept = F.zip_with(
        found, values, lambda m, v: F.when(F.length(v) >= rule.least, F.lit(f"[{rule.kind}]")).otherwise(m)
    )
    pieces = F.split(text, rule.pattern, -1)
    return F.array_join(
        F.zip_with(pieces, kept, lambda piece, m: F.concat(piece, F.coalesce(m, F.lit("")))), ""
    )


def redact(docs: DataFrame, ledger: str | None = None, rules: Sequence[Rule] = MASKED) -> DataFrame:
    """``docs`` with every finding masked; other documents and all other columns unchanged, n_chars follows the text.

    Rules are applied in their order, so a finding inside another is masked with it.
    """
    ledger = ledger or new_path(docs.sparkSession, "ledger")
    versions = docs.select(F.col("doc_id").alias("path"), "text")
    scan(versions, ledger, rules)
    # Three helper columns live beside the documents' own for this join only.
    rules_name, blob_name, own_name = unused(docs, "rules", "blob", "own")
    hit = (
        findings(docs.sparkSession, ledger, rules)
        .groupBy("blob")
        .agg(F.collect_set("rule").alias(rules_name))
        .withColumnRenamed("blob", blob_name)
    )
    out = docs.withColumn(own_name, blob_id(text_or_empty())).join(hit, F.col(own_name) == F.col(blob_name), "left")
    for r in rules:
        out = out.withColumn(
            "text", F.when(F.array_contains(rules_name, r.key), _masked(F.col("text"), r)).otherwise(F.col("text"))
        )
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(
            "n_chars", F.when(F.col(rules_name).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
        )
    return out.select(*docs.columns)


ORACLE_SQL = r"""
WITH rules(rank, kind, pattern, grp, least) AS (VALUES
  (0, 'assign', '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 20),
  (2, 'hex', '[0-9a-f]{24,}', 0, 24),
  (3, 'pem', '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 1),
  (4, 'github', 'gh[pousr]_[A-Za-z0-9]{36,}', 0, 1),
  (5, 'slack', 'xox[abprs]-[A-Za-z0-9-]{10,}', 0, 1),
  (6, 'jwt', '(?:^|[^A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+)', 1, 1)),
doc AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
hit AS (
  SELECT row_id, rank, kind, grp, least,
    unnest([length(x) for x in string_split_regex(text, pattern)][:-2]) AS gap,
    unnest([length(x) for x in regexp_extract_all(text, pattern)]) AS whole,
    unnest([length(x) for x in CASE grp WHEN 2 THEN regexp_extract_all(text, pattern, 2)
      WHEN 1 THEN regexp_extract_all(text, pattern, 1) ELSE regexp_extract_all(text, pattern) END]) AS val,
    generate_subscripts(regexp_extract_all(text, pattern), 1) AS nr
  FROM doc, rules WHERE regexp_matches(text, pattern)),
span AS (
  SELECT *, sum(gap + whole) OVER (PARTITION BY row_id, rank ORDER BY nr)::BIGINT AS stop FROM hit),
kept AS (
  SELECT *, stop - CASE grp WHEN 1 THEN val ELSE whole END AS start,
    kind || ':' || (stop - CASE grp WHEN 1 THEN val ELSE whole END) || ':' || stop AS spelt
  FROM span WHERE val >= least),
per_doc AS (
  SELECT row_id, count(*) FILTER (rank = 0) AS a, count(*) FILTER (rank = 1) AS k, count(*) FILTER (rank = 2) AS h,
    string_agg(spelt, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
    string_agg(spelt, ',' ORDER BY start, rank) AS spans
  FROM kept GROUP BY row_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(text) AS blob
FROM doc LEFT JOIN per_doc USING (row_id)
"""
