"""Whole runs: from a shipment table to the published tables, stage by stage.

Every stage reads and writes tables under ``folder``, so a run can start at any
stage whose input exists, and a later run only works on what is new.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplabel.functions import text as X
from shiplabel.operators import batches, infer, labels, publish, replies, requests
from shiplabel.operators.dictionary import KEY, attach_dictionary
from shiplabel.operators.matching import NEGATION_WINDOW, match_goods
from shiplabel.operators.scale import durable, skew_join
from shiplabel.sources import shipments as S

GOODS = [*KEY, "goods_shipped"]
LOG = logging.getLogger(__name__)


@dataclass
class Options:
    """Settings of a run; the defaults are those of a plain run."""

    hs_rule: str = "digits"
    numeric_hs: bool = False
    hs_filter: Sequence[str] | None = None
    goods_per_product: int | None = None
    batch_size: int = batches.BATCH_SIZE
    token_budget: int = batches.TOKEN_BUDGET
    reply_tokens: int | None = None  # expected for each item of a reply; None: those of a reply with empty values
    preview: int = requests.VALUE_PREVIEW  # values of an attribute that a request shows
    negation: str = "documented"
    min_len: int = 3
    dictionary_first: bool = True
    dictionary_only: bool = False
    heuristic_fill: bool = True
    open_list: bool = True
    custom_flags: bool = False
    dedup_shipments: bool = False  # list a shipment once for a description, however many rows name both
    raw_values: bool = False  # nested records show values as the reply gave them, too
    strategy: str = "auto"
    negation_window: int = NEGATION_WINDOW
    # first values in a column summary; cuts of what replies and columns propose (None: no cut)
    summary_values: int | None = infer.SUMMARY_VALUES
    max_values: int | None = None
    max_representatives: int | None = None
    sample_size: int = infer.MAX_SAMPLES
    resume: bool = True
    stages: Sequence[str] = field(default=("load", "label", "extract", "publish"))


def load(raw: DataFrame, path: str) -> DataFrame:
    """Clean, checked shipments, written to ``path``.

    A table without an ``ord`` column gets one that follows the order it is read in;
    being written, it is the same for all later stages.
    """
    if "ord" not in raw.columns:
        raw = raw.withColumn("ord", F.monotonically_increasing_id())
    publish.write_table(S.clean(raw), path)
    rows = raw.sparkSession.read.parquet(path)
    S.validate(rows)
    return rows


def label(
    rows: DataFrame,
    definition: Sequence[tuple[str, str | None]],
    scorer: Callable[[list[str]], list[str]] | None = None,
    done: DataFrame | None = None,
    failures=None,
) -> DataFrame:
    """Rows with ``category``: each distinct description is scored once.

    Without a ``scorer`` the lexical one is used. ``done`` (``goods_shipped,
    category``) are labels of earlier runs, which are not scored again. ``failures``, an
    accumulator, counts the descriptions of failed calls.
    """
    goods = durable(labels.distinct_goods(rows))
    todo = goods if done is None else goods.join(done, "goods_shipped", "left_anti")
    if scorer is None:
        scored = todo.select(
            "goods_shipped", labels.lexical_label("goods_shipped", definition).alias("category")
        )
    else:
        scored = labels.label_by_scorer(todo, scorer, failures=failures)
    if done is not None:
        scored = scored.unionByName(done.select("goods_shipped", "category"))
    # durable, so that a paid scorer sees each description once
    return labels.propagate_labels(rows, durable(scored.join(goods, "goods_shipped")))


def extraction_rows(labelled: DataFrame, attr_dict: DataFrame, options: Options) -> DataFrame:
    """Labelled rows in the shape extraction works on, without those no dictionary knows."""
    rows = S.with_goods(S.classified_input(labelled, options.hs_rule, options.numeric_hs))
    if options.hs_filter:
        rows = S.hs_filter(rows, options.hs_filter)
    rows = S.with_dictionary(rows, attr_dict)
    if options.goods_per_product:
        few = batches.first_goods(rows, options.goods_per_product)
        rows = rows.join(few.select(*GOODS), GOODS, "left_semi")
    return rows


def extraction_items(
    rows: DataFrame, attr_dict: DataFrame, options: Options, stored: DataFrame | None = None
) -> DataFrame:
    """Batched pending descriptions with what they state, and whether that settles the batch."""
    todo = rows.select(*GOODS).distinct() if stored is None else publish.pending_goods(rows, stored)
    known = todo.join(attr_dict.select(*KEY).distinct(), KEY, "left_semi")
    items = batches.number_batches(known, options.batch_size)
    matched = match_goods(
        items,
        attr_dict,
        negation=options.negation,
        min_len=options.min_len,
        window=options.negation_window,
        strategy=options.strategy,
    )
    if not options.dictionary_first:
        unseen = F.transform("found", lambda f: f.withField("value", F.lit(None).cast("string")))
        matched = matched.withColumn("found", unseen)
    return replies.gate_batches(matched, options.dictionary_only)


def extraction_requests(
    items: DataFrame, attr_dict: DataFrame, attr_defs: DataFrame | None, options: Options, used: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Requests for the batches the dictionary did not settle, as far as the budget reaches, and their guides."""
    open_items = items.where(~F.col("resolved"))
    table, guides = requests.attribute_request_tables(
        open_items, attr_dict, attr_defs, open_list=options.open_list, preview=options.preview
    )
    # what a reply will cost is only known afterwards; the cut reckons with an expected cost
    of_item = F.col("reply_chars") / 4 if options.reply_tokens is None else F.lit(options.reply_tokens)
    costed = table.withColumn("cost", F.col("tokens") + F.ceil(F.col("batch_size") * of_item).cast("bigint"))
    # running totals need gapless positions; settled batches cost nothing
    every = items.select(*KEY, "batch_no").distinct()
    filled = every.join(costed, [*KEY, "batch_no"], "left").withColumn(
        "cost", F.coalesce("cost", F.lit(0))
    )
    within = batches.within_budget(filled, options.token_budget, used).where("runs AND tokens IS NOT NULL")
    return within, guides


def extract(
    items: DataFrame, attr_dict: DataFrame, replied: DataFrame | None, options: Options
) -> DataFrame:
    """Classification records of settled and answered items; the others stay pending."""
    settled = replies.resolved_records(items)
    if replied is None:
        return settled
    aligned = replies.align_replies(items.where(~F.col("resolved")), replied)
    texts = replies.replied_texts(F.col("item"))
    attached = attach_dictionary(
        aligned, attr_dict, min_len=options.min_len, strategy=options.strategy, replied=texts
    )
    merged = replies.merge_values(replies.normalise_replies(attached, options.open_list))
    answered = replies.records(replies.fill_missing(merged, options.heuristic_fill))
    return settled.unionByName(answered)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" in str(problem) or "UNABLE_TO_INFER_SCHEMA" in str(problem):
            return None
        raise


def infer_definition(
    rows: DataFrame, hs_code: str, answer: Callable[[DataFrame], DataFrame], options: Options | None = None
) -> list[tuple[str, str | None]]:
    """Product categories of a heading, proposed for samples of its descriptions."""
    options = options or Options()
    mine = S.of_heading(rows, hs_code).withColumn("hs4", X.hs4_digits("hs_code"))
    asked = requests.product_inference_requests(infer.sample_goods(mine, "hs4", options.sample_size))
    if asked.isEmpty():
        known = [r["hs4"] for r in S.available_headings(rows).orderBy("hs4").collect()]
        raise ValueError(f"no descriptions of heading {hs_code}; the table has {known}")
    # a definition is configuration: a handful of names that become request text
    found = infer.inferred_products(answer(asked), options.max_representatives).orderBy("ord").collect()
    if not found:
        raise ValueError("the reply proposes no product category")
    return [(r["category"], r["description"]) for r in found]


def infer_dictionary(
    labelled: DataFrame,
    hs_code: str,
    definition: Sequence[tuple[str, str | None]],
    answer: Callable[[DataFrame], DataFrame] | None = None,
    options: Options | None = None,
) -> DataFrame:
    """Attributes of every category from replies and columns (``inferred_schema``)."""
    options = options or Options()
    heading = labelled.sparkSession.range(1).select(X.hs4_strict(F.lit(hs_code))).first()[0]
    rows = labelled.where(F.col("category").isin([c for c, _ in definition]))
    asked = requests.attribute_inference_requests(
        infer.sample_goods(rows, "category", options.sample_size),
        infer.category_summary(rows, values=options.summary_values),
        heading,
    )
    replied = (
        answer(asked)
        if answer is not None
        else asked.select("category", F.lit('{"attributes":[]}').alias("reply"))
    )
    return infer.inferred_schema(rows, replied, max_values=options.max_values).withColumn("hs_code", F.lit(heading))


def label_stage(
    spark: SparkSession,
    folder: str,
    definition: Sequence[tuple[str, str | None]],
    scorer: Callable[[list[str]], list[str]] | None,
    options: Options,
) -> None:
    rows = spark.read.parquet(f"{folder}/shipments")
    known = _stored(spark, f"{folder}/labels") if options.resume else None
    done = None if known is None else known.where("category <> ''")
    publish.write_table(label(rows, definition, scorer, done), f"{folder}/labelled")
    fresh = (
        spark.read.parquet(f"{folder}/labelled")
        .where("category <> ''")
        .select("goods_shipped", "category")
        .distinct()
    )
    if done is not None:
        fresh = fresh.join(done, "goods_shipped", "left_anti")
    mode = "append" if options.resume else "overwrite"
    publish.write_table(fresh, f"{folder}/labels", mode=mode)


def extract_stage(
    spark: SparkSession,
    folder: str,
    run_id: str,
    attr_dict: DataFrame,
    attr_defs: DataFrame | None,
    answer: Callable[[DataFrame], DataFrame] | None,
    options: Options,
) -> None:
    """Classify what is pending; everything a run adds carries its ``run`` folder.

    A repeated run of the same id replaces what it had written.
    """

    def earlier(name: str) -> DataFrame | None:
        table = _stored(spark, f"{folder}/{name}") if options.resume else None
        return None if table is None else table.where(F.col("run") != this_run).drop("run")

    this_run = f"id-{run_id}"  # never read back as a number or a date
    mine = lambda name: f"{folder}/{name}/run={this_run}"
    rows = extraction_rows(spark.read.parquet(f"{folder}/labelled"), attr_dict, options)
    # Codes and texts are normalised once; the descriptions and their numbers of rows are counted once.
    rows = durable(rows.select(*GOODS, "shipment_id", "ord"))
    counts = durable(rows.groupBy(*GOODS).agg(F.count("*").alias("_rows")))
    stored, pairs, spent = earlier("classified"), earlier("goods_shipments"), earlier("token_usage")
    items = durable(extraction_items(counts, attr_dict, options, stored))
    replied, costs = None, spark.range(0).select(F.col("id").alias("cost"))
    if answer is not None:
        used = 0 if spent is None else spent.agg(F.sum("cost")).first()[0] or 0
        asked, guides = extraction_requests(items, attr_dict, attr_defs, options, used)
        publish.write_table(asked, mine("requests"))
        publish.write_table(guides, mine("guides"))
        asked = spark.read.parquet(mine("requests"))
        # Whole prompts exist only on their way to the model.
        whole = requests.rendered(asked, spark.read.parquet(mine("guides")))
        publish.write_table(answer(whole), mine("replies"))
        replied = spark.read.parquet(mine("replies"))
        costs = asked.join(replied, [*KEY, "batch_no"]).select(
            requests.cost_of(F.col("prompt_chars"), F.col("reply")).alias("cost")
        )
    publish.write_table(costs, mine("token_usage"))
    number = run_number(_stored(spark, f"{folder}/classified") if options.resume else None, this_run)
    classified = extract(items, attr_dict, replied, options).withColumn("run_no", F.lit(number))
    publish.write_table(classified, mine("classified"))
    done = spark.read.parquet(mine("classified")).select(*GOODS)
    if stored is not None:
        done = done.unionByName(stored.select(*GOODS))
    seen = skew_join(rows, done.distinct(), GOODS, "left_semi", ["shipment_id", "ord"], counts)
    if options.dedup_shipments:
        seen = seen.groupBy(*GOODS, "shipment_id").agg(F.min("ord").alias("ord"))
    added = seen if pairs is None else publish.new_shipments(pairs, seen, "ord", counts)
    publish.write_table(added.withColumn("run_no", F.lit(number)), mine("goods_shipments"))


def run_number(classified: DataFrame | None, this_run: str) -> int:
    """A run comes after all others; a repeated one keeps its place."""
    if classified is None:
        return 0
    own = F.max(F.when(F.col("run") == this_run, F.col("run_no")))
    before, last = classified.agg(own, F.max("run_no")).first()
    return before if before is not None else 0 if last is None else last + 1


# Tables that help readers; without them the others are still published.
HELPERS = ("schema_master", "shipment_attributes")
STATUS = "version bigint, name string, error string"


def publish_stage(
    spark: SparkSession, folder: str, attr_dict: DataFrame, options: Options
) -> dict[str, DataFrame]:
    """Publish all tables as a new version, and switch readers to it once all of them are written.

    Each version has a folder of its own. A last append to ``manifest`` makes it the published one, so
    readers never see tables of two versions, nor half of one. The error of a helper table is
    recorded there and the others are published; any other error leaves the version before in place.
    """
    manifest = _stored(spark, f"{folder}/manifest")
    version = 0 if manifest is None else manifest.agg(F.max("version")).first()[0] + 1
    base = f"{folder}/published/{version}"
    classified = spark.read.parquet(f"{folder}/classified").drop("run")
    pairs = spark.read.parquet(f"{folder}/goods_shipments").drop("run")
    names = publish.attribute_names(attr_dict)
    # Rows of a file: runs one after the other, descriptions of a run sorted, shipments as they were read.
    # What a description is the same for in all its rows is made before it meets its shipments.
    read = F.struct("run_no", "ord")
    placed = pairs.select(*GOODS, "shipment_id", read.alias("_read"))
    wide = publish.placed_descriptions(classified, names, options.custom_flags)
    own = [c for c in wide.columns if c not in (*GOODS, "_at", "_shared")]
    # Where one place has rows of several descriptions, they come as they were read.
    tie = F.when(F.col("_shared"), F.col("_read")).alias("_tie")
    flat = publish.with_shipments(wide, placed, ["_read"]).select(
        *KEY, "shipment_id", "goods_shipped", F.struct("_at", tie, "_read").alias("ord"), *(f"`{c}`" for c in own)
    )
    publish.write_table(flat, f"{base}/flat", partition_by=["hs_code"])
    ordered = spark.read.schema(flat.schema).parquet(f"{base}/flat")
    # Rows of a description say the same, so the first one of each tells the values and their order.
    ties = placed.join(wide.where("_shared").select(*GOODS).distinct(), GOODS, "left_semi")
    earliest = ties.groupBy(*GOODS).agg(F.min("_read").alias("_tie"))
    firsts = wide.join(earliest, GOODS, "left").withColumn("ord", F.struct("_at", "_tie"))
    lists = publish.goods_to_shipments(pairs.withColumn("ord", read), part_size=publish.PART_SIZE)
    tables = {
        "nested": lambda: publish.nested_records(classified, lists, options.raw_values),
        "completed": lambda: publish.completed_products(classified),
        "validation": lambda: replies.validation_stats(classified),
        "metadata": lambda: publish.run_metadata(
            classified,
            spark.read.parquet(f"{folder}/token_usage"),
            options.token_budget,
            options.batch_size,
        ),
        "schema_master": lambda: publish.schema_master(firsts),
        "shipment_attributes": lambda: publish.shipment_attributes(ordered, ["ord._at", "ord._tie"]),
    }
    status = [(version, "flat", None)]
    for name, table in tables.items():
        try:
            publish.write_table(table(), f"{base}/{name}")
        except Exception as problem:
            if name not in HELPERS:
                raise
            LOG.warning("table %s of version %s failed: %s", name, version, problem)
            status.append((version, name, str(problem)))
        else:
            status.append((version, name, None))
    publish.write_table(spark.createDataFrame(status, STATUS).coalesce(1), f"{folder}/manifest", mode="append")
    return published(spark, folder)


def published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the last complete version, and ``status``: its tables with their errors."""
    manifest = spark.read.schema(STATUS).parquet(f"{folder}/manifest")
    version = manifest.agg(F.max("version")).first()[0]
    status = manifest.where(F.col("version") == version)
    sound = [r["name"] for r in status.where("error IS NULL").collect()]
    tables = {name: spark.read.parquet(f"{folder}/published/{version}/{name}") for name in sound}
    # The heading is the folder's name, which stays text, leading zeros included.
    rest = [f for f in tables["flat"].schema if f.name != "hs_code"]
    shape = T.StructType([T.StructField("hs_code", T.StringType()), *rest])
    flat = spark.read.schema(shape).parquet(f"{folder}/published/{version}/flat")
    return {**tables, "flat": flat.select(*shape.names).drop("ord"), "status": status}


def run(
    spark: SparkSession,
    raw: DataFrame | None,
    folder: str,
    *,
    run_id: str,
    attr_dict: DataFrame | None = None,
    definition: Sequence[tuple[str, str | None]] = (),
    attr_defs: DataFrame | None = None,
    scorer: Callable[[list[str]], list[str]] | None = None,
    answer: Callable[[DataFrame], DataFrame] | None = None,
    infer_hs: str | None = None,
    answer_products: Callable[[DataFrame], DataFrame] | None = None,
    answer_attributes: Callable[[DataFrame], DataFrame] | None = None,
    options: Options | None = None,
) -> dict[str, DataFrame]:
    """Run the chosen stages on tables under ``folder``; returns the published tables.

    ``answer`` turns the attribute requests into replies (any batch-inference job);
    without it only batches the dictionary settles are classified. ``infer_hs``
    infers the dictionary of a heading from labelled rows, and its categories, too,
    where ``answer_products`` is given. A skipped stage needs its table from an
    earlier run; an error ends the run, but that of a helper table is recorded in ``status``.
    """
    options = options or Options()
    stages = set(options.stages)
    if infer_hs and "label" not in stages:
        raise ValueError("inferring a dictionary needs the label stage")
    if "load" in stages:
        load(raw, f"{folder}/shipments")
    if infer_hs and answer_products is not None:
        rows = spark.read.parquet(f"{folder}/shipments")
        definition = infer_definition(rows, infer_hs, answer_products, options)
    if "label" in stages:
        if not definition:
            raise ValueError("the label stage needs at least one product category")
        label_stage(spark, folder, definition, scorer, options)
    if infer_hs:
        labelled = spark.read.parquet(f"{folder}/labelled")
        schema = infer_dictionary(labelled, infer_hs, definition, answer_attributes, options)
        publish.write_table(schema, f"{folder}/inferred_schema")
        schema = spark.read.parquet(f"{folder}/inferred_schema")
        if schema.isEmpty():
            raise ValueError("no attributes could be inferred")
        attr_dict = infer.inferred_dictionary(schema)
        attr_defs = infer.inferred_definitions(schema, [c for c, _ in definition])
    if "extract" in stages:
        extract_stage(spark, folder, run_id, attr_dict, attr_defs, answer, options)
    if "publish" in stages:
        return publish_stage(spark, folder, attr_dict, options)
    return {}
