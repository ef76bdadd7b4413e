"""Every operator as a query over the test tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplabel.functions import text as X
from shiplabel.operators import batches as B
from shiplabel.operators import infer as I
from shiplabel.operators import labels as L
from shiplabel.operators import matching as M
from shiplabel.operators import profiles
from shiplabel.operators import publish as P
from shiplabel.operators import replies as R
from shiplabel.operators import requests as Q
from shiplabel.operators.dictionary import KEY, attach_dictionary, compile_values
from shiplabel.operators.scale import checkpoint_folder, durable
from shiplabel.plans import runs
from shiplabel.plans import views as V
from shiplabel.sources import config as C
from shiplabel.sources import published
from shiplabel.sources import shipments as S
from shiplabel.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
GOODS = [*KEY, "goods_shipped"]
BATCH = [*KEY, "batch_no"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows with a description, as extraction reads them."""
    return S.with_goods(S.classified_input(V.shipments(spark, sf_dir)))


def items(spark: SparkSession, sf_dir: str, only=tuple(V.ATTRIBUTES), size: int = B.BATCH_SIZE) -> DataFrame:
    """Batched distinct descriptions with what they state."""
    known = V.attr_dict(spark, only)
    goods = rows(spark, sf_dir).select(*GOODS).distinct()
    batched = B.number_batches(goods.join(known.select(*KEY).distinct(), KEY, "left_semi"), size)
    # requests and replies both start from the items
    return durable(R.gate_batches(M.match_goods(batched, known)))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat rows with their per-product file, from the dictionary alone."""
    known = V.attr_dict(spark)
    matched = M.match_rows(rows(spark, sf_dir), known, derive={"attributes": M.full_map()})
    return P.per_product(matched, list(V.ATTRIBUTES))


# --- sources -----------------------------------------------------------------


@query
def clean_shipments(spark, sf_dir):
    return S.clean(V.shipments(spark, sf_dir)).select("ord", "hs_code", "goods_shipped", "shipment_id")


@query
def filtered_scan(spark, sf_dir):
    loaded = S.load_table(V.shipments(spark, sf_dir), {"hs_code": "901110000", "transport_method": "A"})
    return loaded.select("ord", "hs_code", "goods_shipped", "shipment_id", "transport_method")


@query
def profile_shipments(spark, sf_dir):
    return S.profile(S.clean(V.shipments(spark, sf_dir)))


@query
def product_def(spark, sf_dir):
    return C.product_definitions(V.definition_documents(spark, sf_dir))


@query
def attr_dict(spark, sf_dir):
    return C.attribute_dictionary(V.schema_documents(spark, sf_dir))


@query
def classified_input(spark, sf_dir):
    return S.classified_input(V.shipments(spark, sf_dir), hs_rule="trunc")


@query
def generated_shipment_ids(spark, sf_dir):
    return S.classified_input(V.shipments(spark, sf_dir).drop("shipment_id"))


# --- scalar functions --------------------------------------------------------


@query
def hs4_codes(spark, sf_dir):
    part = V.table(spark, sf_dir, "part")
    code = F.explode(
        F.array(
            F.col("p_partkey").cast("string"),
            F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(".10")),
            F.concat(F.col("p_partkey").cast("string"), F.lit("1100000")),
            F.col("p_brand"),
            F.col("p_type"),
        )
    )
    return (
        part.select(code.alias("code"))
        .distinct()
        .select(
            "code",
            X.hs4_trunc("code").alias("by_position"),
            X.hs4_digits("code").alias("by_digits"),
            X.drop_leading_zeros(F.concat(F.lit("0"), "code")).alias("as_number"),
        )
    )


@query
def norm_text(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select("doc_id", X.norm_text("text").alias("norm"))


@query
def file_names(spark, sf_dir):
    product = F.concat(F.col("p_type"), F.lit(" "), "p_name", F.lit("/"), "p_brand", F.lit("  é-x.y"))
    named = V.table(spark, sf_dir, "part").select(product.alias("product")).distinct()
    file = X.product_file(F.lit("9011"), "product")
    return named.select(
        "product",
        file.alias("file"),
        X.product_from_file(file).alias("from_file"),
        X.product_from_file(F.concat(F.lit("/a_b/"), "product")).alias("from_other"),
    )


@query
def snake_names(spark, sf_dir):
    part = V.table(spark, sf_dir, "part")
    name = F.concat(
        F.when(F.col("p_partkey") % 2 == 0, "attr_").otherwise(""),
        "p_type", F.replace(F.initcap("p_name"), F.lit(" "), F.lit("")), F.lit("-"), "p_brand", F.lit(" __Value"),
    )
    return part.select(name.alias("name")).distinct().select(
        "name",
        X.snake_acronym("name").alias("acronym"),
        X.attr_to_snake("name").alias("dropped"),
        X.attr_to_snake("name", drop_prefix=False).alias("kept"),
        X.snake_simple("name").alias("simple"),
    )


@query
def clean_values(spark, sf_dir):
    shape = F.col("p_partkey") % 9
    raw = (
        F.when(shape == 0, "None")
        .when(shape == 1, '"NaN"')
        .when(shape == 2, " n/a ")
        .when(shape == 3, F.concat(F.lit("'"), "p_name", F.lit("'")))
        .when(shape == 4, F.concat(F.lit(' "'), "p_name", F.lit('" ')))
        .when(shape == 5, "undefined")
        .when(shape == 6, "  ")
        .when(shape == 7, F.concat(F.lit("\t"), "p_brand", F.lit("\n")))
        .otherwise(F.col("p_name"))
    )
    return V.table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw")).select(
        "p_partkey", X.clean_value("raw").alias("in_summary"), X.clean_value_map("raw").alias("in_map")
    )


@query
def attr_names(spark, sf_dir):
    raw = F.concat(F.lit(" -"), "p_name", F.lit("--"), "p_type", F.lit(" "), F.lower("p_type"), F.lit("_"))
    return V.table(spark, sf_dir, "part").select(raw.alias("raw")).distinct().select("raw", X.attr_name("raw").alias("name"), X.attr_key(X.attr_name("raw")).alias("key"))


@query
def title_values(spark, sf_dir):
    values = F.array(
        "p_name", F.upper("p_name"), F.concat(F.lit("  "), "p_type", F.lit("-x  "), "p_name"), F.lit(" "), "p_brand"
    )
    return V.table(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(X.title_values(values), "|").alias("titles")
    )


@query
def value_patterns(spark, sf_dir):
    """Compiled values of a dictionary whose values are the parts' names and densities."""
    part = V.table(spark, sf_dir, "part")
    value = F.explode(
        F.array(
            "p_name",
            F.concat(F.lit(" "), F.upper("p_name"), F.lit(" ")),
            F.concat((F.col("p_size") + 480).cast("string"), F.lit(" G/L")),
            F.concat((F.col("p_size") + 90).cast("string"), F.lit("  gl")),
            F.substring("p_name", 1, 2),
        )
    )
    values = part.select(F.col("p_type").alias("product"), value.alias("value")).distinct()
    listed = values.select(
        F.lit("9011").alias("hs_code"), "product", F.lit("Any").alias("attr"), F.lit(0).alias("attr_ord"),
        "value", F.col("value").alias("value_ord"),
    )
    return compile_values(listed).select(
        "product", "value", F.col("pattern.norm").alias("norm"), F.col("pattern.density").alias("density"),
        F.array_join("pattern.numbers", ",").alias("numbers"),
    )


# --- filters and profiles ----------------------------------------------------


@query
def hs_filter(spark, sf_dir):
    kept = S.hs_filter(rows(spark, sf_dir), ["0901.11", "0904"])
    return S.with_dictionary(kept, V.attr_dict(spark)).select("ord", "hs_code")


@query
def hs4_available(spark, sf_dir):
    return S.available_headings(V.shipments(spark, sf_dir))


@query
def heading_rows(spark, sf_dir):
    return S.of_heading(V.shipments(spark, sf_dir), "9.01").select("ord", "hs_code")


@query
def category_summary(spark, sf_dir):
    return I.category_summary(V.detailed(spark, sf_dir))


@query
def top_values(spark, sf_dir):
    columns = ["shipment_origin", "transport_method", "weight_in_kg", "value_of_goods_usd", "packaging_type", "goods_shipped"]
    return I.first_values(V.detailed(spark, sf_dir), columns, 5)


@query
def category_distribution(spark, sf_dir):
    return L.category_distribution(V.shipments(spark, sf_dir))


@query
def event_distribution(spark, sf_dir):
    events = V.table(spark, sf_dir, "events")
    return L.category_distribution(events.withColumnRenamed("event_type", "category"))


@query
def dedup_stats(spark, sf_dir):
    return L.dedup_stats(V.shipments(spark, sf_dir))


def _recorded(spark: SparkSession, rows: DataFrame, listed=()) -> str:
    """Profiles of three deliveries (by shipment), the middle one recorded twice."""
    folder = f"{checkpoint_folder(spark)}/profiles-{uuid.uuid4().hex}"
    # What is recorded is joined once, not for every delivery and table.
    rows = durable(rows.select(*dict.fromkeys([*S.REQUIRED, *listed])))
    for number in (1, 0, 1, 2):
        mine = rows.where(F.pmod(F.col("shipment_id").cast("bigint"), F.lit(3)) == number)
        profiles.record(mine, folder, f"d{number}", listed=listed)
    return folder


@query
def profile_of_deliveries(spark, sf_dir):
    """The profile of all shipments, from what their deliveries left; rows are not read again."""
    return profiles.profile(spark, _recorded(spark, S.clean(V.shipments(spark, sf_dir))))


@query
def dedup_stats_of_deliveries(spark, sf_dir):
    return profiles.dedup_stats(spark, _recorded(spark, V.shipments(spark, sf_dir), ("category",)))


@query
def category_distribution_of_deliveries(spark, sf_dir):
    return profiles.distribution(spark, _recorded(spark, V.shipments(spark, sf_dir), ("category",)))


# --- dictionary matching -----------------------------------------------------


def _long(matched: DataFrame, *keys: str) -> DataFrame:
    return matched.select(*keys, F.inline("hits"))


def hits() -> dict:
    return {"hits": M.found_values()}


@query
def deterministic_match(spark, sf_dir):
    matched = M.match_rows(rows(spark, sf_dir), V.attr_dict(spark), derive=hits())
    return _long(matched, "ord", *KEY)


@query
def deterministic_match_anchored(spark, sf_dir):
    """The same matches by the join that serves dictionaries too large to broadcast."""
    matched = M.match_rows(rows(spark, sf_dir), V.attr_dict(spark), strategy="anchored", derive=hits())
    return _long(matched, "ord", *KEY)


@query
def match_of_lots(spark, sf_dir):
    """Matches against a dictionary with a value for nearly every line item: tens of thousands for each product."""
    lot = F.concat(
        "goods_shipped", F.lit(" lot "), "shipment_id", F.lit(" "), F.substring_index(F.substring_index("ord", "|", 2), "|", -1)
    )
    goods = rows(spark, sf_dir).where("hs_code = '9011'").withColumn("goods_shipped", lot)
    return _long(M.match_rows(goods, V.lots(spark, sf_dir), derive=hits()), "ord", *KEY)


@query
def density_match(spark, sf_dir):
    known = V.attr_dict(spark, ("Density",))
    return _long(M.match_rows(rows(spark, sf_dir), known, derive=hits()), "ord", *KEY)


@query
def negation_guard(spark, sf_dir):
    goods = rows(spark, sf_dir).select(*GOODS).distinct()
    known = V.attr_dict(spark)
    both = None
    for mode in ("documented", "inert"):
        matched = M.match_goods(goods, known, negation=mode)
        part = matched.select(*GOODS, F.explode("found").alias("f")).select(
            F.lit(mode).alias("mode"), *GOODS, "f.attr", "f.value", F.col("f.blocked").cast("bigint").alias("blocked")
        )
        both = part if both is None else both.unionByName(part)
    return both


@query
def match_coverage(spark, sf_dir):
    goods = rows(spark, sf_dir).select(*GOODS).distinct()
    return M.coverage(M.match_goods(goods, V.attr_dict(spark)))


DOCUMENT_VALUES = {
    "Article": ["the", "der", "les", "The Und", "des"],
    "Accent": ["où", "und", "è", "été", "für den", "que les"],
    "Number": ["100", "2024", "3.5"],
}


@query
def document_match(spark, sf_dir):
    """Matches in long, partly non-ASCII texts; the texts are read whole."""
    documents = V.table(spark, sf_dir, "documents").select(
        F.lit("0001").alias("hs_code"), F.col("source").alias("product"), F.col("text").alias("goods_shipped"), "doc_id"
    )
    listed = [
        (attr, a, value, v)
        for a, (attr, values) in enumerate(DOCUMENT_VALUES.items())
        for v, value in enumerate(values)
    ]
    values = spark.createDataFrame(listed, "attr string, attr_ord int, value string, value_ord int")
    known = (
        documents.select(*KEY).distinct()
        .select("*", F.explode(F.array(*(F.struct(*(F.lit(x) for x in entry)) for entry in listed))).alias("v"))
        .select(*KEY, *(F.col(f"v.col{i + 1}").alias(c) for i, c in enumerate(values.columns)))
    )
    matched = M.match_goods(documents, known, min_len=2)
    return _long(matched.withColumns(hits()), "doc_id")


@query
def batch_gate(spark, sf_dir):
    gated = items(spark, sf_dir, ("Item",), 3)
    return gated.select(*BATCH, "pos", "goods_shipped", M.complete().alias("complete"), "resolved")


# --- grouping and batches ----------------------------------------------------


@query
def goods_to_shipments(spark, sf_dir):
    lists = P.goods_to_shipments(rows(spark, sf_dir), part_size=20)
    return lists.withColumn("shipment_ids", F.array_join("shipment_ids", ","))


@query
def batches(spark, sf_dir):
    goods = rows(spark, sf_dir).select(*GOODS).distinct()
    table = B.batch_table(B.number_batches(goods))
    return table.select(*BATCH, "batch_size", "total_batches", "lines")


@query
def label_batches(spark, sf_dir):
    goods = L.distinct_goods(S.clean(V.shipments(spark, sf_dir)))
    return L.label_batches(goods).select("goods_shipped", "batch_no", "pos")


@query
def token_budget(spark, sf_dir):
    goods = rows(spark, sf_dir).select(*GOODS).distinct()
    costs = B.number_batches(goods).groupBy(*BATCH).agg(
        (F.floor(F.sum(F.length("goods_shipped")) / 4) + 3 * F.count("*")).cast("bigint").alias("cost")
    )
    return B.within_budget(costs, budget=2000, used=100)


@query
def token_cost(spark, sf_dir):
    goods = L.distinct_goods(S.clean(V.shipments(spark, sf_dir)))
    asked = Q.label_requests(L.label_batches(goods), V.DEFINITION)
    return asked.select("batch_no", "tokens", L.label_tokens("prompt", "batch_size").alias("cost"))


@query
def goods_per_product_limit(spark, sf_dir):
    return B.first_goods(rows(spark, sf_dir), 7).select(*GOODS, "place")


# --- label stage -------------------------------------------------------------


@query
def product_requests(spark, sf_dir):
    goods = L.distinct_goods(S.clean(V.shipments(spark, sf_dir)))
    return Q.label_requests(L.label_batches(goods), V.DEFINITION).drop("tokens")


@query
def product_labels(spark, sf_dir):
    clean = S.clean(V.shipments(spark, sf_dir))
    batched = L.label_batches(L.distinct_goods(clean))
    labelled = durable(L.read_label_replies(batched, V.label_replies(batched)))
    return L.propagate_labels(clean, labelled).select("ord", "goods_shipped", "category")


@query
def strict_labels(spark, sf_dir):
    batched = L.label_batches(L.distinct_goods(S.clean(V.shipments(spark, sf_dir))))
    allowed = [c for c, _ in V.DEFINITION if c != "PROMO"]
    labelled = L.read_label_replies(batched, V.label_replies(batched), allowed)
    return labelled.groupBy("category").agg(F.count("*").alias("goods"))


@query
def lexical_labels(spark, sf_dir):
    return runs.label(S.clean(V.shipments(spark, sf_dir)), V.DEFINITION).select("ord", "category")


# --- attribute requests and replies ------------------------------------------


@query
def attribute_requests(spark, sf_dir):
    pending = items(spark, sf_dir, size=25).where(~F.col("resolved"))
    return Q.attribute_requests(pending, V.attr_dict(spark), V.definitions(spark)).drop("reply_schema")


@query
def reply_schemas(spark, sf_dir):
    pending = items(spark, sf_dir, ("Color", "Size")).where(~F.col("resolved"))
    asked = Q.attribute_requests(pending, V.attr_dict(spark, ("Color", "Size")), open_list=False)
    return asked.select(*BATCH, "reply_schema")


@query
def parse_replies(spark, sf_dir):
    replies = V.attribute_replies(items(spark, sf_dir))
    return replies.select(
        *BATCH, X.json_payload("reply").alias("payload"), X.json_object("reply").isNotNull().alias("readable")
    )


def _aligned(spark, sf_dir) -> DataFrame:
    batched = items(spark, sf_dir)
    return R.align_replies(batched, V.attribute_replies(batched))


def _normalised(spark, sf_dir, open_list=True, strategy="auto") -> DataFrame:
    aligned = _aligned(spark, sf_dir)
    texts = R.replied_texts(F.col("item"))
    attached = attach_dictionary(aligned, V.attr_dict(spark), strategy=strategy, replied=texts)
    return R.normalise_replies(attached, open_list)


def _judged(df: DataFrame, *fields: str) -> DataFrame:
    long = df.select(*GOODS, "status", F.explode("replied").alias("r"))
    return long.select(*GOODS, "status", "r.attr", "r.value", *(f"r.{f}" for f in fields))


@query
def reply_alignment(spark, sf_dir):
    return _aligned(spark, sf_dir).select(*BATCH, "pos", "goods_shipped", "status", "preview_ok")


@query
def normalize_replies(spark, sf_dir):
    return _judged(_normalised(spark, sf_dir), "custom", "out_of_schema", "invalid")


@query
def normalize_replies_closed(spark, sf_dir):
    return _judged(_normalised(spark, sf_dir, open_list=False), "custom", "out_of_schema", "invalid")


@query
def normalize_replies_anchored(spark, sf_dir):
    return _judged(_normalised(spark, sf_dir, strategy="anchored"), "custom", "out_of_schema", "invalid")


@query
def merge_values(spark, sf_dir):
    return _judged(R.merge_values(_normalised(spark, sf_dir)), "custom")


@query
def heuristic_fill(spark, sf_dir):
    merged = R.merge_values(_normalised(spark, sf_dir))
    return _judged(R.fill_missing(merged), "filled")


def _records(spark, sf_dir, open_list=True) -> DataFrame:
    merged = R.merge_values(_normalised(spark, sf_dir, open_list))
    return R.records(R.fill_missing(merged))


@query
def validation_stats(spark, sf_dir):
    return R.validation_stats(_records(spark, sf_dir, open_list=False))


# --- publication -------------------------------------------------------------


@query
def flat_attributes(spark, sf_dir):
    known = V.attr_dict(spark)
    matched = M.match_rows(rows(spark, sf_dir), known, derive={"attributes": M.full_map()})
    return P.flat_attributes(matched, P.attribute_names(known))


@query
def wide_per_product(spark, sf_dir):
    records = durable(_records(spark, sf_dir))
    published = P.with_shipments(records, P.goods_shipments(rows(spark, sf_dir)))
    return P.per_product(published, list(V.ATTRIBUTES), flags=True)


@query
def nested_results(spark, sf_dir):
    lists = P.goods_to_shipments(rows(spark, sf_dir), part_size=20)
    return P.nested_records(_records(spark, sf_dir), lists)


@query
def completed_products(spark, sf_dir):
    return P.completed_products(_records(spark, sf_dir))


@query
def schema_master(spark, sf_dir):
    known = V.attr_dict(spark)
    # a file's values follow from its distinct descriptions and where each is first seen
    first = rows(spark, sf_dir).groupBy(*GOODS).agg(F.min("ord").alias("ord")).withColumn("shipment_id", F.lit(""))
    matched = M.match_goods(first, known).withColumn("attributes", M.full_map())
    return P.schema_master(P.per_product(matched, list(V.ATTRIBUTES)))


@query
def folder_schema_master(spark, sf_dir):
    """The schema summary of the per-product files, written and read back."""
    folder = f"{checkpoint_folder(spark)}/files-{uuid.uuid4().hex}"
    P.export_per_product(wide(spark, sf_dir), V.attr_dict(spark), folder)
    return published.folder_schema_master(spark, folder)


@query
def shipment_attributes(spark, sf_dir):
    merged = P.shipment_attributes(wide(spark, sf_dir))
    return merged.select("shipment_id", "product", F.to_json("attrs").alias("attrs_json"))


@query
def conversation_attributes(spark, sf_dir):
    """Ordered merge over another table: the last turn that has a value wins."""
    turns = V.table(spark, sf_dir, "conversations").select(
        F.lit("f").alias("file"),
        F.col("turn").alias("ord"),
        F.col("conv_id").cast("string").alias("shipment_id"),
        F.col("role").alias("product"),
        F.col("role").alias("attr_LastRole"),
        F.when(F.col("turn") % 2 == 1, F.col("text")).otherwise(F.lit("none")).alias("attr_Last reply"),
        F.when(F.col("turn") == 0, F.length("text").cast("string")).alias("attr_first-length"),
    )
    merged = P.shipment_attributes(turns)
    return merged.select(
        "shipment_id", "product", *(F.col("attrs")[k].alias(k) for k in ("last_role", "last_reply", "first_length"))
    )


@query
def run_metadata(spark, sf_dir):
    batched = items(spark, sf_dir)
    replied = V.attribute_replies(batched)
    costs = replied.select(Q.request_cost(F.lit(""), "reply").alias("cost"))
    return P.run_metadata(_records(spark, sf_dir), costs, 20_000, B.BATCH_SIZE)


# --- inference ---------------------------------------------------------------


@query
def goods_sample(spark, sf_dir):
    clean = S.clean(V.shipments(spark, sf_dir)).withColumn("hs4", X.hs4_digits("hs_code"))
    of_heading = I.sample_goods(clean, "hs4").withColumnRenamed("hs4", "group")
    per_category = I.sample_goods(clean, "category", 40).withColumnRenamed("category", "group")
    return of_heading.unionByName(per_category)


@query
def inference_requests(spark, sf_dir):
    detailed = V.detailed(spark, sf_dir)
    samples = I.sample_goods(S.clean(detailed), "category", 15)
    return Q.attribute_inference_requests(samples, I.category_summary(detailed), "0901")


@query
def product_inference_requests(spark, sf_dir):
    clean = S.clean(V.shipments(spark, sf_dir)).withColumn("hs4", X.hs4_digits("hs_code"))
    return Q.product_inference_requests(I.sample_goods(clean, "hs4", 25))


@query
def inferred_products(spark, sf_dir):
    found = I.inferred_products(V.product_replies(spark, sf_dir))
    return found.withColumn("representatives", F.array_join("representatives", ","))


@query
def fallback_attributes(spark, sf_dir):
    existing = I.read_attribute_replies(V.schema_replies(spark, sf_dir))
    found = I.fallback_attributes(V.detailed(spark, sf_dir), existing)
    return found.select("category", "attr", "definition", F.array_join("values", "|").alias("values"))


@query
def inferred_schema(spark, sf_dir):
    schema = I.inferred_schema(V.detailed(spark, sf_dir), V.schema_replies(spark, sf_dir))
    return schema.withColumn("values", F.array_join("values", "|"))


@query
def inferred_definitions(spark, sf_dir):
    schema = I.inferred_schema(V.detailed(spark, sf_dir), V.schema_replies(spark, sf_dir))
    return I.inferred_definitions(schema, [c for c, _ in V.DEFINITION])


@query
def inference_telemetry(spark, sf_dir):
    schema = I.inferred_schema(V.detailed(spark, sf_dir), V.schema_replies(spark, sf_dir))
    return I.telemetry(schema).withColumn("fallback_attributes", F.array_join("fallback_attributes", ","))


# --- incremental runs --------------------------------------------------------


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Events as two deliveries: the type is the product, its rounded value the text."""
    events = V.table(spark, sf_dir, "events").select(
        F.lit("0001").alias("hs_code"),
        F.col("event_type").alias("product"),
        F.concat(F.lit("value "), F.floor("value").cast("string")).alias("goods_shipped"),
        F.col("user_id").cast("string").alias("shipment_id"),
        "event_id",
    )
    first = F.col("ts") < F.lit("2024-01-12").cast("timestamp")
    return events.where(first), events.where(~first)


@query
def pending_goods(spark, sf_dir):
    earlier, later = _halves(spark, sf_dir)
    return P.pending_goods(later, earlier.select(*GOODS).distinct())


@query
def merge_shipments(spark, sf_dir):
    earlier, later = _halves(spark, sf_dir)
    return P.merge_shipments(earlier.select(*GOODS, "shipment_id"), later)


def _two_deliveries(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Published tables of two runs: line items of even orders, then those of odd ones."""
    folder = f"{checkpoint_folder(spark)}/runs-{uuid.uuid4().hex}"
    labelled = S.clean(V.shipments(spark, sf_dir))
    options = runs.Options(dictionary_only=True, stages=("extract", "publish"))
    tables = {}
    for number in range(2):
        mine = labelled.where(F.col("shipment_id").cast("bigint") % 2 == number)
        P.write_table(mine, f"{folder}/labelled")
        tables = runs.run(
            spark, None, folder, run_id=f"r{9 + number}", attr_dict=V.attr_dict(spark), options=options
        )
    return tables


@query
def run_shipment_map(spark, sf_dir):
    """The shipment map after two runs: of a shipment's rows the last in (file, run, description) order counts."""
    merged = _two_deliveries(spark, sf_dir)["shipment_attributes"]
    return merged.select("shipment_id", "product", F.to_json("attrs").alias("attrs_json"))


@query
def run_shipment_lists(spark, sf_dir):
    """Shipments of each description after two runs: runs one after the other, rows as they were read."""
    found = _two_deliveries(spark, sf_dir)["nested"].select(
        "key", "goods_shipped", "part", F.get_json_object("record", "$.shipment_ids").alias("ids")
    )
    return found.select("key", "goods_shipped", "part", F.array_join(F.from_json("ids", "array<string>"), ",").alias("shipment_ids"))


@query
def two_streamed_deliveries(spark, sf_dir):
    """Stated values of each recorded shipment, after line items of even and of odd orders have been streamed."""
    lines = rows(spark, sf_dir).select(*GOODS, "shipment_id")
    even = F.col("shipment_id").cast("bigint") % 2 == 0
    out = incremental.run_deliveries(spark, [lines.where(even), lines.where(~even)], V.attr_dict(spark))
    return out.select(*GOODS, "shipment_id", F.explode("attributes").alias("attr", "value")).where(F.col("value") != X.NO_VALUE)


@query
def csv_round_trip(spark, sf_dir):
    """Shipments written as CSV and read back, cleaned."""
    path = f"{checkpoint_folder(spark)}/csv-{uuid.uuid4().hex}"
    columns = ["ord", "hs_code", "goods_shipped", "shipment_id"]
    P.write_table(V.shipments(spark, sf_dir).select(*columns), path, "csv")
    return S.clean(S.read_csv(spark, path)).select(*columns)


@query
def streamed_match(spark, sf_dir):
    """Matches of line items that arrive as a stream, through to a table."""
    return incremental.match_available(spark, sf_dir)
