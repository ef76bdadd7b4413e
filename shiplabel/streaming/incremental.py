"""Matching and incremental runs on a stream of shipments."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shiplabel.operators import publish
from shiplabel.operators.dictionary import KEY, compile_values, fits_broadcast, roll_dictionary
from shiplabel.operators.matching import NEGATION_WINDOW, found_values, full_map, match_goods, stated
from shiplabel.operators.scale import checkpoint_folder, durable, skew_join
from shiplabel.plans import views
from shiplabel.sources import shipments as S

GOODS = [*KEY, "goods_shipped"]
# Tasks that the rows of one key are dealt to before its first row is chosen.
SALTS = 64


def match_stream(stream: DataFrame, attr_dict: DataFrame, negation: str = "documented") -> DataFrame:
    """Stated values of arriving rows, without state.

    ``stream`` has ``hs_code, product, goods_shipped`` and further columns. A small
    dictionary is broadcast; a larger one, rolled to a row for each product, is joined
    as a static table. Either way a row meets its product's values by key.
    """
    if fits_broadcast(attr_dict):
        return match_goods(stream, attr_dict, negation=negation, strategy="broadcast")
    rolled = durable(roll_dictionary(compile_values(attr_dict)))
    found = stated(F.col("attrs"), F.col("goods_shipped"), negation, NEGATION_WINDOW)
    return stream.join(rolled, KEY).withColumn("found", found).drop("attrs")


@dataclass
class Runs:
    """The two queries of an incremental run; each has its own state, kept by key."""

    goods: StreamingQuery
    shipments: StreamingQuery

    def awaitTermination(self) -> None:  # noqa: N802
        self.goods.awaitTermination()
        self.shipments.awaitTermination()

    def stop(self) -> None:
        self.goods.stop()
        self.shipments.stop()


def first_arrivals(stream: DataFrame, key: list[str]) -> DataFrame:
    """The first row of each key, over all micro-batches.

    What has arrived is looked up in the state store by key, so a batch costs what its own rows
    cost, however many came before. Rows of a key are dealt to SALTS tasks first, of which each
    lets one through, so that a key with a large share of all rows does not meet in one task.
    """
    salt = F.pmod(F.xxhash64(*[c for c in stream.columns if c not in key] or key), F.lit(SALTS))
    few = stream.withColumn("_salt", salt).dropDuplicates([*key, "_salt"]).drop("_salt")
    return few.dropDuplicates(key)


def run_incrementally(
    stream: DataFrame,
    attr_dict: DataFrame,
    folder: str,
    checkpoint: str,
    negation: str = "documented",
    trigger: dict | None = None,
) -> Runs:
    """Classify new descriptions of each micro-batch and record new shipments of all.

    A description is matched in the first batch that brings it; a description's shipment is
    recorded once, with the first batch that brings it. Both are decided by keyed state, so no batch
    reads what earlier ones have written. Each batch writes its own sub-folder, so a
    repeated batch replaces itself. For state beyond memory choose the RocksDB state store
    (``spark.sql.streaming.stateStore.providerClass``).
    """
    known = attr_dict.select(*KEY).distinct()
    arrived = S.with_goods(stream).join(known, KEY, "left_semi").select(*GOODS, "shipment_id")

    def classify(goods: DataFrame, batch_id: int) -> None:
        matched = match_goods(goods.select(*GOODS), attr_dict, negation=negation)
        publish.write_table(
            matched.select(*GOODS, full_map().alias("attributes")), f"{folder}/classified/batch={batch_id}"
        )

    def record(pairs: DataFrame, batch_id: int) -> None:
        publish.write_table(pairs, f"{folder}/goods_shipments/batch={batch_id}")

    def started(rows: DataFrame, process: Callable[[DataFrame, int], None], name: str) -> StreamingQuery:
        return (
            rows.writeStream.foreachBatch(process)
            .option("checkpointLocation", f"{checkpoint}/{name}")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    return Runs(
        started(first_arrivals(arrived, GOODS), classify, "goods"),
        started(first_arrivals(arrived, [*GOODS, "shipment_id"]), record, "shipments"),
    )


def run_deliveries(spark: SparkSession, deliveries: Sequence[DataFrame], attr_dict: DataFrame) -> DataFrame:
    """Stream ``deliveries`` (shipments of one shape) one after the other through :func:`run_incrementally`.

    Every run continues from the state the one before has left. Returns ``hs_code, product,
    goods_shipped, shipment_id, attributes`` of all recorded shipments.
    """
    folder = f"{checkpoint_folder(spark)}/deliveries-{uuid.uuid4().hex}"
    for number, delivery in enumerate(deliveries):
        publish.write_table(delivery, f"{folder}/in/{number}")
        stream = spark.readStream.schema(delivery.schema).option("recursiveFileLookup", True).parquet(f"{folder}/in")
        run_incrementally(stream, attr_dict, f"{folder}/out", f"{folder}/state").awaitTermination()
    tables = [spark.read.parquet(f"{folder}/out/{name}").drop("batch") for name in ("goods_shipments", "classified")]
    return skew_join(*tables, GOODS, spread_by=["shipment_id"])


def match_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the line items of the test tables through :func:`match_stream` into a table."""
    folder = f"{checkpoint_folder(spark)}/stream-{uuid.uuid4().hex}"
    lines = views.table(spark, sf_dir, "lineitem")
    stream = (
        spark.readStream.schema(lines.schema)
        .option("pathGlobFilter", "lineitem.parquet")
        .parquet(sf_dir)
    )
    rows = S.with_goods(S.classified_input(views.shipments(spark, sf_dir, lineitem=stream)))
    matched = match_stream(rows, views.attr_dict(spark))
    long = matched.select("ord", *KEY, F.inline(found_values()))
    written = (
        long.writeStream.format("parquet")
        .option("path", f"{folder}/table")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    written.awaitTermination()
    return spark.read.parquet(f"{folder}/table")
