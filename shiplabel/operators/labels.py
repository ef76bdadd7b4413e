"""The label stage: one product category for each distinct description."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplabel.functions import text as X
from shiplabel.operators.batches import BATCH_SIZE, number_batches
from shiplabel.operators.scale import skew_join

# --- fixed values -----------------------------------------------------------
UNCLASSIFIED = "Unclassified"
NOT_YET = ""
# Tokens an answered label is counted as.
TOKENS_PER_LABEL = 3
# ----------------------------------------------------------------------------


def distinct_goods(rows: DataFrame, ord_column: str = "ord") -> DataFrame:
    """``goods_shipped, first_ord, _rows`` of every distinct description."""
    return rows.groupBy("goods_shipped").agg(
        F.min(ord_column).alias("first_ord"), F.count("*").alias("_rows")
    )


def label_batches(goods: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Batches over all descriptions in first-seen order."""
    return number_batches(goods, size, groups=(), order=("first_ord", "goods_shipped"))


def read_label_replies(
    items: DataFrame, replies: DataFrame, allowed: Sequence[str] | None = None
) -> DataFrame:
    """Add ``category`` from replies ``(batch_no, reply)`` by position in the batch.

    A reply without usable ``classifications`` labels its whole batch as failed; repeated keys
    and NaN are read (:func:`~shiplabel.functions.text.reply_list`). A short reply leaves the tail unlabelled, as does a batch without reply.
    ``allowed`` additionally turns labels outside the list into failures.
    """
    labels = X.reply_list("reply", "classifications")
    read = replies.select("batch_no", F.lit(True).alias("_answered"), labels.alias("_labels"))
    label = F.get("_labels", F.col("pos").cast("int"))
    if allowed is not None:
        label = F.when(label.isin(list(allowed)) | label.isNull(), label).otherwise(UNCLASSIFIED)
    return (
        items.join(read, "batch_no", "left")
        .withColumn(
            "category",
            F.when(F.col("_answered").isNull(), NOT_YET)
            .when(F.col("_labels").isNull(), UNCLASSIFIED)
            .otherwise(F.coalesce(label, F.lit(NOT_YET))),
        )
        .drop("_answered", "_labels")
    )


def label_tokens(prompt, n_labels) -> Column:
    """Estimated tokens of one label request and its reply."""
    return X.token_estimate(prompt) + F.col(n_labels) * TOKENS_PER_LABEL


def propagate_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Each row gets the label of its description; '' where there is none.

    ``labels`` holds ``goods_shipped, category`` and, from :func:`distinct_goods`,
    optionally ``_rows``, which saves a pass over the rows.
    """
    counts = labels.select("goods_shipped", "_rows") if "_rows" in labels.columns else None
    table = labels.select("goods_shipped", "category")
    joined = skew_join(rows.drop("category"), table, ["goods_shipped"], "left", counts=counts)
    return joined.withColumn("category", F.coalesce("category", F.lit(NOT_YET)))


def words(c) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))


def lexical_label(goods, definition: Sequence[tuple[str, str | None]]) -> Column:
    """Category whose name and description share most words with a text.

    Stands in for a model where none is connected. ``definition`` lists
    (category, description) pairs; the earlier one wins a tie, no shared word
    means not classified.
    """
    entries = F.array(
        *(
            F.struct(
                F.lit(-place).alias("place"),
                F.lit(category).alias("category"),
                words(F.lit(f"{category} {description or ''}")).alias("words"),
            )
            for place, (category, description) in enumerate(definition)
        )
    )

    def score(found):
        return F.transform(
            entries,
            lambda e: F.struct(
                F.size(F.array_intersect(found, e["words"])).alias("shared"),
                e["place"].alias("place"),
                e["category"].alias("category"),
            ),
        )

    best = X.let(words(goods), lambda found: F.array_max(score(found)))
    return F.when(best["shared"] > 0, best["category"]).otherwise(UNCLASSIFIED)


def label_by_scorer(goods: DataFrame, scorer, size: int = 1000, failures=None) -> DataFrame:
    """``goods_shipped, category`` by a Python scorer (list of texts -> list of labels).

    The scorer runs on Arrow batches inside the tasks, wherever Spark has put them. A failed
    call leaves its texts unclassified and its error in the task's log; ``failures``, an
    accumulator, counts those texts.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), size):
                texts = frame["goods_shipped"].iloc[start : start + size].tolist()
                try:
                    labels = list(scorer(texts))[: len(texts)]
                except Exception:  # a failed call fails its batch only
                    logging.getLogger("shiplabel.labels").exception("scorer failed on %d texts", len(texts))
                    if failures is not None:
                        failures.add(len(texts))
                    labels = [UNCLASSIFIED] * len(texts)
                labels += [NOT_YET] * (len(texts) - len(labels))
                yield pd.DataFrame({"goods_shipped": texts, "category": labels})

    return goods.select("goods_shipped").mapInPandas(run, "goods_shipped string, category string")


def category_distribution(rows: DataFrame) -> DataFrame:
    """Rows and percentage (one decimal) of each category."""
    counts = rows.groupBy("category").agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("percent", F.round(100 * F.col("rows") / total, 1)).orderBy(
        F.desc("rows"), "category"
    )


def dedup_stats(rows: DataFrame) -> DataFrame:
    """Rows, distinct descriptions, their ratio, and distinct categories."""
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_distinct("goods_shipped").alias("goods"),
        F.count_distinct("category").alias("categories"),
    ).withColumn("ratio", F.round(F.try_divide("goods", "rows"), 6))
