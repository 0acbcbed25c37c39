"""Train/test evaluation of recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.operators.interactions import ROWS_PER_BLOCK
from affinia.operators.skew import rank_by_hash
from affinia.session import cut_lineage


def train_test_split(
    ui: DataFrame, train_fraction: float = 0.7, seed: int | str = 42, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Add ``split``: of a user's n rows, floor(n * fraction) are train, the rest test.

    A user with one row is all train. Rows must be unique on (user, item); the order is
    a seeded md5 of (user, item), so a split can be repeated.
    """
    if not 0.0 <= train_fraction <= 1.0:
        raise ValueError("train_fraction must lie between 0 and 1")
    ui = cut_lineage(ui)  # counted, hashed and ranked
    ranked = rank_by_hash(ui, "user", "item", seed, rows_per_block)
    in_train = (F.col("_size") == 1) | (F.col("_rank") <= F.floor(F.col("_size") * F.lit(float(train_fraction))))
    return ranked.select(*ui.columns, F.when(in_train, "train").otherwise("test").alias("split"))


def hit_counts(recs: DataFrame, test: DataFrame, include_missing: bool = False) -> DataFrame:
    """Per user: recommended items found in the test set (``n_hit``), test items
    (``n_test``) and recommended items (``n_rec``).

    Only users with both lists count; ``include_missing`` keeps test users without
    recommendations too. Both sides are marked and counted together, so no list is
    built and the counts are pre-aggregated.
    """
    marks = recs.select("user", "item", F.lit(1).alias("_rec"), F.lit(0).alias("_test")).unionByName(
        test.select("user", "item", F.lit(0).alias("_rec"), F.lit(1).alias("_test"))
    )
    found = marks.groupBy("user", "item").agg(F.max("_rec").alias("_rec"), F.max("_test").alias("_test"))
    counts = found.groupBy("user").agg(
        F.sum(F.col("_rec") * F.col("_test")).alias("n_hit"),
        F.sum("_test").cast("bigint").alias("n_test"),
        F.sum("_rec").cast("bigint").alias("n_rec"),
    )
    kept = counts.where(F.col("n_test") > 0)
    return kept if include_missing else kept.where(F.col("n_rec") > 0)


def ranking_metrics(hits: DataFrame) -> DataFrame:
    """Precision, recall and F1 per user; all zero for a user without a hit."""
    hit = F.col("n_hit") > 0
    rated = hits.withColumn(
        "precision", F.when(hit, F.col("n_hit") / F.col("n_rec")).otherwise(F.lit(0.0))
    ).withColumn("recall", F.when(hit, F.col("n_hit") / F.col("n_test")).otherwise(F.lit(0.0)))
    p, r = F.col("precision"), F.col("recall")
    return rated.withColumn("f1", F.when(hit, 2 * p * r / (p + r)).otherwise(F.lit(0.0)))


def evaluation_means(metrics: DataFrame, digits: int = 5) -> DataFrame:
    """Mean precision, recall and F1 over users."""
    return metrics.agg(*[F.round(F.avg(c), digits).alias(f"mean_{c}") for c in ("precision", "recall", "f1")])


def precision_recall_points(metrics: DataFrame, digits: int = 4) -> DataFrame:
    """Distinct (precision, recall) pairs."""
    return metrics.select(*[F.round(c, digits).alias(c) for c in ("precision", "recall")]).distinct()
