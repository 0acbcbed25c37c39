"""Preference scores from several raw criteria: entropy weights and logistic z-scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.operators.interactions import ROWS_PER_BLOCK, item_lists, ranked_rows

SCALE = 5.0


def merge_criteria(df: DataFrame, criteria: Sequence[str]) -> DataFrame:
    """One row per (user, item) with each criterion summed."""
    return df.groupBy("user", "item").agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in criteria])


def _x_ln_x(c: str) -> Column:
    x = F.col(c)
    negative = F.raise_error(F.lit(f"criterion {c} is negative; entropy weights need values of 0 or more"))
    return F.when(x > 0, x * F.ln(x)).when(x < 0, negative.cast("double")).otherwise(F.lit(0.0))


def criteria_row(merged: DataFrame, criteria: Sequence[str]) -> DataFrame:
    """All statistics of all criteria as one row, column ``stats``: an array of structs in
    the order of ``criteria``. Sums, means, deviations and entropies come from one pass.

    The entropy of a criterion is sum(f ln f) / ln N with f = x / sum(x), written as
    (sum(x ln x) / S - ln S) / ln N so that it needs no second pass.
    """
    many = len(criteria) > 1
    sums = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(criteria):
        sums += [
            F.sum(c).alias(f"total{i}"),
            F.avg(c).alias(f"mean{i}"),
            F.stddev_pop(c).alias(f"stddev{i}"),
            (F.sum(_x_ln_x(c)) if many else F.lit(None).cast("double")).alias(f"xlnx{i}"),
        ]
    row = merged.agg(*sums).where(F.col("n") > 0)
    ln_n = F.ln(F.col("n").cast("double"))
    for i in range(len(criteria)):
        total = F.col(f"total{i}")
        # A criterion that is zero everywhere tells items apart as little as a uniform one.
        entropy = F.when(total > 0, (F.col(f"xlnx{i}") / total - F.ln(total)) / ln_n).otherwise(F.lit(-1.0))
        row = row.withColumn(f"entropy{i}", F.when((F.col("n") > 1) & F.lit(many), entropy))
    m = len(criteria)
    if many:
        spare = F.lit(float(m)) + sum((F.col(f"entropy{i}") for i in range(1, m)), F.col("entropy0"))
        # One row, or every criterion uniform: nothing to prefer one criterion for.
        weights = [
            F.when((F.col("n") > 1) & (F.abs(spare) > 1e-12), (1.0 + F.col(f"entropy{i}")) / spare).otherwise(
                F.lit(1.0 / m)
            )
            for i in range(m)
        ]
    else:
        weights = [F.lit(1.0)]
    structs = [
        F.struct(
            F.lit(c).alias("criterion"),
            F.col("n"),
            F.col(f"total{i}").alias("total"),
            F.col(f"mean{i}").alias("mean"),
            F.col(f"entropy{i}").alias("entropy"),
            weights[i].alias("weight"),
            F.col(f"stddev{i}").alias("stddev"),
        )
        for i, c in enumerate(criteria)
    ]
    return row.select(F.array(*structs).alias("stats"))


def criteria_stats(merged: DataFrame, criteria: Sequence[str]) -> DataFrame:
    """One row per criterion: ``criterion, n, total, mean, entropy, weight, stddev``."""
    return criteria_row(merged, criteria).select(F.inline("stats"))


def entropy_weights(merged: DataFrame, criteria: Sequence[str]) -> DataFrame:
    """Weight of each criterion; the weights sum to 1."""
    return criteria_stats(merged, criteria).select("criterion", "weight")


def _z(c: str, s: Column) -> Column:
    # A constant criterion has no deviation; every value then sits on its mean.
    return F.when(s["stddev"] > 0, (F.col(c) - s["mean"]) / s["stddev"]).otherwise(F.lit(0.0))


def zscores(merged: DataFrame, criteria: Sequence[str]) -> DataFrame:
    """Population z-score of each criterion, in columns named ``z_<criterion>``."""
    stats = criteria_row(merged, criteria).scalar()
    return merged.select("user", "item", *[_z(c, stats[i]).alias(f"z_{c}") for i, c in enumerate(criteria)])


def preference_scores(merged: DataFrame, criteria: Sequence[str]) -> DataFrame:
    """Score strictly between 0 and 5 per (user, item): 5 * sum(w / (1 + exp(-z))).

    The statistics are a one-row scalar subquery, so the scores are one narrow
    projection over the merged rows.
    """
    stats = criteria_row(merged, criteria).scalar()
    terms = [stats[i]["weight"] / (1.0 + F.exp(-_z(c, stats[i]))) for i, c in enumerate(criteria)]
    return merged.select("user", "item", (SCALE * sum(terms[1:], terms[0])).alias("score"))


def preference_ranks(scores: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Scored items of each user with their rank, best first: ``user, rank, item, score``."""
    ranked = ranked_rows(scores, "user", F.struct("item", "score"), [-F.col("score"), "item"], "_pref", rows_per_block)
    return ranked.select("user", "rank", "_pref.item", "_pref.score")


def preference_lists(scores: DataFrame, max_list: int = ROWS_PER_BLOCK) -> DataFrame:
    """Scored items of each user, best first: ``user, part, prefs`` with structs of item
    and score. Part p holds the ranks from ``p * max_list + 1`` on, so the parts in order are the list."""
    entry = F.struct("item", "score")
    return item_lists(scores, "user", entry, [-F.col("score"), "item"], max_list, "prefs")
