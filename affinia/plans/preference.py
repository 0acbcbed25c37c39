"""Preference run: merged criteria, scores, preference lists, popularity, histogram."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.operators.interactions import ROWS_PER_BLOCK
from affinia.operators.preference import merge_criteria, preference_lists, preference_scores
from affinia.operators.stats import histogram, item_popularity
from affinia.session import cut_lineage, run_scratch
from affinia.sources.results import (
    RECOMMEND_RESULTS,
    STATISTICS_RESULTS,
    STATISTICS_ROWS,
    item_list_results,
    statistics_results,
    write_tables,
)


def preference_run(
    df: DataFrame,
    criteria: Sequence[str],
    batch_id: str,
    base: str | None = None,
    max_list: int = ROWS_PER_BLOCK,
) -> dict[str, DataFrame]:
    """Preference lists and statistics by table name; with ``base`` also written.

    The merged rows feed the statistics and the scores, the scores feed every table;
    both are written once. With ``base`` the run's scratch tables are removed.
    """
    with run_scratch(df.sparkSession, "preference", base is not None):
        merged = cut_lineage(merge_criteria(df, criteria))
        scores = cut_lineage(preference_scores(merged, criteria))
        lists = preference_lists(scores, max_list).withColumn(
            "item_list", F.transform("prefs", lambda p: F.concat_ws(":", p["item"].cast("string"), p["score"].cast("string")))
        )
        popularity = item_popularity(scores).select(
            F.lit("item_popularity").alias("kind"), F.col("item").cast("string").alias("key"), "n"
        )
        score_counts = histogram(scores, "score", 2).select(
            F.lit("score_histogram").alias("kind"), F.format_string("%.2f", "bucket").alias("key"), "n"
        )
        counts = popularity.unionByName(score_counts)
        tables = {
            RECOMMEND_RESULTS: item_list_results(lists, "user", batch_id),
            STATISTICS_RESULTS: statistics_results(counts, batch_id),
            STATISTICS_ROWS: counts,
        }
        return write_tables(tables, base, batch_id)
