"""Association run: baskets, frequent pairs, associated items, lift, lift histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.operators.itemsets import associated_items, associated_lists, basket_rows, pair_lift
from affinia.operators.stats import histogram
from affinia.session import cut_lineage, run_scratch
from affinia.sources.results import (
    EVALUATION_CHECKLIST,
    RECOMMEND_RESULTS,
    STATISTICS_RESULTS,
    STATISTICS_ROWS,
    item_list_results,
    lift_checklist,
    statistics_results,
    write_tables,
)


def association_run(
    ui: DataFrame,
    batch_id: str,
    min_support: int = 100,
    k: int = 50,
    base: str | None = None,
) -> dict[str, DataFrame]:
    """Result tables of an association run, by table name; with ``base`` also written.

    The lifted pairs feed all tables and are computed once. With ``base`` the run's scratch tables are removed.
    """
    with run_scratch(ui.sparkSession, "association", base is not None):
        lifted = cut_lineage(pair_lift(basket_rows(ui), min_support))
        lists = associated_lists(associated_items(lifted, k))
        lift_counts = histogram(lifted, "lift", 1).select(
            F.lit("lift_histogram").alias("kind"), F.format_string("%.1f", "bucket").alias("key"), "n"
        )
        tables = {
            RECOMMEND_RESULTS: item_list_results(lists.withColumn("part", F.lit(0)), "item", batch_id),
            EVALUATION_CHECKLIST: lift_checklist(lifted, batch_id),
            STATISTICS_RESULTS: statistics_results(lift_counts, batch_id),
            STATISTICS_ROWS: lift_counts,
        }
        return write_tables(tables, base, batch_id)
