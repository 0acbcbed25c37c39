"""Recommendation runs: serving, evaluation, and either with text ids."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.functions.measures import Measure
from affinia.operators.evaluate import (
    evaluation_means,
    hit_counts,
    precision_recall_points,
    ranking_metrics,
    train_test_split,
)
from affinia.operators.ids import decode_ids, decode_recs, encode_ids, id_dictionary
from affinia.operators.interactions import rating_matrix
from affinia.operators.recommend import recommend
from affinia.operators.similarity import item_similarity, most_similar_pairs
from affinia.operators.stats import histogram
from affinia.session import cut_lineage, run_scratch
from affinia.sources.results import (
    EVALUATION_CHECKLIST,
    ITEM_SIMILARITIES,
    RECOMMEND_RESULTS,
    STATISTICS_RESULTS,
    STATISTICS_ROWS,
    evaluation_checklist,
    recommend_results,
    statistics_results,
    write_tables,
)


@dataclass(frozen=True)
class RecommendOptions:
    """Options of a recommendation run; the defaults are the usual ones.

    ``max_prefs_in_similarity`` samples heavier users down before items are paired;
    by default all of their items are paired.
    """

    measure: str | Measure = "cooccurrence"
    n: int = 10
    boolean: bool = False
    k: int = 100
    threshold: float | None = None
    min_prefs_per_user: int = 1
    max_prefs_in_similarity: int | None = None
    max_prefs: int | None = None
    users: DataFrame | None = None
    items: DataFrame | None = None
    exclude: DataFrame | None = None
    seed: int | str = 42
    on_duplicate: str | None = "max"

    def matrix(self, ui: DataFrame) -> DataFrame:
        return rating_matrix(ui, self.boolean, self.min_prefs_per_user, self.on_duplicate)

    def similarities(self, prefs: DataFrame) -> DataFrame:
        return item_similarity(prefs, self.measure, self.k, self.threshold, self.max_prefs_in_similarity, self.seed)

    def recommendations(self, prefs: DataFrame, similar: DataFrame) -> DataFrame:
        return recommend(
            prefs,
            similar,
            self.n,
            self.boolean,
            self.max_prefs,
            users=self.users,
            items=self.items,
            exclude=self.exclude,
        )


def recommend_run(
    ui: DataFrame,
    batch_id: str,
    options: RecommendOptions = RecommendOptions(),
    base: str | None = None,
    text_ids: Sequence[str] = (),
    export_similarities: bool = False,
) -> dict[str, DataFrame]:
    """Recommendation tables by name; with ``base`` also written.

    ``text_ids`` names the columns (``user``, ``item``) to replace by dense indexes
    while computing; results carry the original ids again. The lists in ``options``
    use the original ids too.
    """
    with run_scratch(ui.sparkSession, "recommend", base is not None):
        dictionaries = {column: id_dictionary(ui, column) for column in text_ids}

        def encoded(df: DataFrame | None) -> DataFrame | None:
            if df is None:
                return None
            for column in dictionaries:
                if column in df.columns:
                    df = encode_ids(df, dictionaries[column], column)
            return df

        options = replace(
            options, users=encoded(options.users), items=encoded(options.items), exclude=encoded(options.exclude)
        )
        prefs = cut_lineage(options.matrix(encoded(ui)))  # read by the similarities and the recommendations
        similar = options.similarities(prefs)
        if export_similarities:
            similar = cut_lineage(similar)
        recs = options.recommendations(prefs, similar)
        items = dictionaries.get("item")
        tables = {RECOMMEND_RESULTS: recommend_results(decode_recs(recs, dictionaries.get("user"), items), batch_id)}
        if export_similarities:
            pairs = most_similar_pairs(similar)
            if items is not None:
                # The index follows the order of the ids, so the smaller id stays first.
                pairs = decode_ids(decode_ids(pairs, items, "item_a"), items, "item_b")
            tables[ITEM_SIMILARITIES] = pairs
        return write_tables(tables, base, batch_id)


def evaluate_run(
    ui: DataFrame,
    batch_id: str,
    options: RecommendOptions = RecommendOptions(),
    train_fraction: float = 0.7,
    base: str | None = None,
    include_missing: bool = False,
) -> dict[str, DataFrame]:
    """Split, recommend from the train rows, and measure against the test rows.

    Returns the evaluation checklist and the statistics (precision-recall points with
    the means, F1 histogram) by table name; with ``base`` also written. The split feeds
    both sides of the measurement and the metrics feed every table; both are written once.
    """
    with run_scratch(ui.sparkSession, "evaluate", base is not None):
        unique = rating_matrix(ui, options.boolean, on_duplicate=options.on_duplicate)
        parts = cut_lineage(train_test_split(unique, train_fraction, options.seed))
        train = parts.where(F.col("split") == "train").drop("split")
        test = parts.where(F.col("split") == "test")
        options = replace(options, on_duplicate=None)
        prefs = cut_lineage(options.matrix(train))
        recs = options.recommendations(prefs, options.similarities(prefs))
        metrics = cut_lineage(ranking_metrics(hit_counts(recs, test, include_missing)))

        points = precision_recall_points(metrics).select(
            F.lit("precision_recall").alias("kind"),
            F.format_string("%.4f:%.4f", "precision", "recall").alias("key"),
            F.lit(None).cast("bigint").alias("n"),
        )
        f1 = histogram(metrics, "f1", 1).select(
            F.lit("f1_histogram").alias("kind"), F.format_string("%.1f", "bucket").alias("key"), "n"
        )
        means = evaluation_means(metrics).select(
            F.lit("precision_recall").alias("kind"),
            F.format_string("%.5f,%.5f,%.5f", "mean_precision", "mean_recall", "mean_f1").alias("quota_mean"),
        )
        tables = {
            EVALUATION_CHECKLIST: evaluation_checklist(metrics, batch_id),
            STATISTICS_RESULTS: statistics_results(points.unionByName(f1), batch_id, means),
            STATISTICS_ROWS: points.unionByName(f1),
        }
        return write_tables(tables, base, batch_id)
