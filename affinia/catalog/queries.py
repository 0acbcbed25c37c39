"""The registered queries: one per operator or run, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.catalog import fixtures as fx
from affinia.operators import evaluate, ids, interactions, itemsets, preference, recommend, similarity, stats
from affinia.operators.skew import top_per_group
from affinia.plans.association import association_run
from affinia.plans.preference import preference_run
from affinia.plans.recommendation import RecommendOptions, evaluate_run, recommend_run
from affinia.session import cut_lineage, scratch_path
from affinia.sources import results, text

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# One in so many baskets: for pairs, and for larger sets.
PAIR_SHARE = 49
SET_SHARE = 600
TRAIN = 0.6
BATCH = "b01"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def r6(column: str) -> Column:
    return F.round(column, 6).alias(column)


def whole(column: str) -> Column:
    return F.col(column).cast("bigint").alias(column)


# Sources and sinks


@query
def read_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.raw_path(spark, sf_dir, ["user", "item", "pref"])
    return text.read_interactions(spark, path, "\t", 0, 1, 2)


@query
def read_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.raw_path(spark, sf_dir, ["user", "item", "pref", "price"])
    return text.read_criteria(spark, path, "\t", 0, 1, "2-3")


@query
def result_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.ui_text(spark, sf_dir).select(
        results.row_key(BATCH, "user", "item").alias("target_id"), results.clean("item").alias("value"), "pref"
    )
    base = scratch_path(spark, "results")
    results.write_results(rows, base, "sink", BATCH)
    return results.read_results(spark, base, "sink", BATCH).select("batch_id", "target_id", "value", "pref")


@query
def recommend_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = results.recommend_results(_boolean_recs(spark, sf_dir), BATCH)
    return _stored(spark, table, results.RECOMMEND_RESULTS).select(
        "batch_id", "target_id", F.array_join("item_list", ",").alias("item_list")
    )


@query
def evaluation_checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = results.evaluation_checklist(_metrics(spark, sf_dir), BATCH)
    return _stored(spark, table, results.EVALUATION_CHECKLIST).select(
        "batch_id", "target_id", r6("precision"), r6("recall"), r6("f1")
    )


@query
def statistics_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _scores(spark, sf_dir)
    popularity = stats.item_popularity(scores).select(
        F.lit("item_popularity").alias("kind"), F.col("item").cast("string").alias("key"), "n"
    )
    buckets = stats.histogram(scores, "score", 2).select(
        F.lit("score_histogram").alias("kind"), F.format_string("%.2f", "bucket").alias("key"), "n"
    )
    table = results.statistics_results(popularity.unionByName(buckets), BATCH)
    return _stored(spark, table, results.STATISTICS_RESULTS).select("batch_id", "target_id", whole("part"), "keys_list")


def _stored(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    base = scratch_path(spark, "results")
    results.write_results(df, base, table, BATCH)
    return results.read_results(spark, base, table, BATCH)


# Interactions


@query
def dedupe_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.dedupe(fx.ui_dup(spark, sf_dir))


@query
def min_prefs_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.min_prefs(fx.ui(spark, sf_dir), 40)


@query
def top_prefs_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.top_prefs(fx.ui(spark, sf_dir), 10)


@query
def sample_prefs_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.sample_prefs(fx.ui(spark, sf_dir), 20, 42)


@query
def collect_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = interactions.collect_items(fx.ui(spark, sf_dir))
    return lists.select("user", whole("part"), F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


@query
def collect_items_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = interactions.collect_items(fx.ui(spark, sf_dir), max_list=7)
    return lists.select("user", whole("part"), F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


@query
def top_lines_per_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.ui_dup(spark, sf_dir).select("flag", "user", "item", "price").distinct()
    order = [F.desc("price"), F.col("user"), F.col("item")]
    return top_per_group(rows, ["flag"], order, 1_200, rows_per_block=500).withColumn("rank", whole("rank"))


# Similarity


@query
def item_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.item_stats(fx.ui(spark, sf_dir)).select(
        "item", "n", "total", "norm2", "peak", r6("mean"), r6("ssd")
    )


@query
def cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.cooccurrence(fx.ui(spark, sf_dir))


def _similar(spark: SparkSession, sf_dir: str, measure, k: int = 20) -> DataFrame:
    rows = similarity.item_similarity(fx.ui(spark, sf_dir), measure, k)
    return rows.select("item", "other", "sim", whole("rank"))


@query
def sim_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar(spark, sf_dir, "cooccurrence")


@query
def sim_tanimoto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar(spark, sf_dir, "tanimoto")


@query
def sim_loglikelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar(spark, sf_dir, "loglikelihood")


@query
def sim_city_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar(spark, sf_dir, "city_block")


@query
def sim_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar(spark, sf_dir, "cosine")


@query
def sim_pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar(spark, sf_dir, "pearson")


@query
def sim_euclidean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar(spark, sf_dir, "euclidean")


@query
def sim_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar(spark, sf_dir, fx.DICE)


@query
def similarity_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = similarity.item_similarity(fx.ui(spark, sf_dir), "tanimoto", k=None, threshold=0.05)
    return rows.select("item", "other", "sim")


@query
def similarity_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = similarity.item_similarity(fx.ui(spark, sf_dir), "tanimoto", k=None, threshold=0.08, plan="prefix")
    return rows.select("item", "other", "sim")


@query
def similarity_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = similarity.item_similarity(fx.ui(spark, sf_dir), "tanimoto", 20, rows_per_block=50, plan="pruned")
    return rows.select("item", "other", "sim", whole("rank"))


@query
def similar_items_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefs = interactions.rating_matrix(fx.ui_event(spark, sf_dir), on_duplicate=None)
    return similarity.item_similarity(prefs, "cosine", 100).select("item", "other", "sim", whole("rank"))


@query
def most_similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    similar = similarity.item_similarity(fx.ui(spark, sf_dir), "cosine", 10)
    pairs = _stored(spark, similarity.most_similar_pairs(similar), results.ITEM_SIMILARITIES)
    return pairs.select("item_a", "item_b", "sim")


# Recommendation


def _recs(spark: SparkSession, sf_dir: str, **lists) -> DataFrame:
    prefs = cut_lineage(fx.ui(spark, sf_dir))
    similar = similarity.item_similarity(prefs, "cosine", 50)
    return recommend.recommend(prefs, similar, n=10, **lists).select("user", "item", "score", whole("rank"))


def _boolean_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefs = cut_lineage(interactions.rating_matrix(fx.ui(spark, sf_dir), boolean=True, on_duplicate=None))
    similar = similarity.item_similarity(prefs, "tanimoto", 50)
    return recommend.recommend(prefs, similar, n=10, boolean=True)


@query
def recommend_rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recs(spark, sf_dir)


@query
def recommend_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boolean_recs(spark, sf_dir).select("user", "item", "score", whole("rank"))


@query
def recommend_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recs(spark, sf_dir, exclude=fx.excluded(spark, sf_dir))


@query
def recommend_for_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recs(spark, sf_dir, users=fx.served_users(spark, sf_dir))


@query
def recommend_for_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recs(spark, sf_dir, items=fx.served_items(spark, sf_dir))


@query
def explode_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = recommend.rec_lists(_boolean_recs(spark, sf_dir))
    return recommend.explode_recs(lists).select("user", "item", "score", whole("rank"))


# Ids


@query
def id_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.id_dictionary(fx.ui_text(spark, sf_dir), "item")


@query
def encode_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.ui_text(spark, sf_dir)
    encoded = ids.encode_ids(rows, ids.id_dictionary(rows, "user"), "user")
    return ids.encode_ids(encoded, ids.id_dictionary(rows, "item"), "item")


@query
def decode_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.ui_text(spark, sf_dir)
    users, items = ids.id_dictionary(rows, "user"), ids.id_dictionary(rows, "item")
    prefs = ids.encode_ids(ids.encode_ids(rows, users, "user"), items, "item")
    similar = similarity.item_similarity(prefs, "cosine", 50)
    recs = recommend.recommend(prefs, similar, n=10)
    return ids.decode_recs(recs, users, items).select("user", "item", "score", whole("rank"))


# Evaluation


def _holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.train_test_split(fx.ui(spark, sf_dir), TRAIN, 42)


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = cut_lineage(_holdout(spark, sf_dir))
    train = parts.where(F.col("split") == "train").drop("split")
    prefs = interactions.rating_matrix(train, boolean=True, on_duplicate=None)
    similar = similarity.item_similarity(prefs, "cooccurrence", 50)
    recs = recommend.recommend(prefs, similar, n=20, boolean=True)
    return evaluate.hit_counts(recs, parts.where(F.col("split") == "test"))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.ranking_metrics(_hits(spark, sf_dir))


@query
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.split_path(spark, _holdout(spark, sf_dir))
    return spark.read.parquet(path).select("user", "item", "pref", F.col("split").cast("string").alias("split"))


@query
def hit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(spark, sf_dir)


@query
def ranking_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir).select(
        "user", "n_hit", "n_test", "n_rec", r6("precision"), r6("recall"), r6("f1")
    )


@query
def evaluation_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.evaluation_means(_metrics(spark, sf_dir))


@query
def precision_recall_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.precision_recall_points(_metrics(spark, sf_dir))


@query
def f1_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(_metrics(spark, sf_dir), "f1", 1)


# Itemsets


def _support(spark: SparkSession, sf_dir: str) -> int:
    return fx.support(spark, sf_dir, PAIR_SHARE)


@query
def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = itemsets.baskets(fx.brand_rows(spark, sf_dir))
    return lists.select("basket", whole("part"), F.array_join("items", ",").alias("items"))


def _brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itemsets.basket_rows(fx.brand_rows(spark, sf_dir))


@query
def frequent_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = itemsets.frequent_itemsets(_brands(spark, sf_dir), _support(spark, sf_dir))
    return sets.select(F.array_join("items", ",").alias("items"), "freq")


@query
def itemsets_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = itemsets.frequent_itemsets(_brands(spark, sf_dir), fx.support(spark, sf_dir, SET_SHARE))
    return sets.select(F.size("items").cast("bigint").alias("size"), F.array_join("items", ",").alias("items"), "freq")


@query
def rules_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _brands(spark, sf_dir)
    sets = itemsets.frequent_itemsets(rows, fx.support(spark, sf_dir, SET_SHARE))
    rules = itemsets.association_rules(rows, sets, 0.1)
    return rules.withColumn("antecedent", F.array_join("antecedent", ","))


@query
def basket_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = itemsets.baskets(fx.brand_rows(spark, sf_dir), max_list=2)
    return lists.select("basket", whole("part"), F.array_join("items", ",").alias("items"))


@query
def associated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = itemsets.frequent_pairs(_brands(spark, sf_dir), _support(spark, sf_dir))
    return itemsets.associated_items(pairs, 10).select("item", "partner", "freq", whole("rank"))


@query
def pair_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = itemsets.pair_lift(_brands(spark, sf_dir), _support(spark, sf_dir))
    return rows.select("item_a", "item_b", "freq", "freq_a", "freq_b", r6("lift"))


@query
def association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _brands(spark, sf_dir)
    rules = itemsets.association_rules(rows, itemsets.frequent_itemsets(rows, _support(spark, sf_dir)), 0.1)
    return rules.select(
        F.array_join("antecedent", ",").alias("antecedent"),
        "consequent",
        "freq",
        r6("support"),
        r6("confidence"),
        r6("lift"),
    )


@query
def lift_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(itemsets.pair_lift(_brands(spark, sf_dir), _support(spark, sf_dir)), "lift", 1)


# Preferences


def _merged(spark: SparkSession, sf_dir: str, second: str = "price") -> DataFrame:
    rows = fx.ui_dup(spark, sf_dir).select("user", "item", F.col("pref").alias("c1"), F.col(second).alias("c2"))
    return preference.merge_criteria(rows, ["c1", "c2"])


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Read for the statistics, for the scores, and by whatever counts or ranks these.
    return preference.preference_scores(cut_lineage(_merged(spark, sf_dir)), ["c1", "c2"])


@query
def merge_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).select("user", "item", "c1", F.round("c2", 4).alias("c2"))


@query
def criteria_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.criteria_stats(_merged(spark, sf_dir, "discount"), ["c1", "c2"]).select(
        "criterion", "n", F.round("total", 2).alias("total"), r6("mean"), r6("entropy"), r6("weight"), r6("stddev")
    )


@query
def entropy_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.entropy_weights(_merged(spark, sf_dir), ["c1", "c2"]).select("criterion", r6("weight"))


@query
def zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.zscores(cut_lineage(_merged(spark, sf_dir)), ["c1", "c2"]).select("user", "item", r6("z_c1"), r6("z_c2"))


@query
def pref_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("user", "item", r6("score"))


@query
def preference_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = preference.preference_lists(_scores(spark, sf_dir))
    shown = F.transform("prefs", lambda p: F.format_string("%s:%.6f", p["item"], p["score"]))
    return lists.select("user", whole("part"), F.array_join(shown, ",").alias("prefs"))


@query
def preference_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = preference.preference_ranks(_scores(spark, sf_dir), rows_per_block=45)
    return ranked.select("user", whole("rank"), "item", r6("score"))


@query
def preference_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = preference.preference_lists(_scores(spark, sf_dir), max_list=8)
    shown = F.transform("prefs", lambda p: F.format_string("%s:%.6f", p["item"], p["score"]))
    return lists.select("user", whole("part"), F.array_join(shown, ",").alias("prefs"))


@query
def item_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.item_popularity(_scores(spark, sf_dir))


@query
def pref_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(_scores(spark, sf_dir), "score", 2)


@query
def sort_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.ui_text(spark, sf_dir).select(F.concat_ws("_", "user", "item").alias("key"), F.col("pref").cast("string").alias("value"))
    return stats.sort_by_value(rows, "value", "key")


# Whole runs: written to result tables and read back


def _read_back(spark: SparkSession, base: str, table: str, value: Column) -> DataFrame:
    rows = results.read_results(spark, base, table, BATCH)
    part = whole("part") if "part" in rows.columns else F.lit(0).cast("bigint").alias("part")
    return rows.select(F.lit(table).alias("table_name"), "target_id", part, value.alias("value"))


def _lists() -> Column:
    return F.array_join("item_list", ",")


@query
def association_run_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "association")
    association_run(fx.brand_rows(spark, sf_dir), BATCH, _support(spark, sf_dir), k=10, base=base)
    return (
        _read_back(spark, base, results.RECOMMEND_RESULTS, _lists())
        .unionByName(_read_back(spark, base, results.EVALUATION_CHECKLIST, F.format_string("%.6f", "lift")))
        .unionByName(_read_back(spark, base, results.STATISTICS_RESULTS, F.col("keys_list")))
    )


@query
def recommend_run_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "recommend")
    options = RecommendOptions(measure="loglikelihood", n=11, boolean=True, k=80)
    recommend_run(fx.ui_dup(spark, sf_dir).select("user", "item", "pref"), BATCH, options, base)
    return _read_back(spark, base, results.RECOMMEND_RESULTS, _lists())


@query
def recommend_text_ids_run_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "recommend-text")
    options = RecommendOptions(measure="cosine", n=10, k=20)
    recommend_run(fx.ui_text(spark, sf_dir), BATCH, options, base, ("user", "item"), export_similarities=True)
    pairs = results.read_results(spark, base, results.ITEM_SIMILARITIES, BATCH).select(
        F.lit(results.ITEM_SIMILARITIES).alias("table_name"),
        F.concat_ws("-", "item_a", "item_b").alias("target_id"),
        F.lit(0).cast("bigint").alias("part"),
        F.format_string("%.9f", "sim").alias("value"),
    )
    return _read_back(spark, base, results.RECOMMEND_RESULTS, _lists()).unionByName(pairs)


@query
def evaluate_run_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "evaluate")
    options = RecommendOptions(n=20, boolean=True, k=50)
    evaluate_run(fx.ui(spark, sf_dir), BATCH, options, TRAIN, base)
    scores = F.format_string("%.6f,%.6f,%.6f", "precision", "recall", "f1")
    statistics = F.concat_ws("-", "keys_list", "quota_mean")
    return _read_back(spark, base, results.EVALUATION_CHECKLIST, scores).unionByName(
        _read_back(spark, base, results.STATISTICS_RESULTS, statistics)
    )


@query
def preference_run_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "preference")
    rows = fx.ui_dup(spark, sf_dir).select("user", "item", F.col("pref").alias("c1"), F.col("price").alias("c2"))
    preference_run(rows, ["c1", "c2"], BATCH, base)

    def shown(entry: Column) -> Column:
        parts = F.split(entry, ":")
        return F.format_string("%s:%.6f", parts[0], parts[1].cast("double"))

    items = F.array_join(F.transform("item_list", shown), ",")
    return _read_back(spark, base, results.RECOMMEND_RESULTS, items).unionByName(
        _read_back(spark, base, results.STATISTICS_RESULTS, F.col("keys_list"))
    )


@query
def statistics_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "statistics")
    rows = fx.ui_dup(spark, sf_dir).select("user", "item", F.col("pref").alias("c1"), F.col("price").alias("c2"))
    preference_run(rows, ["c1", "c2"], BATCH, base)
    return results.read_results(spark, base, results.STATISTICS_ROWS, BATCH).select("batch_id", "kind", "key", "n")
