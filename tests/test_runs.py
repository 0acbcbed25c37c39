from __future__ import annotations

from pathlib import Path

from conftest import rows

from affinia.operators.similarity import item_similarity, most_similar_pairs
from affinia.plans.association import association_run
from affinia.plans.preference import preference_run
from affinia.plans.recommendation import RecommendOptions, evaluate_run, recommend_run
from affinia.session import scratch_path, shared_dir
from affinia.sources.results import (
    EVALUATION_CHECKLIST,
    ITEM_SIMILARITIES,
    RECOMMEND_RESULTS,
    STATISTICS_RESULTS,
    STATISTICS_ROWS,
    read_results,
)


def test_association_run(spark, hot):
    tables = association_run(hot, "a01", min_support=2, k=3)
    assert set(tables) == {RECOMMEND_RESULTS, EVALUATION_CHECKLIST, STATISTICS_RESULTS, STATISTICS_ROWS}
    assert tables[STATISTICS_ROWS].columns == ["kind", "key", "n"]
    lifts = tables[EVALUATION_CHECKLIST].count()
    (statistics,) = tables[STATISTICS_RESULTS].collect()
    assert statistics.target_id == "a01_lift_histogram"
    assert sum(int(e.split(":")[1]) for e in statistics.keys_list.split(",")) == lifts > 0
    assert max(len(r.item_list) for r in tables[RECOMMEND_RESULTS].collect()) <= 3


def test_recommend_run_with_text_ids_equals_the_plain_run(spark, hot):
    text = hot.selectExpr("format_string('u%02d', user) AS user", "format_string('i%02d', item) AS item", "pref")
    users = text.select("user").distinct().limit(20)
    options = RecommendOptions("cosine", n=5, k=10, users=users)
    plain = recommend_run(text, "c01", options)[RECOMMEND_RESULTS]
    base = scratch_path(spark, "run")
    recommend_run(text, "c01", options, base, ("user", "item"), export_similarities=True)
    columns = ("target_id", "item_list")
    assert rows(read_results(spark, base, RECOMMEND_RESULTS, "c01"), *columns) == rows(plain, *columns)
    pairs = most_similar_pairs(item_similarity(text, "cosine", 10))
    columns = ("item_a", "item_b", "sim")
    assert rows(read_results(spark, base, ITEM_SIMILARITIES, "c01"), *columns) == rows(pairs, *columns)


def test_evaluate_run(spark, hot):
    options = RecommendOptions("tanimoto", n=5, k=20, boolean=True)
    tables = evaluate_run(hot, "c02", options, train_fraction=0.5)
    metrics = tables[EVALUATION_CHECKLIST].collect()
    assert metrics and all(0 <= m.precision <= 1 and 0 <= m.recall <= 1 for m in metrics)
    statistics = {r.target_id: r for r in tables[STATISTICS_RESULTS].collect()}
    f1 = statistics["c02_f1_histogram"].keys_list
    assert sum(int(e.split(":")[1]) for e in f1.split(",")) == len(metrics)
    assert statistics["c02_precision_recall"].quota_mean.count(",") == 2


def test_preference_run(spark, hot):
    df = hot.selectExpr("user", "item", "pref AS c1", "pref * item AS c2")
    tables = preference_run(df, ["c1", "c2"], "p01", max_list=10)
    lists = tables[RECOMMEND_RESULTS].collect()
    assert sum(len(r.item_list) for r in lists) == hot.count()
    hottest = sorted((r.part, r.item_list) for r in lists if r.target_id == "p01_0")
    scores = [float(e.split(":")[1]) for _, part in hottest for e in part]
    assert len(hottest) > 1 and scores == sorted(scores, reverse=True)  # the parts in order are the list
    assert {r.target_id for r in tables[STATISTICS_RESULTS].collect()} == {"p01_item_popularity", "p01_score_histogram"}


def test_batches_of_all_runs_share_the_tables(spark, hot):
    base = scratch_path(spark, "all")
    association_run(hot, "a", 2, base=base)
    recommend_run(hot, "c", RecommendOptions(boolean=True), base)
    evaluate_run(hot, "e", RecommendOptions(boolean=True), base=base)
    preference_run(hot.selectExpr("user", "item", "pref AS c1"), ["c1"], "p", base)
    assert rows(read_results(spark, base, RECOMMEND_RESULTS).select("batch_id").distinct(), "batch_id") == [
        ("a",),
        ("c",),
        ("p",),
    ]
    assert read_results(spark, base, EVALUATION_CHECKLIST, "e").count() > 0


def folders(spark):
    folder = Path(shared_dir(spark).removeprefix("file:"))
    return set(folder.iterdir())


def test_a_stored_run_leaves_only_its_results(spark, hot):
    base = scratch_path(spark, "kept")
    before = folders(spark)
    criteria = hot.selectExpr("user", "item", "pref AS c1")
    text = hot.selectExpr("format_string('u%02d', user) AS user", "format_string('i%02d', item) AS item", "pref")
    association_run(hot, "a", 2, base=base)
    recommend_run(text, "c", RecommendOptions(boolean=True), base, ("user", "item"), export_similarities=True)
    evaluate_run(hot, "e", RecommendOptions(boolean=True), base=base)
    preference_run(criteria, ["c1"], "p", base)
    assert folders(spark) - before == {Path(base)}
    kept = preference_run(criteria, ["c1"], "p")
    assert len(folders(spark) - before) == 2 and kept[RECOMMEND_RESULTS].count() > 0
