from __future__ import annotations

from math import exp, log, sqrt

import pytest
from conftest import rows

from affinia.operators.preference import (
    criteria_stats,
    entropy_weights,
    merge_criteria,
    preference_lists,
    preference_scores,
    zscores,
)
from affinia.operators.stats import histogram, item_popularity

SCHEMA = "user bigint, item string, c1 double, c2 double"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def weights(df, criteria=("c1", "c2")):
    return {r.criterion: r.weight for r in entropy_weights(df, criteria).collect()}


def test_merge_sums_fractions(spark):
    df = frame(spark, [(1, "a", 1.5, 2.0), (1, "a", 0.25, 1.0), (1, "b", 1.0, 1.0)])
    assert rows(merge_criteria(df, ["c1", "c2"]), "user", "item", "c1", "c2") == [
        (1, "a", 1.75, 3.0),
        (1, "b", 1.0, 1.0),
    ]


def test_statistics_by_hand(spark):
    df = frame(spark, [(1, "a", 1.0, 0.0), (1, "b", 2.0, 4.0), (2, "a", 5.0, 4.0)])
    got = {r.criterion: r for r in criteria_stats(df, ["c1", "c2"]).collect()}
    e1 = sum(f * log(f) for f in (1 / 8, 2 / 8, 5 / 8)) / log(3)
    e2 = 2 * 0.5 * log(0.5) / log(3)
    assert got["c1"].n == 3 and got["c1"].total == 8.0
    assert got["c1"].mean == pytest.approx(8 / 3)
    assert got["c1"].stddev == pytest.approx(sqrt(10 - 64 / 9))
    assert got["c1"].entropy == pytest.approx(e1)
    assert got["c2"].entropy == pytest.approx(e2)  # the zero adds nothing
    assert got["c1"].weight == pytest.approx((1 + e1) / (2 + e1 + e2))
    assert got["c1"].weight + got["c2"].weight == pytest.approx(1.0)


def test_scores_by_hand(spark):
    df = frame(spark, [(1, "a", 1.0, 1.0), (1, "b", 3.0, 3.0)])
    z = {r.item: (r.z_c1, r.z_c2) for r in zscores(df, ["c1", "c2"]).collect()}
    assert z == {"a": (-1.0, -1.0), "b": (1.0, 1.0)}
    got = {r.item: r.score for r in preference_scores(df, ["c1", "c2"]).collect()}
    assert got == pytest.approx({"a": 5 / (1 + exp(1)), "b": 5 / (1 + exp(-1))})


def test_single_criterion_weighs_one(spark):
    df = frame(spark, [(1, "a", -1.0, 0.0), (1, "b", 3.0, 0.0)])
    assert weights(df, ["c1"]) == {"c1": 1.0}
    assert rows(preference_scores(df, ["c1"]), "item") == [("a",), ("b",)]


def test_constant_criterion(spark):
    df = frame(spark, [(1, "a", 2.0, 7.0), (1, "b", 4.0, 7.0), (2, "a", 6.0, 7.0)])
    assert weights(df)["c2"] == pytest.approx(0.0, abs=1e-9)
    assert all(0 < s < 5 for (s,) in rows(preference_scores(df, ["c1", "c2"]), "score"))


def test_uniform_criteria_and_one_row_get_equal_weights(spark):
    assert weights(frame(spark, [(1, "a", 2.0, 7.0), (1, "b", 2.0, 7.0)])) == {"c1": 0.5, "c2": 0.5}
    one = frame(spark, [(1, "a", 3.0, 1.0)])
    assert weights(one) == {"c1": 0.5, "c2": 0.5}
    assert rows(preference_scores(one, ["c1", "c2"]), "score") == [(2.5,)]


def test_negative_values_are_an_error(spark):
    with pytest.raises(Exception, match="negative"):
        criteria_stats(frame(spark, [(1, "a", -2.0, 7.0), (1, "b", 2.0, 7.0)]), ["c1", "c2"]).collect()


def test_lists_best_first_and_counts(spark):
    scores = spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", 4.006), (1, "c", 4.006), (2, "a", 2.0)], "user bigint, item string, score double"
    )
    lists = {(r.user, r.part): [p["item"] for p in r.prefs] for r in preference_lists(scores).collect()}
    assert lists == {(1, 0): ["b", "c", "a"], (2, 0): ["a"]}
    assert rows(item_popularity(scores), "item", "n") == [("a", 2), ("b", 1), ("c", 1)]
    assert rows(histogram(scores, "score", 2), "bucket", "n") == [(1.0, 1), (2.0, 1), (4.01, 2)]


def test_merged_rows_and_counts_are_made_once(spark, capsys):
    """Statistics, scores and ranks read them from storage; the joins and sums behind them do not run for each."""
    from affinia.catalog import queries
    from affinia.operators.stats import key_lists

    queries._scores(spark, "/root/testdata/sf0.001").explain()
    queries.zscore(spark, "/root/testdata/sf0.001").explain()
    counts = spark.range(5).selectExpr("'k' AS kind", "cast(id AS string) AS key", "id AS n")
    lists = key_lists(counts, 3)
    lists.explain()
    plan = capsys.readouterr().out
    assert "parquet" in plan and "lineitem" not in plan and "Range (" not in plan
    assert rows(lists, "kind", "part", "keys_list") == [("k", 0, "0:0,1:1,2:2"), ("k", 1, "3:3,4:4")]
