from __future__ import annotations

from collections import Counter
from math import floor

import pytest
from conftest import HOT, rows

from affinia.operators.evaluate import (
    evaluation_means,
    hit_counts,
    precision_recall_points,
    ranking_metrics,
    train_test_split,
)
from affinia.operators.stats import histogram


@pytest.mark.parametrize("p", [0.0, 0.6, 1.0])
def test_split_sizes(spark, hot, p):
    single = spark.createDataFrame([(900, 1, 1.0)], hot.schema)
    got = rows(train_test_split(hot.unionByName(single), p, rows_per_block=6), "user", "item", "pref", "split")
    assert sorted(r[:3] for r in got) == sorted([*HOT, (900, 1, 1.0)])
    train = Counter(r[0] for r in got if r[3] == "train")
    sizes = Counter(u for u, _, _ in HOT)
    assert train[900] == 1
    assert all(train[u] == (1 if n == 1 else floor(n * p)) for u, n in sizes.items())


def test_split_repeats_and_does_not_depend_on_blocks(hot):
    columns = ("user", "item", "split")
    first = rows(train_test_split(hot, 0.5, 1), *columns)
    assert rows(train_test_split(hot.repartition(3), 0.5, 1, rows_per_block=4), *columns) == first
    assert rows(train_test_split(hot, 0.5, 2), *columns) != first
    with pytest.raises(ValueError):
        train_test_split(hot, 1.5)


@pytest.fixture
def metrics(spark):
    recs = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "a"), (3, "x"), (3, "y"), (4, "a")], "user bigint, item string"
    )
    test = spark.createDataFrame(
        [(1, "b"), (1, "c"), (1, "d"), (2, "b"), (3, "x"), (3, "y"), (5, "a")], "user bigint, item string"
    )
    return recs, test


def test_hits_and_metrics_by_hand(metrics):
    hits = hit_counts(*metrics)
    assert rows(hits, "user", "n_hit", "n_test", "n_rec") == [(1, 1, 3, 2), (2, 0, 1, 1), (3, 2, 2, 2)]
    assert rows(hit_counts(*metrics, include_missing=True), "user") == [(1,), (2,), (3,), (5,)]
    rated = ranking_metrics(hits)
    got = {r.user: (r.precision, r.recall, r.f1) for r in rated.collect()}
    assert got[1] == pytest.approx((0.5, 1 / 3, 0.4))
    assert got[2] == (0.0, 0.0, 0.0)
    assert got[3] == (1.0, 1.0, 1.0)
    assert tuple(evaluation_means(rated).first()) == (0.5, 0.44444, 0.46667)
    assert rows(precision_recall_points(rated), "precision", "recall") == [(0.0, 0.0), (0.5, 0.3333), (1.0, 1.0)]
    assert rows(histogram(rated, "f1", 1), "bucket", "n") == [(0.0, 1), (0.4, 1), (1.0, 1)]


def test_rows_to_split_are_made_once(spark, capsys):
    """Counting and ranking read them from storage; what makes them does not run for each."""
    ui = spark.range(40).selectExpr("id % 4 AS user", "id AS item", "1.0D AS pref")
    split = train_test_split(ui, 0.6, 42)
    split.explain()
    plan = capsys.readouterr().out
    assert "parquet" in plan and "Range (" not in plan
    assert sorted((r["split"], r["count"]) for r in split.groupBy("split").count().collect()) == [("test", 16), ("train", 24)]
