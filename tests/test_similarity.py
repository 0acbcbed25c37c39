from __future__ import annotations

from collections import defaultdict
from itertools import combinations
from math import log, sqrt

import pytest
from conftest import HOT, rows
from pyspark.sql import functions as F

from affinia.functions.measures import MEASURES, Measure, measure_named
from affinia.operators.similarity import (
    cooccurrence,
    item_similarity,
    item_stats,
    most_similar_pairs,
    similar_pairs,
)

G2_AC = 2 * log(1.6875)
EXPECTED = {
    "cooccurrence": {("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 2},
    "tanimoto": {("a", "b"): 2 / 3, ("a", "c"): 1 / 3, ("b", "c"): 2 / 3},
    # Every user has b, so b tells nothing about a or c.
    "loglikelihood": {("a", "c"): 1 - 1 / (1 + G2_AC)},
    "city_block": {("a", "b"): 1 / 2, ("a", "c"): 1 / 3, ("b", "c"): 1 / 2},
    "cosine": {("a", "b"): 23 / sqrt(41 * 29), ("a", "c"): 4 / sqrt(41 * 26), ("b", "c"): 22 / sqrt(29 * 26)},
    "pearson": {("a", "b"): 0.5, ("a", "c"): 0.5, ("b", "c"): 1.0},
    "euclidean": {
        ("a", "b"): 1 / (1 + sqrt(24)),
        ("a", "c"): 1 / (1 + sqrt(59)),
        ("b", "c"): 1 / (1 + sqrt(11)),
    },
}


def as_dict(df):
    return {(r.item_a, r.item_b): r.sim for r in df.collect()}


@pytest.mark.parametrize("measure", sorted(EXPECTED))
def test_measures_by_hand(prefs, measure):
    got = as_dict(similar_pairs(prefs, measure))
    assert got == pytest.approx({k: round(v, 9) for k, v in EXPECTED[measure].items()}, abs=1e-9)


def test_every_measure_has_a_case():
    assert set(EXPECTED) == set(MEASURES)


def test_item_stats_by_hand(prefs):
    got = {r.item: r for r in item_stats(prefs).collect()}
    assert (got["a"].n, got["a"].total, got["a"].norm2, got["a"].peak, got["a"].mean) == (2, 9.0, 41.0, 5.0, 4.5)
    assert got["c"].ssd == pytest.approx(8.0)


def test_custom_measure(prefs):
    overlap = Measure(
        "overlap", lambda p: p.co / F.least(p.a["n"], p.b["n"]), pair_stats=("n",), uses_dot=False
    )
    assert as_dict(similar_pairs(prefs, overlap)) == {("a", "b"): 1.0, ("a", "c"): 0.5, ("b", "c"): 1.0}


def test_unknown_names_are_rejected():
    with pytest.raises(ValueError):
        measure_named("nearest")
    with pytest.raises(ValueError):
        Measure("bad", lambda p: p.co, pair_stats=("median",))


@pytest.mark.parametrize("measure", ["cooccurrence", "tanimoto", "city_block", "cosine", "euclidean", "pearson"])
def test_threshold_pruning_changes_nothing(hot, measure):
    whole = as_dict(similar_pairs(hot, measure))
    threshold = sorted(whole.values())[len(whole) // 2]
    assert as_dict(similar_pairs(hot, measure, threshold=threshold)) == {
        k: v for k, v in whole.items() if v >= threshold
    }


def brute_force():
    by_user = defaultdict(list)
    for u, i, p in HOT:
        by_user[u].append((i, p))
    co, dot = defaultdict(int), defaultdict(float)
    for items in by_user.values():
        for (a, x), (b, y) in combinations(sorted(items), 2):
            co[a, b] += 1
            dot[a, b] += x * y
    return sorted((a, b, co[a, b], dot[a, b]) for a, b in co)


@pytest.mark.parametrize("rows_per_block", [3, 7, 25, 1000])
def test_blocks_of_a_hot_user_give_each_pair_once(hot, rows_per_block):
    got = rows(cooccurrence(hot, rows_per_block), "item_a", "item_b", "co", "dot")
    assert got == brute_force()


def test_symmetric_self_free_and_limited(hot):
    similar = item_similarity(hot, "cosine", k=5, rows_per_block=10)
    got = similar.collect()
    assert all(r.item != r.other for r in got)
    assert max(r["rank"] for r in got) <= 5
    full = {(r.item, r.other): r.sim for r in item_similarity(hot, "cosine", k=None).collect()}
    assert all(full[b, a] == s for (a, b), s in full.items())
    best = defaultdict(list)
    for (a, b), s in full.items():
        best[a].append((-s, b))
    assert {(r.item, r["rank"]): r.other for r in got} == {
        (a, n + 1): b for a, partners in best.items() for n, (_, b) in enumerate(sorted(partners)[:5])
    }


def test_ties_at_k_go_to_the_smaller_id(spark):
    rows_ = [(u, i, 1.0) for u in (1, 2) for i in "abc"]
    df = spark.createDataFrame(rows_, "user bigint, item string, pref double")
    assert rows(item_similarity(df, "cosine", k=1), "item", "other") == [("a", "b"), ("b", "a"), ("c", "a")]


def test_most_similar_pairs_once_each(hot):
    pairs = rows(most_similar_pairs(item_similarity(hot, "tanimoto", k=3)), "item_a", "item_b")
    assert all(a < b for a, b in pairs)
    assert len(pairs) == len(set(pairs))


def test_constant_item_has_no_pearson(spark):
    df = spark.createDataFrame(
        [(1, "a", 2.0), (2, "a", 2.0), (1, "b", 1.0), (2, "b", 3.0)], "user bigint, item string, pref double"
    )
    assert similar_pairs(df, "pearson").count() == 0
