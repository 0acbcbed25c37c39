from __future__ import annotations

from math import sqrt

import pytest
from conftest import HOT, rows

from affinia.operators.interactions import rating_matrix
from affinia.operators.recommend import explode_recs, rec_lists, recommend
from affinia.operators.similarity import item_similarity

AB, AC, BC = 23 / sqrt(41 * 29), 4 / sqrt(41 * 26), 22 / sqrt(29 * 26)


def test_rated_scores_by_hand(prefs):
    recs = {(r.user, r.item): r.score for r in recommend(prefs, item_similarity(prefs, "cosine")).collect()}
    assert recs == pytest.approx(
        {(1, "c"): (5 * AC + 3 * BC) / (AC + BC), (3, "a"): (4 * AB + 5 * AC) / (AB + AC)}, abs=1e-8
    )


def test_boolean_scores_are_sums(prefs):
    ones = rating_matrix(prefs, boolean=True)
    recs = rows(recommend(ones, item_similarity(ones, "tanimoto"), boolean=True), "user", "item", "score")
    assert recs == [(1, "c", 1.0), (3, "a", 1.0)]


def test_rated_mode_needs_two_items(prefs):
    similar = item_similarity(prefs, "cosine")
    assert recommend(prefs, similar, max_prefs=1).count() == 0
    assert recommend(prefs, similar, max_prefs=1, min_support_items=1).count() == 2


def test_users_items_and_exclusions(spark, prefs):
    similar = item_similarity(prefs, "cosine")
    users = spark.createDataFrame([(3,)], "user bigint")
    items = spark.createDataFrame([("c",)], "item string")
    exclude = spark.createDataFrame([(1, "c"), (2, "z")], "user bigint, item string")
    assert rows(recommend(prefs, similar, users=users), "user", "item") == [(3, "a")]
    assert rows(recommend(prefs, similar, items=items), "user", "item") == [(1, "c")]
    assert rows(recommend(prefs, similar, exclude=exclude), "user", "item") == [(3, "a")]
    assert recommend(prefs, similar, users=users, exclude=exclude).count() == 1


def test_never_what_the_user_has_and_never_more_than_n(hot):
    similar = item_similarity(hot, "tanimoto", k=20)
    recs = recommend(hot, similar, n=4, boolean=True)
    got = rows(recs, "user", "item", "rank")
    assert got
    assert not {(u, i) for u, i, _ in got} & {(u, i) for u, i, _ in HOT}
    assert max(r for _, _, r in got) <= 4


@pytest.mark.parametrize("max_prefs", [10, None])
def test_blocks_of_hot_items_and_users_change_nothing(hot, max_prefs):
    similar = item_similarity(hot, "cosine", k=10)
    columns = ("user", "item", "score", "rank")
    # User 0 is excluded from far more items than it has.
    exclude = hot.selectExpr("0 AS user", "item + 30 AS item").union(hot.selectExpr("user", "item + 1"))
    for out in (None, exclude):
        whole = recommend(hot, similar, n=5, max_prefs=max_prefs, exclude=out)
        split = recommend(hot, similar, n=5, max_prefs=max_prefs, exclude=out, rows_per_block=3)
        assert rows(split, *columns) == rows(whole, *columns)


def test_scores_match_brute_force(hot):
    similar = item_similarity(hot, "cosine", k=10)
    near = [(r.item, r.other, r.sim) for r in similar.collect()]
    owned = {(u, i) for u, i, _ in HOT}
    sums: dict = {}
    for u, i, p in HOT:
        for item, other, sim in near:
            if item == i and (u, other) not in owned:
                weighted, weight, n = sums.get((u, other), (0.0, 0.0, 0))
                sums[u, other] = (weighted + sim * p, weight + sim, n + 1)
    want = {k: w / s for k, (w, s, n) in sums.items() if n >= 2}
    got = recommend(hot, similar, n=1000, max_prefs=None, rows_per_block=7).collect()
    assert {(r.user, r.item): r.score for r in got} == pytest.approx(want, abs=1e-8)


def test_lists_and_back(hot):
    recs = recommend(hot, item_similarity(hot, "tanimoto", k=20), n=4, boolean=True)
    columns = ("user", "item", "score", "rank")
    assert rows(explode_recs(rec_lists(recs)), *columns) == rows(recs, *columns)
