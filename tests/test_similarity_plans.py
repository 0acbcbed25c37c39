"""Plans that leave pairs out, against the plan that makes them all; exact values of the measures' bounds."""

from __future__ import annotations

import math
import random
from decimal import Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from affinia.functions.measures import LOGLIKELIHOOD, MEASURES, Pair
from affinia.operators import similarity
from affinia.operators.skew import hot_keys

from conftest import rows

SHAPE = "user bigint, item bigint, pref double"


def table(seed, users=40, items=60, heavy=3, negative=False):
    """A few users with most of the items, many with a handful; copies of preference values make ties."""
    rng = random.Random(seed)
    found = {}
    for u in range(users):
        n = rng.randint(items // 2, items) if u < heavy else rng.randint(1, 6)
        for i in rng.sample(range(items), n):
            found[u, i] = float(rng.choice([-2, -1, 1, 3] if negative else [1, 1, 2, 5]))
    return [(u, i, p) for (u, i), p in sorted(found.items())]


@pytest.fixture(scope="module")
def prefs(spark):
    return spark.createDataFrame(table(7, negative=True), SHAPE).repartition(3).cache()


@pytest.mark.parametrize(
    ("measure", "k", "negative"),
    [("cooccurrence", 3, 0), ("tanimoto", 1, 0), ("tanimoto", 10, 1), ("city_block", 3, 0), ("cosine", 3, 0), ("cosine", 3, 1), ("euclidean", 3, 0)],
)
def test_pruned_is_unpruned(spark, measure, k, negative):
    prefs = spark.createDataFrame(table(11 + k, negative=bool(negative)), SHAPE).repartition(3)
    every = rows(similarity.item_similarity(prefs, measure, k, rows_per_block=10_000), "item", "rank", "other", "sim")
    pruned = similarity.item_similarity(prefs, measure, k, rows_per_block=8, plan="pruned")
    assert rows(pruned, "item", "rank", "other", "sim") == every


def test_a_heavy_user_makes_few_pairs(spark):
    # One user owns everything; most items have one more user, so nearly all pairs are nobody's best.
    table = [(0, i, 1.0) for i in range(400)] + [(1 + i % 40, i, 1.0) for i in range(400) if i % 4]
    prefs = spark.createDataFrame(table, SHAPE).cache()
    parts = similarity.pruned_pairs(prefs, MEASURES["tanimoto"], 5, hot_keys(prefs, "user", 50), 50)
    every = 400 * 399 // 2
    assert parts.made.count() + parts.opened.count() < every / 10
    want = rows(similarity.item_similarity(prefs, "tanimoto", 5, rows_per_block=10_000), "item", "rank", "other", "sim")
    assert rows(similarity.item_similarity(prefs, "tanimoto", 5, rows_per_block=50, plan="pruned"), "item", "rank", "other", "sim") == want


@pytest.mark.parametrize(
    ("measure", "threshold"),
    [
        ("tanimoto", 0.5), ("cosine", 0.3), ("pearson", 0.2), ("cooccurrence", 4), ("city_block", 0.3), ("euclidean", 0.1),
    ],
)
def test_prefix_plan_is_the_pair_plan(spark, measure, threshold):
    prefs = spark.createDataFrame(table(5, negative=measure in ("cosine", "pearson")), SHAPE).repartition(3)
    every = similarity.similar_pairs(prefs, measure, None).where(F.col("sim") >= threshold)
    want = rows(every, "item_a", "item_b", "sim")
    for plan in ("prefix", "pairs"):
        got = similarity.similar_pairs(prefs, measure, threshold, plan=plan, rows_per_block=20)
        assert rows(got, "item_a", "item_b", "sim") == want


def test_prefix_pairs_fewer_rows_of_even_items(spark):
    """Every item has ten users, so counts bound nothing; two heavy users hold half of all rows."""
    table = sorted({(u, i, 1.0) for i in range(200) for u in [0, 1, 2, 3, *((i // 3 * 7 + j * 13) % 150 + 10 for j in range(6))]})
    prefs = spark.createDataFrame(table, SHAPE)
    assert [r["n"] for r in similarity.item_stats(prefs).select("n").distinct().collect()] == [10]
    m = MEASURES["tanimoto"]
    weighted = similarity._weighted(prefs, m, {"n"})
    prefix = similarity.prefix_rows(weighted, m, 0.6)
    candidates = similarity.prefix_candidates(prefix, None, {"n"}, 1000)
    every = similarity.cooccurrence(prefs)
    assert candidates.count() < every.count() / 10
    assert similarity._prefix_pays(weighted, m, 0.6) and not similarity._prefix_pays(weighted, m, 0.01)
    want = every.where("co / (20 - co) >= 0.6")
    got = similarity.similar_pairs(prefs, "tanimoto", 0.6, plan="prefix")
    assert rows(got, "item_a", "item_b") == rows(want, "item_a", "item_b") != []


def test_pair_counts(spark):
    prefs = spark.createDataFrame([(u, i, 1.0) for u, n in ((1, 10), (2, 3), (3, 1)) for i in range(n)], SHAPE)
    assert similarity.pair_counts(prefs, 5) == (45.0, 3.0)
    assert similarity.pair_counts(prefs.limit(0), 5) == (0.0, 0.0)


def test_plans_need_what_they_use(prefs):
    with pytest.raises(ValueError, match="positive threshold"):
        similarity.similar_pairs(prefs, "tanimoto", plan="prefix")
    with pytest.raises(ValueError, match="bounds rows"):
        similarity.similar_pairs(prefs, "loglikelihood", 0.5, plan="prefix")
    with pytest.raises(ValueError, match="needs k"):
        similarity.similar_pairs(prefs, "pearson", k=3, plan="pruned")
    with pytest.raises(ValueError, match="plan must be"):
        similarity.similar_pairs(prefs, "tanimoto", 0.5, plan="fast")


@pytest.mark.parametrize("measure", sorted(MEASURES))
def test_upper_bounds_hold(prefs, measure):
    m = MEASURES[measure]
    stats = set(m.pair_stats) | set(m.bound_stats) | ({"users"} if m.uses_users else set())
    weighted = similarity._weighted(similarity.complete(prefs), m, stats)
    carry = ["weight", *sorted(stats)]
    pairs = similarity.pairs_within(weighted, "user", "item", carry, None, "pref", 1000)
    bounds = pairs.select("item_a", "item_b", m.upper_bound(similarity._of("_a"), similarity._of("_b")).alias("bound"))
    met = similarity.similar_pairs(prefs, measure).join(bounds.distinct(), ["item_a", "item_b"])
    assert met.count() and met.where(F.col("sim") > F.col("bound") + 1e-8).count() == 0


def exact_llr(co, a, b, users):
    """The similarity with 60 digits."""
    getcontext().prec = 60
    cells = [(co, a, b), (a - co, a, users - b), (b - co, users - a, b), (users - a - b + co, users - a, users - b)]
    total = sum(Decimal(o) * (Decimal(o) * users / (Decimal(r) * c)).ln() for o, r, c in cells if o)
    return float(1 - 1 / (1 + 2 * total))


@pytest.mark.parametrize(
    ("co", "a", "b", "users"),
    [
        (101, 10**6, 10**6, 10**10), (100, 10**6, 10**6, 10**10), (130, 10**6, 10**6, 10**10), (3, 5, 7, 12), (5, 5, 5, 5),
        (1, 1, 1, 10**10), (5, 5, 9, 100), (15, 60, 50, 100), (7, 100, 7, 100), (25 * 10**8, 5 * 10**9, 5 * 10**9, 10**10),
        (25 * 10**8 + 40_000, 5 * 10**9, 5 * 10**9, 10**10),
    ],
)
def test_loglikelihood_at_any_number_of_users(spark, co, a, b, users):
    frame = spark.createDataFrame([(co, a, b, users)], "co bigint, a bigint, b bigint, users bigint")
    pair = Pair(F.col("co"), F.lit(0.0), {"n": F.col("a")}, {"n": F.col("b")}, F.col("users"))
    got = frame.select(LOGLIKELIHOOD.similarity(pair)).first()[0]
    assert math.isclose(got, exact_llr(co, a, b, users), rel_tol=1e-7, abs_tol=1e-9)


def test_nan_and_zero_preferences_are_no_entries(spark):
    table = [(1, 1, 2.0), (1, 2, 3.0), (2, 1, 1.0), (2, 2, 4.0)]
    odd = [*table, (3, 1, float("nan")), (3, 2, 1.0), (4, 1, 0.0), (3, 3, float("nan")), (1, 3, float("nan"))]
    plain, with_odd = (spark.createDataFrame(t, SHAPE) for t in ([*table, (3, 2, 1.0)], odd))
    for measure in ("cosine", "pearson"):
        want = rows(similarity.item_similarity(plain, measure), "item", "other", "sim")
        assert rows(similarity.item_similarity(with_odd, measure), "item", "other", "sim") == want
    stats = {r["item"]: (r["n"], r["low"], r["spread"]) for r in similarity.item_stats(with_odd).collect()}
    assert stats == {1: (2, 1.0, 0.5), 2: (3, 1.0, pytest.approx(5 / 3))}


@pytest.mark.parametrize(("measure", "threshold"), [("tanimoto", 0.08), ("cooccurrence", 2), ("city_block", 0.05)])
def test_long_prefixes_look_nothing_up(spark, monkeypatch, measure, threshold):
    prefs = spark.createDataFrame(table(9, heavy=8), SHAPE).repartition(3)
    every = similarity.similar_pairs(prefs, measure, None).where(F.col("sim") >= threshold)
    want = rows(every, "item_a", "item_b", "sim")
    monkeypatch.setattr(similarity, "verified_sums", None)
    assert rows(similarity.similar_pairs(prefs, measure, threshold, plan="prefix"), "item_a", "item_b", "sim") == want != []
