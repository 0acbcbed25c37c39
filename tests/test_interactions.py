from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from conftest import HOT, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from affinia.operators.interactions import (
    collect_items,
    item_lists,
    dedupe,
    min_prefs,
    one_pref_per_item,
    rating_matrix,
    sample_prefs,
    top_prefs,
)
from affinia.operators import skew
from affinia.operators.skew import join_hot, rank_by_hash, top_per_group


@pytest.fixture
def repeated(spark):
    return spark.createDataFrame(
        [(1, "a", 5.0), (1, "a", 3.0), (1, "a", 3.0), (2, "b", 0.0), (2, "c", 1.0)],
        "user bigint, item string, pref double",
    )


def test_dedupe_keeps_different_prefs(repeated):
    assert rows(dedupe(repeated), "user", "item", "pref") == [
        (1, "a", 3.0),
        (1, "a", 5.0),
        (2, "b", 0.0),
        (2, "c", 1.0),
    ]


@pytest.mark.parametrize("how,value", [("max", 5.0), ("sum", 11.0), ("avg", 11 / 3)])
def test_duplicates_are_merged(repeated, how, value):
    got = {(r.user, r.item): r.pref for r in one_pref_per_item(repeated, how).collect()}
    assert got[1, "a"] == pytest.approx(value)
    with pytest.raises(ValueError):
        one_pref_per_item(repeated, "first")


def test_matrix_has_no_zero_entries(repeated):
    assert rows(rating_matrix(repeated), "user", "item", "pref") == [(1, "a", 5.0), (2, "c", 1.0)]
    assert rows(rating_matrix(repeated, boolean=True), "user", "item", "pref") == [
        (1, "a", 1.0),
        (2, "b", 1.0),
        (2, "c", 1.0),
    ]


def test_min_prefs(hot):
    counts = Counter(u for u, _, _ in HOT)
    got = rows(min_prefs(hot, 4), "user", "item", "pref")
    assert got == [r for r in HOT if counts[r[0]] >= 4]
    assert 0 < len(got) < len(HOT)


def test_top_prefs_by_magnitude_then_item(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", -3.0), (1, "c", 3.0), (1, "d", 3.0)], "user bigint, item string, pref double"
    )
    assert rows(top_prefs(df, 2), "item") == [("b",), ("c",)]
    assert top_prefs(df, None) is df


@pytest.mark.parametrize("m", [1, 7, 1500])
def test_sample_keeps_m_per_user(hot, m):
    counts = Counter(u for u, _, _ in HOT)
    got = rows(sample_prefs(hot, m, 42), "user", "item", "pref")
    assert Counter(r[0] for r in got) == {u: min(n, m) for u, n in counts.items()}
    assert set(got) <= set(HOT)


@pytest.mark.parametrize("limit", [2, 9, 100])
def test_large_limits_in_ranges_are_the_plain_top(hot, monkeypatch, limit):
    order = [F.desc("pref"), F.col("item")]
    plain = rows(top_per_group(hot, ["user"], order, limit), "user", "item", "rank")
    monkeypatch.setattr(skew, "PRUNED_LIMIT", 1)
    for rows_per_block in (7, 1000):
        got = top_per_group(hot, ["user"], order, limit, rows_per_block=rows_per_block)
        assert rows(got, "user", "item", "rank") == plain


def test_ranks_of_hot_groups_and_null_groups(spark):
    table = [(None if u == 3 else u, "x" if i % 2 else None, i % 17, i) for u, n in ((1, 90), (2, 3), (3, 50)) for i in range(n)]
    df = spark.createDataFrame(table, "user bigint, kind string, pref int, item int").repartition(5)
    order = [F.desc("pref"), F.col("item")]
    plain = rows(skew.rank_within(df, ["user", "kind"], order), "pref", "item", "rank")
    assert rows(skew.rank_within(df, ["user", "kind"], order, 4), "pref", "item", "rank") == plain
    assert skew.rank_within(df.limit(0), ["user"], order, 4).count() == 0


def test_no_task_ranks_a_whole_hot_group(spark):
    """A group of 40,000 rows is ranked with windows of at most its partitions' number of rows."""
    df = spark.range(40_000).select(F.lit(1).alias("user"), F.col("id").alias("item"))
    ranked = skew.top_per_group(df, ["user"], [F.desc("item")], 1_500, rows_per_block=1_000)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") <= 2  # of ordinary groups, and of counts per group and partition
    got = ranked.collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 1_501))
    assert all(r["item"] == 40_000 - r["rank"] for r in got)


@pytest.mark.parametrize("rows_per_block", [2, 5, 1000])
def test_rank_by_hash_is_the_plain_rank(hot, rows_per_block):
    w = Window.partitionBy("user").orderBy(F.md5(F.concat_ws("|", F.lit("7"), "user", "item")), "item")
    plain = rows(hot.withColumn("_rank", F.row_number().over(w)), "user", "item", "_rank")
    assert rows(rank_by_hash(hot, "user", "item", 7, rows_per_block), "user", "item", "_rank") == plain


def test_join_hot_is_the_plain_join(hot):
    right = hot.select("item", F.col("user").alias("other"))
    plain = rows(hot.join(right, "item"), "user", "item", "other")
    assert rows(join_hot(hot, right, "item", "user", hot, "pref", 3), "user", "item", "other") == plain


@pytest.mark.parametrize("rows_per_block", [5, 1000])
@pytest.mark.parametrize("max_list", [4, 1000])
def test_parts_in_order_are_the_list(hot, max_list, rows_per_block):
    want = defaultdict(list)
    for u, i, p in sorted(HOT, key=lambda r: (r[0], -r[2], r[1])):
        want[u].append(i)
    lists = item_lists(hot, "user", "item", [-F.col("pref"), "item"], max_list, rows_per_block=rows_per_block)
    got = defaultdict(dict)
    for r in lists.collect():
        got[r.user][r.part] = r["items"]
    for u, parts in got.items():
        assert sorted(parts) == list(range(len(parts)))
        assert sum((parts[p] for p in range(len(parts))), []) == want[u]
        assert all(len(parts[p]) == max_list for p in range(len(parts) - 1))
    assert set(got) == set(want)
    whole = {r.user: r["items"] for r in collect_items(hot).collect()}
    assert whole == {u: sorted(items) for u, items in want.items()}
