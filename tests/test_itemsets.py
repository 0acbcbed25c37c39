from __future__ import annotations

from collections import Counter
from itertools import combinations
from random import Random

import pytest
from conftest import rows

from affinia.operators.itemsets import (
    associated_items,
    associated_lists,
    association_rules,
    basket_count,
    basket_rows,
    baskets,
    frequent_itemsets,
    frequent_pairs,
    pair_lift,
)
from affinia.operators.stats import histogram

BASKETS = {1: "abc", 2: "ab", 3: "a", 4: "bc", 5: "abc", 6: "d"}


@pytest.fixture
def lines(spark):
    data = [(b, i) for b, items in BASKETS.items() for i in items]
    return spark.createDataFrame([*data, (1, "a"), (3, ""), (7, "")], "user bigint, item string")


def supports(size):
    return Counter(c for items in BASKETS.values() for c in combinations(sorted(items), size))


def test_baskets_are_sets_without_blanks(lines):
    got = {r.basket: "".join(r["items"]) for r in baskets(lines).collect()}
    assert got == BASKETS
    parts = sorted((r.basket, i) for r in baskets(lines, max_list=1).collect() for i in r["items"])
    assert parts == sorted((b, i) for b, items in BASKETS.items() for i in items)
    assert basket_count(basket_rows(lines)).first().n == 6


@pytest.mark.parametrize("max_len", [1, 2, 3, None])
def test_itemsets_match_counting(lines, max_len):
    got = {tuple(r["items"]): r.freq for r in frequent_itemsets(basket_rows(lines), 2, max_len).collect()}
    sizes = range(1, (max_len or 3) + 1)
    assert got == {k: n for s in sizes for k, n in supports(s).items() if n >= 2}


def test_nothing_frequent(lines):
    assert frequent_itemsets(basket_rows(lines), 50).count() == 0
    assert pair_lift(basket_rows(lines), 50).count() == 0


@pytest.mark.parametrize("rows_per_block", [1, 2, 1000])
def test_pairs_do_not_depend_on_blocks(lines, rows_per_block):
    got = rows(frequent_pairs(basket_rows(lines), 1, rows_per_block), "item_a", "item_b", "freq", "freq_a", "freq_b")
    one = {k[0]: n for k, n in supports(1).items()}
    assert got == sorted((a, b, n, one[a], one[b]) for (a, b), n in supports(2).items())


def test_lift_by_hand(lines):
    lifted = pair_lift(basket_rows(lines), 2)
    got = {(r.item_a, r.item_b): r.lift for r in lifted.collect()}
    assert got == pytest.approx({("a", "b"): 18 / 16, ("a", "c"): 12 / 12, ("b", "c"): 18 / 12})
    assert rows(histogram(lifted, "lift", 1), "bucket", "n") == [(1.0, 1), (1.1, 1), (1.5, 1)]


def test_associated_items_strongest_first(lines):
    lists = associated_lists(associated_items(frequent_pairs(basket_rows(lines), 2), k=1))
    assert {r.item: r.item_list for r in lists.collect()} == {"a": ["b"], "b": ["a"], "c": ["b"]}


def test_rules_by_hand(lines):
    lines = basket_rows(lines)
    rules = association_rules(lines, frequent_itemsets(lines, 2), 0.9)
    got = {(tuple(r.antecedent), r.consequent): (r.freq, r.support, r.confidence, r.lift) for r in rules.collect()}
    assert set(got) == {(("c",), "b"), (("a", "c"), "b")}
    assert got[("c",), "b"] == pytest.approx((3, 0.5, 1.0, 18 / 12))
    assert got[("a", "c"), "b"] == pytest.approx((2, 2 / 6, 1.0, 12 / 8))


def by_counting(table, least):
    found = {}
    baskets = {}
    for b, i in table:
        baskets.setdefault(b, set()).add(i)
    for items in baskets.values():
        for size in range(1, len(items) + 1):
            for c in combinations(sorted(items), size):
                found[c] = found.get(c, 0) + 1
    return {c: n for c, n in found.items() if n >= least}


@pytest.mark.parametrize(("seed", "least"), [(1, 3), (2, 5)])
def test_levels_match_counting(spark, seed, least):
    rng = Random(seed)
    table = [(b, f"i{i}") for b in range(40) for i in rng.sample(range(9), rng.randint(1, 6))]
    table += [(100, f"i{i}") for i in range(9)]  # one basket holds everything
    table += [(200 + b, i) for b in range(6) for i in ("x", "y", "z", "w", "i0")]  # a frequent set of five
    rows_ = basket_rows(spark.createDataFrame(table, "user bigint, item string"))
    want = by_counting(table, least)
    assert max(map(len, want)) == 5
    for block in (2, 1000):
        got = {tuple(r["items"]): r.freq for r in frequent_itemsets(rows_, least, rows_per_block=block).collect()}
        assert got == want
    got = {tuple(r["items"]): r.freq for r in frequent_itemsets(rows_, least, 3).collect()}
    assert got == {c: n for c, n in want.items() if len(c) <= 3}
    rules = association_rules(rows_, frequent_itemsets(rows_, least), 0.9).collect()
    assert {len(r.antecedent) for r in rules} >= {2, 3, 4}
    assert all(want[tuple(sorted([*r.antecedent, r.consequent]))] / want[tuple(r.antecedent)] >= 0.9 for r in rules)


def test_baskets_hold_sets_by_number(spark, monkeypatch):
    from affinia.operators import itemsets

    ui = spark.createDataFrame([(b, i) for b in range(6) for i in "abcd" if (b, i) != (0, "d")], "user bigint, item string")
    stored, store = [], itemsets.cut_lineage
    monkeypatch.setattr(itemsets, "cut_lineage", lambda df: stored.append(dict(df.dtypes)) or store(df))
    sets = itemsets.frequent_itemsets(itemsets.basket_rows(ui), 6).collect()
    assert sorted("".join(r["items"]) for r in sets) == ["a", "ab", "abc", "ac", "b", "bc", "c"]
    baskets = [types for types in stored if "basket" in types]
    assert baskets and all(types == {"basket": "bigint", "number": "bigint"} for types in baskets)


def test_rows_of_a_level_go_with_the_next(spark, tmp_path, monkeypatch):
    """Baskets of five items that all are frequent: four levels of rows, of which none is left at the end."""
    import os

    from affinia import session
    from affinia.operators import itemsets

    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    made, real = [], itemsets._holding
    monkeypatch.setattr(itemsets, "_holding", lambda *a: made.append(len(os.listdir(tmp_path))) or real(*a))
    rows_ = spark.createDataFrame([(b, i) for b in range(6) for i in "abcde"], "basket bigint, item string")
    found = {tuple(r["items"]): r["freq"] for r in itemsets.frequent_itemsets(rows_, 3).collect()}
    assert len(found) == 31 and set(found.values()) == {6} and len(made) == 4
    tables = [spark.read.parquet(str(tmp_path / t)).columns for t in os.listdir(tmp_path)]
    assert tables and not any("basket" in columns for columns in tables)
