"""Products summed up block by block, against plain joins."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from affinia.functions.measures import MEASURES
from affinia.operators import product, similarity
from affinia.session import cut_lineage


def table(seed, keys, numbers, share, values):
    rng = random.Random(seed)
    return [(k, i, float(rng.choice(values))) for k in range(keys) for i in range(numbers) if rng.random() < share]


@pytest.mark.parametrize("values", [[1, 2, 50], [300, -7], [0.123456789, 1.0], [0.1 + 0.2, 1e300]])
def test_numbers_travel_unchanged(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "value double")
    how = product.packed(df, "value")
    assert how.type == ("int" if 300 in values else "tinyint" if 50 in values else "int" if 0.123456789 in values else "double")
    assert [r[0] / how.scale for r in df.select(how.of("value")).collect()] == [float(v) for v in values]


@pytest.mark.parametrize(("shift", "limit"), [(0, 3), (10**12, 1000)])
def test_product_is_the_join(spark, monkeypatch, shift, limit):
    monkeypatch.setattr(product, "BLOCK_BYTES", 64)
    left = cut_lineage(spark.createDataFrame(table(1, 12, 30, 0.4, [1, 2]), "key int, row bigint, value double"))
    right = spark.createDataFrame(table(2, 12, 25, 0.4, [0.5, -3.0]), "key int, other bigint, value double")
    right = cut_lineage(right.withColumn("other", F.col("other") - F.lit(shift)))
    out = left.selectExpr("row", f"row - {shift} AS other").distinct()
    how = (product.packed(left, "value"), product.packed(right, "value"))
    got = product.sparse_product(left, right, "all", how, absolute=True, out=out, rows_per_list=limit)
    terms = left.withColumnRenamed("value", "a").join(right.withColumnRenamed("value", "b"), "key")
    sums = [F.count("key").alias("n"), F.sum(F.col("a") * F.col("b")).alias("dot"), F.sum(F.abs("b")).alias("size")]
    want = terms.groupBy("row", "other").agg(*sums).join(out, ["row", "other"], "left_anti")
    columns = ("row", "other", "n", "dot", "size")
    assert rows(got, *columns) == rows(want, *columns) != []


def test_rows_are_cut_into_pieces(monkeypatch, spark):
    """In this process: a row of more terms than are added up at once."""
    monkeypatch.setattr(product, "TERMS", 5)
    import pyarrow as pa

    lists = {"first": [0] * 4, "rows": [[1, 2], [2], [2, 3], [3]], "others": [[5, 6, 7], [5, 6], [7, 8], [5, 9]]}
    types = {"first": pa.int32(), "rows": pa.list_(pa.int64()), "others": pa.list_(pa.int32())}
    batch = pa.RecordBatch.from_pydict({c: pa.array(v, types[c]) for c, v in lists.items()})
    found = [r for b in product._Kernel("all", None, False, (), False)(iter([batch])) for r in b.to_pylist()]
    want = {(r, o): 0 for r, o in ((1, 5), (1, 6), (1, 7), (2, 5), (2, 6), (2, 7), (2, 8), (3, 5), (3, 7), (3, 8), (3, 9))}
    for left, right in zip(lists["rows"], lists["others"]):
        for r in left:
            for o in right:
                want[r, o] += 1
    assert {(r["row"], r["other"]): r["n"] for r in found} == want and len(found) == len(want)


@pytest.mark.parametrize("measure", sorted(MEASURES))
def test_the_best_are_those_of_all_pairs(spark, measure):
    prefs = spark.createDataFrame(table(3, 40, 30, 0.3, [1, 1, 2, 5]), "user bigint, item bigint, pref double")
    every = similarity.symmetric(similarity.similar_pairs(prefs, measure)).collect()
    order = sorted(((r.item, -r.sim, r.other) for r in every))
    want, place = [], {}
    for item, sim, other in order:
        place[item] = place.get(item, 0) + 1
        if place[item] <= 4:
            want.append((item, place[item], other, -sim))
    assert rows(similarity.item_similarity(prefs, measure, 4), "item", "rank", "other", "sim") == want


def test_pairs_are_not_shuffled(spark, capsys):
    prefs = spark.createDataFrame(table(4, 20, 15, 0.4, [1, 2]), "user bigint, item bigint, pref double")
    similarity.item_similarity(prefs, "cosine", 4).explain()
    similarity.cooccurrence(prefs).explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(item_a" not in plan and plan.count("Exchange") and "hashpartitioning(item#" not in plan


def test_proposals_are_not_shuffled(spark, capsys):
    from affinia.operators.recommend import recommend

    prefs = spark.createDataFrame(table(5, 20, 15, 0.4, [1, 2]), "user bigint, item bigint, pref double")
    recommend(prefs, similarity.item_similarity(prefs, "cosine", 4), n=3).explain()
    plan = capsys.readouterr().out
    assert "REPARTITION" in plan.upper() and "hashpartitioning(user" not in plan


def test_centred_preferences_travel_packed(spark, monkeypatch):
    """Preferences less their item's mean fill eight bytes each; the preferences themselves fit one."""
    sent, real = [], similarity.sparse_product

    def spied(left, right, pairs, values, **more):
        sent.extend(v.type for v in values)
        return real(left, right, pairs, values, **more)

    monkeypatch.setattr(similarity, "sparse_product", spied)
    data = table(6, 25, 12, 0.5, [1, 2, 50])
    prefs = spark.createDataFrame(data, "user bigint, item bigint, pref double")
    got = similarity.similar_pairs(prefs, "pearson").collect()
    assert sent == ["tinyint", "tinyint"]
    of = {}
    for user, item, pref in data:
        of.setdefault(item, {})[user] = pref
    off = {i: {u: p - sum(r.values()) / len(r) for u, p in r.items()} for i, r in of.items()}
    want = {}
    for a in off:
        for b in (b for b in off if b > a):
            sides = [sum(x * x for x in off[i].values()) ** 0.5 for i in (a, b)]
            dot = sum(x * off[b][u] for u, x in off[a].items() if u in off[b])
            if all(sides) and dot / (sides[0] * sides[1]) > 1e-6:
                want[a, b] = dot / (sides[0] * sides[1])
    assert {(r.item_a, r.item_b) for r in got if r.sim > 1e-6} == set(want) != set()
    assert all(abs(r.sim - want[r.item_a, r.item_b]) < 1e-8 for r in got if r.sim > 1e-6)


@pytest.mark.parametrize("grid", [(3, 1), (2, 4), (1, 5)])
def test_a_grid_of_blocks_gives_the_same_best(spark, grid):
    left = cut_lineage(spark.createDataFrame(table(7, 14, 30, 0.4, [1, 2]), "key int, row int, value double"))
    right = cut_lineage(spark.createDataFrame(table(8, 14, 25, 0.5, [0.5, 3.0]), "key int, other int, value double"))
    how = (product.packed(left, "value"), product.packed(right, "value"))
    out = left.selectExpr("row", "row + 1 AS other").distinct()

    def scores(**more):
        totals = product.sparse_product(left, right, "all", how, absolute=True, **more)
        return totals.withColumn("score", F.col("dot"))

    whole = scores().join(out, ["row", "other"], "left_anti")
    whole = whole.join(left.selectExpr("row", "key AS other").distinct(), ["row", "other"], "left_anti")
    found = {}
    for r in whole.collect():
        found.setdefault(r.row, []).append((-r.score, r.other))
    want = [(row, i + 1, other, -s) for row, all_of in found.items() for i, (s, other) in enumerate(sorted(all_of)[:4])]
    best = scores(grid=grid, out=out, own=True, best=(lambda t: t["dot"], 4))
    assert rows(product.best_of_rows(best, "score", 4, parts=grid[1]), "row", "rank", "other", "score") == sorted(want) != []


def test_a_grid_moves_less_than_rows_of_blocks(spark):
    """Keys with many rows and many others: every block of rows would get every list."""
    left = cut_lineage(spark.range(20_000).selectExpr("int(id % 50) AS key", "int(id) AS row"))
    right = cut_lineage(spark.range(20_000).selectExpr("int(id % 50) AS key", "int(id) AS other"))
    down, across = product.block_grid(left, right, (5, 8), 1)
    assert across > 1 and down < down * across >= 2 * spark.sparkContext.defaultParallelism


def test_a_stored_table_is_not_written_again(spark, prefs):
    from affinia.operators.interactions import complete

    stored = cut_lineage(prefs)
    assert cut_lineage(complete(stored)).inputFiles() == stored.inputFiles() != []
    assert cut_lineage(stored.withColumn("pref", F.lit(1.0))).inputFiles() != stored.inputFiles()


def test_small_lists_go_to_one_block_a_core(spark):
    rows = [(u, i, 1) for u in range(200) for i in range(u % 7, 60, 7)]
    prefs = spark.createDataFrame(rows, "key bigint, item int, value int").repartition(4)
    left, right = prefs.withColumnRenamed("item", "row"), prefs.withColumnRenamed("item", "other")
    assert product.block_count(left, right, 8) == spark.sparkContext.defaultParallelism
    whole = product.sparse_product(left, right, "other", (product.PACKINGS[1],) * 2)
    grid = product.sparse_product(left, right, "other", (product.PACKINGS[1],) * 2, grid=(3, 4))
    want = {(i, j): sum(u % 7 == i % 7 == j % 7 for u in range(200)) for i in range(60) for j in range(60) if i != j and i % 7 == j % 7}
    for made in (whole, grid):
        assert {(r.row, r.other): r.n for r in made.collect()} == want


@pytest.mark.parametrize("grid", [(40, 1), (24, 2)])
def test_blocks_take_turns(spark, monkeypatch, grid):
    """Lists for more blocks than a round has: what each round gives is stored, and its shuffle files are gone."""
    monkeypatch.setattr(product, "ROUND_BYTES", 1)
    left = cut_lineage(spark.createDataFrame(table(9, 14, 90, 0.4, [1, 2]), "key int, row int, value double"))
    right = cut_lineage(spark.createDataFrame(table(10, 14, 25, 0.5, [0.5, 3.0]), "key int, other int, value double"))
    how = (product.packed(left, "value"), product.packed(right, "value"))
    out = left.selectExpr("row", "row + 1 AS other").distinct()
    turns = []

    def then(totals):
        turns.append(totals)
        return product.best_of_rows(totals.withColumn("score", F.col("dot")), "score", 4, parts=grid[1])

    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    more = {"absolute": True, "out": out, "own": True, "best": (lambda t: t["dot"], 4)}
    whole = then(product.sparse_product(left, right, "all", how, grid=grid, **more))
    want = rows(whole, "row", "rank", "other", "score")
    turns.clear()
    before = files.getAllFiles().size()
    got = product.sparse_product(left, right, "all", how, grid=grid, then=then, **more)
    assert len(turns) > 1 and files.getAllFiles().size() <= before
    assert rows(got, "row", "rank", "other", "score") == want != []


def test_numbers_are_written_and_read():
    import numpy as np

    arrays = [np.array([1, -2, 127], "<i1"), np.array([70_000, -1], "<i4"), np.array([], "<i4"), np.array([2**40], "<i8"), np.array([0.1, -0.0])]
    found = product._read(memoryview(product._written(arrays)))
    assert [(x.dtype, x.tolist()) for x in found] == [(x.dtype, x.tolist()) for x in arrays]


def test_a_table_leaves_no_shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    frame = spark.range(1000, numPartitions=3).groupBy((F.col("id") % 7).alias("k")).count()
    before = files.getAllFiles().size()
    stored = cut_lineage(frame)
    assert files.getAllFiles().size() <= before
    assert stored.count() == 7
