from __future__ import annotations

from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from affinia.operators.stats import key_lists, sort_by_value
from affinia.session import cut_lineage, scratch_path, shared_dir
from affinia.sources.results import (
    STATISTICS_RESULTS,
    clean,
    read_results,
    row_key,
    statistics_results,
    write_results,
    write_split,
)
from affinia.sources.text import parse_criteria, parse_interactions, read_criteria, read_interactions


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_malformed_lines_are_dropped(spark):
    df = lines(spark, "u1\ti1\t2.5", "u1\t", "u1\t\tx", "u2", "", "u3\ti3\t\t", "u4\ti4")
    assert rows(parse_interactions(df), "user", "item") == [
        ("u1", ""),
        ("u1", "i1"),
        ("u3", "i3"),
        ("u4", "i4"),
    ]
    assert rows(parse_interactions(df, pref_idx=2).where("pref IS NOT NULL"), "user", "item", "pref") == [
        ("u1", "i1", 2.5)
    ]


def test_separator_is_a_pattern_and_positions_are_free(spark):
    df = lines(spark, "a ; b;c ;d", "a;b")
    assert rows(parse_interactions(df, r"\s*;\s*", 3, 0), "user", "item") == [("d", "a")]


def test_criteria(spark):
    df = lines(spark, "u\ti\t1\t2.5", "u\ti\t1", "u\ti\tx\t3")
    assert parse_criteria(df, pref_idxs="2-3").collect() == parse_criteria(df, pref_idxs=[2, 3]).collect()
    got = {(r.c1, r.c2) for r in parse_criteria(df, pref_idxs="2-3", pref_count=2).collect()}
    assert got == {(1.0, 2.5), (None, 3.0)}
    with pytest.raises(ValueError):
        parse_criteria(df, pref_idxs="2-3", pref_count=3)


def test_read_from_files(spark):
    path = scratch_path(spark, "text")
    lines(spark, "u\ti\t1\t2", "short").write.text(path)
    assert rows(read_interactions(spark, path), "user", "item") == [("u", "i")]
    assert rows(read_criteria(spark, path, pref_idxs="2-3"), "c1", "c2") == [(1.0, 2.0)]


def test_sink_replaces_only_its_batch(spark):
    base = scratch_path(spark, "sink")
    first = spark.createDataFrame([("x\ty ", 1), ("z", 2)], "key string, n int")
    table = first.select(row_key("01", "key").alias("target_id"), "n")
    for batch in ("01", "02"):
        write_results(table, base, "t", batch)
    write_results(table.where("n = 2"), base, "t", "01")
    assert rows(read_results(spark, base, "t"), "batch_id", "target_id", "n") == [
        ("01", "01_z", 2),
        ("02", "01_x y", 1),
        ("02", "01_z", 2),
    ]
    assert read_results(spark, base, "t", "02").count() == 2
    assert first.select(clean("key").alias("k")).where("k = 'x y'").count() == 1


def test_empty_batch_can_be_read(spark):
    base = scratch_path(spark, "empty")
    none = spark.createDataFrame([], "kind string, key string, n bigint")
    write_results(statistics_results(none, "b"), base, STATISTICS_RESULTS, "b")
    assert read_results(spark, base, STATISTICS_RESULTS, "b").count() == 0


def test_split_folders(spark, hot):
    path = scratch_path(spark, "split")
    write_split(hot.withColumn("split", F.when(F.col("item") % 2 == 0, "train").otherwise("test")), path)
    assert spark.read.parquet(f"{path}/split=train").count() + spark.read.parquet(f"{path}/split=test").count() == hot.count()


@pytest.mark.parametrize("max_entries", [3, 1000])
def test_key_lists_are_pages_in_key_order(spark, max_entries):
    counts = spark.range(40).select(
        F.lit("k").alias("kind"), F.format_string("%02d", "id").alias("key"), F.col("id").alias("n")
    )
    lists = sorted(key_lists(counts.repartition(3), max_entries).collect(), key=lambda r: r.part)
    assert [r.part for r in lists] == list(range(-(-40 // max_entries)))
    assert [e for r in lists for e in r.keys_list.split(",")] == [f"{i:02d}:{i}" for i in range(40)]


@pytest.mark.parametrize("batch", ["é", "a b", "50%", "x/y", "k=v", "#1", "日本", "a:b"])
def test_any_batch_id_is_read_back_and_replaced(spark, batch):
    base = scratch_path(spark, "ids")
    rows_of = spark.createDataFrame([("t", 0, ["i"])], "target_id string, part int, item_list array<string>")
    for table in ("recommend_results", "other"):
        write_results(rows_of.unionByName(rows_of), base, table, batch)
        write_results(rows_of, base, table, batch)
        write_results(rows_of, base, table, "plain")
        assert rows(read_results(spark, base, table, batch), "batch_id", "target_id") == [(batch, "t")]
        assert rows(read_results(spark, base, table), "batch_id") == sorted([(batch,), ("plain",)])
    with pytest.raises(ValueError, match="needs an id"):
        write_results(rows_of, base, "t", "")


def test_sort_by_value_is_global(spark):
    df = spark.createDataFrame([("b", "2"), ("a", "2"), ("c", "10")], "key string, value string")
    assert [r.key for r in sort_by_value(df, "value", "key").collect()] == ["c", "a", "b"]


def test_cut_lineage_keeps_rows_and_types(hot):
    cut = cut_lineage(hot)
    assert cut.schema == hot.schema
    assert rows(cut, *hot.columns) == rows(hot, *hot.columns)


def test_a_cluster_must_name_its_shared_folder():
    class Context(SimpleNamespace):
        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    def session(master, setting):
        conf = SimpleNamespace(get=lambda key, default=None: setting or default)
        return SimpleNamespace(sparkContext=Context(master=master, folder=None), conf=conf)

    with pytest.raises(RuntimeError):
        shared_dir(session("yarn", None))
    assert shared_dir(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
