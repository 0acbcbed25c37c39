"""Histograms, popularity and other summaries of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.operators.skew import rank_within
from affinia.session import cut_lineage


def histogram(df: DataFrame, column: str, digits: int) -> DataFrame:
    """Rows per value rounded half-up to ``digits`` decimals: ``bucket, n``."""
    return df.groupBy(F.round(column, digits).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def item_popularity(scores: DataFrame) -> DataFrame:
    """Users per item: ``item, n``. Rows must be unique on (user, item)."""
    return scores.groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def sort_by_value(df: DataFrame, value: str, key: str) -> DataFrame:
    """Rows in the order of their value, ties by key; a range-partitioned global sort."""
    return df.orderBy(value, key)


def listagg(values: Column | str, order: Column | str | None = None, separator: str = ",") -> Column:
    """Ordered concatenation of a bounded group of texts."""
    text = F.col(values) if isinstance(values, str) else values
    key = text if order is None else (F.col(order) if isinstance(order, str) else order)
    rows = F.sort_array(F.collect_list(F.struct(key.alias("_key"), text.alias("_text"))))
    return F.array_join(rows["_text"], separator)


def key_lists(counts: DataFrame, max_entries: int = 1_000) -> DataFrame:
    """Statistics ``kind, key, n`` as ``key:n`` lists: ``kind, part, keys_list``.

    A page view of the rows: part p holds the keys of a kind from place ``p * max_entries + 1`` on, in key order.
    """
    counts = cut_lineage(counts.select("kind", "key", "n"))  # counted and ranked
    ranked = rank_within(counts, ["kind"], [F.col("key"), F.col("n")])
    placed = ranked.withColumn("part", F.floor((F.col("rank") - 1) / max_entries).cast("bigint"))
    entry = F.concat_ws(":", "key", F.col("n").cast("string"))
    return placed.groupBy("kind", "part").agg(listagg(entry, "rank").alias("keys_list"))
