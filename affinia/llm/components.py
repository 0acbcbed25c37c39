"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component): the smallest id reachable from each id of ``links`` (a, b).

    Each round hangs the neighbours of an id below the smallest of them (large star), then does the
    same among the smaller ones (small star); the links converge to stars around each component's
    smallest id in about log2 of the longest path. Every round is written to the shared folder.
    """
    links = scratch.keep(links.select("a", "b").where("a <> b").distinct())
    while True:
        # Large star: larger neighbours of an id are linked to the smallest of its neighbours and itself.
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.keep(large.where("a <> b").distinct())
        # Small star: smaller neighbours of an id, and itself, are linked to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        following = scratch.keep(small.where("a <> b").distinct())
        # Stars: no id is both below one and above another.
        done = following.join(following.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty() and (
            following.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
        )
        scratch.drop(large)
        scratch.drop(links)
        links = following
        if done:
            break
    centres = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(centres)
