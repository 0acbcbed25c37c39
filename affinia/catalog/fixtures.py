"""Interaction views on the given tables, used by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.functions.measures import Measure
from affinia.sources.results import write_split
from affinia.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ui_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as (user, item, quantity, price, discount); repeats are kept."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("item"),
        F.col("l_quantity").alias("pref"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_returnflag").alias("flag"),
    )


def ui(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer-part interactions, the quantity summed."""
    return ui_dup(spark, sf_dir).groupBy("user", "item").agg(F.sum("pref").alias("pref"))


def ui_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ui`` with text ids."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user"), "c_name")
    return (
        ui(spark, sf_dir)
        .join(customers, "user")
        .select(F.col("c_name").alias("user"), F.concat(F.lit("P"), F.col("item")).alias("item"), "pref")
    )


def ui_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User-event type interactions; few items, many users."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("user"), F.col("event_type").alias("item"))
        .agg(F.sum("value").alias("pref"))
    )


def brand_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands per order; repeats are kept."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("user"), F.col("p_brand").alias("item")
    )


def support(spark: SparkSession, sf_dir: str, share: int) -> int:
    """A minimum support that follows the data: one in ``share`` baskets, at least 2."""
    baskets = brand_rows(spark, sf_dir).where("item <> ''").select("user").distinct().count()
    return max(2, baskets // share)


def raw_lines(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Tab-separated lines, among them lines too short to use: one field only, and a
    user followed by empty fields."""
    rows = ui_dup(spark, sf_dir)
    good = rows.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in columns]).alias("value"))
    orders = table(spark, sf_dir, "orders")
    short = orders.select(F.col("o_custkey").cast("string").alias("value"))
    blank = orders.select(F.concat(F.col("o_custkey").cast("string"), F.lit("\t\t")).alias("value"))
    return good.unionByName(short).unionByName(blank)


def raw_path(spark: SparkSession, sf_dir: str, columns: list[str]) -> str:
    path = scratch_path(spark, "raw")
    raw_lines(spark, sf_dir, columns).write.text(path)
    return path


def split_path(spark: SparkSession, split: DataFrame) -> str:
    path = scratch_path(spark, "split")
    write_split(split, path)
    return path


def served_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of one market segment."""
    customers = table(spark, sf_dir, "customer")
    return customers.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("user"))


def served_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of one type."""
    parts = table(spark, sf_dir, "part")
    return parts.where(F.col("p_type") == "ECONOMY").select(F.col("p_partkey").alias("item"))


def excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every returned line, the customer and the part that follows the returned one."""
    returned = ui_dup(spark, sf_dir).where(F.col("flag") == "R")
    return returned.select("user", (F.col("item") + 1).alias("item")).distinct()


# A measure the library does not have: twice the shared users over all users of both.
def _dice(p):
    return 2 * p.co / (p.a["n"] + p.b["n"])


DICE = Measure("dice", _dice, pair_stats=("n",), uses_dot=False, estimate=_dice)
