"""Result tables: Parquet, one folder per table, partitioned by batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from affinia.operators.stats import key_lists

RECOMMEND_RESULTS = "recommend_results"
EVALUATION_CHECKLIST = "evaluation_checklist"
STATISTICS_RESULTS = "statistics_results"
STATISTICS_ROWS = "statistics_rows"
ITEM_SIMILARITIES = "item_similarities"

# Columns of the fixed result tables; a batch without rows leaves no file to read them from.
SCHEMAS = {
    RECOMMEND_RESULTS: "target_id string, part int, item_list array<string>, batch_id string",
    EVALUATION_CHECKLIST: (
        "target_id string, precision double, recall double, f1 double, lift double, batch_id string"
    ),
    STATISTICS_ROWS: "kind string, key string, n bigint, batch_id string",
    STATISTICS_RESULTS: "target_id string, part bigint, keys_list string, quota_mean string, batch_id string",
}


def clean(column: Column | str) -> Column:
    """Text of a key or value as stored: tabs become blanks, ends are trimmed."""
    return F.trim(F.translate(F.col(column) if isinstance(column, str) else column, "\t", " "))


def row_key(batch_id: str, *parts: Column | str) -> Column:
    """``<batch>_<key>``, the key of a result row."""
    columns = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.concat_ws("_", F.lit(batch_id), clean(F.concat_ws("-", *columns)))


def write_results(df: DataFrame, base: str, table: str, batch_id: str) -> str:
    """Write ``df`` as the rows of one batch of a result table; returns the table path.

    Only the folder of this batch is replaced, also by no rows, so a run may be repeated. The folder is named
    as Spark names partitions, so the id may be any text but the empty one, which Spark reads back as null.
    """
    if not batch_id:
        raise ValueError("a batch needs an id")
    path = f"{base.rstrip('/')}/{table}"
    utils = df.sparkSession._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folder = utils.getPartitionPathString("batch_id", batch_id)
    df.drop("batch_id").write.mode("overwrite").parquet(f"{path}/{folder}")
    return path


def read_results(spark: SparkSession, base: str, table: str, batch_id: str | None = None) -> DataFrame:
    """Rows of a result table; with ``batch_id`` only its partition is read."""
    path = f"{base.rstrip('/')}/{table}"
    schema = SCHEMAS.get(table)
    if schema is None:
        # Batch ids are text; left to inference, batch "01" would be read as 1.
        fields = spark.read.parquet(path).schema.fields
        schema = StructType([StructField(f.name, StringType()) if f.name == "batch_id" else f for f in fields])
    rows = spark.read.schema(schema).parquet(path)
    return rows if batch_id is None else rows.where(F.col("batch_id") == batch_id)


def write_split(df: DataFrame, path: str) -> None:
    """Write a train/test split as two folders, ``split=train`` and ``split=test``."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_tables(tables: dict[str, DataFrame], base: str | None, batch_id: str) -> dict[str, DataFrame]:
    """Write each table of a run if ``base`` is given; returns the tables, as stored if they were."""
    if base is None:
        return tables
    stored = {}
    for name, table in tables.items():
        write_results(table, base, name, batch_id)
        stored[name] = read_results(table.sparkSession, base, name, batch_id).select(table.columns)
    return stored


def item_list_results(lists: DataFrame, key: str, batch_id: str) -> DataFrame:
    """Lists as rows of the recommend-results table: ``target_id`` (``<batch>_<key>``),
    ``part`` (0 unless a long list was split) and ``item_list``, an array of text."""
    return lists.select(
        row_key(batch_id, key).alias("target_id"), "part", F.col("item_list").cast("array<string>").alias("item_list")
    )


def recommend_results(recs: DataFrame, batch_id: str) -> DataFrame:
    """Recommendation rows as the recommend-results table, best item first. Lists are
    bounded by the number of recommendations per user."""
    lists = recs.groupBy("user").agg(F.sort_array(F.collect_list(F.struct("rank", "item"))).alias("_rows"))
    named = lists.select("user", F.lit(0).alias("part"), F.col("_rows.item").alias("item_list"))
    return item_list_results(named, "user", batch_id)


def evaluation_checklist(metrics: DataFrame, batch_id: str) -> DataFrame:
    """Metrics per user as rows of the evaluation checklist, keyed ``<batch>_<user>``."""
    return metrics.select(
        row_key(batch_id, "user").alias("target_id"),
        "precision",
        "recall",
        "f1",
        F.lit(None).cast("double").alias("lift"),
    )


def lift_checklist(lifts: DataFrame, batch_id: str) -> DataFrame:
    """Lift per pair as rows of the evaluation checklist, keyed ``<batch>_<a>-<b>``."""
    none = F.lit(None).cast("double")
    return lifts.select(
        row_key(batch_id, "item_a", "item_b").alias("target_id"),
        none.alias("precision"),
        none.alias("recall"),
        none.alias("f1"),
        "lift",
    )


def statistics_results(
    counts: DataFrame, batch_id: str, means: DataFrame | None = None, max_entries: int = 1_000
) -> DataFrame:
    """Statistics as the statistics-results table: ``target_id, part, keys_list, quota_mean``.

    ``counts`` has ``kind, key, n``; ``means`` has ``kind, quota_mean`` for the kinds that
    carry means.
    """
    lists = key_lists(counts, max_entries)
    if means is None:
        lists = lists.withColumn("quota_mean", F.lit(None).cast("string"))
    else:
        # One row per kind of statistic, a handful by design.
        lists = lists.join(F.broadcast(means.select("kind", "quota_mean")), "kind", "left")
    return lists.select(row_key(batch_id, "kind").alias("target_id"), "part", "keys_list", "quota_mean")
