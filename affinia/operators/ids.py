"""Dense ids for text keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.operators.skew import POSITION_BITS
from affinia.session import cut_lineage


def id_dictionary(df: DataFrame, column: str) -> DataFrame:
    """Distinct ids with a dense 1-based index in key order: ``id, idx``.

    The ids are range-partitioned and sorted where they lie; their positions inside the
    partitions are written out once (the range bounds are sampled, so they must not be
    drawn again), and the row counts of the partitions before are added. The ids are
    never gathered in one task: the only global window runs over one row per partition,
    and that same table is what is broadcast.
    """
    placed = (
        df.select(F.col(column).alias("id"))
        .where(F.col("id").isNotNull())
        .distinct()
        .repartitionByRange("id")
        .sortWithinPartitions("id")
        .withColumn("_position", F.monotonically_increasing_id())
    )
    placed = cut_lineage(placed).select(
        "id",
        F.shiftright("_position", POSITION_BITS).alias("_part"),
        F.col("_position").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).alias("_offset"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count("id").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return placed.join(F.broadcast(starts), "_part").select(
        "id", (F.col("_start") + F.col("_offset") + 1).alias("idx")
    )


def encode_ids(df: DataFrame, dictionary: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Replace ``column`` by its index; an id the dictionary lacks becomes null."""
    target = name or column
    lookup = dictionary.select(F.col("id").alias(column), F.col("idx").alias("_idx"))
    kept = [c for c in df.columns if c != column]
    return df.join(lookup, column, "left").select(*kept, F.col("_idx").alias(target)).select(
        *[target if c == column else c for c in df.columns]
    )


def decode_ids(df: DataFrame, dictionary: DataFrame, column: str) -> DataFrame:
    """Replace an index by its id; an index the dictionary lacks becomes null."""
    return encode_ids(df, dictionary.select(F.col("idx").alias("id"), F.col("id").alias("idx")), column)


def decode_recs(recs: DataFrame, users: DataFrame | None = None, items: DataFrame | None = None) -> DataFrame:
    """Recommendation rows with text ids; either dictionary may be left out."""
    decoded = recs if items is None else decode_ids(recs, items, "item")
    return decoded if users is None else decode_ids(decoded, users, "user")
