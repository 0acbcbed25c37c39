"""Splitting of hot groups.

A key may own a large share of all rows. The helpers here look at the row count
of each key, leave ordinary keys alone, and give keys above ``rows_per_block`` a
number of blocks in proportion to their size. Nothing is dropped or sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinia.session import cut_lineage

BLOCKS = "_blocks"

# Window limits up to this size are applied before the shuffle by Spark
# (spark.sql.optimizer.windowGroupLimitThreshold).
PRUNED_LIMIT = 1000

# Rows of a group that one task may rank.
RANK_BLOCK = 100_000

# monotonically_increasing_id keeps the row position in its low 33 bits.
POSITION_BITS = 33


def hot_keys(df: DataFrame, key: str, rows_per_block: int) -> DataFrame:
    """Keys with more than ``rows_per_block`` rows, stored: ``key, _rows``; at most rows / rows_per_block of them."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return cut_lineage(counts.where(F.col("_rows") > rows_per_block).where(F.col(key).isNotNull()))


def with_blocks(
    df: DataFrame, key: str, counted: DataFrame, count_column: str, rows_per_block: int
) -> DataFrame:
    """Add ``_blocks``: 1 for ordinary keys, ceil(rows / rows_per_block) for hot ones.

    The rows of each key are counted in ``counted``: ``df`` itself or a plainer table with
    the same rows per key. ``count_column`` must not be null; counting it (rather than
    ``*``) keeps it in the shuffle that feeds both tables, so Spark can reuse that. The
    table of hot keys carries no broadcast hint: adaptive execution broadcasts it
    when its measured size allows and splits the hot partition otherwise.
    """
    hot = (
        counted.groupBy(key)
        .agg(F.count(count_column).alias("_rows"))
        .where(F.col("_rows") > rows_per_block)
        .select(key, F.ceil(F.col("_rows") / rows_per_block).cast("int").alias(BLOCKS))
    )
    return df.join(hot, key, "left").withColumn(BLOCKS, F.coalesce(BLOCKS, F.lit(1)))


def block_of(column: str) -> Column:
    """Block of a row inside its key, by the hash of ``column``."""
    return F.pmod(F.xxhash64(column), F.col(BLOCKS)).cast("int")


def join_hot(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: str,
    counted: DataFrame,
    count_column: str,
    rows_per_block: int,
) -> DataFrame:
    """Inner join on ``key`` of rows that may be hot with a side of few rows per key.

    Each left row multiplies by the right rows of its key, so a hot key is more than a
    skewed read. Its left rows are spread over blocks by the hash of ``spread`` and its
    right rows are repeated for each block; other keys have one block.
    """
    rows = with_blocks(left, key, counted, count_column, rows_per_block).withColumn("_block", block_of(spread))
    repeated = with_blocks(right, key, counted, count_column, rows_per_block).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.col(BLOCKS) - 1))
    )
    return rows.drop(BLOCKS).join(repeated.drop(BLOCKS), [key, "_block"]).drop("_block")


def pairs_within(
    df: DataFrame,
    key: str,
    item: str,
    carry: list[str],
    counted: DataFrame | None,
    count_column: str,
    rows_per_block: int,
    keep: Column | None = None,
) -> DataFrame:
    """Every pair ``item_a < item_b`` of items that share a ``key``.

    Returns ``item_a``, ``item_b`` and, for each carried column, ``<c>_a`` and ``<c>_b``.
    Rows must be unique on (key, item).

    The items of a hot key fall into B blocks and the pairs into B(B+1)/2 cells, one
    per unordered pair of blocks; a row is sent to the B cells of its block. Cells are
    the join key, so the work of one key is spread over many tasks and no task sees
    more than two blocks of it. With B = 1 this is the plain self-join, and so it is for
    all keys with ``counted=None``, which states that none is hot. ``keep`` is an
    optional filter on the pair columns, applied inside the join.
    """
    if counted is None:
        a, b = (
            df.select(key, F.col(item).alias(f"item{x}"), *[F.col(c).alias(f"{c}{x}") for c in carry])
            for x in ("_a", "_b")
        )
        met = a.join(b, key).where(F.col("item_a") < F.col("item_b"))
        met = met if keep is None else met.where(keep)
        return met.select("item_a", "item_b", *[f"{c}{s}" for c in carry for s in ("_a", "_b")])
    cells = (
        with_blocks(df, key, counted, count_column, rows_per_block)
        .withColumn("_block", block_of(item))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(BLOCKS) - 1)))
        .select(
            key,
            item,
            *carry,
            "_block",
            F.least("_block", "_other").alias("_lo"),
            F.greatest("_block", "_other").alias("_hi"),
        )
    )

    def side(suffix: str) -> DataFrame:
        return cells.select(
            F.col(key).alias(f"_key{suffix}"),
            F.col("_lo").alias(f"_lo{suffix}"),
            F.col("_hi").alias(f"_hi{suffix}"),
            F.col("_block").alias(f"_block{suffix}"),
            F.col(item).alias(f"item{suffix}"),
            *[F.col(c).alias(f"{c}{suffix}") for c in carry],
        )

    on = (
        (F.col("_key_a") == F.col("_key_b"))
        & (F.col("_lo_a") == F.col("_lo_b"))
        & (F.col("_hi_a") == F.col("_hi_b"))
        & (F.col("item_a") < F.col("item_b"))
        # Two items of one block meet in all of its cells; count them in its own cell only.
        & ((F.col("_block_a") != F.col("_block_b")) | (F.col("_lo_a") == F.col("_hi_a")))
    )
    if keep is not None:
        on = on & keep
    return (
        side("_a")
        .join(side("_b"), on)
        .select("item_a", "item_b", *[f"{c}{s}" for c in carry for s in ("_a", "_b")])
    )


def rank_within(
    df: DataFrame, group: list[str], order: list[Column], rows_per_block: int = RANK_BLOCK, rank: str = "rank"
) -> DataFrame:
    """Exact rank (a long, from 1) of each row within its group, for groups of any size.

    Groups of at most ``rows_per_block`` rows are ranked by a window. The rows of larger ones are
    range-partitioned by group and order, sorted where they lie and stored; a row's rank is its place in its
    partition, plus the group's rows in the partitions before. Only those counts, one per group and partition,
    are windowed. Both ways give the same ranks; rows equal in ``order`` are ranked in any order.
    """
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > rows_per_block)
    hot = cut_lineage(counts.select(*[F.col(g).alias(f"_hot_{g}") for g in group]))
    window = F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("long")
    if hot.isEmpty():
        return df.withColumn(rank, window)
    same = [df[g].eqNullSafe(hot[f"_hot_{g}"]) for g in group]
    ranked = df.join(hot, same, "left_anti").withColumn(rank, window)
    by = [*[F.col(g) for g in group], *order]
    heavy = df.join(hot, same, "left_semi").withColumn("_tie", F.monotonically_increasing_id())
    placed = heavy.repartitionByRange(*by, "_tie").sortWithinPartitions(*by, "_tie").drop("_tie")
    placed = cut_lineage(placed.withColumn("_position", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_position", POSITION_BITS))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_position").alias("_first"))
    parts = parts.select(
        *[F.col(g).alias(f"_hot_{g}") for g in group], F.col("_part").alias("_hot_part"), "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    same = [placed[g].eqNullSafe(parts[f"_hot_{g}"]) for g in group]
    met = placed.join(parts, [*same, placed["_part"] == parts["_hot_part"]])
    place = (F.col("_position") - F.col("_first") + F.col("_before") + 1).cast("long").alias(rank)
    return ranked.unionByName(met.select(*df.columns, place))


def top_per_group(
    df: DataFrame, group: list[str], order: list[Column], limit: int, rank: str = "rank", rows_per_block: int = RANK_BLOCK
) -> DataFrame:
    """First ``limit`` rows of each group; ``order`` must be a full order.

    Up to ``PRUNED_LIMIT`` rows Spark keeps only the best rows of each group in every
    map task, so a hot group shrinks before it is shuffled. Beyond that it does not, so
    hot groups are ranked in ranges (see ``rank_within``), and no task sees more of one
    than its range or ``rows_per_block`` rows.
    """
    if limit > PRUNED_LIMIT:
        kept = rank_within(df, group, order, rows_per_block, rank).where(F.col(rank) <= limit)
        return kept.withColumn(rank, F.col(rank).cast("int"))
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return numbered.where(F.col(rank) <= limit)


def rank_by_hash(
    df: DataFrame, key: str, tie: str, seed: int | str, rows_per_block: int, size: str = "_size", rank: str = "_rank"
) -> DataFrame:
    """Exact rank of each row within its key, in the order of a seeded md5 of (key, tie).

    Adds ``size`` (rows of the key) and ``rank`` (1-based). Rows must be unique on
    (key, tie). The rows of a hot key are first grouped by leading hex digits of the
    hash, enough of them for about ``rows_per_block`` rows per group; ranks are taken
    inside the groups and shifted by the rows of the groups before.
    """
    # Taken where it is needed: its 32 characters are most of a row and would travel with every shuffle.
    hashed = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key), F.col(tie)))
    sizes = df.groupBy(key).agg(F.count(tie).alias(size))
    digits = F.ceil(F.log(16.0, F.col(size) / rows_per_block)).cast("int")
    grouped = df.join(sizes, key).withColumn(
        "_prefix",
        F.when(F.col(size) <= rows_per_block, F.lit("")).otherwise(F.substring(hashed, F.lit(1), digits)),
    )
    before = Window.partitionBy(key).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        grouped.where(F.col(size) > rows_per_block)
        .groupBy(key, "_prefix")
        .agg(F.count(tie).alias("_rows"))
        .select(key, "_prefix", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    )
    inner = Window.partitionBy(key, "_prefix").orderBy(hashed, tie)
    return (
        grouped.join(shifts, [key, "_prefix"], "left")
        .withColumn(rank, F.row_number().over(inner) + F.coalesce("_shift", F.lit(0)))
        .drop("_prefix", "_shift")
    )
