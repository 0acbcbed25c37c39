"""Shaping of (user, item, preference) rows before any analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.operators.skew import rank_within, top_per_group
from affinia.session import picked_from

ROWS_PER_BLOCK = 100_000

_ON_DUPLICATE = {"max": F.max, "sum": F.sum, "avg": F.avg}


def dedupe(ui: DataFrame, columns: Sequence[str] = ("user", "item", "pref")) -> DataFrame:
    """Distinct interactions over the given columns."""
    return ui.select(*columns).distinct()


def one_pref_per_item(ui: DataFrame, on_duplicate: str = "max") -> DataFrame:
    """One row per (user, item); several preferences are merged by max, sum or avg."""
    if on_duplicate not in _ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {sorted(_ON_DUPLICATE)}")
    return ui.groupBy("user", "item").agg(_ON_DUPLICATE[on_duplicate]("pref").alias("pref"))


def as_boolean(ui: DataFrame) -> DataFrame:
    """Ignore preference values: every interaction weighs 1.0."""
    return ui.withColumn("pref", F.lit(1.0))


def complete(prefs: DataFrame) -> DataFrame:
    """Rows with a user, an item and a preference that is a number other than 0, which is no entry; as doubles.

    Joins on these columns would drop incomplete rows anyway, but each at its own place.
    Dropped here, every branch of a plan starts from the same rows and columns, and Spark
    scans and shuffles the input once for all of them.
    """
    pref = F.col("pref").cast("double")
    entry = F.col("user").isNotNull() & F.col("item").isNotNull() & (F.col("pref") != 0) & ~F.isnan(pref)
    return picked_from(prefs, prefs.where(entry).withColumn("pref", pref))


def min_prefs(ui: DataFrame, n: int) -> DataFrame:
    """Users with at least ``n`` rows. Counted apart from the rows, so a hot user is
    pre-aggregated and its rows are never gathered in one task."""
    if n <= 1:
        return ui
    kept = ui.groupBy("user").agg(F.count("item").alias("_rows")).where(F.col("_rows") >= n)
    return ui.join(kept.select("user"), "user", "left_semi")


def top_prefs(ui: DataFrame, m: int | None) -> DataFrame:
    """The ``m`` strongest preferences of each user, by absolute value, then item."""
    if m is None:
        return ui
    order = [F.abs("pref").desc(), F.col("item")]
    return top_per_group(ui, ["user"], order, m, rank="_rank").drop("_rank")


def sample_prefs(ui: DataFrame, m: int | None, seed: int | str = 42) -> DataFrame:
    """Users with more than ``m`` rows are sampled down to ``m``, in seeded md5 order.

    This is the optional bound on heavy users in similarity; the same seed always
    keeps the same rows. Rows must be unique on (user, item).
    """
    if m is None:
        return ui
    order = [F.md5(F.concat_ws("|", F.lit(str(seed)), "user", "item")), F.col("item")]
    return top_per_group(ui, ["user"], order, m, rank="_rank").drop("_rank")


def rating_matrix(
    ui: DataFrame,
    boolean: bool = False,
    min_prefs_per_user: int = 1,
    on_duplicate: str | None = "max",
) -> DataFrame:
    """The sparse user-item matrix as rows: unique (user, item), no zero entries,
    users below ``min_prefs_per_user`` left out.

    ``on_duplicate=None`` states that the input is already unique on (user, item).
    """
    source = as_boolean(ui) if boolean else ui
    unique = source if on_duplicate is None else one_pref_per_item(source, on_duplicate)
    return min_prefs(complete(unique.select("user", "item", "pref")).where(F.col("pref") != 0), min_prefs_per_user)


def ranked_rows(
    df: DataFrame,
    user: str = "user",
    entry: Column | str = "item",
    order: Sequence[Column | str] = (),
    name: str = "item",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Entries of each user with their exact rank: ``user, rank, <name>``, in ``order`` and then by entry."""
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    value = F.col(entry) if isinstance(entry, str) else entry
    rows = df.select(user, F.struct(*[k.alias(f"_{i}") for i, k in enumerate(keys)], value.alias("_entry")).alias("_row"))
    ranked = rank_within(rows, [user], [F.col("_row")], rows_per_block)
    return ranked.select(user, "rank", F.col("_row._entry").alias(name))


def item_lists(
    df: DataFrame,
    user: str = "user",
    entry: Column | str = "item",
    order: Sequence[Column | str] = (),
    max_list: int = ROWS_PER_BLOCK,
    name: str = "items",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """``ranked_rows`` as lists: ``user, part, <name>``.

    Part p holds ranks ``p * max_list + 1`` to ``(p + 1) * max_list``, for a user of any size: the parts
    in order are the user's whole ordered list.
    """
    ranked = ranked_rows(df, user, entry, order, "_entry", rows_per_block)
    placed = ranked.withColumn("part", F.floor((F.col("rank") - 1) / max_list).cast("int"))
    return (
        placed.groupBy(user, "part")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "_entry"))).alias("_rows"))
        .select(user, "part", F.col("_rows._entry").alias(name))
    )


def collect_items(ui: DataFrame, max_list: int = ROWS_PER_BLOCK) -> DataFrame:
    """Items of each user as sorted lists of at most ``max_list``, the parts in order."""
    return item_lists(ui, max_list=max_list)
