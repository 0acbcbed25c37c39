"""Frequent itemsets, associated items, lift and association rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.operators.interactions import ROWS_PER_BLOCK as MAX_LIST
from affinia.operators.interactions import item_lists
from affinia.operators.skew import pairs_within, top_per_group
from affinia.session import cut_lineage, drop_table

ROWS_PER_BLOCK = 1_000


def basket_rows(ui: DataFrame, basket: str = "user", item: str = "item") -> DataFrame:
    """Distinct (basket, item) rows without blank items: baskets in long form."""
    rows = ui.select(F.col(basket).alias("basket"), F.col(item).cast("string").alias("item"))
    return rows.where(F.col("item") != "").distinct()


def baskets(ui: DataFrame, basket: str = "user", item: str = "item", max_list: int = MAX_LIST) -> DataFrame:
    """The distinct items of each basket, sorted: ``basket, part, items``.

    Part p holds the items from place ``p * max_list + 1`` on. The operators below work on ``basket_rows`` and build no such lists.
    """
    return item_lists(basket_rows(ui, basket, item), "basket", "item", max_list=max_list)


def basket_count(rows: DataFrame) -> DataFrame:
    """Number of baskets with at least one item, as one row ``n``."""
    return rows.select("basket").distinct().agg(F.count("basket").alias("n"))


def frequent_items(rows: DataFrame, min_support: int) -> DataFrame:
    """Items in at least ``min_support`` baskets: ``item, freq``."""
    return rows.groupBy("item").agg(F.count("basket").alias("freq")).where(F.col("freq") >= min_support)


def frequent_pairs(rows: DataFrame, min_support: int, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Item pairs in at least ``min_support`` baskets, with the supports of both items:
    ``item_a, item_b, freq, freq_a, freq_b``.

    Infrequent items cannot be part of a frequent pair and go first. A hot basket is
    paired in blocks. The item supports travel with the rows, so pairs are joined to
    nothing afterwards.
    """
    kept = rows.join(frequent_items(rows, min_support), "item")
    pairs = pairs_within(kept, "basket", "item", ["freq"], kept, "item", rows_per_block)
    return (
        pairs.groupBy("item_a", "item_b", "freq_a", "freq_b")
        .agg(F.count(F.lit(1)).alias("freq"))
        .where(F.col("freq") >= min_support)
        .select("item_a", "item_b", "freq", "freq_a", "freq_b")
    )


def _candidates(sets: DataFrame, size: int, rows_per_block: int) -> DataFrame:
    """Sets of ``size + 1`` items all of whose subsets of ``size`` are in ``sets``: ``items, left, right``.

    Two sets that differ in their last item only are joined; ``left`` and ``right`` are these two. The other
    subsets are looked up in ``sets``.
    """
    stems = sets.select(
        F.slice("items", 1, size - 1).alias("stem"), F.get("items", F.lit(size - 1)).alias("last"), "items"
    )
    pairs = pairs_within(stems, "stem", "last", ["items"], stems, "last", rows_per_block)
    joined = pairs.select(
        F.concat("items_a", F.array("item_b")).alias("items"),
        F.col("items_a").alias("left"),
        F.col("items_b").alias("right"),
    )
    without = F.transform(F.sequence(F.lit(0), F.lit(size - 2)), lambda i: F.filter("items", lambda _, j: j != i))
    found = joined.withColumn("_subset", F.explode(without)).join(sets.select(F.col("items").alias("_subset")), "_subset")
    return (
        found.groupBy("items", "left", "right")
        .agg(F.count(F.lit(1)).alias("_found"))
        .where(F.col("_found") == size - 1)
        .drop("_found")
    )


def _numbered(sets: DataFrame) -> DataFrame:
    """Sets stored with a ``number`` of their own, which stands for them in the rows of the baskets."""
    return cut_lineage(sets.withColumn("number", F.monotonically_increasing_id()))


def _parts_numbered(candidates: DataFrame, sets: DataFrame) -> DataFrame:
    """``left`` and ``right`` of candidates as the numbers of these sets."""
    for part in ("left", "right"):
        names = sets.select(F.col("items").alias(part), F.col("number").alias(f"_{part}"))
        candidates = candidates.join(names, part).drop(part).withColumnRenamed(f"_{part}", part)
    return candidates


def _holding(held: DataFrame, candidates: DataFrame) -> DataFrame:
    """``basket, number`` for every candidate and basket that holds both of its parts.

    The second join is on basket and part, so the sets of a large basket meet in many tasks.
    """
    left = held.select("basket", F.col("number").alias("left"))
    right = held.select("basket", F.col("number").alias("right"))
    met = left.join(candidates.select("left", "right", "number"), "left").select("basket", "right", "number")
    return met.join(right, ["basket", "right"]).drop("right")


def frequent_itemsets(
    rows: DataFrame, min_support: int = 100, max_len: int | None = None, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Itemsets in at least ``min_support`` baskets: ``items`` (sorted array), ``freq``.

    ``rows`` comes from ``basket_rows``. Level by level: the frequent sets of one size are joined to candidates of
    the next, candidates with an infrequent subset are dropped, and the baskets that hold a candidate are found by
    joining those that hold its two parts. Baskets hold sets by number. Sets, candidates and these rows are tables, whatever their
    number; the driver sees only how many there are. The rows of a level go when those of the next are stored. Sizes beyond 2
    run jobs when called.
    """
    single = frequent_items(rows, min_support)
    levels = [single.select(F.array("item").alias("items"), "freq")]
    if max_len == 1:
        return levels[0]
    pairs = frequent_pairs(rows, min_support, rows_per_block)
    if max_len == 2:
        return levels[0].unionByName(pairs.select(F.array("item_a", "item_b").alias("items"), "freq"))
    levels = [_numbered(levels[0])]
    parts = [F.array(c).alias(n) for c, n in (("item_a", "left"), ("item_b", "right"))]
    pairs = _numbered(pairs.select(F.array("item_a", "item_b").alias("items"), "freq", *parts))
    levels.append(pairs.select("items", "freq", "number"))
    kept = rows.join(levels[0].select(F.get("items", F.lit(0)).alias("item"), "number"), "item").select("basket", "number")
    held = rows_of_level = cut_lineage(_holding(kept, _parts_numbered(pairs, levels[0])))
    size = 2
    # A set of one more item needs all of its size + 1 subsets.
    while (max_len is None or size < max_len) and levels[-1].count() > size:
        candidates = _numbered(_parts_numbered(_candidates(levels[-1].select("items", "freq"), size, rows_per_block), levels[-1]))
        before, rows_of_level = rows_of_level, cut_lineage(_holding(held, candidates))
        drop_table(before)
        held = rows_of_level
        counts = held.groupBy("number").agg(F.count("basket").alias("freq")).where(F.col("freq") >= min_support)
        levels.append(cut_lineage(candidates.join(counts, "number").select("items", "freq", "number")))
        held = held.join(levels[-1].select("number"), "number", "left_semi")
        size += 1
    drop_table(rows_of_level)
    return reduce(DataFrame.unionByName, [level.select("items", "freq") for level in levels])


def associated_items(pairs: DataFrame, k: int = 50) -> DataFrame:
    """Partners of each item in frequent pairs, most frequent first: ``item, partner, freq, rank``."""
    both = F.array(
        F.struct(F.col("item_a").alias("item"), F.col("item_b").alias("partner")),
        F.struct(F.col("item_b").alias("item"), F.col("item_a").alias("partner")),
    )
    long = pairs.select(F.inline(both), "freq")
    return top_per_group(long, ["item"], [F.desc("freq"), F.col("partner")], k)


def associated_lists(associated: DataFrame) -> DataFrame:
    """``associated_items`` as one list per item; lists are bounded by its ``k``."""
    return (
        associated.groupBy("item")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "partner"))).alias("_rows"))
        .select("item", F.col("_rows.partner").alias("item_list"))
    )


def lift(joint: Column, n: Column, a: Column, b: Column) -> Column:
    """Lift of two itemsets: joint support times basket count over the product of supports."""
    return (joint * n).cast("double") / (a * b).cast("double")


def pair_lift(rows: DataFrame, min_support: int = 100, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Lift of each frequent pair: ``item_a, item_b, freq, freq_a, freq_b, lift``."""
    n = basket_count(rows).scalar()
    pairs = frequent_pairs(rows, min_support, rows_per_block)
    return pairs.withColumn("lift", lift(F.col("freq"), n, F.col("freq_a"), F.col("freq_b")))


def association_rules(rows: DataFrame, itemsets: DataFrame, min_confidence: float = 0.8) -> DataFrame:
    """Rules with a one-item consequent from frequent itemsets:
    ``antecedent, consequent, freq, support, confidence, lift``.

    All subsets of a frequent itemset are frequent, so both joins find their partner.
    """
    n = basket_count(rows).scalar()
    antecedents = itemsets.select(F.col("items").alias("antecedent"), F.col("freq").alias("_freq_x"))
    singles = itemsets.where(F.size("items") == 1).select(
        F.col("items")[0].alias("consequent"), F.col("freq").alias("_freq_y")
    )
    rules = (
        itemsets.where(F.size("items") > 1)
        .select("items", "freq", F.explode("items").alias("consequent"))
        .withColumn("antecedent", F.array_remove("items", F.col("consequent")))
        .join(antecedents, "antecedent")
        .withColumn("confidence", F.col("freq") / F.col("_freq_x"))
        .where(F.col("confidence") >= min_confidence)
        .join(singles, "consequent")
    )
    return rules.select(
        "antecedent",
        "consequent",
        "freq",
        (F.col("freq") / n).alias("support"),
        "confidence",
        lift(F.col("freq"), n, F.col("_freq_x"), F.col("_freq_y")).alias("lift"),
    )
