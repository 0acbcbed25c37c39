"""Item-item similarity from shared users."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinia.functions.measures import ITEM_STATS, Measure, Pair, measure_named
from affinia.operators.ids import decode_ids, id_dictionary
from affinia.operators.interactions import complete, sample_prefs
from affinia.operators.product import INTEGRAL, best_of_rows, packed, sparse_product
from affinia.operators.skew import hot_keys, pairs_within, top_per_group
from affinia.session import cut_lineage, picked_from

# A hot user's items are paired in blocks of this many rows.
ROWS_PER_BLOCK = 1_000

# Slack of comparisons between bounds and similarities that are sums of doubles.
MARGIN = 2e-9

# Classes of users per doubling of their rows, for the order in which rows enter a prefix.
CLASSES = 8

# The prefix plan is taken where it pairs at most this share of the plain plan's pairs.
PREFIX_SHARE = 0.25

# The pruned plan, which reads its input several times, is taken where heavy users make at least this many
# times the pairs of all others.
HEAVY_FACTOR = 4.0

# For the plain sums over the users of a pair.
COOCCURRENCE_AND_DOT = Measure("sums", lambda p: p.dot)


def item_stats(prefs: DataFrame) -> DataFrame:
    """Per item: non-zero count, sum, squared norm, largest magnitude, smallest value, mean, the sum of
    squared deviations from the mean, and a bound of the largest deviation."""
    high, low, mean = F.max("pref"), F.min("pref"), F.avg("pref")
    return complete(prefs).groupBy("item").agg(
        F.count("pref").alias("n"),
        F.sum("pref").alias("total"),
        F.sum(F.col("pref") * F.col("pref")).alias("norm2"),
        F.max(F.abs("pref")).alias("peak"),
        low.alias("low"),
        mean.alias("mean"),
        (F.var_pop("pref") * F.count("pref")).alias("ssd"),
        F.greatest(high - mean, mean - low).alias("spread"),
    )


def user_count(prefs: DataFrame) -> Column:
    """Number of distinct users as a scalar subquery, computed once per query."""
    return prefs.select("user").distinct().agg(F.count("user")).scalar()


def cooccurrence(prefs: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Per item pair: users that have both (``co``) and the dot product (``dot``).

    ``prefs`` must be unique on (user, item).
    """
    totals, items = _products(complete(prefs), COOCCURRENCE_AND_DOT, "above", rows_per_block)
    return _named(totals.select("row", "other", "co", "dot"), items, "item_a", "item_b")


def _products(
    prefs: DataFrame,
    m: Measure,
    pairs: str,
    rows_per_block: int,
    k: int | None = None,
    marked: DataFrame | None = None,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Sums per pair of items with their statistics, made item by item: ``row, other, co, dot, <s>_a, <s>_b``.

    With ``k``, pairs that are surely not among the ``k`` best of the row may be left out. With rows ``marked``
    (user, item), for measures without a dot product, ``dot`` counts the users whose rows of both items are among them.

    ``then`` is what becomes of the sums, row by row (see ``sparse_product``). Also returns the dictionary to name the
    items by, or None where they are named.
    """
    prefs = _stored(prefs)
    stats = sorted(set(m.pair_stats))
    numbers = id_dictionary(prefs, "item").withColumnRenamed("id", "item")
    items = cut_lineage(numbers.join(item_stats(prefs), "item").select("item", "idx", *sorted({*stats, *m.row_stats})))
    # Numbers made from preferences and means fill eight bytes; the preferences they are made of travel packed.
    late = m.weigh is not None and m.uses_dot and marked is None
    weight = F.col("pref") if late else m.weight(F.col("pref"), {s: F.col(s) for s in m.row_stats})
    number = F.col("idx").cast("int")
    if marked is not None:
        found = marked.select("user", "item", F.lit(1.0).alias("_marked"))
        prefs = prefs.join(found, ["user", "item"], "left")
        weight = F.coalesce("_marked", F.lit(0.0))
    rows = prefs.join(items, "item").select(F.col("user").alias("key"), number.alias("number"), weight.alias("value"))
    rows = cut_lineage(rows)
    how = packed(rows, "value") if m.uses_dot or marked is not None else None
    whole = dict(prefs.dtypes)["item"] in INTEGRAL
    read = m.row_stats if late else ()
    vectors = items.select("idx", *sorted({*stats, *read}), *([F.col("item").alias("id")] if whole else []))
    counts = [F.col(f"n{x}").cast("bigint").alias(f"n{x}") for x in ("_a", "_b") if "n" in stats]
    others = [f"{s}{x}" for s in stats if s != "n" for x in ("_a", "_b")]

    def shown(totals: DataFrame) -> DataFrame:
        totals = totals.select("row", "other", F.col("n").alias("co"), *(["dot"] if how else []), *counts, *others)
        return totals if then is None else then(totals)

    totals = sparse_product(
        rows.withColumnRenamed("number", "row"),
        rows.withColumnRenamed("number", "other"),
        pairs,
        (how, how) if how else None,
        vectors=vectors if stats or read or whole else None,
        ids=whole,
        weigh=(m.weigh, read) if late else None,
        shown=stats,
        best=(_estimate(m, stats, rows), k) if k is not None and m.estimate is not None else None,
        rows_per_list=max(rows_per_block, ROWS_PER_BLOCK),
        then=None if then is None else shown,
    )
    totals = shown(totals) if then is None else totals
    return totals, None if whole else items.select(F.col("item").alias("id"), "idx")


def _stored(prefs: DataFrame) -> DataFrame:
    """The rows to pair, stored once for all that read them."""
    return cut_lineage(picked_from(prefs, prefs.select("user", "item", "pref")))


def _estimate(m: Measure, stats: list[str], rows: DataFrame) -> Callable[[dict[str, np.ndarray]], np.ndarray]:
    users = rows.agg(F.count_distinct("key")).first()[0] if m.uses_users else None

    def estimate(sums: dict[str, np.ndarray]) -> np.ndarray:
        a, b = ({s: sums[f"{s}{x}"] for s in stats} for x in ("_a", "_b"))
        return m.estimate(Pair(sums["n"], sums.get("dot"), a, b, users)).astype(np.float64)

    return estimate


def _named(df: DataFrame, items: DataFrame | None, row: str, other: str) -> DataFrame:
    """The numbers of both items replaced by their ids."""
    if items is not None:
        df = decode_ids(decode_ids(df, items, "row"), items, "other")
    return df.withColumnsRenamed({"row": row, "other": other})


def _of(suffix: str) -> dict[str, Column]:
    return {s: F.col(f"{s}{suffix}") for s in (*ITEM_STATS, "users")}


def _weighted(prefs: DataFrame, m: Measure, carried: set[str]) -> DataFrame:
    """Rows ``user, item, pref, weight`` with the carried statistics of their items."""
    stats = carried - {"users"} | set(m.row_stats)
    rows = prefs
    if stats:
        rows = prefs.join(item_stats(prefs).select("item", *[s for s in ITEM_STATS if s in stats]), "item")
    if "users" in carried:
        rows = rows.withColumn("users", user_count(prefs))
    return rows.withColumn("weight", m.weight(F.col("pref"), {s: F.col(s) for s in m.row_stats}))


def _sums(pairs: DataFrame, m: Measure, by: list[str], again: bool = False) -> DataFrame:
    """Shared users and dot product per pair, of rows of pairs or, with ``again``, of sums over parts of them.

    The statistics ``by`` are functions of the items, so grouping by them adds no groups.
    """
    sums = [(F.sum("co") if again else F.count(F.lit(1))).alias("co")]
    if m.uses_dot:
        sums.append(F.sum("dot" if again else F.col("weight_a") * F.col("weight_b")).alias("dot"))
    return pairs.groupBy("item_a", "item_b", *[f"{s}{x}" for s in by for x in ("_a", "_b")]).agg(*sums)


def _pair(m: Measure, prefs: DataFrame) -> Pair:
    users = user_count(prefs) if m.uses_users else None
    return Pair(co=F.col("co"), dot=F.col("dot"), a=_of("_a"), b=_of("_b"), users=users)


def similar_pairs(
    prefs: DataFrame,
    measure: str | Measure = "cosine",
    threshold: float | None = None,
    max_prefs: int | None = None,
    seed: int | str = 42,
    rows_per_block: int = ROWS_PER_BLOCK,
    k: int | None = None,
    plan: str = "auto",
) -> DataFrame:
    """Similarity of each unordered item pair once: ``item_a < item_b, sim``.

    Only positive similarities are kept, and only those that reach ``threshold``. With ``k``,
    pairs that are among the ``k`` best of neither item may be left out; where heavy users
    exist, most of those are then never made (see ``pruned_pairs``).

    With a threshold, ``plan="prefix"`` finds candidates in the rows of rare users only (see
    ``prefix_candidates``) and sums up just these, ``plan="pairs"`` sums up all pairs whose
    bound reaches the threshold. ``plan="pruned"`` always prunes for ``k``, and ``"auto"``
    counts what each plan would pair. All plans give the same rows.

    Without such a plan pairs are summed up item by item (see ``sparse_product``): the lists of the
    users are shuffled, the pairs, by far the largest intermediate, are not.
    """
    m, prefs, floor = _asked(prefs, measure, threshold, max_prefs, seed, k, plan)
    prefs = _stored(prefs)  # counted first, then read by the plan
    totals = _planned(prefs, m, floor, rows_per_block, k, plan)
    if totals is not None:
        return _at_least(totals.select("item_a", "item_b", m.rounded(_pair(m, prefs)).alias("sim")), threshold)

    def reached(totals: DataFrame) -> DataFrame:
        return _at_least(totals.select("row", "other", m.rounded(_pair(m, prefs)).alias("sim")), threshold)

    # Without a threshold nearly all pairs are the result, which is not stored on its way.
    totals, items = _products(prefs, m, "above", rows_per_block, then=reached if floor is not None else None)
    return _named(totals if floor is not None else reached(totals), items, "item_a", "item_b")


def _asked(
    prefs: DataFrame, measure: str | Measure, threshold: float | None, max_prefs: int | None, seed: int | str, k: int | None, plan: str
) -> tuple[Measure, DataFrame, float | None]:
    """The measure, the rows to pair and the threshold that bounds them, of a request that can be met."""
    if plan not in ("auto", "pairs", "prefix", "pruned"):
        raise ValueError(f"plan must be auto, pairs, prefix or pruned, not {plan!r}")
    m = measure_named(measure)
    prefs = sample_prefs(complete(prefs), max_prefs, seed)
    floor = threshold if threshold is not None and threshold > 0 else None
    if plan == "pruned" and (k is None or m.lower_bound is None):
        raise ValueError("the pruned plan needs k and a measure that grows with the shared users")
    if plan == "prefix" and (floor is None or m.light is None):
        raise ValueError("the prefix plan needs a positive threshold and a measure that bounds rows")
    return m, prefs, floor


def _at_least(sim: DataFrame, threshold: float | None) -> DataFrame:
    kept = sim.where(F.col("sim") > 0)
    return kept.where(F.col("sim") >= threshold) if threshold is not None else kept


def _planned(
    prefs: DataFrame, m: Measure, floor: float | None, rows_per_block: int, k: int | None, plan: str
) -> DataFrame | None:
    """Sums per pair by a plan that leaves pairs out, or None where no such plan is asked for or pays."""
    bound = m.upper_bound if floor is not None else None
    carried = set(m.pair_stats) | (set(m.bound_stats) if bound else set())
    if bound and m.uses_users:
        carried.add("users")
    # The bound is compared with a margin, as the similarity is rounded afterwards.
    keep = bound(_of("_a"), _of("_b")) >= floor - 10.0 ** -(9 if m.digits is None else m.digits) if bound else None
    by = sorted(m.pair_stats)
    prunable = k is not None and m.lower_bound is not None and plan != "pairs"
    by_prefix = floor is not None and m.light is not None and plan in ("auto", "prefix")
    if by_prefix:
        rows = _weighted(prefs, m, carried | set(m.light_stats))
        pays = _prefix_pays(rows, m, floor)
        if plan == "prefix" or pays:
            prefix = prefix_rows(rows, m, floor)
            if not pays and not m.uses_dot:
                return prefixed_sums(prefs, prefix, m, rows_per_block, floor)
            return verified_sums(rows, prefix_candidates(prefix, keep, carried, rows_per_block), m, by)
    if prunable:
        by_heavy, by_others = pair_counts(prefs, rows_per_block)
        if plan == "pruned" and by_heavy > 0 or by_heavy > 0 and by_heavy >= HEAVY_FACTOR * by_others:
            return pruned_sums(prefs, m, k, hot_keys(prefs, "user", rows_per_block), rows_per_block)
    return None


def pair_counts(prefs: DataFrame, rows_per_block: int) -> tuple[float, float]:
    """Pairs that users with more than ``rows_per_block`` rows make, and those of all others."""
    sizes = prefs.groupBy("user").agg(F.count("pref").cast("double").alias("_rows"))
    pairs, heavy = F.col("_rows") * (F.col("_rows") - 1) / 2, F.col("_rows") > rows_per_block
    sums = [F.coalesce(F.sum(F.when(c, pairs)), F.lit(0.0)) for c in (heavy, ~heavy)]
    return tuple(sizes.agg(*sums).first())


def seed_pairs(heavy: DataFrame, carry: list[str], k: int, rows_per_block: int) -> DataFrame:
    """A number of pairs in proportion to the rows of heavy users, chosen so that every item has about ``k`` good ones.

    Measures are highest for items with equally many users, ties go to smaller ids. An item is
    paired with the ``k + 1`` smallest ids that have its count, and with the next ``k`` items by
    count in its block of the user.
    """
    columns = ["item", *carry]
    left, right = ([F.col(c).alias(f"{c}{x}") for c in columns] for x in ("_a", "_b"))
    first = top_per_group(heavy, ["user", "n"], [F.col("item")], k + 1, "_at")
    same = heavy.select("user", "n", *left).join(first.select("user", "n", *right), ["user", "n"])
    sizes = heavy.groupBy("user").agg(F.ceil(F.count("item") / rows_per_block).alias("_blocks"))
    placed = heavy.join(sizes, "user").withColumn("_block", F.pmod(F.xxhash64("item"), F.col("_blocks")))
    place = F.row_number().over(Window.partitionBy("user", "_block").orderBy("n", "item"))
    placed = placed.withColumn("_at", place)
    a = placed.select("user", "_block", F.col("_at").alias("_at_a"), *left)
    b = placed.select("user", "_block", F.col("_at").alias("_at_b"), *right)
    near = a.join(b, ["user", "_block"]).where(
        (F.col("_at_b") > F.col("_at_a")) & (F.col("_at_b") <= F.col("_at_a") + k)
    )
    shown = ["user", *[f"{c}{x}" for c in columns for x in ("_a", "_b")]]
    swapped = ["user", *[F.col(f"{c}{y}").alias(f"{c}{x}") for c in columns for x, y in (("_a", "_b"), ("_b", "_a"))]]
    found = same.select(shown).unionByName(near.select(shown))
    ordered = found.where("item_a < item_b").unionByName(found.where("item_a > item_b").select(swapped))
    return ordered.dropDuplicates(["user", "item_a", "item_b"])


def _reaches(m: Measure, co: Column, dot: Column) -> Column:
    """Whether a pair with at most these sums can be among the best of either item, by their bars.

    Exact measures are compared with the tie rule, the others with a margin and ties included.
    Items without a bar, which know fewer than k partners, take every pair.
    """
    ub = m.at_digits(m.similarity(Pair(co, dot, _of("_a"), _of("_b"))))
    reached = []
    for x, y in (("_a", "_b"), ("_b", "_a")):
        bar, none = F.col(f"bar{x}"), F.col(f"bar{x}").isNull()
        if m.uses_dot:
            reached.append(none | (ub >= bar - MARGIN))
        else:
            reached.append(none | (ub > bar) | ((ub == bar) & (F.col(f"item{y}") <= F.col(f"bar_other{x}"))))
    return reached[0] | reached[1]


def _from_heavy() -> tuple[Column, Column]:
    """The most that heavy users can add to a pair's shared users and dot product."""
    return F.least("heavy_n_a", "heavy_n_b"), F.sqrt("heavy_square_a") * F.sqrt("heavy_square_b")


@dataclass(frozen=True)
class PrunedPairs:
    """Parts of the pruned plan: sums over ordinary users, the bars of the items, and what heavy users make.

    ``made`` holds pairs within heavy users that may reach a bar without any other user, ``opened``
    the pairs of ``known`` that need the heavy users to reach one.
    """

    known: DataFrame
    bars: DataFrame
    heavy: DataFrame
    made: DataFrame
    opened: DataFrame
    by: list[str]


def pruned_pairs(prefs: DataFrame, m: Measure, k: int, hot: DataFrame, rows_per_block: int) -> PrunedPairs:
    """Which pairs of the ``hot`` users are needed for the ``k`` best partners of every item.

    A heavy user's items make most of all pairs, and nearly all of them are nobody's best. So the
    pairs of the other users are summed up first, with a few seed pairs of the heavy ones; the k that
    may become best for an item are summed up over all users. Sums over some of the users bound the similarity
    from below, and the k-th best of these bounds is a bar for each item. From above it is bounded by what ordinary users gave and the most that an item's rows
    of heavy users can add. Pairs that ordinary users do not share are made only where heavy users
    alone can lift them to a bar, and the others are looked up one by one where they can reach it.
    """
    stats = sorted(set(m.pair_stats) | set(m.lower_stats) | {"n"})
    weighted = cut_lineage(_weighted(prefs, m, set(stats)))
    named = hot.select("user")
    square = F.sum(F.col("weight") * F.col("weight")).alias("heavy_square")
    share = weighted.join(named, "user", "left_semi").groupBy("item").agg(F.count("user").alias("heavy_n"), square)
    rows = weighted.join(share, "item", "left").fillna(0, ["heavy_n", "heavy_square"])
    light, heavy = rows.join(named, "user", "left_anti"), rows.join(named, "user", "left_semi")
    by = [*stats, "heavy_n", "heavy_square"]
    carry = ["weight", *by]
    known = cut_lineage(_sums(pairs_within(light, "user", "item", carry, None, "item", rows_per_block), m, by))
    seeds = _sums(seed_pairs(heavy, carry, k, rows_per_block), m, by)
    lower = m.at_digits(m.lower_bound(_pair(m, prefs)))
    begun = _sums(known.unionByName(seeds), m, by, again=True).select("item_a", "item_b", lower.alias("sim"))
    co, dot = _from_heavy()
    most = Pair(F.col("co") + co, (F.col("dot") + dot) if m.uses_dot else dot, _of("_a"), _of("_b"))
    hopes = known.select("item_a", "item_b", m.rounded(most).alias("sim"))
    best = most_similar_pairs(top_similar(hopes, k)).select("item_a", "item_b")
    whole = known.join(best, ["item_a", "item_b"], "left_semi").unionByName(verified_sums(heavy, best, m, by))
    whole = _sums(whole, m, by, again=True).select("item_a", "item_b", lower.alias("sim"))
    bounds = begun.unionByName(whole).groupBy("item_a", "item_b").agg(F.max("sim").alias("sim"))
    ranked = top_similar(bounds.where(F.col("sim") > 0), k).where(F.col("rank") == k)
    bars = cut_lineage(ranked.select("item", F.col("sim").alias("bar"), F.col("other").alias("bar_other")))
    alone = _reaches(m, *_from_heavy())
    barred = heavy.join(bars, "item", "left")
    made = pairs_within(
        barred, "user", "item", [*carry, "bar", "bar_other"], heavy, "item", rows_per_block, alone
    )
    opened = known.where((F.col("heavy_n_a") > 0) & (F.col("heavy_n_b") > 0))
    for x in ("_a", "_b"):
        opened = opened.join(bars.select(*[F.col(c).alias(f"{c}{x}") for c in bars.columns]), f"item{x}", "left")
    lifted = _reaches(m, most.co, most.dot)
    opened = opened.where(lifted & ~alone).select("item_a", "item_b")
    return PrunedPairs(known, bars, heavy, made, opened, by)


def pruned_sums(prefs: DataFrame, m: Measure, k: int, hot: DataFrame, rows_per_block: int) -> DataFrame:
    """Sums per pair that hold the ``k`` best partners of every item, without all pairs of the ``hot`` users.

    The sums of pairs that were not looked up stay incomplete, which can only keep them below the
    bars they missed.
    """
    p = pruned_pairs(prefs, m, k, hot, rows_per_block)
    made = _sums(p.made, m, p.by)
    looked_up = verified_sums(p.heavy, p.opened, m, p.by)
    return _sums(p.known.unionByName(made).unionByName(looked_up), m, p.by, again=True)


def prefix_rows(rows: DataFrame, m: Measure, threshold: float) -> DataFrame:
    """The weighted rows that can bring an item to the threshold on their own or with later ones; adds ``_class``.

    Users are put in classes by their number of rows. From the heaviest class down, as long as an
    item's rows together are too light to reach the threshold with any partner, they are left out.
    Two items that reach it therefore share a user among the rows that stay: were all shared users
    left out for one of them, that one's shared rows would be too light. Heavy users, which make most
    pairs, are the first to go. Rows are summed per class before the window, so an item of any size
    has as many rows there as there are classes.
    """
    degree = rows.groupBy("user").agg(F.count("item").alias("_rows"))
    grade = F.floor(F.log2("_rows") * CLASSES).cast("int").alias("_class")
    placed = rows.join(degree.select("user", grade), "user")
    last = _class_sums(placed, m, threshold).where(~F.col("_light")).groupBy("item").agg(F.max("_class").alias("_last"))
    return placed.join(last, "item").where(F.col("_class") <= F.col("_last")).drop("_last")


def _class_sums(placed: DataFrame, m: Measure, threshold: float) -> DataFrame:
    """Per item and class of users: rows, and whether they and those of heavier classes are too light together."""
    stats = sorted(m.light_stats)
    per_class = placed.groupBy("item", "_class", *stats).agg(
        F.count("user").alias("_count"), F.sum(F.col("weight") * F.col("weight")).alias("_square")
    )
    onwards = Window.partitionBy("item").orderBy(F.desc("_class")).rowsBetween(Window.unboundedPreceding, 0)
    light = m.light(
        F.sum("_count").over(onwards), F.sum("_square").over(onwards), {s: F.col(s) for s in stats}, threshold
    )
    return per_class.withColumn("_light", light)


def _prefix_pays(rows: DataFrame, m: Measure, threshold: float) -> bool:
    """Whether the prefix rows make about ``PREFIX_SHARE`` of all pairs or less, by the rows left in each class."""
    degree = rows.groupBy("user").agg(F.count("item").alias("_rows"))
    grade = F.floor(F.log2("_rows") * CLASSES).cast("int").alias("_class")
    sums = _class_sums(rows.join(degree.select("user", grade), "user"), m, threshold)
    kept = F.sum(F.when(~F.col("_light"), F.col("_count")).otherwise(0)).alias("kept")
    every, paired = 0.0, 0.0
    # One row per class of users, a few hundred at most.
    for c in sums.groupBy("_class").agg(F.sum("_count").alias("every"), kept).collect():
        made = c["every"] * (2.0 ** (c["_class"] / CLASSES) - 0.5)
        every, paired = every + made, paired + made * (c["kept"] / c["every"]) ** 2
    return paired <= PREFIX_SHARE * every


def prefixed_sums(
    prefs: DataFrame, prefix: DataFrame, m: Measure, rows_per_block: int, threshold: float | None = None
) -> DataFrame:
    """Sums over all shared users of the pairs that share a user of their prefixes, in one pass over all rows.

    With ``threshold`` only pairs that reach it.

    For long prefixes: their candidates are a large part of all pairs, and to look up the users of each costs
    more than to sum up every pair in the block of its item.
    """

    def reached(totals: DataFrame) -> DataFrame:
        totals = totals.where(F.col("dot") > 0)
        return (totals if threshold is None else totals.where(m.rounded(_pair(m, prefs)) >= threshold)).drop("dot")

    totals, items = _products(prefs, m, "above", rows_per_block, marked=prefix, then=reached)
    return _named(totals, items, "item_a", "item_b")


def prefix_candidates(
    prefix: DataFrame, keep: Column | None, carried: set[str], rows_per_block: int
) -> DataFrame:
    """Distinct pairs that share a user of their prefixes and whose bound reaches the threshold: ``item_a, item_b``."""
    pairs = pairs_within(prefix, "user", "item", sorted(carried), prefix, "item", rows_per_block, keep)
    return pairs.select("item_a", "item_b").distinct()


def verified_sums(rows: DataFrame, candidates: DataFrame, m: Measure, by: list[str]) -> DataFrame:
    """Sums over all shared users of the candidate pairs only.

    The users of the pair's smaller item are looked up in the other, so a pair costs as many
    rows as its smaller item has.
    """
    counts = rows.groupBy("item").agg(F.count("user").alias("_n"))
    sized = candidates.join(counts.select(F.col("item").alias("item_a"), F.col("_n").alias("_n_a")), "item_a")
    sized = sized.join(counts.select(F.col("item").alias("item_b"), F.col("_n").alias("_n_b")), "item_b")
    first = F.col("_n_a") <= F.col("_n_b")
    sized = sized.select(
        F.when(first, F.col("item_a")).otherwise(F.col("item_b")).alias("_small"),
        F.when(first, F.col("item_b")).otherwise(F.col("item_a")).alias("_large"),
        first.alias("_first"),
    )
    columns = ["weight", *by]
    small = rows.select("user", F.col("item").alias("_small"), *[F.col(c).alias(f"{c}_s") for c in columns])
    large = rows.select("user", F.col("item").alias("_large"), *[F.col(c).alias(f"{c}_l") for c in columns])
    met = sized.join(small, "_small").join(large, ["user", "_large"])

    def side(x: str, small_side: Column) -> list[Column]:
        item = F.when(small_side, F.col("_small")).otherwise(F.col("_large")).alias(f"item{x}")
        return [item, *[F.when(small_side, F.col(f"{c}_s")).otherwise(F.col(f"{c}_l")).alias(f"{c}{x}") for c in columns]]

    return _sums(met.select(*side("_a", F.col("_first")), *side("_b", ~F.col("_first"))), m, by)


def symmetric(pairs: DataFrame) -> DataFrame:
    """Both orders of each pair, in one pass over the pairs."""
    both = F.array(
        F.struct(F.col("item_a").alias("item"), F.col("item_b").alias("other")),
        F.struct(F.col("item_b").alias("item"), F.col("item_a").alias("other")),
    )
    return pairs.select(F.inline(both), "sim")


def top_similar(pairs: DataFrame, k: int | None) -> DataFrame:
    """The ``k`` most similar partners of each item: ``item, other, sim, rank``."""
    if k is None:
        return symmetric(pairs)
    return top_per_group(symmetric(pairs), ["item"], [F.desc("sim"), F.col("other")], k)


def item_similarity(
    prefs: DataFrame,
    measure: str | Measure = "cosine",
    k: int | None = 100,
    threshold: float | None = None,
    max_prefs: int | None = None,
    seed: int | str = 42,
    rows_per_block: int = ROWS_PER_BLOCK,
    plan: str = "auto",
) -> DataFrame:
    """Similar items of each item: ``item, other, sim`` and, with ``k``, ``rank``.

    ``max_prefs`` samples heavier users down before pairing; without it every pair
    counts, however many items a user has.
    """
    m, sampled, floor = _asked(prefs, measure, threshold, max_prefs, seed, k, plan)
    sampled = sampled if k is None else _stored(sampled)  # counted first, then read by the plan
    totals = None if k is None else _planned(sampled, m, floor, rows_per_block, k, plan)
    if k is None or totals is not None:
        if totals is None:
            return symmetric(similar_pairs(prefs, measure, threshold, max_prefs, seed, rows_per_block, k, plan))
        sim = totals.select("item_a", "item_b", m.rounded(_pair(m, sampled)).alias("sim"))
        return top_similar(_at_least(sim, threshold), k)

    def best(totals: DataFrame) -> DataFrame:
        sim = _at_least(totals.select("row", "other", m.rounded(_pair(m, sampled)).alias("sim")), threshold)
        return best_of_rows(sim, "sim", k)

    totals, items = _products(sampled, m, "other", rows_per_block, k, then=best)
    return _named(totals, items, "item", "other")


def most_similar_pairs(similar: DataFrame) -> DataFrame:
    """Rows of ``item_similarity`` as unordered pairs, smaller id first, each once."""
    return similar.groupBy(
        F.least("item", "other").alias("item_a"), F.greatest("item", "other").alias("item_b")
    ).agg(F.max("sim").alias("sim"))
