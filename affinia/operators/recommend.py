"""Top-N recommendations from item similarities."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.operators.ids import decode_ids, encode_ids
from affinia.operators.interactions import complete, top_prefs
from affinia.operators.product import best_of_rows, block_grid, dictionary_of, narrowed, packed, sparse_product
from affinia.session import cut_lineage, picked_from


# A hot item's users are listed in pages of about this many rows.
ROWS_PER_BLOCK = 100_000

# Digits kept of a score, so that sums taken in another order rank alike.
DIGITS = 9


def recommend(
    prefs: DataFrame,
    similar: DataFrame,
    n: int = 10,
    boolean: bool = False,
    max_prefs: int | None = None,
    min_support_items: int = 2,
    users: DataFrame | None = None,
    items: DataFrame | None = None,
    exclude: DataFrame | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Best ``n`` new items of each user: ``user, item, score, rank``.

    ``prefs`` is unique on (user, item); ``similar`` has ``item, other, sim``. Each of a
    user's items proposes its similar items; with ``max_prefs`` only so many of the strongest. With ``boolean`` the
    score is the sum of the similarities, otherwise the similarity-weighted mean of the
    preferences, for candidates proposed by at least ``min_support_items`` items.

    ``users`` and ``items`` (one column each) limit who is served and what is proposed;
    ``exclude`` (user, item) and everything the user already has are left out.

    Proposals are the product of preferences and similarities. They are summed up user by user where the
    user's block lies (see ``sparse_product``); the exclusions are sent there as well, and the best of a user are
    taken in the block of each group of candidates first, then of all groups.
    """
    served = complete(prefs)
    if users is not None:
        served = served.join(users.select("user"), "user", "left_semi")
    served = cut_lineage(picked_from(served, served.select("user", "item", "pref")))
    offered = similar.select(F.col("item").alias("key"), F.col("other").alias("_candidate"), "sim")
    if items is not None:
        offered = offered.join(items.select(F.col("item").alias("_candidate")), "_candidate", "left_semi")
    offered = cut_lineage(offered.where(F.col("sim").isNotNull()))
    names = {"user": dictionary_of(served, "user"), "item": dictionary_of(offered, "_candidate")}
    # What a user has is known in its block if all of it proposes there, under the numbers of the candidates.
    own = max_prefs is None and names["item"] is None
    out = None if own else served.select("user", "item")
    if exclude is not None:
        listed = exclude.select("user", "item").where(F.col("user").isNotNull() & F.col("item").isNotNull())
        out = listed if out is None else out.unionByName(listed)
    left = _numbered(top_prefs(served, max_prefs), names["user"], "user").select(
        F.col("item").alias("key"), F.col("user").alias("row"), F.col("pref").alias("value")
    )
    right = _numbered(offered, names["item"], "_candidate").select(
        "key", F.col("_candidate").alias("other"), F.col("sim").alias("value")
    )
    # Columns picked from a stored table need not be stored again.
    left = narrowed(left if names["user"] is None and max_prefs is None else cut_lineage(left), "row")
    right = narrowed(right if names["item"] is None else cut_lineage(right), "other")
    if out is not None:
        out = _numbered(_numbered(out, names["user"], "user"), names["item"], "item")
        out = out.select(F.col("user").alias("row"), F.col("item").alias("other"))
    values = (packed(left, "value"), packed(right, "value"))
    grid = block_grid(left, right, (4 + values[0].bytes, 4 + values[1].bytes), n)

    def ranked(totals: DataFrame) -> DataFrame:
        if boolean:
            scored = totals.withColumn("score", F.round("size", DIGITS))
        else:
            mean = F.round(F.col("dot") / F.col("size"), DIGITS)
            scored = totals.where(F.col("n") >= min_support_items).withColumn("score", mean)
        return best_of_rows(scored, "score", n, parts=grid[1])

    recs = sparse_product(
        left,
        right,
        values=values,
        absolute=True,
        out=out,
        own=own,
        grid=grid,
        best=(_sums if boolean else _means(min_support_items), n),
        rows_per_list=rows_per_block,
        then=ranked,
    ).withColumnsRenamed({"row": "user", "other": "item"})
    for column, dictionary in names.items():
        recs = recs if dictionary is None else decode_ids(recs, dictionary, column)
    return recs.select("user", "item", "score", "rank")


def _numbered(df: DataFrame, dictionary: DataFrame | None, column: str) -> DataFrame:
    """Ids as numbers; rows of ids that the dictionary lacks are left out."""
    if dictionary is None:
        return df.withColumn(column, F.col(column).cast("bigint"))
    return encode_ids(df, dictionary, column).where(F.col(column).isNotNull())


def _sums(totals: dict[str, np.ndarray]) -> np.ndarray:
    return totals["size"]


def _means(min_support_items: int) -> Callable[[dict[str, np.ndarray]], np.ndarray]:
    return lambda t: np.where(t["n"] >= min_support_items, t["dot"] / t["size"], -np.inf)


def rec_lists(recs: DataFrame) -> DataFrame:
    """Long recommendation rows as one list per user, best first: ``user, recs``.

    Lists are bounded by the number of recommendations per user.
    """
    return (
        recs.groupBy("user")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "item", "score"))).alias("_recs"))
        .select("user", F.expr("transform(_recs, r -> struct(r.item AS item, r.score AS score))").alias("recs"))
    )


def explode_recs(lists: DataFrame) -> DataFrame:
    """Recommendation lists as rows: ``user, item, score, rank``."""
    return lists.select("user", F.posexplode("recs").alias("_pos", "_rec")).select(
        "user", F.col("_rec.item").alias("item"), F.col("_rec.score").alias("score"), (F.col("_pos") + 1).alias("rank")
    )
