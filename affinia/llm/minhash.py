"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

Fast similarity sketching fills t bins in rounds: in each of the first t rounds every element is
thrown into one hashed bin with a hashed value above the round's number, and in round t + i every
element goes to bin i, so that after 2t rounds at the latest no bin is empty; a bin keeps its smallest
value. Two sets agree in a bin with probability equal to their similarity, with the concentration
of independent samples. Sets of n >> t elements fill all bins in about one round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinia.llm.common import Scratch, WordHashes, ascii_lower, map_batches, mark_members, mix, run_hashes, values
from affinia.llm.components import components

SHINGLE = 5
PERCENT = 80
#: 32 bands of 4 bins: a pair of similarity 0.8 shares no band once in 4e7 times.
BINS, BAND = 128, 4


def shingles(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the word runs of ``size``; of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    return np.unique(run_hashes(h, min(size, len(h))))


def set_digest(elements: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(elements.tobytes())


def sketch(elements: np.ndarray, bins: int) -> np.ndarray:
    """The smallest value of every bin: the round in the high bits, a hash below it."""
    out = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    if not len(elements):
        return out
    top = np.uint64(1 << 48)
    with np.errstate(over="ignore"):
        for r in range(2 * bins):
            h = mix(elements + np.uint64(0x9E3779B97F4A7C15) * np.uint64(r + 1))
            value = (h >> np.uint64(16)) % top + np.uint64(r) * top
            if r < bins:
                np.minimum.at(out, ((h & np.uint64(0xFFFF)) % np.uint64(bins)).astype(np.int64), value)
            else:
                out[r - bins] = min(out[r - bins], value.min())
            if out.max() != np.iinfo(np.uint64).max:
                break
    return out


def signatures(docs: DataFrame, shingle: int, doc_id: str, text: str, bins: int = BINS, band: int = BAND) -> DataFrame:
    """(id, n_shingles, set_id, bands): set_id is a digest of the whole set, bands one hash each."""

    def run(batches) -> Iterator[dict]:
        hashes = WordHashes()
        for batch in batches:
            n, ids, bands = [], [], []
            for (body,) in values(batch, "_text"):
                s = shingles(ascii_lower(body).split(), shingle, hashes)
                n.append(len(s))
                if not len(s):
                    ids.append(None)
                    bands.append([])
                    continue
                ids.append(set_digest(s))
                rows = sketch(s, bins).reshape(-1, band)
                bands.append([xxhash.xxh3_64_intdigest(x.tobytes(), seed=i) - (1 << 63) for i, x in enumerate(rows)])
            yield {"id": batch.column(0), "n_shingles": n, "set_id": ids, "bands": bands}

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    return map_batches(rows, run, f"id {kind}, n_shingles bigint, set_id binary, bands array<bigint>")


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, set_id, set) of (id, text)."""

    def run(batches) -> Iterator[dict]:
        hashes = WordHashes()
        for batch in batches:
            ids, digests, sets = [], [], []
            for key, body in values(batch, "id", "text"):
                s = shingles(ascii_lower(body).split(), shingle, hashes)
                ids.append(key)
                digests.append(set_digest(s))
                sets.append(s.view(np.int64))
                if len(ids) == 256:
                    yield {"id": ids, "set_id": digests, "set": sets}
                    ids, digests, sets = [], [], []
            if ids:
                yield {"id": ids, "set_id": digests, "set": sets}

    return map_batches(docs, run, f"id {docs.schema['id'].dataType.simpleString()}, set_id binary, set array<bigint>")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union, on the full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("_a"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    met = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("_both", both)
    return met.where(100 * F.col("_both") >= percent * (F.size("_a") + F.size("_b") - F.col("_both"))).select("a", "b")


def prefix_pairs(sets: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """(a, b) of (id, set, component): every pair of different components that can be similar enough.

    Two sets that share ``percent`` of their union also share one of the rarest elements of each, if as
    many are taken as a similar set may lack, and one more. At their first shared element in the order of rarity, both
    must have enough left to reach the shared part that their sizes ask for; the smaller set has it among
    fewer of its rarest elements, so only these are looked up. A common element is rarely among them, and
    members of a group of copies, which differ in rare elements, meet in few rows.
    """
    elements = scratch.keep(sets.select("id", "component", F.size("set").alias("n"), F.explode("set").alias("x")))
    found = elements.groupBy("x").agg(F.count("*").alias("df"), F.min("component").alias("_lo"), F.max("component").alias("_hi"))
    rarest = Window.partitionBy("id").orderBy(F.coalesce("df", F.lit(1)), "x")
    ranked = elements.join(found.where("_lo < _hi"), "x", "left").withColumn("r", F.row_number().over(rarest))
    prefix = scratch.keep(ranked.where(f"df > 1 and r <= n - ({percent} * n + 99) div 100 + 1").select("id", "component", "n", "x", "r"))
    scratch.drop(elements)
    small, large = (prefix.select("x", *[F.col(c).alias(f"{c}_{e}") for c in ("id", "component", "n", "r")]) for e in "ab")
    small = small.where(f"r_a <= n_a - ({2 * percent} * n_a + {99 + percent}) div {100 + percent} + 1")
    met = small.withColumnRenamed("x", "x_a").join(
        large.withColumnRenamed("x", "x_b"),
        F.expr(
            f"x_a = x_b and component_a <> component_b and (n_a < n_b or n_a = n_b and id_a < id_b) and 100 * n_a >= {percent} * n_b"
            f" and least(n_a - r_a, n_b - r_b) + 1 >= ({percent} * (n_a + n_b) + {99 + percent}) div {100 + percent}"
        ),
    )
    return met.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def _apart(pairs: DataFrame, grouped: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are in different components."""
    for end in ("a", "b"):
        named = grouped.select(F.col("id").alias(end), F.col("component").alias(f"_c{end}"))
        pairs = pairs.join(named, end, "left").withColumn(f"_c{end}", F.coalesce(f"_c{end}", end))
    return pairs.where("_ca <> _cb").select("a", "b")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id linked, directly or not), kept (doc_id = component_id).

    Words are white-space separated with A-Z lowered. Documents with equal sets share one
    representative. A band's members are compared with its centre, the member with the most company in all its
    bands: first each with its best placed centre, then with the others it is still apart from. Where a band then still joins several
    components, members of different ones that share a rare shingle are compared, so no link between components is missed.
    Empty and null texts have no shingles and are linked with nothing; a null id is in no group and not
    kept; repeated rows are one document each with the same answer; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    signed = scratch.keep(signatures(docs, shingle, doc_id, text))
    sets_of = signed.where("set_id is not null and id is not null").groupBy("set_id")
    classes = sets_of.agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = scratch.keep(classes)
    banded = classes.select("rep", "n", F.posexplode("bands").alias("i", "band"))
    shared = banded.groupBy("i", "band").agg(F.count("*").alias("size")).where("size > 1")
    banded = scratch.keep(banded.join(shared, ["i", "band"]))
    # The more company a representative has in its bands, the nearer it is to the middle of its group.
    hubs = banded.groupBy("rep").agg(F.sum("size").alias("hub"))
    banded = scratch.keep(banded.drop("size").join(hubs, "rep"))
    centre = banded.groupBy("i", "band").agg(F.max(F.struct("hub", "rep", "n")).alias("centre"))

    def fits(one: str, other: str) -> Column:
        """Whether sets of these sizes can be similar enough."""
        return F.col(one).between(F.col(other) * percent / 100.0 - 1, F.col(other) * 100.0 / percent + 1)

    met = banded.join(centre, ["i", "band"]).select(
        F.col("centre.rep").alias("a"), F.col("rep").alias("b"), F.col("centre.hub").alias("hub"), F.col("centre.n").alias("_na"), F.col("n").alias("_nb")
    )
    stars = scratch.keep(met.where("a <> b").where(fits("_na", "_nb")).select("a", "b", "hub").distinct())

    wanted = banded.select("rep").distinct()
    # Only texts of representatives with company are shuffled: a filter of their ids leaves the others in the scan.
    hashed = {"_k1": F.xxhash64(F.lit(1), "id"), "_k2": F.xxhash64(F.lit(2), "id")}
    wanted = scratch.keep(wanted.select(F.col("rep").alias("id")).withColumns(hashed))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).withColumns(hashed)
    texts = mark_members(texts, wanted, ("_k1", "_k2"), "_wanted", scratch).where("_wanted").select("id", "text")
    texts = texts.join(wanted.select("id").hint("merge"), "id", "left_semi")
    # Of a repeated id only the row with the representative's set counts, and that once.
    named = classes.select(F.col("rep").alias("id"), "set_id")
    sets = shingle_sets(texts, shingle).join(named, ["id", "set_id"]).dropDuplicates(["id", "set_id"])
    sets = scratch.keep(sets.select("id", "set"))
    # Each representative meets its best placed centre first; other centres only if that leaves them apart.
    nearest = stars.groupBy("b").agg(F.max(F.struct("hub", "a")).alias("_best")).select(F.col("_best.a").alias("a"), "b")
    links = scratch.keep(confirm(nearest, sets, percent))
    grouped = scratch.keep(components(links, scratch))
    apart = scratch.keep(_apart(stars.join(nearest, ["a", "b"], "left_anti"), grouped))
    if not apart.isEmpty():
        links = scratch.keep(links.unionByName(confirm(apart, sets, percent)))
        grouped = scratch.keep(components(links, scratch))

    # Bands that still hold several components: their members of different components meet.
    labelled = banded.join(grouped, banded["rep"] == grouped["id"], "left").select(
        "i", "band", F.col("rep").alias("id"), F.coalesce("component", "rep").alias("component")
    )
    several = labelled.groupBy("i", "band").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"))
    open_ = labelled.join(several.where("_lo < _hi").select("i", "band"), ["i", "band"]).select("id", "component").distinct()
    rest = prefix_pairs(sets.join(open_, "id"), scratch, percent)
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = scratch.keep(rest.join(tried, ["a", "b"], "left_anti"))
    more = scratch.keep(confirm(rest, sets, percent))
    if not more.isEmpty():
        grouped = scratch.keep(components(links.unionByName(more), scratch))

    member = classes.join(grouped, classes["rep"] == grouped["id"], "left").select(
        "set_id", F.coalesce("component", "rep").alias("component")
    )
    out = signed.join(member, "set_id", "left").select(
        F.col("id").alias(doc_id), "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")
    )
    scratch.drop(sets)
    return out.withColumn("kept", F.coalesce(F.col(doc_id) == F.col("component_id"), F.lit(False)))
