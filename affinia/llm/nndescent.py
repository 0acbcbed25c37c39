"""Near-duplicate vectors by NN-descent over a neighbour graph, within labels.

The graph starts from runs of vectors that lie side by side in random hyperplane orders. Each round
joins the neighbours of every vector with one another and keeps what is nearer than a list's last entry. A
list full of links is saturated and may hide links to other groups, so the components of the graph are only
a first grouping: an audit compares all vectors of a label with one another, in blocks of bounded size, and
joins every two components that a link connects. The links of a component are counted in blocks as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.llm.bitsearch import usable
from affinia.llm.common import Scratch, map_batches
from affinia.llm.components import components

THRESHOLD = 0.93
#: Length of the lists, and of the runs that they start from.
NEIGHBOURS, RUN = 8, 256
#: Random orders to start from; a round that changes a smaller share of the entries is the last.
ORDERS, SETTLED = 3, 0.002
ROUNDS = 10
#: Vectors of a block when links are counted, and when components are audited; rows compared at once.
BLOCK, AUDIT_BLOCK, SLICE = 1024, 4096, 1024


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(vectors: DataFrame) -> DataFrame:
    """(id, label, v) with v scaled to length one; no square overflows or vanishes."""

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column(2))
                v = v / np.abs(v).max(1, keepdims=True)
                v = v / np.sqrt((v * v).sum(1, keepdims=True))
                yield {"id": batch.column(0), "label": batch.column(1), "v": list(v)}

    kinds = ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in ("id", "label"))
    return map_batches(vectors.select("id", "label", "v"), run, f"{kinds}, v array<double>")


def _codes(vectors: DataFrame, seed: int) -> DataFrame:
    """``vectors`` with the signs of 62 random projections in ``code``."""

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column(2))
                planes = np.random.default_rng(seed).standard_normal((v.shape[1], 62))
                yield {
                    "id": batch.column(0), "label": batch.column(1), "v": batch.column(2),
                    "code": (v @ planes > 0) @ (1 << np.arange(62, dtype=np.int64)),
                }

    kinds = ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in ("id", "label"))
    return map_batches(vectors.select("id", "label", "v"), run, f"{kinds}, v array<double>, code bigint")


def _nearest_in(ids: np.ndarray, labels: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    cos = v @ v.T
    cos[labels[:, None] != labels[None]] = -2.0
    np.fill_diagonal(cos, -2.0)
    k = min(k, len(ids) - 1)
    top = np.argpartition(-cos, k - 1, axis=1)[:, :k]
    a, b = np.repeat(np.arange(len(ids)), k), top.ravel()
    near = cos[a, b]
    held = near > -2.0
    return ids[a[held]], ids[b[held]], near[held]


def _start(vectors: DataFrame, seed: int, id_type: str) -> DataFrame:
    """(a, b, cos): the nearest within runs of one random order; half of each run is in the next one too."""

    def run(batches) -> Iterator[dict]:
        ids, labels, v = [], [], []
        held = 0

        def window(size: int) -> tuple:
            return np.concatenate(ids)[:size], np.concatenate(labels)[:size], np.concatenate(v)[:size]

        for batch in batches:
            for at in range(0, batch.num_rows, RUN // 2):
                part = batch.slice(at, RUN // 2)
                ids.append(part.column(0).to_numpy(zero_copy_only=False))
                labels.append(part.column(1).to_numpy(zero_copy_only=False))
                v.append(_matrix(part.column(2)))
                held += part.num_rows
                if held >= RUN:
                    a, b, cos = _nearest_in(*window(held), NEIGHBOURS)
                    yield {"a": a, "b": b, "cos": cos}
                    tail = [x[-(RUN // 2) :] for x in window(held)]
                    ids, labels, v, held = [tail[0]], [tail[1]], [tail[2]], len(tail[0])
        if held > 1:
            a, b, cos = _nearest_in(*window(held), NEIGHBOURS)
            yield {"a": a, "b": b, "cos": cos}

    placed = _codes(vectors, seed).withColumn("_tie", F.xxhash64("id"))
    placed = placed.repartitionByRange("label", "code", "_tie").sortWithinPartitions("label", "code", "_tie")
    return map_batches(placed.select("id", "label", "v"), run, f"a {id_type}, b {id_type}, cos double")


def _lists(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest of each list."""
    by = Window.partitionBy("a").orderBy(F.desc("cos"), "b")
    best = edges.groupBy("a", "b").agg(F.max("cos").alias("cos"))
    return best.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= k).drop("_n")


def _descend(edges: DataFrame, vectors: DataFrame, threshold: float, id_type: str) -> DataFrame:
    """Nearer pairs among the neighbours of each vector, forward and backward."""
    back = Window.partitionBy("b").orderBy(F.desc("cos"), "a")
    backward = edges.withColumn("_n", F.row_number().over(back)).where(F.col("_n") <= NEIGHBOURS)
    around = edges.select(F.col("a").alias("pivot"), F.col("b").alias("id")).unionByName(
        backward.select(F.col("b").alias("pivot"), F.col("a").alias("id"))
    )
    last = edges.groupBy("a").agg(F.count("*").alias("_n"), F.min("cos").alias("_last"))
    # A saturated list needs no nearer entries; one that is not full takes any.
    bar = F.when(F.col("_n") < NEIGHBOURS, -2.0).when(F.col("_last") >= threshold, 2.0).otherwise(F.col("_last"))
    known = vectors.join(last, F.col("id") == F.col("a"), "left").select("id", "v", F.coalesce(bar, F.lit(-2.0)).alias("bar"))
    met = around.distinct().join(known, "id").groupBy("pivot").agg(F.collect_list(F.struct("id", "v", "bar")).alias("near"))

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            near = batch.column(0)
            rows = near.flatten()
            if not len(rows):
                continue
            ids = rows.field("id").to_numpy(zero_copy_only=False)
            v, bars = _matrix(rows.field("v")), rows.field("bar").to_numpy(zero_copy_only=False)
            ends = np.cumsum(near.value_lengths().to_numpy(zero_copy_only=False))
            found: list[tuple] = []
            for x, y in zip(np.append(0, ends[:-1]), ends, strict=True):
                cos = v[x:y] @ v[x:y].T
                np.fill_diagonal(cos, -3.0)
                i, j = np.nonzero(cos > bars[x:y, None])
                found.append((ids[x:y][i], ids[x:y][j], cos[i, j]))
            a, b, cos = (np.concatenate(c) for c in zip(*found, strict=True))
            yield {"a": a, "b": b, "cos": cos}

    return map_batches(met.select("near"), run, f"a {id_type}, b {id_type}, cos double")


def _counts(members: DataFrame, threshold: float, id_type: str) -> DataFrame:
    """(id, links): links of each class within its component, weighted by copies, counted in blocks."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    placed = members.join(sizes, "component").withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
    dealt = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cell = [F.least("_own", "_other").alias("_lo"), F.greatest("_own", "_other").alias("_hi")]
    cells = dealt.select("component", *cell, F.struct("id", "copies", "v", F.col("_own").alias("own")).alias("_row"))
    cells = cells.groupBy("component", "_lo", "_hi").agg(F.collect_list("_row").alias("rows"))

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            lows, highs, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            for i, (low, high) in enumerate(zip(lows, highs, strict=True)):
                rows = lists[i].values
                ids = rows.field("id").to_numpy(zero_copy_only=False)
                copies = rows.field("copies").to_numpy(zero_copy_only=False)
                own, v = rows.field("own").to_numpy(zero_copy_only=False), _matrix(rows.field("v"))
                linked = v @ v.T >= threshold
                np.fill_diagonal(linked, False)
                if low != high:
                    linked &= own[:, None] != own[None]
                yield {"id": ids, "links": linked @ copies}

    parts = map_batches(cells.select("_lo", "_hi", "rows"), run, f"id {id_type}, links bigint")
    return parts.groupBy("id").agg(F.sum("links").alias("links"))


def _audit(members: DataFrame, threshold: float) -> DataFrame:
    """(a, b): every two components that a link connects, from all pairs of vectors of a label.

    The blocks of a label meet in cells, and each task holds one cell at a time.
    """
    blocks = members.groupBy("label").agg(F.ceil(F.count("*") / AUDIT_BLOCK).cast("int").alias("_blocks"))
    placed = members.join(blocks, "label").withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
    dealt = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cell = ["label", "_lo", "_hi"]
    dealt = dealt.select(
        "label", F.least("_own", "_other").alias("_lo"), F.greatest("_own", "_other").alias("_hi"), "_own", "component", "v"
    )
    dealt = dealt.repartition(*cell).sortWithinPartitions(*cell)

    def joined(low: int, high: int, own: np.ndarray, comps: np.ndarray, v: np.ndarray) -> dict:
        # Off the diagonal only the pairs of the two blocks are new.
        one, two = (own == low, own == high) if low != high else (slice(None), slice(None))
        met: list[np.ndarray] = []
        mine, left, others, right = comps[one], v[one], comps[two], v[two]
        for at in range(0, len(mine), SLICE):
            i, j = np.nonzero(left[at : at + SLICE] @ right.T >= threshold)
            pairs = np.stack([mine[at + i], others[j]], 1)
            met.append(np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0))
        found = np.unique(np.concatenate(met), axis=0) if met else np.empty((0, 2), comps.dtype)
        return {"a": found[:, 0], "b": found[:, 1]}

    def run(batches) -> Iterator[dict]:
        key, held = None, []

        def out() -> dict:
            own, comps, v = (np.concatenate(c) for c in zip(*held, strict=True))
            return joined(*key[1:], own, comps, v)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], 1)
            starts = np.append(0, np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1)
            for x, y in zip(starts, np.append(starts[1:], batch.num_rows), strict=True):
                if held and tuple(keys[x]) != key:
                    yield out()
                    held = []
                key, part = tuple(keys[x]), batch.slice(x, y - x)
                held.append((*(part.column(i).to_numpy(zero_copy_only=False) for i in (3, 4)), _matrix(part.column(5))))
        if held:
            yield out()

    kind = members.schema["component"].dataType.simpleString()
    return map_batches(dealt, run, f"a {kind}, b {kind}").distinct()


def near_duplicates(
    docs: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """vec_id, n_links, component_id (smallest id reachable by links, itself included), kept (vec_id = component_id).

    Vectors are linked if their labels are equal and not null and their cosine, in double precision, is at
    least ``threshold``. Vectors that are null, zero or hold null or non-finite components, and rows without a
    label or id, are linked with nothing. Equal vectors of one label are one class and meet the others once.
    Rows of equal id are one vector (the smallest) and get equal rows. An empty table gives no rows.
    Ids and labels are integers.
    """
    scratch = Scratch(docs.sparkSession, "nndescent")
    id_type = docs.schema[vec_id].dataType.simpleString()
    named = docs.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    rows = named.where(usable("v") & F.col("id").isNotNull() & F.col("label").isNotNull())
    rows = rows.groupBy("id").agg(F.min(F.struct("v", "label")).alias("_r")).select("id", "_r.label", "_r.v")
    rows = _unit(rows)
    rows = scratch.keep(rows)
    classes = rows.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    classes = scratch.keep(classes.select("id", "label", "v", "copies"))
    vectors = classes.select("id", "label", "v")
    n = classes.count()

    starts = [_start(vectors, i, id_type) for i in range(ORDERS)]
    for other in starts[1:]:
        starts[0] = starts[0].unionByName(other)
    edges = scratch.keep(_lists(starts[0], NEIGHBOURS))
    for _ in range(ROUNDS):
        better = scratch.keep(_descend(edges, vectors, threshold, id_type).distinct())
        following = scratch.keep(_lists(edges.unionByName(better), NEIGHBOURS))
        changed = following.join(edges, ["a", "b"], "left_anti").count()
        edges = following
        if changed <= SETTLED * NEIGHBOURS * n:
            break
    grouped = components(edges.where(F.col("cos") >= threshold).select("a", "b"), scratch)
    members = classes.join(grouped, "id", "left").withColumn("component", F.coalesce("component", "id"))
    members = scratch.keep(members)
    found = scratch.keep(_audit(members, threshold))
    if not found.isEmpty():  # all pairs were compared: with these, no link between components is left
        merged = components(found, scratch).select(F.col("id").alias("component"), F.col("component").alias("_least"))
        members = members.join(merged, "component", "left").withColumn("component", F.coalesce("_least", "component"))
        members = scratch.keep(members.drop("_least"))
    several = members.groupBy("component").agg(F.count("*").alias("_n")).where("_n > 1").select("component")
    counted = _counts(members.join(several, "component"), threshold, id_type)
    totals = members.join(counted, "id", "left").select(
        "label", "v", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    each = rows.join(totals, ["label", "v"]).select("id", "n_links", "component")
    out = docs.select(F.col(vec_id).alias("id")).join(each, "id", "left").select(
        F.col("id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col(vec_id) == F.col("component_id"), F.lit(False)))
