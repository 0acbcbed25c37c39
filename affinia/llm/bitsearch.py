"""Approximate nearest neighbours by inner product, with randomly rotated one-bit codes.

Every vector is rotated at random and kept as the signs of its coordinates plus two scalars: its norm
and the inner product of its direction with its code. An inner product with a query is estimated from
the code, without bias; the error bound says which vectors can still be among the nearest, and only
those are reranked by exact inner products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinia.llm.common import Scratch, map_batches, values

#: Rows of a block, of queries and of candidates.
BLOCK = 4096
#: Standard deviations that an estimate may be off before a vector is missed.
ERRORS = 3.0
_SEED = 20


def usable(vector: str) -> Column:
    """Whether a vector is not null, not zero and all its components are finite numbers."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same for every task."""
    q, r = np.linalg.qr(np.random.default_rng(_SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


class Codes:
    """Packed signs and correction scalars of the rows of a block."""

    def __init__(self, vectors: np.ndarray) -> None:
        rotated = vectors @ rotation(vectors.shape[1]).T
        self.norms = np.linalg.norm(rotated, axis=1)
        self.packed = np.packbits(rotated > 0, axis=1)
        self.dim = vectors.shape[1]
        self.along = np.abs(rotated).sum(1) / np.sqrt(self.dim) / self.norms

    def estimate(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products (queries x rows), and a standard deviation per row for unit queries."""
        signs = np.unpackbits(self.packed, axis=1, count=self.dim).astype(np.float32) * 2 - 1
        rotated = (queries @ rotation(self.dim).T).astype(np.float32)
        scale = self.norms / self.along / np.sqrt(self.dim)
        spread = np.sqrt(np.maximum(1 - self.along**2, 0)) / self.along / np.sqrt(max(self.dim - 1, 1))
        return (rotated @ signs.T) * scale.astype(np.float32), self.norms * spread


def _search(qids: list, q: np.ndarray, ids: list, x: np.ndarray, k: int) -> Iterator[tuple]:
    """(query, id, score): the k nearest of a block's rows for each query, ties to the smaller id."""
    codes, order = Codes(x), np.argsort(np.array(ids), kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    ids_array = np.array(ids)
    for a in range(0, len(q), 256):
        part = q[a : a + 256]
        near, spread = codes.estimate(part)
        error = ERRORS * np.linalg.norm(part, axis=1)[:, None] * spread
        for i, (low, high) in enumerate(zip(near - error, near + error, strict=True)):
            other = ids_array != qids[a + i]
            if not (n := int(other.sum())):
                continue
            low = np.where(other, low, -np.inf)
            bound = np.partition(low, len(low) - min(k, n))[len(low) - min(k, n)]
            at = np.flatnonzero(other & (high >= bound))
            score = np.einsum("ij,j->i", x[at], part[i])
            for j in np.lexsort((rank[at], -score))[:k]:
                yield qids[a + i], ids[at[j]], float(score[j])


def _blocks(vectors: DataFrame, count: int, other: int, mine: str, theirs: str) -> DataFrame:
    """Packed rows (ids, data), each repeated for every block of the other side."""
    kind = vectors.schema["id"].dataType.simpleString()

    def pack(batches) -> Iterator[dict]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for block, key, v in values(batch, "_block", "id", "v"):
                ids, rows = held.setdefault(block, ([], []))
                ids.append(key)
                rows.append(np.array(v, "<f8").tobytes())
        for block, (ids, rows) in held.items():
            yield {mine: [block], f"{mine}_ids": [ids], f"{mine}_data": [b"".join(rows)]}

    placed = vectors.withColumn("_block", F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")).repartition(count, "_block")
    packed = map_batches(placed, pack, f"{mine} int, {mine}_ids array<{kind}>, {mine}_data binary")
    return packed.withColumn(theirs, F.explode(F.sequence(F.lit(0), F.lit(other - 1))))


def nearest(
    docs: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", block: int = BLOCK
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row that ``queries`` marks, its k nearest by inner product.

    All other rows are candidates; all of them are returned if there are fewer than k. Ties go to the smaller
    id. Vectors that are null, zero or hold null or non-finite components take no part, nor do null ids; of
    several rows with one id the smallest vector counts. Vectors must have one dimension (others than the
    smallest are an error). An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "bitsearch")
    rows = docs.where(usable(vector) & F.col(vec_id).isNotNull())
    rows = rows.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("_asks"))
    rows = scratch.keep(rows.groupBy("id").agg(F.min("v").alias("v"), F.max("_asks").alias("_asks")))
    n, asking = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("_asks").cast("int")), F.lit(0))).first()
    c_blocks, q_blocks = max(1, -(-n // block)), max(1, -(-asking // block))
    asked = _blocks(rows.where("_asks").select("id", "v"), q_blocks, c_blocks, "q", "c")
    offered = _blocks(rows.select("id", "v"), c_blocks, q_blocks, "c", "q")
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            for qids, q, ids, x in values(batch, "q_ids", "q_data", "c_ids", "c_data"):
                q, x = (np.frombuffer(raw, "<f8").reshape(len(keys), -1) for raw, keys in ((q, qids), (x, ids)))
                found = list(_search(qids, q, ids, x, k))
                if found:
                    yield dict(zip(("query_id", "vec_id", "score"), map(list, zip(*found, strict=True)), strict=True))

    met = asked.join(offered, ["q", "c"]).select("q_ids", "q_data", "c_ids", "c_data")
    found = map_batches(met, run, f"query_id {kind}, vec_id {kind}, score double")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").alias(vec_id), "score")
