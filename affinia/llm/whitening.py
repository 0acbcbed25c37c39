"""Whitening of embeddings: exact covariance, eigenvectors by mixed-precision refinement.

Counts, sums and cross products are gathered as integers, so the covariance does not depend on how rows are dealt
out. Its eigenvectors are found in float32 and corrected by the iteration of Ogita and Aishima, which multiplies
matrices in extended precision and doubles the number of right digits each round. Eigenvalues that are too close
together for it are solved again on their own, shifted and scaled, so that float32 can tell them apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm.common import map_batches

#: Numbers of a batch that are handled at once.
CELLS = 1 << 20
#: Quantised components must be smaller than this, so that all products stay exact.
LARGEST = 1 << 48
_LIMB = 25
_EXACT = 1 << 53


def finite(vector: str) -> Column:
    """Whether a vector is not null, not empty and all its components are finite numbers."""
    v = F.col(vector)
    numbers = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & numbers, F.lit(False))


def matrices(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, components) of runs of rows that have vectors of one size, in bounded pieces."""
    column = batch.column(batch.schema.get_field_index(name))
    sizes, flat = column.value_lengths().to_numpy(zero_copy_only=False), column.flatten().to_numpy()
    starts = np.flatnonzero(np.diff(sizes, prepend=-1))
    at = 0
    for a, b in zip(starts, [*starts[1:], len(sizes)], strict=True):
        size = int(sizes[a])
        for c in range(a, b, step := max(1, min(4096, CELLS // size))):
            n = min(step, b - c)
            yield c, flat[at : at + n * size].reshape(n, size)
            at += n * size


def quantise(components: np.ndarray, scale: int, shift: int) -> np.ndarray:
    """floor(scale * c) + shift as integers."""
    x = np.floor(components.astype(np.float64) * scale)
    if x.size and np.abs(x).max() + abs(shift) >= LARGEST:
        raise ValueError(f"a quantised component reaches {LARGEST}")
    return x.astype(np.int64) + shift


@dataclass
class Fit:
    """What whitening needs of the fit list: count, sums, covariance (extended precision) and its components."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return (self.values / np.trace(self.covariance)).astype(np.float64)


def _sums(vectors: DataFrame, scale: int, shift: int) -> tuple[int, list[int]]:
    """Number of vectors and their sums per dimension; an error if the vectors have different sizes."""

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            for _, part in matrices(batch, "v"):
                size = part.shape[1]
                yield {
                    "size": np.full(size + 1, size, np.int32),
                    "i": np.arange(-1, size, dtype=np.int32),
                    "total": np.concatenate([[len(part)], quantise(part, scale, shift).sum(0)]),
                }

    found = map_batches(vectors, run, "size int, i int, total long").groupBy("size", "i")
    rows = found.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("size", "i").collect()
    if len(sizes := {r["size"] for r in rows}) > 1:
        raise ValueError(f"vectors of different sizes: {sorted(sizes)}")
    totals = [int(r["total"]) for r in rows]
    return (totals[0], totals[1:]) if totals else (0, [])


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b of integer matrices, exact: by float64 for as many rows as stay below 2**53."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    rows = len(a) if not largest else max(1, _EXACT // largest)
    out = np.zeros((a.shape[1], b.shape[1]), np.int64)
    for i in range(0, len(a), rows):
        out += (a[i : i + rows].astype(np.float64).T @ b[i : i + rows].astype(np.float64)).astype(np.int64)
    return out


def _crosses(vectors: DataFrame, middle: list[int], scale: int, shift: int) -> dict[tuple[int, int], int]:
    """Sums of (x_i - middle_i) * (x_j - middle_j) for i <= j, exact at any number of rows.

    Numbers beyond 25 bits are cut into two limbs; each plane holds the products that count 2**(25 * plane).
    """
    size = len(middle)
    upper = np.triu_indices(size)

    def run(batches) -> Iterator[dict]:
        planes: dict[int, np.ndarray] = {}
        bound = 0

        def out() -> Iterator[dict]:
            for plane, sums in planes.items():
                yield {
                    "plane": np.full(len(upper[0]), plane, np.int32),
                    "i": upper[0].astype(np.int32),
                    "j": upper[1].astype(np.int32),
                    "total": sums[upper],
                }
            planes.clear()

        for batch in batches:
            for _, part in matrices(batch, "v"):
                y = quantise(part, scale, shift) - np.array(middle, np.int64)
                high = np.trunc(y / (1 << _LIMB)).astype(np.int64)
                low = y - (high << _LIMB)
                grown = len(y) * max(int(np.abs(low).max()), int(np.abs(high).max())) ** 2 * 2
                if bound + grown >= 1 << 62:
                    yield from out()
                    bound = 0
                bound += grown
                planes[0] = planes.get(0, 0) + _product(low, low)
                if high.any():
                    mixed = _product(high, low)
                    planes[1] = planes.get(1, 0) + mixed + mixed.T
                    planes[2] = planes.get(2, 0) + _product(high, high)
        yield from out()

    found = map_batches(vectors, run, "plane int, i int, j int, total long").groupBy("plane", "i", "j")
    sums: dict[tuple[int, int], int] = {}
    for plane, i, j, total in found.agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect():
        sums[i, j] = sums.get((i, j), 0) + (int(total) << (_LIMB * plane))
    return sums


def _extended(top: int, bottom: int) -> np.longdouble:
    """top / bottom to the precision of an extended double: the rounded quotient and what it leaves over."""
    near = top / bottom
    a, b = near.as_integer_ratio()
    return np.longdouble(near) + np.longdouble((top * b - a * bottom) / (bottom * b))


def _clusters(values: np.ndarray, gap: np.longdouble) -> list[np.ndarray]:
    """Index sets of more than one eigenvalue whose neighbours are at most ``gap`` apart."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def eigen(matrix: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, in extended precision.

    float32 gives the first vectors X. A round measures R = I - X'X and S = X'AX; the correction X E solves both to
    first order, with E_ij = (S_ij + l_j R_ij) / (l_j - l_i) for separate eigenvalues and R_ij / 2 for those closer
    than the error bound. Where such a cluster stays, its own small matrix, less its mean and scaled up, is solved
    in the same way and turns the cluster's vectors. Equal eigenvalues keep any orthonormal vectors of their space.
    """
    a = np.asarray(matrix, np.longdouble)
    size = len(a)
    scale = np.abs(a).max(initial=0)
    if size < 2 or not scale:
        return np.diag(a).copy(), np.eye(size, dtype=np.longdouble)
    a = (a + a.T) / (2 * scale)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    eps = np.finfo(np.longdouble).eps
    turned: set[tuple[int, ...]] = set()
    for _ in range(rounds):
        r = np.eye(size, dtype=np.longdouble) - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        gap = 2 * (np.linalg.norm(s - np.diag(values)) + np.linalg.norm(a) * np.linalg.norm(r))
        gap = max(gap, 16 * size * eps)
        apart = values[None, :] - values[:, None]
        separate = np.abs(apart) > gap
        e = np.where(separate, (s + values[None, :] * r) / np.where(separate, apart, 1), r / 2)
        x = x + x @ e
        settled = np.abs(e).max() < 4 * eps
        for cluster in map(np.sort, _clusters(values, gap)):
            near = x[:, cluster]
            if tuple(cluster) in turned or np.abs(near.T @ near - np.eye(len(cluster))).max() > 1e-9:
                continue
            turned.add(tuple(cluster))
            middle = values[cluster].mean()
            own = near.T @ (a @ near) - middle * (near.T @ near)
            if np.abs(own).max() > 64 * size * eps:
                x[:, cluster] = near @ eigen(own, rounds)[1]
                settled = False
        if settled:
            break
    x = x @ (1.5 * np.eye(size) - 0.5 * (x.T @ x))
    values = np.einsum("ij,ij->j", x, a @ x) * scale
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def fit(vectors: DataFrame, scale: int, shift: int) -> Fit | None:
    """The fit of all rows of ``vectors`` (column v); None without rows."""
    n, sums = _sums(vectors, scale, shift)
    if not n:
        return None
    middle = [round(s / n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle, strict=True)]
    covariance = np.zeros((len(sums), len(sums)), np.longdouble)
    for (i, j), total in _crosses(vectors, middle, scale, shift).items():
        covariance[i, j] = covariance[j, i] = _extended(n * total - rest[i] * rest[j], n * n)
    return Fit(n, sums, covariance, *eigen(covariance))


def _deviations(rows: np.ndarray) -> pa.Array:
    """Sums of squares of integer rows, exact: as Python integers where 64 bits may not do."""
    about = (rows.astype(np.float64) ** 2).sum(1)
    if (about < 1 << 62).all():
        return pa.array((rows * rows).sum(1).astype(np.int64)).cast(pa.decimal128(38, 0))
    return pa.array([Decimal(sum(int(v) ** 2 for v in row)) for row in rows], pa.decimal128(38, 0))


def whiten(
    docs: DataFrame, components: int = 8, vec_id: str = "vec_id", vector: str = "embedding",
    scale: int = 1024, shift: int = 100_000,
) -> DataFrame:
    """vec_id, component (from 1), n, deviation (decimal), whitened, explained, identity_error, per row and component.

    A component c enters as floor(scale * c) + shift. ``whitened`` is the row less the mean, projected on the unit
    eigenvector of the covariance (divisor n) and divided by the root of its eigenvalue; ``deviation`` is the exact
    sum of (n * x - sum)^2; ``identity_error`` is the largest entry by which the covariance of ``whitened``, measured
    on all rows, differs from the identity.

    Rows whose vector is null, empty or holds null or non-finite components are left out; null and repeated ids and
    repeated rows stay, each as a row of its own. Vectors of different sizes, and components that quantise to 2**48
    or more, are an error. Components without variance (eigenvalue below size * 2**-50 of the largest) cannot be
    whitened and are not returned: of equal rows, or a single one, nothing is. An empty table gives no rows. Other
    columns are ignored, whatever their names. Equal eigenvalues take any orthonormal vectors of their space.
    """
    vectors = docs.where(finite(vector)).select(F.col(vec_id).alias("id"), F.col(vector).alias("v"))
    kind = vectors.schema["id"].dataType.simpleString()
    done = fit(vectors, scale, shift)
    names = [F.col("id").alias(vec_id), "component", "n", "deviation", "whitened", "explained", "identity_error"]
    keep = 0
    if done:
        least = done.values[0] * len(done.values) * 2.0**-50
        keep = int((done.values[:components] > max(least, 0)).sum())
    if not keep:
        schema = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return docs.sparkSession.createDataFrame([], schema).select(*names)
    n, sums = done.n, np.array(done.sums, object)
    turn = (done.vectors[:, :keep] / np.sqrt(done.values[:keep])).astype(np.float64)

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("id"))
            for at, part in matrices(batch, "v"):
                x = quantise(part, scale, shift)
                wide = n * int(np.abs(x).max()) + max(map(abs, done.sums)) >= 1 << 62
                off = x.astype(object) * n - sums if wide else x * n - sums.astype(np.int64)
                yield {
                    "id": ids.slice(at, len(part)),
                    "deviation": _deviations(off),
                    "w": pa.FixedSizeListArray.from_arrays(
                        pa.array(((off.astype(np.float64) / n) @ turn).ravel()), keep
                    ).cast(pa.list_(pa.field("element", pa.float64()))),
                }

    white = map_batches(vectors, run, f"id {kind}, deviation decimal(38,0), w array<double>")
    error = identity_error(white, "w", keep)
    explained = F.array(*(F.lit(float(v)) for v in done.explained[:keep]))
    out = white.select("id", "deviation", F.posexplode("w").alias("_at", "whitened")).select(
        "id", "deviation", "whitened", (F.col("_at") + 1).alias("component"), F.lit(n).cast("long").alias("n"),
        F.get(explained, "_at").alias("explained"), F.lit(error).alias("identity_error"),
    )
    return out.select(*names)


def identity_error(white: DataFrame, column: str, size: int) -> float:
    """Largest absolute entry of the covariance (divisor n, centred) of an array column minus the identity.

    The rows are centred by where whitening puts their mean, at 0, and the sums corrected by how far it is off.
    """

    def run(batches) -> Iterator[dict]:
        n, sums, crosses = 0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            for _, w in matrices(batch, column):
                n, sums, crosses = n + len(w), sums + w.sum(0), crosses + w.T @ w
        yield {"n": [n], "sums": [sums], "crosses": [crosses.ravel()]}

    parts = map_batches(white.select(column), run, "n long, sums array<double>, crosses array<double>")

    def summed(name: str, length: int) -> list:
        return [F.sum(F.get(name, F.lit(i))) for i in range(length)]

    n, *found = parts.agg(F.sum("n"), *summed("sums", size), *summed("crosses", size * size)).first()
    mean, crosses = np.array(found[:size]) / n, np.array(found[size:]).reshape(size, size) / n
    return float(np.abs(crosses - np.outer(mean, mean) - np.eye(size)).max())
