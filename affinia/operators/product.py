"""Products of sparse matrices, summed up row by row in the block that owns the row.

The rows of the result are dealt over blocks. A block gets its rows of the left side and each list of the right
side that one of them meets, once, and sums its rows up in pieces. What is shuffled are lists of numbers, not the
terms of the sums, and a row of the result is whole where it is made: its best entries are taken there.

Lists are stored once and sent to some of the blocks at a time, round by round, so that the disk never holds what all
blocks get.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.operators.ids import id_dictionary
from affinia.operators.skew import BLOCKS, block_of, top_per_group, with_blocks
from affinia.session import cut_lineage, scratch_path, stored, write_table

# Bytes of lists and rows a block may hold; one task works on one block.
BLOCK_BYTES = 128 * 2**20

# Bytes that a row's entry takes in its block, with its place among the lists.
ENTRY_BYTES = 56

# Bytes of the blocks that are sent lists at a time, if there are enough of them for all cores.
ROUND_BYTES = 4 * 2**30

# Terms that are added up at once, entries that are dealt over blocks at once, and rows of an Arrow batch given back.
TERMS = 500_000
DEALT = 1_000_000
BATCH = 200_000

# Bytes that one of the best entries of a row takes on its way, about.
BEST_BYTES = 16

# Longer lists of one key are cut.
ROWS_PER_LIST = 1_000_000

# Entries of the item vectors in one row.
CHUNK = 65_536

# Similarities with this many decimals travel as whole numbers.
SCALE = 1e9

# Estimates further apart than this are in the order of the scores, which are rounded to nine decimals.
SLACK = 2.5e-9

INTEGRAL = ("tinyint", "smallint", "int", "bigint")


@dataclass(frozen=True)
class Packed:
    """How numbers travel: as ``type``, times ``scale``; every value comes back as it was."""

    type: str
    scale: float
    bytes: int

    def of(self, column: str) -> Column:
        value = F.col(column) if self.scale == 1.0 else F.round(F.col(column) * self.scale)
        return value.try_cast(self.type)


PACKINGS = (Packed("tinyint", 1.0, 1), Packed("int", 1.0, 4), Packed("int", SCALE, 4))
PLAIN = Packed("double", 1.0, 8)


def packed(df: DataFrame, column: str) -> Packed:
    """The smallest packing that keeps every value of a (stored) column exactly."""
    kept = [F.bool_and(F.coalesce(p.of(column) / p.scale == F.col(column), F.lit(False))) for p in PACKINGS]
    found = df.agg(*[c.alias(f"_{i}") for i, c in enumerate(kept)]).first()
    return next((p for p, holds in zip(PACKINGS, found) if holds), PLAIN)


def narrowed(df: DataFrame, column: str) -> DataFrame:
    """A column of whole numbers as ints where all fit and none is negative."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return df.withColumn(column, F.col(column).cast("int")) if low is not None and low >= 0 and high < 2**31 else df


def dictionary_of(df: DataFrame, column: str) -> DataFrame | None:
    """A dictionary for ids that are no whole numbers, None for those that are."""
    return None if dict(df.dtypes)[column] in INTEGRAL else id_dictionary(df, column)


def block_count(left: DataFrame, right: DataFrame, entry_bytes: int) -> int:
    """Blocks for both sides: one for each core at least, and as many as keep a block's lists in bounds.

    A key with n rows on the left is met in P (1 - (1 - 1/P)^n) of P blocks, about.
    """
    keys, rows = left.agg(F.count_distinct("key"), F.count("key")).first()
    whole, each = right.count() * entry_bytes, rows / max(keys, 1)
    blocks = left.sparkSession.sparkContext.defaultParallelism
    while whole * (1.0 - (1.0 - 1.0 / blocks) ** each) + rows * ENTRY_BYTES / blocks > BLOCK_BYTES and blocks < 100_000:
        blocks += 1 + blocks // 8
    return blocks


def block_grid(left: DataFrame, right: DataFrame, sizes: tuple[int, int], k: int) -> tuple[int, int]:
    """Groups of rows and groups of others that move the least, for products of which ``k`` entries of a row are taken.

    A block owns a group of rows and a group of others. The left side goes to each group of others, the right side to
    each group of rows that meets its key, and the ``k`` best of a row come from every group of others. ``sizes``:
    bytes of an entry of both sides. Blocks are two for each core at least, and as many as keep a block's lists in bounds.
    """
    keys, entries = left.agg(F.count_distinct("key"), F.count("key")).first()
    rows, others = left.agg(F.approx_count_distinct("row")).first()[0], right.count()
    blocks = 2 * left.sparkSession.sparkContext.defaultParallelism

    def met(groups: int, entries: int) -> float:
        """Groups out of ``groups`` that a key with its entries dealt over them is found in."""
        return groups * (1.0 - (1.0 - 1.0 / groups) ** (entries / max(keys, 1)))

    found = []
    for across in range(1, blocks + 1):
        down = -(-blocks // across)
        while (others * sizes[1] * met(down, entries) / across + entries * ENTRY_BYTES) / down > BLOCK_BYTES and down < 100_000:
            down += 1 + down // 8
        again = rows * k * across * BEST_BYTES if across > 1 else 0
        found.append((others * sizes[1] * met(down, entries) + entries * sizes[0] * met(across, others) + again, down, across))
    return min(found)[1:]


def _lists(df: DataFrame, column: str, value: Packed | None, names: list[str], limit: int) -> DataFrame:
    """Rows of a key as parallel arrays, those of a hot key in pages of about ``limit`` rows."""
    entry = [F.col(column), *([value.of("value").alias("value")] if value else [])]
    paged = with_blocks(df, "key", df, column, limit).withColumn("_page", block_of(column)).drop(BLOCKS)
    lists = paged.groupBy("key", "_page").agg(F.collect_list(F.struct(*entry)).alias("_rows"))
    arrays = [F.col(f"_rows.{column}").alias(names[0])]
    if value:
        arrays.append(F.col("_rows.value").alias(names[1]))
    return lists.select("key", *arrays)


def _whole(df: DataFrame) -> DataFrame:
    """Columns as ints where every value stays the same."""
    how = PACKINGS[1]
    kept = df.agg(*[F.bool_and(F.coalesce(how.of(c) == F.col(c), F.lit(False))).alias(c) for c in df.columns]).first()
    return df.withColumns({c: how.of(c) for c in df.columns if kept[c]})


def sparse_product(
    left: DataFrame,
    right: DataFrame,
    pairs: str = "all",
    values: tuple[Packed, Packed] | None = None,
    absolute: bool = False,
    out: DataFrame | None = None,
    vectors: DataFrame | None = None,
    ids: bool = False,
    best: tuple[Callable[[dict[str, np.ndarray]], np.ndarray], int] | None = None,
    rows_per_list: int = ROWS_PER_LIST,
    weigh: tuple[Callable[[np.ndarray, dict[str, np.ndarray]], np.ndarray], Sequence[str]] | None = None,
    shown: Sequence[str] | None = None,
    grid: tuple[int, int] | None = None,
    own: bool = False,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Sums over shared keys: ``row, other, n`` and, with ``values``, ``dot``.

    ``left`` has ``key, row, value``, ``right`` has ``key, other, value``, both stored; ``row`` and ``other`` are
    whole numbers. ``n`` counts the terms, ``dot`` adds up the products of the values, and with ``absolute`` the
    column ``size`` adds up the magnitudes of the right values. ``pairs`` keeps ``all`` entries, those
    with another number than their row (``other``), or a larger one (``above``). Pairs ``row, other`` of ``out`` are
    left out, and with ``own`` all pairs of a row and one of its keys, which are then numbers like the others.

    ``vectors`` has a dense ``idx`` from 1 and columns that are given back for the row (``<c>_a``) and the other
    (``<c>_b``), all or those in ``shown``. With ``ids``, their column ``id`` replaces both numbers.

    ``weigh`` makes the values to multiply in the block: from those that travel and the named columns of ``vectors``
    of their row or other.

    ``best`` is an estimate of the scores, from a batch of the columns above (before ``ids``), and a number k: entries
    that are surely not among the k best of their row by it, ties to the smaller other, are left out.

    Rows of the result lie together, in ascending order of ``other``, for ``best_of_rows`` to use. ``grid``: groups of
    rows and of others; with several of others (see ``block_grid``) a row lies together once in each, and so do its best.

    ``then`` is what becomes of the result, for every row on its own, and gives less than it gets: with it, blocks that
    hold more than ``ROUND_BYTES`` take turns, and what each turn gives is stored before the next one's lists are sent.
    """
    down, across = grid or (block_count(left, right, 4 + (values[1].bytes if values else 0)), 1)
    types = {"row": dict(left.dtypes)["row"], "other": dict(right.dtypes)["other"]}
    numbers = ["a", "b"] if values else []
    left_lists = _lists(left, "row", values[0] if values else None, ["rows", "a"], rows_per_list)
    right_lists = _lists(right, "other", values[1] if values else None, ["others", "b"], rows_per_list)
    met = left_lists.join(right_lists, "key", "left" if own else "inner")
    mark = F.col("key").try_cast(types["other"]) if own else F.lit(None)
    sent = met.select("rows", "others", *numbers, mark.cast("bigint").alias("mark"))
    if out is not None:
        marked = out.select(F.col("other").try_cast(types["other"]).alias("key"), F.col("row").try_cast(types["row"]).alias("row"))
        marked = _lists(marked.where(F.col("key").isNotNull() & F.col("row").isNotNull()), "row", None, ["rows"], rows_per_list)
        alike = [F.array_repeat(F.lit(0).cast(values[0].type), F.size("rows")).alias("a")] if values else []
        marked = marked.select("rows", *alike, F.col("key").cast("bigint").alias("mark"))
        sent = sent.unionByName(marked, allowMissingColumns=True)
    stats = [] if vectors is None else [c for c in vectors.columns if c != "idx"]
    if stats:
        chunk = F.floor((F.col("idx") - 1) / CHUNK).cast("int")
        listed = F.sort_array(F.collect_list(F.struct("idx", *stats)))
        chunks = _whole(vectors).groupBy(chunk.alias("_chunk")).agg(listed.alias("_rows"))
    shown = [s for s in stats if s != "id" and (shown is None or s in shown)]
    whole = "bigint"
    schema = f"row {whole}, other {whole}, n bigint"
    schema += ", dot double" if values else ""
    schema += ", size double" if absolute else ""
    schema += "".join(f", {s}{x} double" for s in shown for x in ("_a", "_b"))
    kernel = _Kernel(pairs, tuple(v.scale for v in values) if values else None, absolute, tuple(shown), ids, best, weigh)

    def product(sent: DataFrame, first: int, last: int) -> DataFrame:
        """The rows of the groups from ``first`` up to ``last``."""
        blocks = (last - first) * across
        dealt = sent.mapInArrow(_Deal(down, across, first, last), "block int, first int, lists binary")
        if stats:
            every = chunks.select(
                F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                (F.col("_chunk") + 1).alias("first"),
                *[F.col(f"_rows.{s}").alias(f"v_{s}") for s in stats],
            )
            dealt = dealt.unionByName(every, allowMissingColumns=True)
        return dealt.repartitionById(blocks, "block").mapInArrow(_Unpacked(kernel), schema)

    together = max(2 * left.sparkSession.sparkContext.defaultParallelism, ROUND_BYTES // BLOCK_BYTES)
    step = max(1, together // across)
    if then is None or down <= step:
        return product(sent, 0, down) if then is None else then(product(sent, 0, down))
    sent, path, found = cut_lineage(sent), scratch_path(left.sparkSession, "rounds"), None
    for first in range(0, down, step):
        found = then(product(sent, first, min(down, first + step)))
        write_table(found, path, "append")
    return stored(found, path)


def _group(numbers: np.ndarray, groups: int) -> np.ndarray:
    """The group of whole numbers, whatever their type."""
    if groups == 1:
        return np.zeros(len(numbers), np.int32)
    x = numbers.astype(np.int64).astype(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(groups)).astype(np.int32)


# How numbers are written in lists that travel: by type, each byte of all numbers after the other, as the high ones repeat.
_TYPES = ("<i1", "<i4", "<i8", "<f8")


def _written(arrays: Sequence[np.ndarray]) -> bytes:
    head = np.array([(_TYPES.index(x.dtype.str.replace("|", "<")), len(x)) for x in arrays], "<i8")
    bodies = (np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() if len(x) else b"" for x in arrays)
    return b"".join((np.int64(len(arrays)).tobytes(), head.tobytes(), *bodies))


def _read(raw: memoryview) -> list[np.ndarray]:
    count = int(np.frombuffer(raw, "<i8", 1)[0])
    head, at, found = np.frombuffer(raw, "<i8", 2 * count, 8).reshape(-1, 2), 8 + 16 * count, []
    for kind, size in head.tolist():
        type_ = np.dtype(_TYPES[kind])
        planes = np.frombuffer(raw, np.uint8, size * type_.itemsize, at).reshape(type_.itemsize, size)
        found.append(np.ascontiguousarray(planes.T).view(type_).ravel())
        at += planes.size
    return found


@dataclass(frozen=True)
class _Deal:
    """Sends the lists of a key to the blocks of its rows, with the part of its others that each block owns.

    Of all groups of rows those from ``first`` up to ``last``. Marks are pairs of a row and one number to leave out.
    """

    down: int
    across: int
    first: int
    last: int

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, others = batch.column("rows").value_lengths(), batch.column("others").value_lengths()
            rows, others = (x.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (rows, others))
            ends = np.cumsum(np.minimum(rows, self.last - self.first) * others + rows)
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + DEALT, side="right")))
                yield from self.dealt(batch.slice(at, to - at), rows[at:to], others[at:to])
                at = to

    def dealt(self, batch: pa.RecordBatch, sizes: np.ndarray, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
        has = batch.schema.names
        rows = batch.column("rows").flatten().to_numpy()
        of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        down = _group(rows, self.down)
        mine = np.flatnonzero((down >= self.first) & (down < self.last))
        order = mine[np.argsort(down[mine], kind="stable")]
        rows, of, down = rows[order], of[order], down[order]
        a = batch.column("a").flatten().to_numpy()[order] if "a" in has else None
        others = batch.column("others").flatten().to_numpy()
        b = batch.column("b").flatten().to_numpy() if "b" in has else None
        parts = self.parts(others, b, lengths)
        marks = batch.column("mark")
        marked = marks.is_valid().to_numpy(zero_copy_only=False)
        marks = marks.fill_null(0).to_numpy(zero_copy_only=False)
        marks_of = np.where(marked, _group(marks, self.across), -1)
        bounds = np.searchsorted(down, np.arange(self.first, self.last + 1))
        made: list[tuple[int, int, bytes]] = []
        for d in range(self.last - self.first):
            span = slice(bounds[d], bounds[d + 1])
            if span.start == span.stop:
                continue
            for x, (others_x, b_x, starts, counts) in enumerate(parts):
                block, lists = d * self.across + x, of[span]
                keep = counts[lists] > 0
                if keep.any():
                    lists = lists[keep]
                    fresh = np.flatnonzero(np.concatenate(([True], lists[1:] != lists[:-1])))
                    met, size = lists[fresh], np.diff(np.append(fresh, len(lists)))
                    n = counts[met]
                    at = np.repeat(starts[met] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                    arrays = [size.astype("<i4"), n.astype("<i4"), rows[span][keep], others_x[at]]
                    if a is not None:
                        arrays += [a[span][keep], b_x[at]]
                    made.append((block, 0, _written(arrays)))
                lists = of[span]
                keep = marks_of[lists] == x
                if keep.any():
                    each = np.ones(int(keep.sum()), "<i4")
                    made.append((block, -1, _written([each, each, rows[span][keep], marks[lists[keep]]])))
            if sum(len(m[2]) for m in made) > 4 * DEALT:
                yield self.batch(made)
                made = []
        if made:
            yield self.batch(made)

    def parts(self, others: np.ndarray, b: np.ndarray | None, lengths: np.ndarray) -> list[tuple]:
        """Per group of others: its numbers and values, and where those of each list start and how many they are."""
        if self.across == 1:
            return [(others, b, np.cumsum(lengths) - lengths, lengths)]
        of, across, found = np.repeat(np.arange(len(lengths)), lengths), _group(others, self.across), []
        for x in range(self.across):
            at = np.flatnonzero(across == x)
            counts = np.bincount(of[at], minlength=len(lengths))
            found.append((others[at], b[at] if b is not None else None, np.cumsum(counts) - counts, counts))
        return found

    def batch(self, made: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        block, first, lists = zip(*made)
        return pa.RecordBatch.from_pydict(
            {"block": pa.array(block, pa.int32()), "first": pa.array(first, pa.int32()), "lists": pa.array(lists, pa.binary())}
        )


@dataclass(frozen=True)
class _Unpacked:
    """A kernel that is given lists as they travel."""

    kernel: _Kernel

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from self.kernel(self.lists(batches))
        _give_back()

    def lists(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column("first").to_numpy()
            if (first > 0).any():
                yield batch.filter(pa.array(first > 0)).drop_columns(["lists"])
            for i in np.flatnonzero(first <= 0):
                size, n, rows, others, *values = _read(memoryview(batch.column("lists")[i].as_buffer()))
                columns = {"first": np.full(len(size), first[i], np.int32)}
                for c, lengths, x in (("rows", size, rows), ("others", n, others), *zip("ab", (size, n), values)):
                    ends = np.append(np.int32(0), np.cumsum(lengths)).astype(np.int32)
                    columns[c] = pa.ListArray.from_arrays(pa.array(ends), pa.array(x))
                yield pa.RecordBatch.from_pydict(columns)


@dataclass(frozen=True)
class _Kernel:
    """Sums up the rows of a block."""

    pairs: str
    scales: tuple[float, float] | None
    absolute: bool
    stats: tuple[str, ...]
    ids: bool
    best: tuple[Callable[[dict[str, np.ndarray]], np.ndarray], int] | None = None
    weigh: tuple[Callable[[np.ndarray, dict[str, np.ndarray]], np.ndarray], Sequence[str]] | None = None

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, others, a, b, met, lengths, marks, chunks, count = [], [], [], [], [], [], [], [], 0
        for batch in batches:
            first = batch.column("first").to_numpy()
            for i in np.flatnonzero(first > 0):
                chunks.append((first[i], {s: batch.column(f"v_{s}")[i].values.to_numpy() for s in self.vectors()}))
            if (first < 0).any():
                m = batch.filter(pa.array(first < 0))
                marked, others_of = (m.column(c).flatten().to_numpy() for c in ("rows", "others"))
                marks.append((marked, np.repeat(others_of, m.column("rows").value_lengths().to_numpy())))
            lists = batch.filter(pa.array(first == 0)) if (first != 0).any() else batch
            if lists.num_rows:
                left = lists.column("rows").value_lengths().to_numpy()
                met.append(np.repeat(np.arange(count, count + lists.num_rows, dtype=np.int32), left))
                lengths.append(lists.column("others").value_lengths().to_numpy())
                count += lists.num_rows
                for found, column in ((rows, "rows"), (others, "others"), *(((a, "a"), (b, "b")) if self.scales else ())):
                    found.append(lists.column(column).flatten().to_numpy())
        if not count:
            return
        chunks.sort(key=lambda c: c[0])
        vectors = {s: np.concatenate([c[1].pop(s) for c in chunks]) for s in self.vectors()} if chunks else {}
        chunks.clear()
        others, b, lengths = _joined(others), _joined(b) if self.scales else None, _joined(lengths).astype(np.int64)
        rows, met = _joined(rows), _joined(met)
        order = np.argsort(rows, kind="stable")
        rows, met = rows[order], met[order]
        if self.scales:
            a = _joined(a)[order]
        del order
        numbers = None
        if others.dtype != np.int32 or others.min() < 0:
            numbers, others = np.unique(others, return_inverse=True)
        starts, sizes = (np.cumsum(lengths) - lengths)[met], lengths[met]
        del met, lengths
        fresh = np.concatenate(([True], rows[1:] != rows[:-1]))
        names, local = rows[fresh], np.cumsum(fresh) - 1
        hidden = self.hidden(marks, names, numbers)
        ends = np.cumsum(sizes)
        last = np.append(np.flatnonzero(fresh)[1:], len(rows))  # ends of the rows among the entries
        begin = 0
        while begin < len(rows):
            done = ends[begin - 1] if begin else 0
            at = np.searchsorted(ends[last - 1], done + TERMS, side="right") - 1
            end = max(int(last[at]) if at >= 0 else 0, int(last[local[begin]]))
            parts, i = [], begin
            while i < end:
                j = max(i + 1, int(np.searchsorted(ends[i:end], (ends[i - 1] if i else 0) + TERMS, side="right")) + i)
                span = slice(i, j)
                parts.append(self.sums(local[span], names, starts[span], sizes[span], others, numbers, a[span] if self.scales else None, b, vectors))
                i = j
            summed = parts[0] if len(parts) == 1 else _again(parts)
            yield from self.shown(summed, names, numbers, hidden, vectors)
            begin = end

    def vectors(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((*self.stats, *(self.weigh[1] if self.weigh else ()), *(("id",) if self.ids else ()))))

    def hidden(self, marks: list, names: np.ndarray, numbers: np.ndarray | None) -> np.ndarray | None:
        """Sorted keys of the pairs to leave out, of rows and numbers that occur here."""
        if not marks:
            return None
        rows, others = (np.concatenate([m[i] for m in marks]) for i in (0, 1))
        at = np.minimum(np.searchsorted(names, rows), len(names) - 1)
        known = names[at] == rows
        if numbers is not None:
            to = np.minimum(np.searchsorted(numbers, others), len(numbers) - 1)
            known &= numbers[to] == others
            others = to
        known &= others >= 0
        return np.unique((at[known].astype(np.int64) << 32) | others[known].astype(np.int64))

    def weighed(self, values, scale, at, vectors) -> np.ndarray:
        """The values to multiply, of rows or others with these numbers."""
        values = values if scale == 1.0 else values / scale
        if self.weigh is None:
            return values
        return self.weigh[0](values.astype(np.float64), {s: vectors[s][at - 1].astype(np.float64) for s in self.weigh[1]})

    def sums(self, local, names, starts, sizes, others, numbers, a, b, vectors) -> list[np.ndarray]:
        """Keys (row, other) in ascending order with their sums."""
        total = int(sizes.sum())
        at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
        other, row = others[at].astype(np.int64), np.repeat(local, sizes)
        keys = (row << 32) | other
        terms = []
        if self.scales:
            right = self.weighed(b[at], self.scales[1], other if numbers is None else numbers[other], vectors)
            left = np.repeat(self.weighed(a, self.scales[0], names[local], vectors), sizes)
            terms = [left.astype(np.float64) * right, *([np.abs(right.astype(np.float64))] if self.absolute else [])]
        if self.pairs != "all":
            number, own = other if numbers is None else numbers[other], names[row]
            kept = number > own if self.pairs == "above" else number != own
            keys, terms = keys[kept], [t[kept] for t in terms]
        return _add(keys, np.ones(len(keys), np.int64), terms)

    def shown(self, summed, names, numbers, hidden, vectors) -> Iterator[pa.RecordBatch]:
        keys = summed[0]
        if hidden is not None and len(hidden) and len(keys):
            at = np.minimum(np.searchsorted(hidden, keys), len(hidden) - 1)
            kept = hidden[at] != keys
            summed = [s[kept] for s in summed]
            keys = summed[0]
        row, other = names[keys >> 32], keys & 0xFFFFFFFF
        if numbers is not None:
            other = numbers[other]
        columns = {"row": row, "other": other, "n": summed[1]}
        columns.update(zip(("dot", "size"), summed[2:]))
        for s in self.stats:
            columns[f"{s}_a"], columns[f"{s}_b"] = (vectors[s][at - 1].astype(np.float64) for at in (row, other))
        if self.best is not None and len(keys):
            with np.errstate(all="ignore"):
                at = _hopeful(keys >> 32, self.best[0](columns), self.best[1])
            columns = {c: v[at] for c, v in columns.items()}
            row, other = columns["row"], columns["other"]
        if self.ids:
            columns["row"], columns["other"] = vectors["id"][row - 1], vectors["id"][other - 1]
        for c in ("row", "other"):
            columns[c] = columns[c].astype(np.int64)
        batch = pa.RecordBatch.from_pydict({c: pa.array(v) for c, v in columns.items()})
        for i in range(0, batch.num_rows, BATCH):
            yield batch.slice(i, BATCH)


def _add(keys: np.ndarray, counts: np.ndarray, terms: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Sums per key, keys ascending."""
    if not len(keys):
        return [keys, counts, *terms]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return [keys[first], *(np.add.reduceat(t[order], first) for t in (counts, *terms))]


def _give_back() -> None:
    """Unused memory of this worker process, which stays for other tasks, to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library
        pass


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """The parts as one array, which alone is held afterwards."""
    whole = np.concatenate(parts)
    parts.clear()
    return whole


def _again(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    keys, counts, *terms = (np.concatenate(p) for p in zip(*parts))
    return _add(keys, counts, terms)


def _hopeful(row: np.ndarray, estimate: np.ndarray, k: int) -> np.ndarray:
    """Places of the entries that may be among the ``k`` best of their row."""
    value = np.nan_to_num(np.floor(estimate * 1e9 + 0.5) / 1e9, copy=False, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
    bounds = np.append(np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))), len(row))
    chosen = []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        v = value[start:end]
        if len(v) <= k:
            chosen.append(np.arange(start, end))
            continue
        bar = np.partition(v, len(v) - k)[len(v) - k]
        kept = v >= bar - SLACK
        kept[np.flatnonzero(v == bar)[k:]] = False
        chosen.append(np.flatnonzero(kept) + start)
    return np.concatenate(chosen)


def best_of_rows(df: DataFrame, score: str, k: int, rank: str = "rank", parts: int = 1) -> DataFrame:
    """The ``k`` highest scores of each row, ties to the smaller other: ``row, other, <score>, <rank>``.

    ``df`` comes from ``sparse_product`` by projections and filters only, so that rows still lie together, each in
    ``parts`` blocks; the best of several parts meet in a shuffle.
    """

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            part = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if part[0][0] == part[0][-1] and (not held or held[-1][0][-1] == part[0][0]):
                held.append(part)  # the row goes on
                continue
            held.append(part)
            row, other, value = (np.concatenate(c) for c in zip(*held))
            end = int(np.flatnonzero(row != row[-1])[-1]) + 1
            held = [(row[end:], other[end:], value[end:])]
            yield _best(row[:end], other[:end], value[:end], k, score, rank)
        if held:
            yield _best(*(np.concatenate(c) for c in zip(*held)), k, score, rank)

    ranked = df.select("row", "other", score).mapInArrow(best, f"row bigint, other bigint, {score} double, {rank} int")
    if parts == 1:
        return ranked
    first = top_per_group(ranked.drop(rank), ["row"], [F.desc(score), F.col("other")], k, rank)
    return first.select("row", "other", score, F.col(rank).cast("int").alias(rank))


def _best(row: np.ndarray, other: np.ndarray, value: np.ndarray, k: int, score: str, rank: str) -> pa.RecordBatch:
    bounds = np.append(np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))), len(row))
    chosen, ranks = [], []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        v = value[start:end]
        if len(v) > k:
            bar = np.partition(v, len(v) - k)[len(v) - k]
            above = np.flatnonzero(v > bar)
            at = np.concatenate((above, np.flatnonzero(v == bar)[: k - len(above)]))
            at = at[np.argsort(-v[at], kind="stable")]
        else:
            at = np.argsort(-v, kind="stable")
        chosen.append(at + start)
        ranks.append(np.arange(1, len(at) + 1, dtype=np.int32))
    at = np.concatenate(chosen)
    return pa.RecordBatch.from_pydict(
        {"row": pa.array(row[at]), "other": pa.array(other[at]), score: pa.array(value[at]), rank: pa.array(np.concatenate(ranks))}
    )
