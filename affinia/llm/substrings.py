"""Removal of word runs that occur more than once, with a count-min sketch before the exact grouping.

First pass: every task sketches its windows, the sketches are merged by blocks of cells, and a cell is
remembered if it was hit twice. To need far fewer cells, a window is counted under its anchor, the run
inside it with the smallest hash: equal windows have equal anchors at equal distances, so an
anchor's count is never below its window's count. Second pass: windows whose anchor is estimated to
repeat, and only these, are grouped exactly (by a 128-bit hash of their words). The sketch only ever
overestimates, so no repeated window is lost; where it is full, more windows are grouped. Equal windows
that a task holds together are known to repeat: only one of them is shuffled to meet the other tasks'
windows, however often it occurs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.llm.common import FLUSH, WordHashes, map_batches, mix, run_hashes, split_words, values

LENGTH = 35
#: Words of an anchor, as a share of the window's.
ANCHOR_SHARE = 0.6
ROWS = 2
#: Cells of a sketch row, 2^27: 16 MB each for the merged bits, whatever the input.
BITS = 27
_BLOCK = 16  # bits of a cell's place in its block


def _anchors(words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every possible anchor, and for each window the position of its own (the first smallest)."""
    size = max(1, int(length * ANCHOR_SHARE))
    runs = run_hashes(words, size)
    n = len(words) - length + 1
    span = length - size + 1
    # Sliding minimum by doubling; the position settles ties for the first.
    best, at = runs, np.arange(len(runs))
    width = 1
    while 2 * width <= span:
        left, right = best[:-width], best[width:]
        first = left <= right
        at = np.where(first, at[:-width], at[width:])
        best = np.where(first, left, right)
        width *= 2
    if width < span:
        shift = span - width
        first = best[: len(best) - shift] <= best[shift:]
        at = np.where(first, at[: len(at) - shift], at[shift:])
    return runs, at[:n]


def _cells(anchors: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of each anchor in each sketch row."""
    with np.errstate(over="ignore"):
        return [mix(anchors + np.uint64(0xD1B54A32D192ED03) * np.uint64(r + 1)) >> np.uint64(64 - bits) for r in range(ROWS)]


def sketch(docs: DataFrame, text: str, length: int, bits: int) -> list[np.ndarray]:
    """Per sketch row, a bit for each cell that at least two anchors of the corpus fall into."""
    block_bits = min(_BLOCK, bits - 3)
    blocks = 1 << (bits - block_bits)

    def partial(batches) -> Iterator[dict]:
        hashes, held, size = WordHashes(), [], 0

        def out() -> Iterator[dict]:
            anchors = np.concatenate(held)
            for r, cells in enumerate(_cells(anchors, bits)):
                cells = np.sort(cells)
                # A cell counts once or twice: the third and later hits of a task say nothing new.
                cells = cells[np.append([True, True], cells[2:] != cells[:-2])[: len(cells)]]
                block = (cells >> np.uint64(block_bits)).astype(np.int64)
                ends = np.flatnonzero(np.append(block[1:] != block[:-1], True)) + 1
                places = (cells & np.uint64((1 << block_bits) - 1)).astype("<u2")
                starts = np.append(0, ends[:-1])
                yield {
                    "sketch": np.full(len(ends), r, np.int32),
                    "block": block[starts].astype(np.int32),
                    "places": [places[a:b].tobytes() for a, b in zip(starts, ends, strict=True)],
                }

        for batch in batches:
            for (body,) in values(batch, "text"):
                words = hashes.of(split_words(body))
                if len(words) >= length:
                    runs, at = _anchors(words, length)
                    held.append(runs[at[np.append(True, at[1:] != at[:-1])]])
                    size += len(held[-1])
                    if size > 1_000_000:
                        yield from out()
                        held, size = [], 0
        if held:
            yield from out()

    def merge(batches) -> Iterator[dict]:
        counts: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for r, block, places in values(batch, "sketch", "block", "places"):
                if (mine := counts.get((r, block))) is None:
                    mine = counts[r, block] = np.zeros(1 << block_bits, np.uint8)
                found, n = np.unique(np.frombuffer(places, "<u2"), return_counts=True)
                mine[found] = np.minimum(mine[found] + n, 2)
        for (r, block), mine in counts.items():
            if (mine >= 2).any():
                yield {"sketch": [r], "block": [block], "bits": [np.packbits(mine >= 2).tobytes()]}

    rows = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    parts = map_batches(rows, partial, "sketch int, block int, places binary")
    merged = map_batches(parts.repartition("sketch", "block"), merge, "sketch int, block int, bits binary")
    out = [np.zeros((blocks, (1 << block_bits) // 8), np.uint8) for _ in range(ROWS)]
    for r, block, packed in merged.collect():  # at most ROWS * 2^bits / 8 bytes
        out[r][block] = np.frombuffer(bytes(packed), np.uint8)
    return [x.reshape(-1) for x in out]


def _repeats(anchors: np.ndarray, merged: list[np.ndarray], bits: int) -> np.ndarray:
    """Whether the sketch estimates each anchor at two or more."""
    found = np.ones(len(anchors), bool)
    for cells, row in zip(_cells(anchors, bits), merged, strict=True):
        found &= (row[cells >> np.uint64(3)] >> (7 - (cells & np.uint64(7))).astype(np.uint8)) & 1 == 1
    return found


def _settled(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For windows by their hashes: whether an equal one is among them, and whether it is the first of its kind.

    Should two kinds share h1, equal windows may go unnoticed here and are left to the exact grouping.
    """
    order = np.argsort(h1)
    a, b = h1[order], h2[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    alone = fresh & np.append(fresh[1:], True)
    twice, first = np.empty(len(order), bool), np.empty(len(order), bool)
    twice[order], first[order] = ~alone, fresh
    return twice, first


def repeated_windows(docs: DataFrame, key: list[str], text: str, length: int = LENGTH, bits: int = BITS) -> DataFrame:
    """(key, runs): the first words of a row's windows whose word sequence starts at another place too.

    ``key`` are long columns that tell rows apart; ``runs`` is an array of (start, run), of windows that begin
    at ``run`` consecutive words.
    """
    context = docs.sparkSession.sparkContext
    merged = context.broadcast(sketch(docs, text, length, bits))
    names = [f"_key{i}" for i in range(len(key))]

    def windows(batches) -> Iterator[dict]:
        """Windows that may repeat, with n = 1, and one of each kind that does, with n = 2; rows without h1 are sure."""
        hashes, held, size = WordHashes(), [], 0

        def out() -> dict:
            h1, h2, start, row = (np.concatenate([h[i] for h in held]) for i in range(4))
            keys = [np.array([h[4][i] for h in held], np.int64)[row] for i in range(len(key))]
            twice, first = _settled(h1, h2)
            sure = np.flatnonzero(twice)
            # Sure windows as runs of consecutive starts of a row.
            begins = np.ones(len(sure), bool)
            begins[1:] = (np.diff(start[sure]) != 1) | (np.diff(row[sure]) != 0)
            begins = np.flatnonzero(begins)
            runs, sure = np.diff(np.append(begins, len(sure))), sure[begins]
            asked = np.flatnonzero(first)
            at = np.concatenate([sure, asked])
            known = np.arange(len(at)) < len(sure)
            return dict(zip(names, (k[at] for k in keys), strict=True)) | {
                "h1": pa.array(h1[at], mask=known),
                "h2": pa.array(h2[at], mask=known),
                "start": start[at],
                "run": np.append(runs, np.ones(len(asked), np.int64)).astype(np.int32),
                "n": np.append(np.full(len(sure), 2), 1 + twice[asked]).astype(np.int8),
            }

        for batch in batches:
            for body, *mine in values(batch, "_text", *names):
                words = hashes.of(split_words(body))
                if len(words) < length:
                    continue
                runs, at = _anchors(words, length)
                own = np.flatnonzero(_repeats(runs, merged.value, bits)[at])
                if not len(own):
                    continue
                h1, h2 = (run_hashes(words, length, i)[own].view(np.int64) for i in (0, 1))
                held.append((h1, h2, own.astype(np.int32), np.full(len(own), len(held)), mine))
                size += len(own)
                if size > FLUSH:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    rows = docs.select(*[F.col(k).alias(n) for k, n in zip(key, names, strict=True)], F.col(text).alias("_text"))
    kinds = "".join(f"{n} bigint, " for n in names)
    found = map_batches(rows, windows, f"{kinds}h1 bigint, h2 bigint, start int, run int, n tinyint")
    # Sure rows have no hash: they spread over the tasks by their key, each a group of its own.
    same = [F.coalesce(F.col(h), F.xxhash64(F.lit(i), *names, "start")) for i, h in enumerate(("h1", "h2"))]
    alike = F.sum("n").over(Window.partitionBy(*same))
    # A window that stands for its kind is among the sure ones already.
    repeated = found.withColumn("_alike", alike).where("_alike > 1 and (n = 1 or h1 is null)")
    out = repeated.groupBy(*names).agg(F.collect_set(F.struct("start", "run")).alias("runs"))
    return out.select(*[F.col(n).alias(k) for k, n in zip(key, names, strict=True)], "runs")


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, bits: int = BITS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text: words covered by a repeated window are removed.

    Windows are judged on the input; all places of a repeated window go, the first one too. Words
    are joined by one space. Null and empty texts have no words and an empty kept text; texts shorter
    than a window stay. A row is a document of its own: repeated rows of at least ``length`` words repeat
    each other. Null ids are kept; an empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    # Equal rows share their windows' fate.
    rows = rows.withColumns({"_k1": F.xxhash64(F.lit(1), "_id"), "_k2": F.xxhash64(F.lit(2), "_id", "_text")})
    found = repeated_windows(rows, ["_k1", "_k2"], "_text", length, bits)

    def keep(batches) -> Iterator[dict]:
        for batch in batches:
            counts, removed, kept = [], [], []
            runs = batch.column(batch.schema.get_field_index("runs"))
            known, bounds = runs.is_valid().to_numpy(zero_copy_only=False), runs.offsets.to_numpy()
            start, run = (runs.values.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
            for i, (body,) in enumerate(values(batch, "_text")):
                words = split_words(body)
                counts.append(len(words))
                if not known[i]:
                    removed.append(0)
                    kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                    continue
                at = slice(bounds[i], bounds[i + 1])
                gone = np.bincount(start[at], minlength=len(words) + 1)
                gone -= np.bincount(start[at] + run[at] + length - 1, minlength=len(words) + 1)
                stay = np.cumsum(gone)[:-1] == 0
                removed.append(int(len(words) - stay.sum()))
                left = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
            yield {"doc_id": batch.column(0), "n_words": counts, "n_removed": removed, "kept_text": kept}

    met = rows.join(found, ["_k1", "_k2"], "left").select("_id", "_text", "runs")
    kind = docs.schema[doc_id].dataType.simpleString()
    out = map_batches(met, keep, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_text string")
    return out.withColumnRenamed("doc_id", doc_id)


def kept_sha256(text: str) -> str:
    """The digest of a kept text, used by tests."""
    return hashlib.sha256(text.encode()).hexdigest()
