"""Mixture-controlled packing: deficit round-robin over one queue of tokens per source.

Every window takes from each source its target share of the tokens. What rounding leaves over, the
deficit, is carried on, so that after any number of windows a source is within one token of its
share. A queue's k-th token is due at time (k - 1/2) / weight; windows take tokens by due time,
which is what round-robin with deficits amounts to, and a queue that has run dry no longer counts.
Since the number of tokens due by a time follows from the totals alone, each task works out by
itself which windows its documents fall into: deficits carry across partitions without any
partition waiting for another, and no text is shuffled.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.llm.common import Scratch, held, map_batches

WINDOW = 1024
END_ID = 0
#: Numbers of a schedule that a task works out at once.
CELLS = 200_000
#: Bytes of remembered parts in each generation of an encoder, of texts encoded at once, of ids cut at once.
CACHE, TEXTS, IDS = 32 << 20, 1 << 20, 2 << 20
_NULL = "\x00null"
_SPACES = re.compile(r"\s{2,}")


class Encoder:
    """Token ids of texts, with the pieces between single spaces remembered.

    A single space between two other characters always starts a token of a byte-level vocabulary, so a
    text may be cut before each such space and the parts encoded on their own. Texts with any other
    white space next to a space are encoded whole. Two generations of parts are remembered, each up
    to ``limit`` bytes: what is met again moves to the younger one, the rest is forgotten with the older.
    """

    #: Bytes of memory that a remembered part takes besides its characters and ids.
    ENTRY = 220

    def __init__(self, path: str, limit: int = CACHE) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Type of an id: two bytes if the vocabulary allows.
        self.kind = "<u2" if max(vocabulary.values(), default=0) < 1 << 16 else "<u4"
        self.leading = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        # The byte-level vocabularies write a space as this character; added tokens hold none.
        self.leading[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.limit, self.held = limit, 0

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in encoded]

    def _learn(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        """The ids of parts that follow a space, many by one call: a leading space marks where each begins."""
        for a in range(0, len(parts), 200):
            some = parts[a : a + 200]
            (ids,) = self._encode([" " + " ".join(some)])
            starts = np.flatnonzero(self.leading[ids])
            if len(starts) == len(some):
                at = [*(ids.itemsize * starts).tolist(), ids.nbytes]
                held = ids.tobytes()
                yield from zip(some, map(held.__getitem__, map(slice, at, at[1:])), strict=True)
            else:  # a part holds a token that the tokenizer treats apart
                yield from zip(some, (x.tobytes() for x in self._encode([f" {p}" for p in some])), strict=True)

    def _remember(self, part: str, ids: bytes) -> None:
        if self.held > self.limit:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[part] = ids
        self.held += len(part) + len(ids) + self.ENTRY

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian integers of type ``kind``; null has none."""
        cut = [t.split(" ") if t else [] for t in texts]
        whole = [len(p) < 2 or not p[0] or not p[-1] or self._odd(t) for t, p in zip(texts, cut, strict=True)]
        wanted: set[str] = set()
        for parts, one in zip(cut, whole, strict=True):
            if not one:
                wanted.update(parts[1:])
        known: dict[str, bytes] = {}
        missing = []
        for part in wanted:
            if (ids := self.young.get(part)) is None:
                if (ids := self.old.get(part)) is None:
                    missing.append(part)
                    continue
                self._remember(part, ids)
            known[part] = ids
        for part, ids in self._learn(missing):
            known[part] = ids
            self._remember(part, ids)
        firsts = iter(self._encode([t if one else p[0] for t, p, one in zip(texts, cut, whole, strict=True) if t]))
        return [
            next(firsts).tobytes() + (b"" if one else b"".join(map(known.__getitem__, parts[1:]))) if t else b""
            for t, parts, one in zip(texts, cut, whole, strict=True)
        ]

    def _odd(self, text: str) -> bool:
        return any(" " in m.group() for m in _SPACES.finditer(text))


def _encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker process, until another operator runs there."""
    return held(("encoder", path), lambda: Encoder(path))


def _bounded(batch, name: str, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose values of a column take about ``limit`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name))), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes + 64) // limit
    bounds = np.flatnonzero(np.diff(ends)) + 1
    bounds = [0, *bounds.tolist(), len(sizes)]
    yield from ((a, b) for a, b in zip(bounds, bounds[1:]) if a < b)


def tokenize(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, queue, ids, width, n, part, before): ids with the end id; before: tokens of the queue ahead in the part.

    ``width``: bytes of an id, 2 where the vocabulary allows.
    """

    def run(batches) -> Iterator[dict]:
        encoder, ahead = _encoder(tokenizer), {}
        part = TaskContext.get().partitionId()
        end, width = np.array([END_ID], encoder.kind).tobytes(), np.dtype(encoder.kind).itemsize
        for batch in batches:
            for a, b in _bounded(batch, "_text", TEXTS):
                some = batch.slice(a, b - a)
                keys, texts, queues = (some.column(i) for i in range(3))
                queues = [_NULL if q is None else q for q in queues.to_pylist()]
                ids = [x + end for x in encoder.encode(texts.to_pylist())]
                n, before = [len(x) // width for x in ids], []
                for queue, m in zip(queues, n, strict=True):
                    before.append(ahead.get(queue, 0))
                    ahead[queue] = before[-1] + m
                yield {
                    "doc_id": keys,
                    "queue": queues,
                    "ids": ids,
                    "width": np.full(len(ids), width, np.int32),
                    "n": n,
                    "part": np.full(len(ids), part, np.int32),
                    "before": before,
                }

    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.col(source).cast("string").alias("_queue"))
    id_type = rows.schema["_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {id_type}, queue string, ids binary, width int, n bigint, part int, before bigint", True)


class Schedule:
    """How many tokens of each queue the first w windows take.

    Queues of equal total and weight are due alike and form a class; ``lane`` numbers the queues class by
    class. However many queues there are, the work of a window grows with the classes only.
    """

    def __init__(self, totals: list[int], weights: list[float], window: int) -> None:
        totals, weights = np.array(totals, np.int64), np.array(weights, float) / max(sum(weights), 1e-300)
        order = np.lexsort((np.arange(len(totals)), weights, totals))
        fresh = np.ones(len(order), bool)
        t, w = totals[order], weights[order]
        fresh[1:] = (t[1:] != t[:-1]) | (w[1:] != w[:-1])
        first = np.flatnonzero(fresh)
        self.lane = np.empty(len(order), np.int64)
        self.lane[order] = np.arange(len(order))
        self.kind = np.cumsum(fresh) - 1  # class of each lane
        self.place = np.arange(len(order)) - first[self.kind] if len(order) else first
        self.size = np.diff(np.append(first, len(order)))
        self.totals, self.weights = t[first], w[first]
        self.window, self.all = window, int(totals.sum())

    def due(self, times: np.ndarray) -> np.ndarray:
        """Tokens due by each time, per queue of a class."""
        return np.minimum(np.floor(times[:, None] * self.weights + 0.5).astype(np.int64), self.totals)

    def taken(self, windows: np.ndarray, lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each lane in the windows before the one beside it, and those of all lanes ahead of it."""
        own, ahead = np.zeros(len(windows), np.int64), np.zeros(len(windows), np.int64)
        different, at = np.unique(windows, return_inverse=True)
        step = max(1, CELLS // max(1, len(self.totals)))
        for a in range(0, len(different), step):
            mine = np.flatnonzero((at >= a) & (at < a + step))
            own[mine], ahead[mine] = self._taken(different[a : a + step], at[mine] - a, lanes[mine])
        return own, ahead

    def _taken(self, windows: np.ndarray, row: np.ndarray, lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        want = np.minimum(windows * self.window, self.all)
        low = np.zeros(len(want))
        high = np.full(len(want), float((self.totals / np.maximum(self.weights, 1e-300)).max(initial=0.0)) + 1.0)
        # While no queue has run dry, a token more or less per queue is all that is due besides.
        slack = float(self.size.sum()) + 1.0
        for guess in (want - slack, want + slack):
            guess = np.clip(guess, low, high)
            over = self.due(guess) @ self.size > want
            high, low = np.where(over, guess, high), np.where(over, low, guess)
        while True:  # the largest time at which no more are due than wanted
            middle = (low + high) / 2
            if ((middle <= low) | (middle >= high)).all():
                break
            over = self.due(middle) @ self.size > want
            high, low = np.where(over, middle, high), np.where(over, low, middle)
        out = self.due(low)
        after = self.due(high) - out  # tokens due at the same moment: in the order of the lanes
        lacking = (want - out @ self.size)[row]
        kind, place = self.kind[lanes], self.place[lanes]
        earlier = [(np.cumsum(x * self.size, 1) - x * self.size)[row, kind] for x in (out, after)]
        out, after = out[row, kind], after[row, kind]
        room = lacking - earlier[1]
        own = out + np.clip(room - place * after, 0, after)
        ahead = earlier[0] + place * out + np.minimum(lacking, earlier[1]) + np.clip(room, 0, place * after)
        return own, ahead


def pack(
    docs: DataFrame,
    tokenizer: str,
    targets: Mapping[str, float] | None = None,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Cut all documents into pieces that fill sequences of ``window`` tokens with the target mixture.

    ``targets`` maps sources to shares of a window's tokens; without it every source gets its share of
    all tokens, so all queues last to the end. Sources that ``targets`` leaves out come after the others
    are used up. Null sources form a queue. A null or empty text is its end id alone; repeated rows
    are packed each; an empty table gives no rows. Only the last sequence can be short.

    Returns a row per piece: doc_id, queue, start, length, ids (binary), ids_crc32, doc_tokens, sequence_id, offset.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    tokens = scratch.keep(tokenize(docs, tokenizer, doc_id, text, source))
    sizes = tokens.groupBy("part", "queue").agg(F.sum("n").alias("n"))
    named = {r["queue"]: r["n"] for r in tokens.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    wanted = {_NULL if q is None else q: share for q, share in (targets or {}).items()}
    names = sorted(named)
    totals = [named[q] for q in names]
    least = 1e-9 * (sum(wanted.values()) or 1.0)
    schedule = Schedule(totals, [wanted.get(q) or least for q in names] if targets else [float(max(t, 1)) for t in totals], window)

    first = sizes.withColumn("_base", F.sum("n").over(Window.partitionBy("queue").orderBy("part")) - F.col("n")).drop("n")
    placed = tokens.join(first, ["part", "queue"]).withColumn("at", F.col("_base") + F.col("before"))
    lanes = dict(zip(names, schedule.lane.tolist(), strict=True))

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            for a, b in _bounded(batch, "ids", IDS):
                yield cut(batch.slice(a, b - a), schedule, lanes)

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_batches(
        placed.select("doc_id", "queue", "ids", "width", "n", "at"),
        run,
        f"doc_id {kind}, queue string, start bigint, length bigint, ids binary, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint",
    )


def cut(batch: pa.RecordBatch, schedule: Schedule, lanes: dict[str, int]) -> dict:
    """The pieces of some documents, rows of (doc_id, queue, ids, width, n, at)."""
    column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    queues = column["queue"].to_pylist()
    lane = np.array([lanes[q] for q in queues])
    n, at = (column[k].to_numpy() for k in ("n", "at"))
    rows = len(lane)
    last_window = max(-(-schedule.all // schedule.window) - 1, 0)

    def window_of(position: np.ndarray) -> np.ndarray:
        """The window that holds a queue's token at each position."""
        low, high = np.zeros(rows, np.int64), np.full(rows, last_window, np.int64)
        # The share gives a guess; bracket it, then halve.
        guess = (position / np.maximum(schedule.weights[schedule.kind[lane]], 1e-300) / schedule.window).astype(np.float64)
        guess = np.clip(guess, 0, last_window).astype(np.int64)
        for w, is_low in ((np.maximum(guess - 2, 0), True), (np.minimum(guess + 2, last_window), False)):
            taken = schedule.taken(w + (0 if is_low else 1), lane)[0]
            if is_low:
                low = np.where(taken <= position, w, low)
            else:
                high = np.where(taken > position, w, high)
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            taken = schedule.taken(middle, lane)[0]
            low, high = np.where(open_ & (taken <= position), middle, low), np.where(open_ & (taken > position), middle - 1, high)
        return low

    first, last = window_of(at), window_of(at + n - 1)
    held = last - first + 2  # bounds of a document's windows
    row = np.repeat(np.arange(rows), held)
    windows = np.arange(len(row)) - np.repeat(np.cumsum(held) - held, held) + first[row]
    taken, before = schedule.taken(windows, lane[row])
    # A piece lies between two bounds of one row.
    piece = np.flatnonzero(row[1:] == row[:-1])
    row, own, end = row[piece], taken[piece], taken[piece + 1]
    start, stop = np.maximum(own - at[row], 0), np.minimum(end - at[row], n[row])
    offset = before[piece + 1] - before[piece] + start + at[row] - own
    kept = stop > start
    row, start, length, offset, sequence = row[kept], start[kept], (stop - start)[kept], offset[kept], windows[piece][kept]

    # The pieces of a row follow each other, so their ids are those of the rows.
    width = int(column["width"][0].as_py())
    ids = np.frombuffer(b"".join(column["ids"].to_pylist()), f"<u{width}").astype("<u4").tobytes()
    bounds = np.append(0, np.cumsum(4 * length)).tolist()
    view = memoryview(ids)
    crc = np.fromiter((zlib.crc32(view[a:b]) for a, b in zip(bounds, bounds[1:])), np.int64, len(length))
    pieces = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.array(bounds, pa.int32()).buffers()[1], pa.py_buffer(ids)])
    names = pa.array([None if q == _NULL else q for q in queues], pa.string())
    return {
        "doc_id": column["doc_id"].take(pa.array(row)),
        "queue": names.take(pa.array(row)),
        "start": start,
        "length": length,
        "ids": pieces,
        "ids_crc32": crc,
        "doc_tokens": n[row],
        "sequence_id": sequence,
        "offset": offset,
    }
