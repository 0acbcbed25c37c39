"""Language-model scores: the marginal probability of a text over all its segmentations into subwords.

The subword vocabulary exists already; its scores (ranks) give the prior of a unigram model, and the
training documents its weights, by expected counts over the segmentations of all their words.
No subword spans two words, so a text's probability is the product over its words and its end, and
the recursions run once per distinct word instead of once per occurrence, for blocks of words at a time.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm.common import FLUSH, Scratch, ascii_lower, map_batches, most_frequent, task_rows, values

SPACE = "▁"  # the vocabulary's mark of a word's start
END = b""  # no word is empty, so this stands for the end of a text
#: Words whose scores every task holds; the others meet theirs in a join.
HEAD = 100_000
_LN10 = math.log(10.0)


def vocabulary(path: str) -> list[str]:
    """Pieces of a sentencepiece vocabulary, best score first; byte pieces as ``<0x..>``."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return [model.id_to_piece(i) for i in sorted(ids, key=lambda i: (model.is_byte(i), -model.get_score(i), i))]


def prior(size: int) -> np.ndarray:
    """Probabilities falling with the rank as in Zipf's law."""
    p = 1.0 / (np.arange(size) + 2.7)
    return p / p.sum()


class Lattice:
    """The segmentations of words: arcs are pieces, or the bytes of one character.

    Words are handled in blocks as flat arrays: all places of a block walk the trie of pieces together, then
    the recursions go through the words' offsets, one step for all words of the block.
    """

    def __init__(self, pieces: list[str], logs: np.ndarray) -> None:
        self.logs = np.asarray(logs, float)
        self.bytes: dict[int, int] = {}
        # The trie: a sorted key for each pair of a node and a character, the node it leads to, the piece ending there.
        self.ids = np.zeros(sys.maxunicode + 1, np.int64)  # 0: a character of no piece
        children: list[dict[int, int]] = [{}]
        ending = [-1]
        for i, piece in enumerate(pieces):
            if len(piece) == 6 and piece.startswith("<0x"):
                self.bytes[int(piece[3:5], 16)] = i
                continue
            node = 0
            for c in map(ord, piece):
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    ending.append(-1)
                node = children[node][c]
            ending[node] = i
        known = sorted({c for at in children for c in at})
        self.ids[known] = np.arange(1, len(known) + 1)
        self.width = len(known) + 1
        steps = sorted((node * self.width + int(self.ids[c]), child) for node, at in enumerate(children) for c, child in at.items())
        self.keys, self.child = np.array(steps + [(np.iinfo(np.int64).max, 0)], np.int64).T.copy()
        self.ending = np.array(ending)
        self.by_bytes = np.full(sys.maxunicode + 1, np.nan)

    def _spelled(self, char: int) -> list[int]:
        """The byte pieces of a character."""
        return [self.bytes[x] for x in chr(char).encode("utf-8", "surrogatepass")]

    def _arcs(self, words: list[str]) -> _Arcs:
        text = SPACE + SPACE.join(words)  # no word holds white space, and a mark before each is what they get
        flat = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        stop = np.cumsum(sizes)
        word = np.repeat(np.arange(len(words)), sizes)
        offset = np.arange(len(flat)) - np.repeat(stop - sizes, sizes)
        for c in set(flat[np.isnan(self.by_bytes[flat])].tolist()):
            self.by_bytes[c] = sum(self.logs[i] for i in self._spelled(c))
        chars, last = self.ids[flat], stop[word]
        starts, sized, pieces = [np.arange(len(flat))], [np.ones(len(flat), np.int64)], [np.full(len(flat), -1)]
        at, node, size = np.arange(len(flat)), np.zeros(len(flat), np.int64), 0
        while len(at):
            key = node * self.width + chars[at + size]
            found = np.searchsorted(self.keys, key)
            hit = self.keys[found] == key
            at, node, size = at[hit], self.child[found[hit]], size + 1
            piece = self.ending[node]
            ends = piece >= 0
            starts.append(at[ends])
            sized.append(np.full(len(starts[-1]), size))
            pieces.append(piece[ends])
            more = at + size < last[at]
            at, node = at[more], node[more]
        start, size, piece = np.concatenate(starts), np.concatenate(sized), np.concatenate(pieces)
        log = np.where(piece < 0, self.by_bytes[flat[start]], self.logs[piece])
        # A word has one node more than characters.
        tail = start + word[start]
        return _Arcs(flat, start, tail, tail + size, offset[start], offset[start] + size, log, piece, stop + np.arange(len(words)), word)

    def forward(self, words: list[str]) -> np.ndarray:
        """Log probability of each word over all its segmentations."""
        arcs = self._arcs(words)
        return _sums(arcs.tail, arcs.head, arcs.upto, arcs.log, arcs.final, len(words) + len(arcs.flat), forwards=True)[arcs.final]

    def expect(self, words: list[str], weights: np.ndarray, counts: np.ndarray) -> None:
        """Add the expected number of times each piece is used in the words."""
        arcs = self._arcs(words)
        nodes = len(words) + len(arcs.flat)
        alpha = _sums(arcs.tail, arcs.head, arcs.upto, arcs.log, arcs.final, nodes, forwards=True)
        beta = _sums(arcs.head, arcs.tail, arcs.since, arcs.log, arcs.final, nodes, forwards=False)
        word = arcs.word[arcs.start]
        p = weights[word] * np.exp(alpha[arcs.tail] + arcs.log + beta[arcs.head] - alpha[arcs.final][word])
        piece = arcs.piece >= 0
        counts += np.bincount(arcs.piece[piece], p[piece], len(counts))
        chars, which = np.unique(arcs.flat[arcs.start[~piece]], return_inverse=True)
        for char, x in zip(chars.tolist(), np.bincount(which, p[~piece]), strict=True):
            for i in self._spelled(char):
                counts[i] += x


class _Arcs(NamedTuple):
    flat: np.ndarray  # characters of all words, each after a mark
    start: np.ndarray  # of each arc: its first character, the nodes it joins, their offsets in the word
    tail: np.ndarray
    head: np.ndarray
    since: np.ndarray
    upto: np.ndarray
    log: np.ndarray
    piece: np.ndarray  # -1: spelled by bytes
    final: np.ndarray  # last node of each word
    word: np.ndarray  # word of each character


def _sums(
    source: np.ndarray, target: np.ndarray, offset: np.ndarray, log: np.ndarray, final: np.ndarray, nodes: int, forwards: bool
) -> np.ndarray:
    """Log of the summed probabilities of all ways to each node, from the words' beginnings or from their ends.

    ``offset`` is that of each arc's target in its word; targets of one offset are settled in one step.
    """
    order = np.argsort(offset * nodes + target)
    source, target, offset, log = source[order], target[order], offset[order], log[order]
    if not forwards:  # the offset counts from the beginning, so the last comes first
        source, target, offset, log = source[::-1], target[::-1], offset[::-1], log[::-1]
    first = np.flatnonzero(np.diff(target, prepend=-1))
    levels = np.flatnonzero(np.diff(offset[first], prepend=-1))
    out = np.zeros(nodes)
    bounds = [*levels.tolist(), len(first)]
    edges = np.append(first, len(target))
    for a, b in zip(bounds, bounds[1:], strict=False):
        lo, hi = edges[a], edges[b]
        ways = out[source[lo:hi]] + log[lo:hi]
        groups = first[a:b] - lo
        top = np.maximum.reduceat(ways, groups)
        sizes = np.diff(edges[a : b + 1])
        out[target[first[a:b]]] = top + np.log(np.add.reduceat(np.exp(ways - np.repeat(top, sizes)), groups))
    return out


def _blocks(batch: pa.RecordBatch, limit: int = 32_000) -> Iterator[tuple[int, list[str]]]:
    """(first row, words) of a batch in blocks of about ``limit`` bytes; a longer word is a block of its own."""
    held: list[str] = []
    size = begin = 0
    for row, (word,) in enumerate(values(batch, "word")):
        if held and size + len(word) > limit:
            yield begin, held
            held, size, begin = [], 0, row
        held.append(word.decode("utf-8", "surrogatepass"))
        size += len(word) + 1
    if held:
        yield begin, held


def count_words(docs: DataFrame, text: str, train: Column) -> DataFrame:
    """(word, c, total): occurrences in training documents and in all; the end is a word of its own."""

    def run(batches) -> Iterator[dict]:
        both: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> dict:
            held, trained = both
            words = list(held.keys() | trained.keys())
            columns = {
                "word": words,
                "c": [trained.get(w, 0) for w in words],
                "total": [trained.get(w, 0) + held.get(w, 0) for w in words],
            }
            held.clear(), trained.clear()
            return columns

        for batch in batches:
            for body, trains in values(batch, "text", "train"):
                counter = both[bool(trains)]
                counter.update(ascii_lower(body).split())
                counter[END] += 1
                if len(both[0]) + len(both[1]) > FLUSH:
                    yield out()
        yield out()

    rows = docs.select(F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    counted = map_batches(rows, run, "word binary, c bigint, total bigint")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("total").alias("total"))


def expected(words: DataFrame, pieces: list[str], probabilities: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in the training words; as many numbers as pieces reach the driver."""
    logs = np.log(probabilities)

    def run(batches) -> Iterator[dict]:
        lattice, counts = Lattice(pieces, logs), np.zeros(len(pieces))
        for batch in batches:
            weights = batch.column(batch.schema.get_field_index("c")).to_numpy().astype(float)
            for row, held in _blocks(batch):
                lattice.expect(held, weights[row : row + len(held)], counts)
        used = np.flatnonzero(counts)
        yield {"piece": used.astype(np.int32), "x": counts[used]}

    rows = words.where((F.col("c") > 0) & (F.col("word") != F.lit(END))).select("word", "c")
    out = np.zeros(len(pieces))
    for piece, x in map_batches(rows, run, "piece int, x double").groupBy("piece").agg(F.sum("x")).collect():
        out[piece] = x
    return out


def score(
    docs: DataFrame,
    vocabulary_path: str,
    train: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    head: int = HEAD,
) -> DataFrame:
    """A row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    ``train`` marks the documents to learn from (null: not). Words are white-space separated, A-Z
    lowered; a text's tokens are its words and one end. ``base_score`` is the log10 probability under
    add-0.1 word counts, ``score`` that under the subword lattice. Null and empty texts are the end
    alone. Repeated rows get equal rows; null ids stay null; without training documents the counts are
    0 and the lattice has its prior.
    """
    scratch = Scratch(docs.sparkSession, "lmscore")
    words = scratch.keep(count_words(docs, text, train))
    n, v, ends = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)),
        F.count(F.when(F.col("c") > 0, 1)),
        F.coalesce(F.sum(F.when(F.col("word") == F.lit(END), F.col("c"))), F.lit(0)),
    ).first()
    pieces = vocabulary(vocabulary_path)
    before = prior(len(pieces))
    counts = expected(words, pieces, before)
    # As much weight for the prior as a tenth of an occurrence of each piece.
    weights = np.append(counts + 0.1 * len(pieces) * before, ends + 0.1)
    logs = np.log(weights / weights.sum())
    end_log = float(logs[-1]) / _LN10

    def marginals(batches) -> Iterator[dict]:
        lattice = Lattice(pieces, logs[:-1])
        for batch in batches:
            found = np.empty(batch.num_rows)
            for row, held in _blocks(batch):
                logs_of = lattice.forward(held) / _LN10
                found[row : row + len(held)] = np.where([not w for w in held], end_log, logs_of)
            yield {k: batch.column(batch.schema.get_field_index(k)) for k in ("word", "c", "total")} | {"score": found}

    scored = map_batches(words, marginals, "word binary, c bigint, total bigint, score double")
    base = F.log10((F.col("c") + 0.1) / F.lit(n + 0.1 * (v + 1)))
    scored = scratch.keep(scored.withColumn("base", base))
    scratch.drop(words)
    top = most_frequent(scored, "total", "word", head).select("word", "c", "base", "score").collect()
    frequent = {bytes(r[0]): (r[1] > 0, r[2], r[3]) for r in top}
    id_type = docs.schema[doc_id].dataType.simpleString()

    def partial(batches) -> Iterator[dict]:
        rows = task_rows()
        names = ("row", "word", "tf")
        doc_type = None
        for batch in batches:
            doc_type = doc_type or batch.schema.field("_id").type
            out: list[tuple] = []
            sums: list[dict | None] = []

            def made() -> dict:
                columns = dict(zip(names, map(list, zip(*out, strict=True)), strict=True))
                kind = pa.struct([("id", doc_type), ("tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])
                columns["doc"] = pa.array(sums, kind)
                out.clear(), sums.clear()
                return columns

            for key, body in values(batch, "_id", "_text"):
                row, tokens = next(rows), Counter(ascii_lower(body).split())
                tokens[END] = 1
                known, base_sum, score_sum = 0, 0.0, 0.0
                for w, tf in tokens.items():
                    if (found := frequent.get(w)) is not None:
                        known += tf * found[0]
                        base_sum += tf * found[1]
                        score_sum += tf * found[2]
                    else:
                        out.append((row, w, tf))
                        sums.append(None)
                # A row for the document itself, under a word that its counts can't change.
                out.append((row, b"\0%d" % row, 0))
                sums.append({"id": key, "tokens": tokens.total(), "known": known, "base": base_sum, "score": score_sum})
                if len(out) > 100_000:
                    yield made()
            if out:
                yield made()

    parts = map_batches(
        docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")),
        partial,
        f"row bigint, word binary, tf bigint, doc struct<id: {id_type}, tokens: bigint, known: bigint, base: double, score: double>",
    )
    met = parts.join(scored.select("word", "c", "base", "score"), "word", "left")
    each = lambda c: F.coalesce(F.col("tf") * F.col(c), F.lit(0.0))
    return (
        met.groupBy("row")
        .agg(
            F.first("doc", ignorenulls=True).alias("doc"),
            F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("more_known"),
            F.sum(each("base")).alias("more_base"),
            F.sum(each("score")).alias("more_score"),
        )
        .select(
            F.col("doc.id").alias(doc_id),
            F.col("doc.tokens").alias("n_tokens"),
            (F.col("doc.known") + F.col("more_known")).alias("n_known"),
            F.lit(n).cast("bigint").alias("train_tokens"),
            (F.col("doc.base") + F.col("more_base")).alias("base_score"),
            (F.col("doc.score") + F.col("more_score")).alias("score"),
        )
    )
