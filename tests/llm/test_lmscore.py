"""The subword lattice against an enumeration of all segmentations."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from affinia.llm import lmscore
from affinia.llm.queries import tokenizer_path

PIECES = [f"{lmscore.SPACE}a", "b", "ab", "abc", "c", "é", f"{lmscore.SPACE}", "bcab", *[f"<0x{i:02X}>" for i in range(256)], "ca"]
LOGS = np.log(np.random.default_rng(5).dirichlet(np.ones(len(PIECES))))
WORDS = ["abc", "", "a", "éa", "abcabcab", "𝄞b", "\udc80", "abc", "cabcab", "zzz"]


def segmentations(text):
    """Every way to write the text as pieces, each as the indices of its pieces; a character may be its bytes."""
    if not text:
        return [[]]
    at = {p: i for i, p in enumerate(PIECES)}
    spelled = [at[f"<0x{b:02X}>"] for b in text[0].encode("utf-8", "surrogatepass")]
    heads = [(1, spelled)] + [(n, [at[text[:n]]]) for n in range(1, len(text) + 1) if text[:n] in at]
    return [head + rest for n, head in heads for rest in segmentations(text[n:])]


def ways(word):
    return [(sum(LOGS[i] for i in ids), ids) for ids in segmentations(lmscore.SPACE + word)]


def whole(word):
    return math.log(math.fsum(math.exp(x) for x, _ in ways(word)))


def test_forward_is_the_sum_over_all_segmentations():
    got = lmscore.Lattice(PIECES, LOGS).forward(WORDS)
    assert got == pytest.approx([whole(w) for w in WORDS], rel=1e-12)


def test_expected_uses_are_those_of_all_segmentations():
    counts, weights = np.zeros(len(PIECES)), np.arange(1.0, len(WORDS) + 1)
    lmscore.Lattice(PIECES, LOGS).expect(WORDS, weights, counts)
    want = Counter()
    for word, weight in zip(WORDS, weights, strict=True):
        for log, ids in ways(word):
            for i in ids:
                want[i] += weight * math.exp(log - whole(word))
    assert counts == pytest.approx([want[i] for i in range(len(PIECES))], rel=1e-9, abs=1e-12)


def test_blocks_cover_a_batch_in_order():
    made = [b"", b"x" * 70_000, *[b"ab"] * 40_000, b"last"]
    batch = pa.RecordBatch.from_pydict({"word": pa.array(made, pa.binary())})
    blocks = list(lmscore._blocks(batch))
    assert [w.encode() for _, held in blocks for w in held] == made
    assert [begin for begin, _ in blocks] == [0, *np.cumsum([len(held) for _, held in blocks])[:-1]]


def test_scores_add_up_by_document(spark):
    draw = random.Random(3)
    table = [(i, " ".join(draw.choices(["abc", "Éa", " x", "wort", "the", "𝄞"], k=draw.randint(0, 30)))) for i in range(30)]
    table += [(30, None), (31, ""), (32, "x" * 30_000), (5, table[5][1]), (None, "the end")]
    docs = spark.createDataFrame(table, "doc_id bigint, text string").withColumn("score", F.lit("clash"))
    path = tokenizer_path("piece_bpe_32k.model")
    for head in (2, lmscore.HEAD):  # words met in a join, and all held by the tasks
        got = lmscore.score(docs, path, F.col("doc_id") < 25, head=head).collect()
        by_id = {r["doc_id"]: r for r in got}
        assert len(got) == len(table) and by_id[30]["score"] == by_id[31]["score"]
        end = by_id[31]["score"]
        # The weights from this corpus, found word by word.
        pieces = lmscore.vocabulary(path)
        before = lmscore.prior(len(pieces))
        learned = Counter(w for i, t in table if i is not None and i < 25 for w in lmscore.ascii_lower(t).decode().split(" ") if w)
        counts, first = np.zeros(len(pieces)), lmscore.Lattice(pieces, np.log(before))
        for word, n in learned.items():
            first.expect([word], np.array([float(n)]), counts)
        weights = np.append(counts + 0.1 * len(pieces) * before, sum(i is not None and i < 25 for i, _ in table) + 0.1)
        logs = np.log(weights / weights.sum())
        assert end == pytest.approx(logs[-1] / math.log(10), rel=1e-9)
        lattice = lmscore.Lattice(pieces, logs[:-1])
        for i, text in table:
            words = [w for w in lmscore.ascii_lower(text).decode().split(" ") if w]
            want = math.fsum(lattice.forward([w])[0] for w in words) / math.log(10) + end
            assert by_id[i]["score"] == pytest.approx(want, rel=1e-9)
    assert lmscore.score(docs.limit(0), path, F.lit(True)).count() == 0
