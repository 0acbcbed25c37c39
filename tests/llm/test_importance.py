"""Importance resampling against brute force."""

from __future__ import annotations

import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from affinia.llm import importance

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
OUT = ["doc_id", "n_features", "weight", "score", "rank"]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def features(text):
    w = words(text)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def brute(docs, target, percent=25, min_words=20, buckets=10_000, seed=7):
    def tally(texts):
        counts = Counter(crc32(f.encode()) % buckets for t in texts for f in features(t))
        return counts, sum(counts.values())

    (s, ns), (t, nt) = tally(d[1] for d in docs), tally(target)
    rows = []
    for key, text in docs:
        gain = [
            math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets))))
            for b in (crc32(f.encode()) % buckets for f in features(text))
        ]
        weight = sum(gain) // len(gain) if gain else 0
        score = None
        if key is not None:
            h = int(sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(gain), weight, score, None, len(words(text))])
    can = sorted((r for r in rows if r[5] >= min_words and r[0] is not None), key=lambda r: (-r[3], r[0]))
    for place, row in enumerate(can[: percent * len(can) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


def frames(spark, docs, target):
    wide = [(k, t, 1, "x", 2, 3.0) for k, t in docs]
    schema = "doc_id bigint, text string, rank int, score string, _id int, n_words double"
    return spark.createDataFrame(wide, schema).repartition(3), spark.createDataFrame([(t,) for t in target], "text string")


def compare(spark, docs, target, **options):
    got = importance.resample(*frames(spark, docs, target), **options)
    assert got.columns == OUT
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, target, **options)


def texts(n, seed=1):
    rng = np.random.default_rng(seed)
    vocabulary = ["Der", "hund", "läuft", "the", "DOG", "3", "x-ray", "中文", "a.b", "END", "~"]
    return [" ".join(rng.choice(vocabulary, rng.integers(0, 60))) for _ in range(n)]


def test_against_brute_force(spark):
    docs = list(enumerate(texts(200)))
    docs += [(300, None), (301, ""), (302, "   \x00\t.,;"), (None, "a b " * 20), (303, "word " * 40_000), (304, "z" * 50_000)]
    docs += [(5, docs[5][1])] * 3 + [(6, docs[7][1])]  # repeated rows, and an id with two texts
    compare(spark, docs, [*texts(20, 2), None, ""])
    compare(spark, docs, texts(5, 3), percent=100, min_words=1, buckets=97, seed=8)
    compare(spark, docs, texts(5, 3), buckets=70_000)


def test_empty_tables(spark):
    docs = list(enumerate(texts(30)))
    compare(spark, docs, [])
    compare(spark, [], texts(3))
    compare(spark, [(1, None), (2, "")], [None])


def test_draw_follows_the_target(spark):
    near, far = "ship sails over the wide sea " * 5, "stock market prices fall again today " * 5
    docs = [(i, near if i % 2 else far) for i in range(400)]
    got = importance.resample(*frames(spark, docs, [near] * 40))
    drawn = [r["doc_id"] % 2 for r in got.where("rank is not null").collect()]
    assert len(drawn) == 100 and sum(drawn) >= 90


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_words_are_those_of_the_contract(text):
    found = importance.words(text, importance.splitter())
    lowered = text.translate(LOWER)
    assert [w for w, _ in found] == words(text)
    assert [lowered[a:b] for _, (a, b) in found] == words(text)
    assert list(importance.features(found, lowered)) == features(text)
    want = [crc32(f.encode()) % 10_000 for f in features(text)]
    assert sorted(importance.bucket_ids(found, 10_000, 2).tolist()) == sorted(want)


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_longer_runs(longest):
    text = "one two three four five"
    found = importance.words(text, importance.splitter())
    want = [crc32(f.encode()) % 1000 for f in importance.features(found, text, longest)]
    assert importance.bucket_ids(found, 1000, longest).tolist() == want
    assert len(want) == sum(5 - n + 1 for n in range(1, longest + 1))
