"""Candidate pairs of the last step of near-duplicates against all pairs of random sets."""

from __future__ import annotations

import random

import pytest

from affinia.llm import minhash
from affinia.llm.common import Scratch


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_prefix_pairs_lose_no_similar_pair(spark, percent):
    draw = random.Random(percent)
    table = []
    for group in range(12):
        base = draw.sample(range(400), draw.randint(2, 40))
        for _ in range(12):  # copies with some elements changed for common or for rare ones
            mine = [x if draw.random() > 0.12 else draw.choice((draw.randrange(400), draw.randrange(10**6))) for x in base]
            table.append((len(table), sorted(set(mine[: len(mine) - draw.randint(0, 1)] or mine)), group if draw.random() < 0.3 else 1000 + len(table)))
    sets = spark.createDataFrame(table, "id bigint, set array<bigint>, component bigint")
    want = {
        (a, b)
        for a, x, p in table
        for b, y, q in table
        if a < b and p != q and 100 * len(set(x) & set(y)) >= percent * len(set(x) | set(y))
    }
    pairs = minhash.prefix_pairs(sets, Scratch(spark, "test"), percent)
    got = {tuple(r) for r in pairs.collect()}
    assert want and want <= got and all(a < b for a, b in got)
    assert {tuple(r) for r in minhash.confirm(pairs, sets, percent).collect()} == want
