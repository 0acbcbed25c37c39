"""Mixing sources to target weights: a rate for each document, so that domains get their shares.

A classifier learned from a table of labels gives every document its membership in each domain. The
rates r >= 0 minimise the squared difference between the domains' expected tokens (the sum over
documents of rate * tokens * membership) and their targets, by projected gradient from r = 1.

The gradient of a document's rate is a combination of its memberships by one vector of residuals. So a
document's rate follows from its memberships and the few vectors of the rounds so far: tasks replay
them, sum their part, and only a total per domain travels; no rate is stored or shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm.common import Scratch, ascii_lower, let_go, map_batches, values

#: Labelled documents the classifier is fitted on, those of smallest id hash; bounds what reaches the driver.
SAMPLE = 4_000
FEATURE_BITS = 14
EPOCHS, RATE, DECAY = 200, 0.05, 1e-4
ROUNDS, ENOUGH = 200, 1e-4


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of the whole text (A-Z lowered), log counts scaled to length one."""
    return counted(ascii_lower(text).split())


def counted(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The features of a text with these words, lowered."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    found, n = np.unique((hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int64), return_counts=True)
    x = np.log1p(n)
    return found, x / max(np.sqrt((x * x).sum()), 1e-12)


class Classifier:
    """Multinomial logistic regression on hashed words."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray) -> None:
        self.weights, self.bias = weights, bias

    def posteriors(self, text: str | None) -> np.ndarray:
        return self.of(features(text))

    def of(self, features: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        at, x = features
        z = x @ self.weights[at] + self.bias
        p = np.exp(z - z.max())
        return p / p.sum()

    @classmethod
    def fit(cls, rows: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, domains: int) -> Classifier:
        """Adam over all rows at once; classes without rows keep their smoothed share as bias."""
        share = (np.bincount(labels, minlength=domains) + 1.0) / (len(labels) + domains)
        w, b = np.zeros((1 << FEATURE_BITS, domains)), np.log(share)
        if not len(labels):
            return cls(w, b)
        at = np.concatenate([r[0] for r in rows]).astype(np.int64)
        x = np.concatenate([r[1] for r in rows])
        row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        want = np.eye(domains)[labels]
        m, v = np.zeros(w.shape), np.zeros(w.shape)
        for k in range(1, EPOCHS + 1):
            z = np.stack([np.bincount(row, x * w[at, d], len(rows)) for d in range(domains)], 1) + b
            p = np.exp(z - z.max(1, keepdims=True))
            gap = (p / p.sum(1, keepdims=True) - want) / len(rows)
            g = np.stack([np.bincount(at, x * gap[row, d], len(w)) for d in range(domains)], 1) + DECAY * w / len(rows)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
            b -= gap.sum(0)
        return cls(w, b)


def train(docs: DataFrame, labels: DataFrame, domain: Column, domains: Sequence[str], sample: int = SAMPLE) -> Classifier:
    """Fit on at most ``sample`` labelled documents; ``domain`` names the domain of a row of ``labels``.

    Rows of ``labels`` with a null id or a domain not in ``domains`` are left out; of an id with
    several labels the smallest counts. Without labelled rows all domains are equally likely.
    """
    named = labels.select(F.col("doc_id").alias("_id"), domain.alias("_domain")).where(F.col("_domain").isin(list(domains)))
    named = named.groupBy("_id").agg(F.min("_domain").alias("_domain"))
    chosen = named.where("_id is not null").orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).join(chosen, "_id")

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            for key, name, text in values(batch, "_id", "_domain", "_text"):
                at, x = features(text)
                yield {"id": [str(key)], "domain": [name], "at": [at.astype(np.int32)], "x": [x.astype(np.float32)]}

    # Of an id that many rows have, one text is enough.
    texts = texts.groupBy("_id", "_domain").agg(F.min("_text").alias("_text"))
    found = sorted(map_batches(texts, run, "id string, domain string, at array<int>, x array<float>").collect(), key=lambda r: r[0])
    rows = [(np.array(r[2], np.int64), np.array(r[3], float)) for r in found]
    return Classifier.fit(rows, np.array([list(domains).index(r[1]) for r in found], np.int64), len(domains))


def rates_of(p: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The rates after the rounds whose vectors are given: r = max(0, r - p . step) from r = 1."""
    r = np.ones(len(p))
    for s in steps:
        r = np.maximum(0.0, r - p @ s)
    return r


def fit_rates(members: DataFrame, targets: Sequence[float]) -> np.ndarray:
    """The vectors of the rounds, for (tokens, p); what comes back from a round is a number per domain.

    The residual of a domain counts relative to its tokens at rate 1, and a document's step to its own
    tokens; then the curvature is at most 1, so a step of 1 never overshoots.
    """
    d = len(targets)

    def totals(steps: np.ndarray) -> np.ndarray:
        def run(batches) -> Iterator[dict]:
            for batch in batches:
                p = batch.column(1).flatten().to_numpy().reshape(-1, d)
                n = batch.column(0).to_numpy().astype(float)
                yield {"x": [(n * rates_of(p, steps)) @ p]}

        parts = map_batches(members.select("tokens", "p"), run, "x array<double>")
        sums = parts.agg(*[F.coalesce(F.sum(F.col("x")[i]), F.lit(0.0)) for i in range(d)])
        return np.array(sums.first(), float)

    steps = np.zeros((0, d))
    base = totals(steps)
    whole = base.sum()
    if not whole:
        return steps
    scale = np.maximum(base, 1e-9 * whole)
    want = np.array(targets, float) / sum(targets) * whole
    now = base
    for _ in range(ROUNDS):
        if np.abs(now - want).max() <= ENOUGH * whole:
            break
        steps = np.vstack([steps, (now - want) / scale])
        before, now = now, totals(steps)
        if np.abs(now - before).max() <= 0.01 * ENOUGH * whole:
            break  # the targets can't be met; this is the least-squares rate
    return steps


def reader(model: Classifier, domains: int):
    """Tokens and posteriors of a text, by one function: a second one would take a worker of its own.

    Spark broadcasts the function with the model in it: domains * 2^14 numbers. Of a batch, one text at a time
    becomes an object of Python's, and its words are cut once.
    """

    @F.arrow_udf("struct<tokens: bigint, posteriors: array<double>>")
    def read(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        let_go()
        for texts in parts:
            tokens, p = np.zeros(len(texts), np.int64), np.zeros((len(texts), domains))
            for i, t in enumerate(texts.cast(pa.binary())):
                words = (t.as_py() or b"").lower().split()
                tokens[i], p[i] = len(words), model.of(counted(words))
            bounds = pa.array(np.arange(len(texts) + 1) * domains, pa.int32())
            columns = [pa.array(tokens), pa.ListArray.from_arrays(bounds, pa.array(p.ravel()))]
            yield pa.StructArray.from_arrays(columns, ["tokens", "posteriors"])

    return read.asNondeterministic()  # so that a filter on what it gives does not run it a second time


def rater(steps: np.ndarray):
    """The rate of a document after the rounds, from its posteriors."""

    @F.arrow_udf("double")
    def rate(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        let_go()
        for p in parts:
            yield pa.array(rates_of(p.flatten().to_numpy().reshape(-1, steps.shape[1]), steps))

    return rate.asNondeterministic()


def mix(
    docs: DataFrame,
    model: Classifier,
    targets: Mapping[str, float],
    text: str = "text",
) -> DataFrame:
    """``docs`` with tokens, posteriors (array in the order of ``targets``), rate and copies.

    Tokens are white-space separated words; the total of the expected tokens stays what it is.
    ``copies`` is the rate rounded up or down so that its expectation over documents is the rate: a hash
    of the text decides, hence repeated rows fare alike. Null and empty texts have no
    tokens and no say, but get a rate. An empty table gives no rows. Columns with the new names are replaced.

    The documents are stored once with what was read from them, so no text is read a second time for its rate.
    """
    scratch = Scratch(docs.sparkSession, "mixing")

    fresh = docs.drop("tokens", "posteriors", "rate", "copies")
    unit = F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.lit(1 << 40)) / float(1 << 40)
    made = fresh.withColumn("_read", reader(model, len(targets))(F.col(text)))
    made = made.withColumns({"tokens": F.col("_read.tokens"), "posteriors": F.col("_read.posteriors"), "_unit": unit})
    made = scratch.keep(made.drop("_read"))
    steps = fit_rates(made.select("tokens", F.col("posteriors").alias("p")).where("tokens > 0"), list(targets.values()))
    out = made.withColumn("rate", rater(steps)(F.col("posteriors")))
    return out.withColumn("copies", F.floor(F.col("rate") + F.col("_unit")).cast("bigint")).drop("_unit")
