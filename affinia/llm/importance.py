"""Importance resampling towards a target: hashed word n-grams, bucket gains, and a seeded draw of the best scores.

Texts are cut by an untrained Regex Split of tokenizers, which returns words with their offsets; windows over
neighbouring offset pairs are the features. A feature counts in the bucket its CRC names, so the statistics of both
sides are histograms of a fixed number of buckets, whatever the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm.common import Scratch, ascii_lower, map_batches, values

#: Fixed values of the contract: what a word is, buckets of the histograms, words a drawn document needs.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
MIN_WORDS = 20
#: Features of a task that are handed on at once.
HELD = 1 << 20


def splitter():
    """The pre-tokenizer that keeps what ``WORD`` matches."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


def words(text: str | None, split) -> list[tuple[str, tuple[int, int]]]:
    """Words of the text with A-Z lowered, and their offsets in code points; none for null."""
    lowered = ascii_lower(text).decode("utf-8", "replace")
    return split.pre_tokenize_str(lowered) if lowered else []


def features(found: list[tuple[str, tuple[int, int]]], text: str, longest: int = 2) -> Iterator[str]:
    """Runs of 1 to ``longest`` neighbouring words, cut from the lowered text by their offsets, joined by one space."""
    cut = [text[a:b] for _, (a, b) in found]
    for n in range(1, longest + 1):
        for i in range(len(cut) - n + 1):
            yield " ".join(cut[i : i + n])


def bucket_ids(found: list[tuple[str, tuple[int, int]]], buckets: int, longest: int) -> np.ndarray:
    """Buckets of all features: the CRC of a run goes on from that of the run without its last word."""
    ends = [word.encode() for word, _ in found]
    joined = [b" " + e for e in ends]
    runs = list(map(crc32, ends))
    kept = [runs]
    for n in range(1, longest):
        runs = list(map(crc32, joined[n:], runs))
        kept.append(runs)
    return np.concatenate([np.array(r, np.uint32) for r in kept]) % np.uint32(buckets)


def hashed(df: DataFrame, text: str, buckets: int, longest: int, scratch: Scratch, keep: list[Column]) -> DataFrame:
    """The ``keep`` columns with n_words and hashes (packed bucket numbers of all features), stored."""
    rows = df.select(*keep, F.col(text).alias("_text"))
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema if f.name != "_text")
    names = [f.name for f in rows.schema if f.name != "_text"]

    def run(batches) -> Iterator[dict]:
        split = splitter()
        for batch in batches:
            at, held, n_words, packed = 0, 0, [], []

            def out(upto: int) -> dict:
                own = {c: batch.column(batch.schema.get_field_index(c)).slice(at, upto - at) for c in names}
                return {**own, "n_words": n_words, "hashes": packed}

            for row, (value,) in enumerate(values(batch, "_text"), 1):
                found = words(value, split)
                ids = bucket_ids(found, buckets, longest).astype("<u4" if buckets > 1 << 16 else "<u2")
                n_words.append(len(found))
                packed.append(ids.tobytes())
                held += len(ids)
                if held >= HELD:
                    yield out(row)
                    at, held, n_words, packed = row, 0, [], []
            yield out(batch.num_rows)

    return scratch.keep(map_batches(rows, run, f"{schema}n_words long, hashes binary"))


def histogram(stored: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall in each bucket; one row per bucket and task is shuffled, one per bucket collected."""
    width = "<u4" if buckets > 1 << 16 else "<u2"

    def run(batches) -> Iterator[dict]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for (raw,) in values(batch, "hashes"):
                sums += np.bincount(np.frombuffer(raw, width), minlength=buckets)
        at = np.flatnonzero(sums)
        yield {"bucket": at.astype(np.int32), "total": sums[at]}

    parts = map_batches(stored.select("hashes"), run, "bucket int, total long")
    out = np.zeros(buckets, np.int64)
    for bucket, total in parts.groupBy("bucket").agg(F.sum("total")).collect():
        out[bucket] = total
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed share in the target over that in the source), per bucket."""
    top = (target + 1.0) * (source.sum() + float(len(source)))
    return np.floor(1000 * np.log(top / ((source + 1.0) * (target.sum() + float(len(target)))))).astype(np.int64)


def weigh(stored: DataFrame, gain: np.ndarray) -> DataFrame:
    """The stored rows with n_features and weight, the floored mean gain of their features (0 without any)."""
    width = "<u4" if len(gain) > 1 << 16 else "<u2"
    names = [c for c in stored.columns if c != "hashes"]
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in stored.schema if f.name != "hashes")

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            n, weight = [], []
            for (raw,) in values(batch, "hashes"):
                ids = np.frombuffer(raw, width)
                n.append(len(ids))
                weight.append(int(gain[ids].sum()) // len(ids) if len(ids) else 0)
            own = {c: batch.column(batch.schema.get_field_index(c)) for c in names}
            yield {**own, "n_features": pa.array(n, pa.int64()), "weight": pa.array(weight, pa.int64())}

    return map_batches(stored, run, f"{schema}n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 * a Gumbel variable) that the seed and the id determine; null for a null id."""
    text = F.concat(F.lit(f"{seed}:"), doc_id.cast("string"))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def numbered(df: DataFrame, order: list[Column], scratch: Scratch, name: str) -> DataFrame:
    """``df`` with its place (from 1) in a total order, sorted in parallel.

    Rows are range-partitioned, sorted and stored; the number of a row is its place in its partition plus the rows
    of the partitions before. Only the counts, one row per partition, pass through a window.
    """
    from pyspark.sql import Window

    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie")
    rows = rows.withColumn("_at", F.monotonically_increasing_id()).drop("_tie")
    rows = scratch.keep(rows.withColumn("_part", F.shiftright("_at", 33)))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = starts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return rows.join(F.broadcast(starts), "_part").withColumn(name, place).drop("_part", "_at", "_before")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = MIN_WORDS, seed: int = 7,
    longest: int = 2, buckets: int = BUCKETS, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn) of every document.

    ``weight`` is the floored mean, over a document's runs of 1 to ``longest`` words, of the gains of their buckets;
    ``score`` adds Gumbel noise from the seed and the id, so the highest scores are a draw without replacement in
    proportion to the weights. Of the documents with ``min_words`` words and an id, floor(percent / 100 of them) are
    drawn, best first, ties to the smaller id.

    Texts are read whole. Null and empty texts have no features and weight 0. A row without an id has no score and
    is never drawn nor counted. Repeated rows count as often as they stand there; those that tie in score and id
    are ranked one after the other. Empty tables are allowed on both sides: without target texts all target counts
    are 0, without documents there are no rows. Other columns are ignored, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "importance")
    aimed = hashed(target, target_text, buckets, longest, scratch, [])
    stored = hashed(docs, text, buckets, longest, scratch, [F.col(doc_id).alias("_id")])
    gain = gains(histogram(stored, buckets), histogram(aimed, buckets))
    weighed = weigh(stored, gain).withColumn("score", F.col("weight") + noise(F.col("_id"), seed))
    can = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    order = [F.col("_can").desc(), F.col("score").desc(), F.col("_id")]
    ranked = numbered(weighed.withColumn("_can", can), order, scratch, "_place")
    drawn = F.col("_can") & (F.col("_place") <= percent * ranked.where("_can").count() // 100)
    return ranked.select(
        F.col("_id").alias(doc_id), "n_features", "weight", "score", F.when(drawn, F.col("_place")).alias("rank")
    )
