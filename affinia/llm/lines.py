"""Line dedup: a suffix array over line ids by prefix doubling; later copies of repeated runs go.

A position's rank at depth k is the order of its next k lines among all positions'. Ranks at depth 2k
are the dense order of the pairs (rank here, rank k lines further on), so each round is a window over a
document, a distributed sort of distinct pairs and a join. A position whose next k lines occur nowhere
else is settled and leaves the rounds, as nothing that begins there can repeat. Positions of equal
rank at depth L are the suffix array's intervals of longest common prefix L or more: each holds all
copies of a run, of which the earliest stays. A run counts by its lines or by its words in all, so every
depth below ``min_lines`` is judged by its words; longer runs are the unions of runs of ``min_lines``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.llm.common import Scratch, map_batches, mark_members, values
from affinia.operators.ids import id_dictionary

#: A run counts if it has this many lines, or this many words in all.
MIN_LINES, MIN_WORDS = 3, 40


def _split(docs: DataFrame, id_type: str) -> DataFrame:
    """(k1, k2, doc, seq, h1, h2, before, upto): a row per line that is not blank; seq counts these lines.

    before and upto: words of the document ahead of the line, and up to its end.
    """

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("k1", "k2", "doc", "seq", "h1", "h2", "before", "upto")}
            for k1, k2, doc, text in values(batch, "_k1", "_k2", "_id", "_text"):
                lines = [w for w in (x.strip() for x in (text or "").split("\n")) if w]
                upto = 0
                for seq, line in enumerate(lines):
                    raw = line.encode("utf-8", "surrogatepass")
                    digest = np.frombuffer(xxhash.xxh3_128_digest(raw), ">i8")
                    before, upto = upto, upto + len(raw.split())
                    row = (k1, k2, doc, seq, int(digest[0]), int(digest[1]), before, upto)
                    for column, value in zip(out.values(), row, strict=True):
                        column.append(value)
                    if len(out["seq"]) >= 100_000:
                        yield out
                        out = {k: [] for k in out}
            if out["seq"]:
                yield out

    return map_batches(docs, run, f"k1 bigint, k2 bigint, doc {id_type}, seq int, h1 bigint, h2 bigint, before bigint, upto bigint")


def _ranked(positions: DataFrame, pair: tuple[str, str], scratch: Scratch) -> DataFrame:
    """Positions whose pair occurs more than once, with the dense rank of the pair in place of it."""
    groups = scratch.keep(positions.groupBy(*pair).agg(F.count("*").alias("_n")).where("_n > 1").select(*pair))
    ranks = id_dictionary(groups.select(F.struct(*pair).alias("_pair")), "_pair")
    ranks = ranks.select(F.col(f"id.{pair[0]}").alias(pair[0]), F.col(f"id.{pair[1]}").alias(pair[1]), F.col("idx").alias("_rank"))
    kept = [c for c in positions.columns if c not in (*pair, "rank")]
    return scratch.keep(positions.join(ranks, list(pair)).select(*kept, F.col("_rank").alias("rank")))


def _ahead(positions: DataFrame, distance: int) -> DataFrame:
    """Positions with the rank ``distance`` lines further on in their document, where it has one; upto follows."""
    there = Window.partitionBy("k1", "k2").orderBy("seq").rangeBetween(distance, distance)
    ahead = {"_next": F.first("rank").over(there), "upto": F.first("upto").over(there)}
    return positions.withColumns(ahead).where("_next is not null")


def _later(positions: DataFrame, length: int) -> DataFrame:
    """(k1, k2, seq, length) of positions that are not the first of their rank."""
    place = F.struct("doc", "k1", "k2", "seq")
    first = positions.groupBy("rank").agg(F.min(place).alias("_first"))
    met = positions.join(first, "rank").where(~place.eqNullSafe(F.col("_first")))
    return met.select("k1", "k2", "seq", F.lit(length).alias("length"))


def repeated_runs(
    docs: DataFrame, scratch: Scratch, id_type: str, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS
) -> DataFrame:
    """(k1, k2, seq, length): later copies of runs, by document key and place of their first line."""
    # A document that comes in several equal rows counts as one.
    key = ["k1", "k2", "seq"]
    lines = _split(docs, id_type).groupBy(*key).agg(*[F.first(c).alias(c) for c in ("doc", "h1", "h2", "before", "upto")])
    positions, depth = _ranked(scratch.keep(lines), ("h1", "h2"), scratch), 1
    long_enough = F.col("upto") - F.col("before") >= min_words
    found = _later(positions if min_lines <= 1 else positions.where(long_enough), 1)
    while depth < min_lines:
        # Two overlapping runs of this depth make each of the lengths up to twice the depth.
        for length in range(depth + 1, min(2 * depth, min_lines) + 1):
            deeper = _ranked(_ahead(positions, length - depth), ("rank", "_next"), scratch)
            found = found.unionByName(_later(deeper if length == min_lines else deeper.where(long_enough), length))
        positions, depth = deeper, length
    return found


def drop_lines(text: str | None, runs: list[tuple[int, int]]) -> tuple[int, int, str]:
    """Lines that are not blank, how many of them were removed, and the text that stays."""
    lines = (text or "").split("\n")
    shown = [i for i, x in enumerate(lines) if x.strip()]
    gone: set[int] = set()
    for seq, length in runs:
        gone.update(shown[seq : seq + length])
    return len(shown), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text or ""


def _meet_runs(keyed: DataFrame, runs: DataFrame, scratch: Scratch) -> DataFrame:
    """``keyed`` with ``_runs``: null for documents that lose no line, whose texts are not shuffled."""
    met = mark_members(keyed, runs, ("_k1", "_k2"), "_changed", scratch)
    # One plan at every size: the table of runs grows with the input and is never broadcast.
    joined = met.where("_changed").join(runs.hint("merge"), ["_k1", "_k2"], "left")
    untouched = met.where("not _changed").withColumn("_runs", F.lit(None).cast(runs.schema["_runs"].dataType))
    return untouched.unionByName(joined).drop("_changed")


def dedup_lines(
    docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with n_lines, n_removed and kept_text: later copies of repeated line runs are deleted.

    Lines end at U+000A and are compared without white space at their ends; blank lines are in no run
    and stay. A run is ``min_lines`` lines, or any number with ``min_words`` words in all. Its first copy, by doc_id
    (null first) and line, stays unless it overlaps a later copy of some other run. Null and empty texts
    have no lines and an empty kept_text. Rows of equal doc_id and text are one document and fare alike. An
    empty table gives no rows. Columns of ``docs`` with the new names are replaced.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    keys = {
        "_k1": F.xxhash64(F.lit(1), F.col(doc_id), F.col(text)),
        "_k2": F.xxhash64(F.lit(2), F.col(doc_id), F.length(text), F.reverse(F.col(text))),
    }
    keyed = docs.withColumns(keys)
    rows = keyed.select("_k1", "_k2", F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    runs = repeated_runs(rows, scratch, docs.schema[doc_id].dataType.simpleString(), min_lines, min_words)
    runs = runs.groupBy(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).agg(
        F.collect_set(F.struct("seq", "length")).alias("_runs")
    )
    runs = scratch.keep(runs)

    @F.pandas_udf("struct<n_lines: bigint, n_removed: bigint, kept_text: string>")
    def dropped(texts, found):
        import pandas as pd

        made = [
            drop_lines(t, [] if r is None else [(x["seq"], x["length"]) for x in r])
            for t, r in zip(texts, found, strict=True)
        ]
        return pd.DataFrame(made, columns=["n_lines", "n_removed", "kept_text"])

    met = _meet_runs(keyed, runs, scratch).withColumn("_kept", dropped(F.col(text), F.col("_runs")))
    new = {c: F.col(f"_kept.{c}") for c in ("n_lines", "n_removed", "kept_text")}
    return met.withColumns(new).drop("_k1", "_k2", "_runs", "_kept")
