"""Shared pieces of the operators: words, hashes of word runs, scratch tables, count thresholds.

Words are the runs of characters other than space and U+0009 to U+000D, which is what
``bytes.split()`` cuts UTF-8 text into; no word is changed unless an operator says so.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from affinia.session import scratch_path

#: Rows of a counter or buffers that a task holds before it hands them on.
FLUSH = 400_000


def split_words(text: str | None) -> list[bytes]:
    """The words of a text; none for null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def ascii_lower(text: str | None) -> bytes:
    """UTF-8 with A-Z lowered and every other character as it is; empty for null."""
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % parts


class WordHashes(dict):
    """64-bit hashes of words, remembered for up to ``limit`` of them."""

    def __init__(self, limit: int = 600_000) -> None:
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


# Odd multipliers of the two independent polynomial hashes over word hashes.
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values, so that every bit depends on all."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def run_hashes(words: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of every run of ``length`` consecutive words (none if there are fewer)."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base = _BASES[which]
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        if length <= 8:
            for k in range(length):
                out = out * base + words[k : k + n]
            return mix(out)
        # Horner's rule by doubling: a run of 2m words from two runs of m.
        powers, runs, m, p = {}, {}, 1, base
        runs[1], powers[1] = words, p
        while 2 * m <= length:
            a = runs[m]
            runs[2 * m] = a[: len(a) - m] * powers[m] + a[m:]
            powers[2 * m] = powers[m] * powers[m]
            m *= 2
        at = 0
        for m in sorted(runs, reverse=True):
            if length & m:
                out = out * powers[m] + runs[m][at : at + n]
                at += m
        return mix(out)


def task_rows() -> Iterator[int]:
    """Row numbers that no other task of the job uses."""
    context = TaskContext.get()
    start = (context.partitionId() if context else 0) << 33
    while True:
        yield start
        start += 1


_held: dict = {}


def held(key, make: Callable):
    """What ``make`` gives, kept by a worker process for later tasks that ask for the same key; it keeps one such object."""
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """Forget what this worker process keeps for another operator, and give unused memory back."""
    _held.clear()
    pa.default_memory_pool().release_unused()


def map_batches(
    df: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str, keeps: bool = False
) -> DataFrame:
    """``mapInArrow`` for functions that yield columns as a dict of lists or arrays; ``keeps``: they ask for what is ``held``."""
    wanted = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            let_go()
        for columns in make(batches):
            arrays = [
                columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
                for f in wanted
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=wanted)

    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema))


def values(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Rows of a batch, made one at a time so that long texts are not all copied at once."""
    columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in columns)


class Scratch:
    """Tables below one fresh folder of the shared directory, each written once and read back."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.base, self.made = spark, scratch_path(spark, name), 0

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` written as a table: later reads survive lost executors and do not recompute it."""
        self.made += 1
        path = f"{self.base}/{self.made}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out

    def drop(self, df: DataFrame | None) -> None:
        """Remove a table that no later plan reads."""
        path = getattr(df, "_scratch", None)
        if path:
            jvm = self.spark._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


#: Most rows of a filter that is broadcast, 64 bits each.
FILTER_WORDS = 1 << 20


def mark_members(df: DataFrame, members: DataFrame, keys: tuple[str, str], name: str, scratch: Scratch) -> DataFrame:
    """``df`` with the boolean ``name``: true where the keys, two hashes, are those of a member, and for a few others.

    A blocked Bloom filter (three bits in one word of 64, about 16 bits a member up to ``FILTER_WORDS``
    words) tells most of the others apart in the scan. A fuller filter only marks more rows.
    """
    words = min(FILTER_WORDS, max(64, members.count() // 4))
    word = F.pmod(keys[0], F.lit(words))
    mask = F.expr(" | ".join(f"shiftleft(1L, cast(pmod(shiftright({keys[1]}, {shift}), 64) as int))" for shift in (0, 6, 12)))
    marked = scratch.keep(members.groupBy(word.alias("_word")).agg(F.bit_or(mask).alias("_bits")))
    met = df.withColumn("_word", word).join(F.broadcast(marked), "_word", "left")
    return met.withColumn(name, F.coalesce(F.col("_bits").bitwiseAND(mask) == mask, F.lit(False))).drop("_word", "_bits")


def most_frequent(df: DataFrame, n: str, key: str, limit: int, group: str | None = None) -> DataFrame:
    """About ``limit`` rows of each group with the largest ``n``, found without sorting a group in one task.

    The cut comes from the histogram of ``n``; of the rows on the cut itself a hashed share
    is taken, so the bound holds for any distribution (within 10 % and 64 rows).
    """
    from pyspark.sql import Window

    by = [group] if group else []
    sizes = df.groupBy(*by, n).agg(F.count("*").alias("_rows"))
    above = F.sum("_rows").over(Window.partitionBy(*by).orderBy(F.col(n).desc()))
    cut = sizes.withColumn("_upto", above).withColumn("_free", F.lit(limit) - (F.col("_upto") - F.col("_rows")))
    cut = cut.where("_free > 0").select(*by, n, F.least(F.lit(1.0), F.col("_free") / F.col("_rows")).alias("_share"))
    return (
        df.join(cut, [*by, n])
        .where(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < F.col("_share") * (1 << 20))
        .drop("_share")
    )
