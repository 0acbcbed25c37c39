"""Language ID by known words, with a fall-back to ever shorter character n-grams."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.llm.common import FLUSH, let_go, map_batches, values

UNDETERMINED = "und"
LONGEST_GRAM = 5
#: The classifier is fitted on at most so many labelled documents, and on about so many characters, of all
#: languages together; the model, which is broadcast, is bounded by the characters.
DOCUMENTS, CHARACTERS = 4_000, 12_000_000
#: Words of the texts whose scores a task remembers.
REMEMBERED = 100_000


def bare(word: str) -> str:
    """The word without characters at its ends that are no letters; empty if it has no letter."""
    a, b = 0, len(word)
    while a < b and not word[a].isalpha():
        a += 1
    while b > a and not word[b - 1].isalpha():
        b -= 1
    return word[a:b]


def _count(batches) -> Iterator[dict]:
    counts: dict[str, Counter] = {}

    def out() -> dict:
        merged: dict[tuple[str, str], int] = {}
        for lang, words in counts.items():
            for w, n in words.items():
                if key := bare(w):
                    merged[lang, key] = merged.get((lang, key), 0) + n
        counts.clear()
        return {"lang": [k[0] for k in merged], "word": [k[1] for k in merged], "n": list(merged.values())}

    for batch in batches:
        for text, lang in values(batch, "text", "lang"):
            counts.setdefault(lang, Counter()).update(text.lower().split())
            if sum(map(len, counts.values())) > FLUSH:
                yield out()
    yield out()


def grams(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


class Model:
    """Log frequencies per language of words and character n-grams."""

    def __init__(self, rows: list[tuple[str, str, int]], totals: dict[str, tuple[int, int]]) -> None:
        """rows: (lang, word, n); totals: per language the words counted and the distinct ones."""
        self.langs = sorted(totals)
        at = {lang: i for i, lang in enumerate(self.langs)}
        size = len(self.langs)
        words: dict[str, list] = {}
        pieces: list[dict[str, list]] = [{} for _ in range(LONGEST_GRAM + 1)]
        for lang, word, n in rows:
            i = at[lang]
            words.setdefault(word, [0] * size)[i] += n
            for k, held in enumerate(pieces[1:], 1):
                for g in grams(word, k):
                    if (counts := held.get(g)) is None:
                        if g.isspace():
                            continue
                        counts = held[g] = [0] * size
                    counts[i] += n
        all_words = np.array([totals[lang][0] for lang in self.langs], float)
        kinds = np.array([totals[lang][1] for lang in self.langs], float)
        self.words = self._log(words, all_words, kinds)
        self.grams = [self._log(p, None, None) for p in pieces]

    @staticmethod
    def _log(table: dict[str, list], totals, kinds) -> tuple[dict[str, int], np.ndarray]:
        if not table:
            return {}, np.empty((0, 0))
        counts = np.array(list(table.values()), float)
        totals = counts.sum(0) if totals is None else totals
        kinds = float(len(table)) if kinds is None else kinds
        return {k: i for i, k in enumerate(table)}, np.log((counts + 0.5) / (totals + 0.5 * (kinds + 1)))

    def word(self, word: str) -> np.ndarray:
        """Log score of one word per language; zeros if even its letters are unknown."""
        index, logs = self.words
        if (i := index.get(word)) is not None:
            return logs[i]
        for k in range(LONGEST_GRAM, 0, -1):
            index, logs = self.grams[k]
            if known := [index[g] for g in grams(word, k) if g in index]:
                return np.add.reduce(logs[known]) / len(known)
        return np.zeros(len(self.langs))

    def predict(self, text: str | None, memory: Memory) -> tuple[str, float]:
        counts = Counter((text or "").lower().split())
        if len(memory) > REMEMBERED:
            memory.clear()
        at = np.fromiter(map(memory.__getitem__, counts), np.int64, len(counts))
        if not self.langs or not at.any():
            return UNDETERMINED, 0.0
        total = np.fromiter(counts.values(), float, len(counts)) @ memory.scores[at]
        best = int(total.argmax())
        return self.langs[best], float(1.0 / np.exp(total - total[best]).sum())


class Memory(dict):
    """Rows of ``scores`` of the words met so far; row 0 is for words without a letter."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model, self.scores, self.used = model, np.zeros((1024, len(model.langs))), 1

    def clear(self) -> None:
        super().clear()
        self.used = 1

    def __missing__(self, word: str) -> int:
        key = bare(word)
        if not key:
            self[word] = 0
            return 0
        if self.used == len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        self.scores[self.used] = self.model.word(key)
        self[word] = self.used
        self.used += 1
        return self.used - 1


def sample(labelled: DataFrame, documents: int, characters: int, doc_id: str = "doc_id") -> DataFrame:
    """(text, lang): whole labelled texts to learn from, the same number of each language if there are enough.

    A language has its equal part of ``documents`` and of ``characters``. Its documents enter in the order of a
    hash of their ids as long as those before them hold fewer characters than that, so at least one does.
    """
    rows = labelled.where("lang is not null").select(F.col("text"), F.col("lang"), F.xxhash64(doc_id).alias("_at"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return rows.select("text", "lang").limit(0)
    each, room = -(-documents // len(sizes)), characters // len(sizes)
    # Hashes below this bound hold enough rows: only these few are numbered.
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, (1.5 * each + 100) / n)))])
    low = (F.col("_at").cast("double") / 2.0**64 + 0.5) <= F.try_element_at(share, F.col("lang"))
    order = Window.partitionBy("lang").orderBy("_at", F.xxhash64("text"))
    before = F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    few = rows.where("text is not null").where(low)
    few = few.withColumns({"_row": F.row_number().over(order), "_before": F.coalesce(before, F.lit(0))})
    return few.where((F.col("_row") <= each) & (F.col("_before") < room)).select("text", "lang")


def train(
    labelled: DataFrame, documents: int = DOCUMENTS, characters: int = CHARACTERS, doc_id: str = "doc_id"
) -> Model:
    """Learn all words and n-grams of a bounded sample of the rows of ``labelled`` (doc_id, text, lang).

    Rows without text or language teach nothing; an empty table gives a model that tells nothing.
    """
    rows = sample(labelled, documents, characters, doc_id)
    counted = map_batches(rows, _count, "lang string, word string, n bigint")
    counted = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    kept = sorted((tuple(r) for r in counted.collect()), key=lambda r: (r[0], -r[2], r[1]))  # bounded by the sample
    totals: dict[str, tuple[int, int]] = {}
    for lang, _, n in kept:
        words, kinds = totals.get(lang, (0, 0))
        totals[lang] = words + n, kinds + 1
    return Model(kept, totals)


def identify(docs: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its posterior (0 to 1); only the text is read.

    Null texts and texts without a letter get ``und`` and 0, and so does everything under a model
    that has learned from nothing. Ties go to the language first in order. Columns of ``docs`` named
    like the new ones are replaced.
    """
    # Spark broadcasts the function with the model in it. A batch holds thousands of texts: each becomes a string
    # of Python's on its own, when it is scored.

    @F.arrow_udf("struct<lang: string, score: double>")
    def predicted(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        let_go()
        memory = Memory(model)
        for texts in parts:
            told = [model.predict(t.as_py(), memory) for t in texts]
            columns = [pa.array([t[i] for t in told], kind) for i, kind in enumerate((pa.string(), pa.float64()))]
            yield pa.StructArray.from_arrays(columns, ["lang", "score"])

    made = docs.withColumn("_langid", predicted(F.col(text)))
    return made.withColumn(pred, F.col("_langid.lang")).withColumn(score, F.col("_langid.score")).drop("_langid")
