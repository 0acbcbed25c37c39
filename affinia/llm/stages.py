"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.llm import langid, lines, minhash, mixing, packing
from affinia.llm.common import fold
from affinia.llm.queries import DOMAIN, MIXTURE, read, tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told (no letters, or null text); the others stay as they are."""
    model = langid.train(docs.where(fold("doc_id", 5) != 0))
    found = langid.identify(docs, model, pred="_pred", score="_score")
    return found.where(F.col("_pred") != langid.UNDETERMINED).select(docs.columns)


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated line runs; documents of which nothing is left go."""
    found = lines.dedup_lines(docs)
    kept = found.where("n_removed = 0 or n_removed < n_lines")
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    n_chars = F.when(changed, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return kept.withColumns({"text": text, "n_chars": n_chars}).select(docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id; rows without an id stay."""
    found = minhash.near_duplicates(docs.select("doc_id", "text"))
    # A repeated row has the same answer as the first: one row of an id is enough.
    gone = found.where("doc_id is not null and not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate asks for, from not at all to several times."""
    model = mixing.train(docs, read(spark, sf_dir, "labels"), F.expr(DOMAIN), list(MIXTURE))
    mixed = mixing.mix(docs, model, MIXTURE)
    copies = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return mixed.where("copies > 0").withColumn("_copy", copies).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences in which every source has its share of the tokens."""
    return packing.pack(docs, tokenizer_path())
