"""From raw documents to packed sequences in five stages, each on what the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from affinia.llm.stages import (
    delete_repeated_lines,
    identify_language,
    keep_one_of_near_duplicates,
    mix_domains,
    pack_sequences,
)

STAGES = [
    ("language", identify_language),
    ("lines", delete_repeated_lines),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("mixing", mix_domains),
    ("packing", pack_sequences),
]

#: Trained models, iteration and tokenizers are not for SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read again."""
    from affinia.llm.common import Scratch

    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.keep(docs)
    return docs
