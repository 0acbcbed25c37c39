"""The registered queries of these operators; each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.llm import (
    bitsearch,
    importance,
    langid,
    lines,
    lmscore,
    minhash,
    mixing,
    nndescent,
    packing,
    pivots,
    secrets,
    substrings,
    whitening,
)
from affinia.llm.common import fold


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "n_markov",
        secrets.spans_sha256(F.col("base_spans")).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", "kept_text")


#: Shares of the mixture, and how a row of ``labels`` names its domain.
MIXTURE = {"good": 0.80, "plain": 0.19, "toxic": 0.01}
DOMAIN = "case when toxic = 1 then 'toxic' when quality = 1 then 'good' when quality = 0 then 'plain' end"


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = mixing.train(docs, read(spark, sf_dir, "labels"), F.expr(DOMAIN), list(MIXTURE))
    return mixing.mix(docs, model, MIXTURE).select("doc_id", "tokens", "posteriors", "rate", "copies")


def op4_nndescent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.near_duplicates(read(spark, sf_dir, "embeddings"))


def op5_bitsearch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsearch.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    model = langid.train(docs.where(fold("doc_id", 5) != 0))
    found = langid.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4)


def op9_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = lmscore.score(docs, tokenizer_path("piece_bpe_32k.model"), fold("doc_id", 10) != 0)
    held_out = F.coalesce(fold("doc_id", 10) == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    pieces = packing.pack(docs, tokenizer_path())
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_lines": op2_lines,
    "op3_mixing": op3_mixing,
    "op4_nndescent": op4_nndescent,
    "op5_bitsearch": op5_bitsearch,
    "op6_substrings": op6_substrings,
    "op7_langid": op7_langid,
    "op8_minhash": op8_minhash,
    "op9_lmscore": op9_lmscore,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_importance": op12_importance,
    "op13_topk": op13_topk,
}

#: The CRC of a text's UTF-8 bytes, by the table of the 256 byte values.
CRC = """
list_reduce([4294967295] || list_transform(range(1, 2 * octet_length(encode({0})), 2),
    lambda i: ('0x' || substr(hex(encode({0})), i, 2))::BIGINT),
    lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]))"""

#: Components of ``links`` (x, y, both ways) among ``nodes`` (id).
REACH = """
reach(id, component) AS (
    SELECT id, id FROM nodes UNION SELECT y, component FROM reach JOIN links ON x = id),
parts AS (SELECT id, min(component) AS component_id FROM reach GROUP BY id),
degrees AS (SELECT x AS id, count(*) AS n_links FROM links GROUP BY x)"""

#: What SQL can express; the others are trained models, tokenizers and sums of doubles in another order.
ORACLE: dict[str, str] = {
    "op4_nndescent": f"""
WITH RECURSIVE usable AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
nodes AS (SELECT vec_id AS id FROM embeddings), {REACH}
SELECT id AS vec_id, coalesce(n_links, 0) AS n_links, component_id, id = component_id AS kept
FROM parts LEFT JOIN degrees USING (id)""",
    "op6_substrings": """
WITH cut AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM cut),
windows AS (
    SELECT doc_id, i, w[i] AS word, CASE WHEN i + 34 <= len(w) THEN array_to_string(w[i : i + 34], ' ') END AS run
    FROM words),
judged AS (
    SELECT *, run IS NOT NULL AND count(*) OVER (PARTITION BY run) > 1 AS again FROM windows),
covered AS (
    SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
    FROM judged),
left_over AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
    FROM covered GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM cut LEFT JOIN left_over USING (doc_id)""",
    "op8_minhash": f"""
WITH RECURSIVE cut AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))) END AS s
    FROM cut),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, a.n AS n_x, b.n AS n_y, count(*) AS both_
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared WHERE 100 * both_ >= 80 * (n_x + n_y - both_)),
nodes AS (SELECT doc_id AS id FROM documents), {REACH}
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN parts ON doc_id = id""",
    "op12_importance": f"""
WITH crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entries),
texts AS (
    SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark),
cut AS (
    SELECT side, id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
found AS (
    SELECT side, id, len(w) AS n_words,
        w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS f FROM cut),
each AS (SELECT side, id, unnest(f) AS f FROM found),
crcs AS (SELECT f, xor({CRC.format("f")}, 4294967295) % 10000 AS b
    FROM (SELECT DISTINCT f FROM each), crc_table),
put AS (SELECT side, id, b FROM each JOIN crcs USING (f)),
tally AS (
    SELECT b, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM put GROUP BY b),
gain AS (
    SELECT b, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM tally)::DOUBLE + 10000)
        / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM tally)::DOUBLE + 10000))))::BIGINT AS g FROM tally),
weight AS (
    SELECT id, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM put JOIN gain USING (b)
    WHERE side = 'd' GROUP BY id),
scored AS (
    SELECT id AS doc_id, n_words, len(f) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln(
            (('0x' || substr(sha256('7:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM found LEFT JOIN weight USING (id) WHERE side = 'd'),
ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
    FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)""",
    "op13_topk": """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.x, b.x)::BIGINT AS score
    FROM vectors a, vectors b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
ranked AS (
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
        vec_id, score FROM met)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
}
