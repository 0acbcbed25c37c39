"""The registered queries as SQL for DuckDB, over the same tables."""

from __future__ import annotations

UI_DUP = """ui_dup AS (
  SELECT o_custkey AS "user", l_partkey AS item, l_quantity AS pref, l_extendedprice AS price,
         l_discount AS discount, l_returnflag AS flag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
UI = UI_DUP + """,
ui AS (SELECT "user", item, sum(pref) AS pref FROM ui_dup GROUP BY "user", item)"""
UI_TEXT = UI + """,
ui_text AS (
  SELECT c_name AS "user", 'P' || item AS item, pref FROM ui JOIN customer ON c_custkey = "user")"""
BRANDS = """brands AS (
  SELECT DISTINCT l_orderkey AS basket, p_brand AS item
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand <> '')"""

_STATS = """stats AS (
  SELECT item, count(*) AS n, sum(pref) AS total, sum(pref * pref) AS norm2, max(abs(pref)) AS peak,
         avg(pref) AS mean, var_pop(pref) * count(*) AS ssd
  FROM {prefs} GROUP BY item)"""

def _llr() -> str:
    """Twice the sum of observed * ln(1 + off / expected), with ln(1 + x) = 2 atanh(x / (2 + x)).

    A sum of x ln x terms loses digits to cancellation, and the ninth digit is compared.
    """
    off = "(co - CAST(na AS DOUBLE) * nb / users)"
    cells = [
        ("co", off, "CAST(na AS DOUBLE) * nb"),
        ("(na - co)", f"-{off}", "CAST(na AS DOUBLE) * (users - nb)"),
        ("(nb - co)", f"-{off}", "CAST(users - na AS DOUBLE) * nb"),
        ("(users - na - nb + co)", off, "CAST(users - na AS DOUBLE) * (users - nb)"),
    ]
    terms = [
        f"CASE WHEN {n} > 0 THEN {n} * 2 * atanh(({d} * users / ({e})) / (2 + {d} * users / ({e}))) ELSE 0 END"
        for n, d, e in cells
    ]
    return f"1 - 1 / (1 + greatest(0, 2 * ({' + '.join(terms)})))"


FORMULAS = {
    "cooccurrence": "CAST(co AS DOUBLE)",
    "tanimoto": "co / CAST(na + nb - co AS DOUBLE)",
    "loglikelihood": _llr(),
    "city_block": "1 / CAST(1 + na + nb - 2 * co AS DOUBLE)",
    "cosine": "dot / (sqrt(norm2a) * sqrt(norm2b))",
    "pearson": "CASE WHEN ssda > 0 AND ssdb > 0 THEN dot / (sqrt(ssda) * sqrt(ssdb)) END",
    "euclidean": "1 / (1 + sqrt(greatest(0, norm2a - 2 * dot + norm2b)))",
    "dice": "2 * co / CAST(na + nb AS DOUBLE)",
}


def pairs_sql(measure: str, prefs: str = "ui") -> str:
    """CTEs ending in ``kept``: positive similarities of unordered pairs."""
    weight = "pref - mean" if measure == "pearson" else "pref"
    return f"""{_STATS.format(prefs=prefs)},
weighted AS (SELECT "user", item, {weight} AS w FROM {prefs} JOIN stats USING (item)),
pairs AS (
  SELECT a.item AS item_a, b.item AS item_b, count(*) AS co, sum(a.w * b.w) AS dot
  FROM weighted a JOIN weighted b ON a."user" = b."user" AND a.item < b.item
  GROUP BY a.item, b.item),
described AS (
  SELECT item_a, item_b, co, dot, a.n AS na, b.n AS nb, a.norm2 AS norm2a, b.norm2 AS norm2b,
         a.ssd AS ssda, b.ssd AS ssdb, (SELECT count(DISTINCT "user") FROM {prefs}) AS users
  FROM pairs JOIN stats a ON a.item = item_a JOIN stats b ON b.item = item_b),
measured AS (SELECT item_a, item_b, round({FORMULAS[measure]}, 9) AS sim FROM described),
kept AS (SELECT * FROM measured WHERE sim > 0)"""


def similar_sql(measure: str, k: int, prefs: str = "ui") -> str:
    """CTEs ending in ``neighbours``: item, other, sim, rank."""
    return f"""{pairs_sql(measure, prefs)},
both_ways AS (
  SELECT item_a AS item, item_b AS other, sim FROM kept
  UNION ALL SELECT item_b, item_a, sim FROM kept),
neighbours AS (
  SELECT * FROM (
    SELECT item, other, sim, row_number() OVER (PARTITION BY item ORDER BY sim DESC, other) AS rank
    FROM both_ways) WHERE rank <= {k})"""


def recs_sql(
    n: int,
    prefs: str = "ui",
    boolean: bool = False,
    users: str = "",
    candidates: str = "",
    exclude: str = "",
) -> str:
    """CTEs ending in ``recs``: user, item, score, rank; needs ``neighbours``."""
    pref = "1.0" if boolean else "pref"
    score = "sum(s.sim)" if boolean else f"sum(s.sim * c.pref) / sum(abs(s.sim))"
    support = 1 if boolean else 2
    return f"""considered AS (
  SELECT "user", item, {pref} AS pref FROM {prefs} {users}),
proposed AS (
  SELECT c."user", s.other AS item, round({score}, 9) AS score
  FROM considered c JOIN neighbours s ON s.item = c.item {candidates}
  GROUP BY c."user", s.other HAVING count(*) >= {support}),
fresh AS (
  SELECT p.* FROM proposed p
  WHERE NOT EXISTS (SELECT 1 FROM {prefs} h WHERE h."user" = p."user" AND h.item = p.item) {exclude}),
recs AS (
  SELECT * FROM (
    SELECT "user", item, score, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank
    FROM fresh) WHERE rank <= {n})"""


SHOW_SIM = "SELECT item, other, sim, rank FROM neighbours"
SHOW_RECS = 'SELECT "user", item, score, rank FROM recs'

_DIGEST = """md5('42|' || "user" || '|' || item)"""

HOLDOUT = UI + f""",
placed AS (
  SELECT *, count(*) OVER (PARTITION BY "user") AS size,
         row_number() OVER (PARTITION BY "user" ORDER BY {_DIGEST}, item) AS r
  FROM ui),
holdout AS (
  SELECT "user", item, pref,
         CASE WHEN size = 1 OR r <= floor(size * CAST('0.6' AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
  FROM placed),
train AS (SELECT "user", item, pref FROM holdout WHERE split = 'train'),
test AS (SELECT "user", item FROM holdout WHERE split = 'test')"""

METRICS = f"""{HOLDOUT}, {similar_sql("cooccurrence", 50, "train")}, {recs_sql(20, "train", True)},
n_recs AS (SELECT "user", count(*) AS n_rec FROM recs GROUP BY "user"),
n_tests AS (SELECT "user", count(*) AS n_test FROM test GROUP BY "user"),
n_hits AS (SELECT r."user", count(*) AS n_hit FROM recs r JOIN test t ON r."user" = t."user" AND r.item = t.item
           GROUP BY r."user"),
hits AS (
  SELECT "user", coalesce(n_hit, 0) AS n_hit, n_test, n_rec
  FROM n_recs JOIN n_tests USING ("user") LEFT JOIN n_hits USING ("user")),
ratios AS (
  SELECT *, CASE WHEN n_hit > 0 THEN n_hit / CAST(n_rec AS DOUBLE) ELSE 0.0 END AS precision_,
         CASE WHEN n_hit > 0 THEN n_hit / CAST(n_test AS DOUBLE) ELSE 0.0 END AS recall_
  FROM hits),
metrics AS (
  SELECT "user", n_hit, n_test, n_rec, CAST(precision_ AS DOUBLE) AS "precision", CAST(recall_ AS DOUBLE) AS recall,
         CASE WHEN n_hit > 0 THEN 2 * precision_ * recall_ / (precision_ + recall_)
              ELSE CAST(0 AS DOUBLE) END AS f1
  FROM ratios)"""



_PAIRS = f"""{BRANDS},
singles AS (SELECT item, count(*) AS freq FROM brands GROUP BY item HAVING count(*) >= :least),
pairs AS (
  SELECT a.item AS item_a, b.item AS item_b, count(*) AS freq
  FROM brands a JOIN brands b ON a.basket = b.basket AND a.item < b.item
  GROUP BY a.item, b.item HAVING count(*) >= :least),
total AS (SELECT count(DISTINCT basket) AS n FROM brands),
lifts AS (
  SELECT item_a, item_b, p.freq, a.freq AS freq_a, b.freq AS freq_b,
         CAST(p.freq * n AS DOUBLE) / CAST(a.freq * b.freq AS DOUBLE) AS lift
  FROM pairs p JOIN singles a ON a.item = item_a JOIN singles b ON b.item = item_b, total),
partners AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY freq DESC, partner) AS rank FROM (
    SELECT item_a AS item, item_b AS partner, freq FROM pairs
    UNION ALL SELECT item_b, item_a, freq FROM pairs))"""
_TRIPLES = _PAIRS + """,
triples AS (
  SELECT a.item AS item_a, b.item AS item_b, c.item AS item_c, count(*) AS freq
  FROM brands a JOIN brands b ON a.basket = b.basket AND a.item < b.item
                JOIN brands c ON a.basket = c.basket AND b.item < c.item
  GROUP BY a.item, b.item, c.item HAVING count(*) >= :least)"""
_RULES = _TRIPLES + """,
implications AS (
  SELECT item_a AS antecedent, item_b AS consequent, freq FROM pairs
  UNION ALL SELECT item_b, item_a, freq FROM pairs
  UNION ALL SELECT item_b || ',' || item_c, item_a, freq FROM triples
  UNION ALL SELECT item_a || ',' || item_c, item_b, freq FROM triples
  UNION ALL SELECT item_a || ',' || item_b, item_c, freq FROM triples),
bodies AS (
  SELECT item AS antecedent, freq FROM singles
  UNION ALL SELECT item_a || ',' || item_b, freq FROM pairs)"""



def frequent(ctes: str, share: int) -> str:
    """The CTEs with sets counted as frequent in one of ``share`` baskets and at least 2."""
    return ctes.replace(":least", f"(SELECT greatest(2, count(DISTINCT basket) // {share}) FROM brands)")


PAIRS, TRIPLES, RULES = (frequent(ctes, 49) for ctes in (_PAIRS, _TRIPLES, _RULES))
# Every subset of every basket, counted.
SETS = """,
grown(basket, items) AS (
  SELECT basket, [item] FROM brands
  UNION ALL SELECT g.basket, list_append(items, b.item) FROM grown g JOIN brands b ON b.basket = g.basket AND b.item > items[-1]),
sets AS (SELECT len(items) AS size, items, count(*) AS freq FROM grown GROUP BY items HAVING count(*) >= :least)"""
BY_LEVEL = "RECURSIVE " + frequent(_PAIRS + SETS, 600)

def merged_sql(second: str = "price") -> str:
    """CTEs ending in ``scores`` and ``criteria``."""
    xlx = "sum(CASE WHEN {0} > 0 THEN {0} * ln({0}) ELSE 0 END)"
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS criterion, count(*) AS n, sum({c}) AS total, avg({c}) AS mean,
    ({xlx.format(c)} / sum({c}) - ln(sum({c}))) / ln(count(*)) AS entropy, stddev_pop({c}) AS stddev FROM merged"""
        for c in ("c1", "c2")
    )
    return f"""{UI_DUP},
merged AS (SELECT "user", item, sum(pref) AS c1, sum({second}) AS c2 FROM ui_dup GROUP BY "user", item),
entropies AS ({parts}),
criteria AS (
  SELECT criterion, n, total, mean, entropy, (1 + entropy) / (2 + sum(entropy) OVER ()) AS weight, stddev
  FROM entropies),
zs AS (
  SELECT m."user", m.item, (c1 - a.mean) / a.stddev AS z1, (c2 - b.mean) / b.stddev AS z2,
         a.weight AS w1, b.weight AS w2
  FROM merged m, (SELECT * FROM criteria WHERE criterion = 'c1') a, (SELECT * FROM criteria WHERE criterion = 'c2') b),
scores AS (SELECT "user", item, 5 * (w1 / (1 + exp(-z1)) + w2 / (1 + exp(-z2))) AS score FROM zs)"""


def key_lists_sql(counts: str) -> str:
    """CTEs ending in ``lists``: kind, part, keys_list, from ``counts`` (kind, key, n)."""
    return f"""counts AS ({counts}),
paged AS (SELECT *, (row_number() OVER (PARTITION BY kind ORDER BY key) - 1) // 1000 AS part FROM counts),
lists AS (
  SELECT kind, part, string_agg(concat_ws(':', key, CAST(n AS VARCHAR)), ',' ORDER BY key) AS keys_list
  FROM paged GROUP BY ALL)"""


SCORE_COUNTS = """
  SELECT 'item_popularity' AS kind, CAST(item AS VARCHAR) AS key, count(*) AS n FROM scores GROUP BY item
  UNION ALL SELECT 'score_histogram', printf('%.2f', round(score, 2)), count(*) FROM scores GROUP BY round(score, 2)"""
LIFT_COUNTS = """
  SELECT 'lift_histogram' AS kind, printf('%.1f', round(lift, 1)) AS key, count(*) AS n FROM lifts GROUP BY round(lift, 1)"""
METRIC_COUNTS = """
  SELECT DISTINCT 'precision_recall' AS kind,
         printf('%.4f:%.4f', round("precision", 4), round(recall, 4)) AS key, CAST(NULL AS BIGINT) AS n FROM metrics
  UNION ALL SELECT 'f1_histogram', printf('%.1f', round(f1, 1)), count(*) FROM metrics GROUP BY round(f1, 1)"""
METRIC_MEANS = """means AS (
  SELECT printf('%.5f,%.5f,%.5f', round(avg("precision"), 5), round(avg(recall), 5), round(avg(f1), 5)) AS quota_mean
  FROM metrics)"""


def raw_sql(columns: str) -> str:
    """CTEs ending in ``fields``: the split lines, trailing empty fields removed."""
    return f"""{UI_DUP},
raw AS (
  SELECT concat_ws(chr(9), {columns}) AS value FROM ui_dup
  UNION ALL SELECT CAST(o_custkey AS VARCHAR) FROM orders
  UNION ALL SELECT o_custkey || chr(9) || chr(9) FROM orders),
fields AS (SELECT string_split(rtrim(value, chr(9)), chr(9)) AS f FROM raw)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


ORACLE: dict[str, str] = {
    "read_interactions": _with(
        raw_sql("CAST(\"user\" AS VARCHAR), CAST(item AS VARCHAR), CAST(pref AS VARCHAR)"),
        'SELECT f[1] AS "user", f[2] AS item, CAST(f[3] AS DOUBLE) AS pref FROM fields WHERE len(f) > 2',
    ),
    "read_criteria": _with(
        raw_sql("CAST(\"user\" AS VARCHAR), CAST(item AS VARCHAR), CAST(pref AS VARCHAR), CAST(price AS VARCHAR)"),
        'SELECT f[1] AS "user", f[2] AS item, CAST(f[3] AS DOUBLE) AS c1, CAST(f[4] AS DOUBLE) AS c2 '
        "FROM fields WHERE len(f) > 3",
    ),
    "result_sink": _with(
        UI_TEXT, "SELECT 'b01' AS batch_id, 'b01_' || \"user\" || '-' || item AS target_id, item AS value, pref FROM ui_text"
    ),
    "recommend_results": _with(
        f"{UI}, {similar_sql('tanimoto', 50)}, {recs_sql(10, boolean=True)}",
        "SELECT 'b01' AS batch_id, 'b01_' || \"user\" AS target_id, "
        "string_agg(CAST(item AS VARCHAR), ',' ORDER BY rank) AS item_list FROM recs GROUP BY \"user\"",
    ),
    "evaluation_checklist": _with(
        METRICS,
        "SELECT 'b01' AS batch_id, 'b01_' || \"user\" AS target_id, round(\"precision\", 6) AS \"precision\", "
        "round(recall, 6) AS recall, round(f1, 6) AS f1 FROM metrics",
    ),
    "statistics_results": _with(
        f"{merged_sql()}, {key_lists_sql(SCORE_COUNTS)}",
        "SELECT 'b01' AS batch_id, 'b01_' || kind AS target_id, part, keys_list FROM lists",
    ),
    "dedupe_interactions": _with(UI_DUP, 'SELECT DISTINCT "user", item, pref FROM ui_dup'),
    "min_prefs_filter": _with(
        UI, 'SELECT * FROM ui WHERE "user" IN (SELECT "user" FROM ui GROUP BY "user" HAVING count(*) >= 40)'
    ),
    "top_prefs_per_user": _with(
        UI,
        'SELECT "user", item, pref FROM ui '
        'QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY abs(pref) DESC, item) <= 10',
    ),
    "sample_prefs_per_user": _with(
        UI,
        'SELECT "user", item, pref FROM ui '
        f'QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY {_DIGEST}, item) <= 20',
    ),
    "collect_items": _with(
        UI,
        'SELECT "user", CAST(0 AS BIGINT) AS part, string_agg(CAST(item AS VARCHAR), \',\' ORDER BY item) AS items '
        'FROM ui GROUP BY "user"',
    ),
    "item_stats": _with(
        f"{UI}, {_STATS.format(prefs='ui')}",
        "SELECT item, n, total, norm2, peak, round(mean, 6) AS mean, round(ssd, 6) AS ssd FROM stats",
    ),
    "cooccurrence": _with(f"{UI}, {pairs_sql('cooccurrence')}", "SELECT item_a, item_b, co, dot FROM pairs"),
    "similarity_threshold": _with(
        f"{UI}, {pairs_sql('tanimoto')}",
        "SELECT item_a AS item, item_b AS other, sim FROM kept WHERE sim >= 0.05 "
        "UNION ALL SELECT item_b, item_a, sim FROM kept WHERE sim >= 0.05",
    ),
    "similarity_prefix": _with(
        f"{UI}, {pairs_sql('tanimoto')}",
        "SELECT item_a AS item, item_b AS other, sim FROM kept WHERE sim >= CAST('0.08' AS DOUBLE) "
        "UNION ALL SELECT item_b, item_a, sim FROM kept WHERE sim >= CAST('0.08' AS DOUBLE)",
    ),
    "similarity_pruned": _with(f"{UI}, {similar_sql('tanimoto', 20)}", SHOW_SIM),
    "collect_items_parts": _with(
        UI
        + """,
placed AS (SELECT *, (row_number() OVER (PARTITION BY "user" ORDER BY item) - 1) // 7 AS part FROM ui)""",
        'SELECT "user", part, string_agg(CAST(item AS VARCHAR), \',\' ORDER BY item) AS items FROM placed GROUP BY ALL',
    ),
    "top_lines_per_flag": _with(
        UI_DUP,
        'SELECT flag, "user", item, price, rank FROM (SELECT *, '
        'row_number() OVER (PARTITION BY flag ORDER BY price DESC, "user", item) AS rank '
        'FROM (SELECT DISTINCT flag, "user", item, price FROM ui_dup)) WHERE rank <= 1200',
    ),
    "itemsets_by_level": _with(
        BY_LEVEL, "SELECT CAST(size AS BIGINT) AS size, array_to_string(items, ',') AS items, freq FROM sets"
    ),
    "rules_by_level": _with(
        BY_LEVEL
        + """,
implications AS (
  SELECT list_filter(items, lambda x: x <> consequent) AS antecedent, consequent, freq
  FROM (SELECT items, unnest(items) AS consequent, freq FROM sets WHERE size > 1))""",
        "SELECT array_to_string(antecedent, ',') AS antecedent, consequent, i.freq, "
        "i.freq / CAST(n AS DOUBLE) AS support, i.freq / CAST(b.freq AS DOUBLE) AS confidence, "
        "CAST(i.freq * n AS DOUBLE) / CAST(b.freq * s.freq AS DOUBLE) AS lift "
        "FROM implications i JOIN sets b ON b.items = antecedent JOIN singles s ON s.item = consequent, total "
        "WHERE i.freq / CAST(b.freq AS DOUBLE) >= CAST('0.1' AS DOUBLE)",
    ),
    "basket_parts": _with(
        BRANDS
        + """,
placed AS (SELECT *, (row_number() OVER (PARTITION BY basket ORDER BY item) - 1) // 2 AS part FROM brands)""",
        "SELECT basket, part, string_agg(item, ',' ORDER BY item) AS items FROM placed GROUP BY ALL",
    ),
    "preference_ranks": _with(
        merged_sql(),
        'SELECT "user", row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank, item, '
        "round(score, 6) AS score FROM scores",
    ),
    "preference_parts": _with(
        merged_sql()
        + """,
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) - 1) // 8 AS part FROM scores)""",
        'SELECT "user", part, string_agg(printf(\'%d:%.6f\', item, score), \',\' ORDER BY score DESC, item) AS prefs '
        "FROM placed GROUP BY ALL",
    ),
    "statistics_rows": _with(
        f"{merged_sql()}, counts AS ({SCORE_COUNTS})", "SELECT 'b01' AS batch_id, kind, key, n FROM counts"
    ),
    "similar_items_topk": _with(
        """ui_event AS (
  SELECT * FROM (SELECT user_id AS "user", event_type AS item, sum(value) AS pref FROM events GROUP BY ALL)
  WHERE pref <> 0), """
        + similar_sql("cosine", 100, "ui_event"),
        SHOW_SIM,
    ),
    "most_similar_pairs": _with(
        f"{UI}, {similar_sql('cosine', 10)}",
        "SELECT least(item, other) AS item_a, greatest(item, other) AS item_b, max(sim) AS sim "
        "FROM neighbours GROUP BY ALL",
    ),
    "recommend_rated": _with(f"{UI}, {similar_sql('cosine', 50)}, {recs_sql(10)}", SHOW_RECS),
    "recommend_boolean": _with(f"{UI}, {similar_sql('tanimoto', 50)}, {recs_sql(10, boolean=True)}", SHOW_RECS),
    "explode_recs": _with(f"{UI}, {similar_sql('tanimoto', 50)}, {recs_sql(10, boolean=True)}", SHOW_RECS),
    "recommend_exclude": _with(
        UI
        + """,
excluded AS (SELECT DISTINCT "user", item + 1 AS item FROM ui_dup WHERE flag = 'R'), """
        + similar_sql("cosine", 50)
        + ", "
        + recs_sql(
            10,
            exclude='AND NOT EXISTS (SELECT 1 FROM excluded e WHERE e."user" = p."user" AND e.item = p.item)',
        ),
        SHOW_RECS,
    ),
    "recommend_for_users": _with(
        f"{UI}, {similar_sql('cosine', 50)}, "
        + recs_sql(10, users="WHERE \"user\" IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"),
        SHOW_RECS,
    ),
    "recommend_for_items": _with(
        f"{UI}, {similar_sql('cosine', 50)}, "
        + recs_sql(10, candidates="AND s.other IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY')"),
        SHOW_RECS,
    ),
    "id_dictionary": _with(
        UI_TEXT,
        "SELECT item AS id, row_number() OVER (ORDER BY item) AS idx FROM (SELECT DISTINCT item FROM ui_text)",
    ),
    "encode_ids": _with(
        UI_TEXT,
        'SELECT dense_rank() OVER (ORDER BY "user") AS "user", dense_rank() OVER (ORDER BY item) AS item, pref '
        "FROM ui_text",
    ),
    "decode_recs": _with(
        f"{UI_TEXT}, {similar_sql('cosine', 50, 'ui_text')}, {recs_sql(10, 'ui_text')}", SHOW_RECS
    ),
    "train_test_split": _with(HOLDOUT, 'SELECT "user", item, pref, split FROM holdout'),
    "hit_counts": _with(METRICS, 'SELECT "user", n_hit, n_test, n_rec FROM metrics'),
    "ranking_metrics": _with(
        METRICS,
        'SELECT "user", n_hit, n_test, n_rec, round("precision", 6) AS "precision", round(recall, 6) AS recall, '
        "round(f1, 6) AS f1 FROM metrics",
    ),
    "evaluation_means": _with(
        METRICS,
        'SELECT round(avg("precision"), 5) AS mean_precision, round(avg(recall), 5) AS mean_recall, '
        "round(avg(f1), 5) AS mean_f1 FROM metrics",
    ),
    "precision_recall_points": _with(
        METRICS, 'SELECT DISTINCT round("precision", 4) AS "precision", round(recall, 4) AS recall FROM metrics'
    ),
    "f1_histogram": _with(METRICS, "SELECT round(f1, 1) AS bucket, count(*) AS n FROM metrics GROUP BY bucket"),
    "baskets": _with(
        BRANDS,
        "SELECT basket, CAST(0 AS BIGINT) AS part, "
        "string_agg(item, ',' ORDER BY item) AS items FROM brands GROUP BY basket",
    ),
    "frequent_itemsets": _with(
        TRIPLES,
        "SELECT item AS items, freq FROM singles UNION ALL SELECT item_a || ',' || item_b, freq FROM pairs "
        "UNION ALL SELECT item_a || ',' || item_b || ',' || item_c, freq FROM triples",
    ),
    "associated_items": _with(PAIRS, "SELECT item, partner, freq, rank FROM partners WHERE rank <= 10"),
    "pair_lift": _with(PAIRS, "SELECT item_a, item_b, freq, freq_a, freq_b, round(lift, 6) AS lift FROM lifts"),
    "association_rules": _with(
        RULES,
        "SELECT i.antecedent, consequent, i.freq, round(i.freq / CAST(n AS DOUBLE), 6) AS support, "
        "round(i.freq / CAST(b.freq AS DOUBLE), 6) AS confidence, "
        "round(CAST(i.freq * n AS DOUBLE) / CAST(b.freq * s.freq AS DOUBLE), 6) AS lift "
        "FROM implications i JOIN bodies b ON b.antecedent = i.antecedent JOIN singles s ON s.item = consequent, total "
        "WHERE i.freq / CAST(b.freq AS DOUBLE) >= CAST('0.1' AS DOUBLE)",
    ),
    "lift_histogram": _with(PAIRS, "SELECT round(lift, 1) AS bucket, count(*) AS n FROM lifts GROUP BY bucket"),
    "merge_criteria": _with(merged_sql(), 'SELECT "user", item, c1, round(c2, 4) AS c2 FROM merged'),
    "criteria_stats": _with(
        merged_sql("discount"),
        "SELECT criterion, n, round(total, 2) AS total, round(mean, 6) AS mean, round(entropy, 6) AS entropy, "
        "round(weight, 6) AS weight, round(stddev, 6) AS stddev FROM criteria",
    ),
    "entropy_weights": _with(merged_sql(), "SELECT criterion, round(weight, 6) AS weight FROM criteria"),
    "zscore": _with(merged_sql(), 'SELECT "user", item, round(z1, 6) AS z_c1, round(z2, 6) AS z_c2 FROM zs'),
    "pref_score": _with(merged_sql(), 'SELECT "user", item, round(score, 6) AS score FROM scores'),
    "preference_lists": _with(
        merged_sql(),
        'SELECT "user", CAST(0 AS BIGINT) AS part, '
        "string_agg(printf('%d:%.6f', item, score), ',' ORDER BY score DESC, item) AS prefs "
        'FROM scores GROUP BY "user"',
    ),
    "item_popularity": _with(merged_sql(), "SELECT item, count(*) AS n FROM scores GROUP BY item"),
    "pref_histogram": _with(
        merged_sql(), "SELECT round(score, 2) AS bucket, count(*) AS n FROM scores GROUP BY bucket"
    ),
    "sort_by_value": _with(
        UI_TEXT,
        "SELECT \"user\" || '_' || item AS key, CAST(pref AS VARCHAR) AS value FROM ui_text ORDER BY value, key",
    ),
    "association_run_tables": _with(
        f"{PAIRS}, {key_lists_sql(LIFT_COUNTS)}",
        "SELECT 'recommend_results' AS table_name, 'b01_' || item AS target_id, CAST(0 AS BIGINT) AS part, "
        "string_agg(partner, ',' ORDER BY rank) AS value FROM partners WHERE rank <= 10 GROUP BY item "
        "UNION ALL SELECT 'evaluation_checklist', 'b01_' || item_a || '-' || item_b, 0, printf('%.6f', lift) FROM lifts "
        "UNION ALL SELECT 'statistics_results', 'b01_' || kind, part, keys_list FROM lists",
    ),
    "recommend_run_tables": _with(
        f"{UI}, {similar_sql('loglikelihood', 80)}, {recs_sql(11, boolean=True)}",
        "SELECT 'recommend_results' AS table_name, 'b01_' || \"user\" AS target_id, CAST(0 AS BIGINT) AS part, "
        "string_agg(CAST(item AS VARCHAR), ',' ORDER BY rank) AS value FROM recs GROUP BY \"user\"",
    ),
    "recommend_text_ids_run_tables": _with(
        f"{UI_TEXT}, {similar_sql('cosine', 20, 'ui_text')}, {recs_sql(10, 'ui_text')}",
        "SELECT 'recommend_results' AS table_name, 'b01_' || \"user\" AS target_id, CAST(0 AS BIGINT) AS part, "
        "string_agg(item, ',' ORDER BY rank) AS value FROM recs GROUP BY \"user\" "
        "UNION ALL SELECT 'item_similarities', least(item, other) || '-' || greatest(item, other), 0, "
        "printf('%.9f', max(sim)) FROM neighbours GROUP BY least(item, other), greatest(item, other)",
    ),
    "evaluate_run_tables": _with(
        f"{METRICS}, {METRIC_MEANS}, {key_lists_sql(METRIC_COUNTS)}",
        "SELECT 'evaluation_checklist' AS table_name, 'b01_' || \"user\" AS target_id, CAST(0 AS BIGINT) AS part, "
        "printf('%.6f,%.6f,%.6f', \"precision\", recall, f1) AS value FROM metrics "
        "UNION ALL SELECT 'statistics_results', 'b01_' || kind, part, "
        "concat_ws('-', keys_list, CASE WHEN kind = 'precision_recall' THEN quota_mean END) FROM lists, means",
    ),
    "preference_run_tables": _with(
        f"{merged_sql()}, {key_lists_sql(SCORE_COUNTS)}",
        "SELECT 'recommend_results' AS table_name, 'b01_' || \"user\" AS target_id, CAST(0 AS BIGINT) AS part, "
        "string_agg(printf('%d:%.6f', item, score), ',' ORDER BY score DESC, item) AS value FROM scores GROUP BY \"user\" "
        "UNION ALL SELECT 'statistics_results', 'b01_' || kind, part, keys_list FROM lists",
    ),
}

for _measure in FORMULAS:
    _name = "sim_custom" if _measure == "dice" else f"sim_{_measure}"
    ORACLE[_name] = _with(f"{UI}, {similar_sql(_measure, 20)}", SHOW_SIM)
