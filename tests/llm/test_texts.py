"""Text operators against brute force: nulls, empty and short texts, repeated rows, empty tables, extra columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from affinia.llm import langid, lmscore, minhash, packing, secrets, substrings
from affinia.llm.queries import tokenizer_path

DOCS = "doc_id bigint, text string"


def words(n, seed, kinds=500):
    r = random.Random(seed)
    return [f"w{r.randrange(kinds)}" for _ in range(n)]


def test_minhash(spark):
    base = words(60, 1, 10**6)
    # Changed copies are near the base, which comes last, but not near each other.
    table = [(i, " ".join([*base[: 5 * i], "X" + str(i), *base[5 * i + 1 :]])) for i in range(1, 11)]
    table += [(50, " ".join(base).upper()), (60, None), (61, ""), (62, "a b"), (63, "A  b"), (62, "a b"), (64, " ".join(words(50, 2)))]
    sets = {}
    for i, t in table:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    docs = spark.createDataFrame(table, DOCS).withColumn("set_id", F.lit("clash"))
    got = minhash.near_duplicates(docs, shingle=4).collect()
    assert len(got) == len(table)
    assert all(tuple(r) == (r[0], len(sets[r[0]]), root[r[0]], r[0] == root[r[0]]) for r in got)
    assert root[50] == root[10] == 1
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_substrings(spark):
    run = words(41, 3)
    table = [(1, " ".join(words(30, 4) + run + words(9, 5))), (2, "\t".join(run)), (3, " ".join(words(80, 6))), (4, None), (5, "")]
    table += [(6, " ".join(run[:34])), (7, " ".join(["x"] * 36)), (8, " ".join(words(50, 7))), (8, " ".join(words(50, 7)))]
    split = [(t or "").split() for _, t in table]
    at = Counter(tuple(w[k : k + 35]) for w in split for k in range(len(w) - 34))
    want = []
    for (i, _), w in zip(table, split, strict=True):
        gone = {k + j for k in range(len(w) - 34) if at[tuple(w[k : k + 35])] > 1 for j in range(35)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want.append((i, len(w), len(gone), kept))
    docs = spark.createDataFrame(table, DOCS)
    got = substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    # A sketch too small for the table only sends more windows to the exact grouping.
    full = substrings.remove_repeats(docs, bits=8).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, full)) == sorted(want)
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


def test_secrets(spark):
    table = [(1, "é password: 'hunter22' token=ab API_key=Zz9+/=xx"), (2, None), (3, ""), (4, "AKIA" + "A1" * 8 + " AKIA123 " + "0af" * 9)]
    docs = spark.createDataFrame(table, DOCS)
    got = {r["doc_id"]: r for r in secrets.scan(docs, secrets.train(docs)).collect()}
    assert {i: (r["n_assign"], r["n_access"], r["n_hex"]) for i, r in got.items()} == {1: (2, 0, 0), 2: (0, 0, 0), 3: (0, 0, 0), 4: (0, 1, 1)}
    for i, text in table:
        low = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        found = [(m.start(), "assign", m.end()) for m in re.finditer(low, text or "") if len(m.group(2)) >= 6]
        found += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m.group()) >= 20]
        found += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m.group()) >= 24]
        assert [(s["start"], s["kind"], s["end"]) for s in got[i]["base_spans"]] == sorted(found)
        digest = ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(found))
        assert secrets.digest_sha256(text or "") == hashlib.sha256(digest.encode()).hexdigest()
    assert secrets.scan(docs.limit(0), secrets.train(docs.limit(0))).count() == 0


def test_langid(spark):
    text = {"en": "the house is on the hill and the river is near", "de": "das haus steht auf dem berg und der fluss ist nah"}
    learned = spark.createDataFrame([(i, text[k], k) for i in range(5) for k in text] + [(9, None, "en"), (9, "x", None)], DOCS + ", lang string")
    model = langid.train(learned)
    table = [(1, "The hills, the rivers"), (2, "die häuser, der berge"), (3, None), (4, ""), (5, "12 34 !"), (1, "The hills, the rivers")]
    got = langid.identify(spark.createDataFrame(table, DOCS), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und"}
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert langid.train(learned.limit(0)).predict("the", langid.Memory(langid.Model([], {}))) == ("und", 0.0)


def test_langid_scores_by_words_then_grams(spark):
    text = {"en": "the house is on the hill and the river is near", "de": "das haus steht auf dem berg und der fluss ist nah", "xx": "ab"}
    learned = spark.createDataFrame([(i, text[k], k) for i in range(5) for k in text], DOCS + ", lang string")
    table = [(1, "The hills, the rivers"), (2, "die häuser, der berge"), (3, None), (4, ""), (5, "12 34 !"), (1, "The hills, the rivers")]
    table += [(6, "berg near"), (7, "flusses"), (8, "qqq"), (9, "steht Haus 7"), (10, "rivermouth und"), (11, "the berg " * 100_000)]
    langs = sorted(text)
    count = {k: Counter(5 * text[k].split()) for k in langs}
    every = {w for k in langs for w in count[k]}

    def logs(table, totals, kinds, key):
        return [math.log((table[k][key] + 0.5) / (totals[k] + 0.5 * (kinds[k] + 1))) for k in langs]

    def score(word):
        if word in every:
            totals = {k: sum(count[k].values()) for k in langs}
            return logs(count, totals, {k: len(count[k]) for k in langs}, word)
        for n in range(5, 0, -1):
            grams = {k: Counter() for k in langs}
            for k in langs:
                for w, m in count[k].items():
                    for g in (f" {w} "[i : i + n] for i in range(len(w) + 3 - n)):
                        if not g.isspace():
                            grams[k][g] += m
            known = {g for k in langs for g in grams[k]}
            if met := [g for g in (f" {word} "[i : i + n] for i in range(len(word) + 3 - n)) if g in known]:
                totals, kinds = {k: sum(grams[k].values()) for k in langs}, dict.fromkeys(langs, len(known))
                return np.mean([logs(grams, totals, kinds, g) for g in met], axis=0)
        return [0.0] * len(langs)

    got = langid.identify(spark.createDataFrame(table, DOCS), langid.train(learned)).collect()
    assert len(got) == len(table)
    for r in got:
        words = Counter(w.strip(",!") for w in (dict(table)[r["doc_id"]] or "").lower().split())
        words = {w: n for w, n in words.items() if any(map(str.isalpha, w))}
        total = sum((n * np.array(score(w)) for w, n in words.items()), np.zeros(3))
        want = (langs[int(total.argmax())], 1 / np.exp(total - total.max()).sum()) if words else ("und", 0.0)
        assert r["lang_pred"] == want[0] and abs(r["score"] - want[1]) < 1e-9


def test_langid_remembers_few_words(monkeypatch):
    """What a task holds besides the model is bounded, and forgetting changes no prediction."""
    rows = [("de", "der", 5), ("de", "hund", 2), ("en", "the", 5), ("en", "hound", 2)]
    model = langid.Model(rows, {"de": (7, 2), "en": (7, 2)})
    texts = [f"the der hund{i} hound{i % 7} thou{i * i}" for i in range(200)]
    whole = langid.Memory(model)
    want = [model.predict(t, whole) for t in texts]
    monkeypatch.setattr(langid, "REMEMBERED", 50)
    few, held = langid.Memory(model), 0
    got = []
    for t in texts:
        got.append(model.predict(t, few))
        held = max(held, len(few))
    assert got == want and held <= 55 < len(whole)


def test_langid_learns_from_a_bounded_equal_sample(spark):
    table = [(i, f"w{i}a " * 20, "en") for i in range(3000)] + [(5000 + i, f"x{i}a " * 20, "de") for i in range(9)]
    table += [(9000, None, "de"), (9001, "y", None), (None, "z", "en"), (1, "w1a " * 20, "en")]
    docs = spark.createDataFrame(table, DOCS + ", lang string")
    got = [langid.sample(docs.repartition(n), 100, 10**6).groupBy("lang").count().collect() for n in (1, 5)]
    assert all({r["lang"]: r["count"] for r in g} == {"en": 50, "de": 9} for g in got)
    # Whole texts enter until the characters are used up, one at least.
    few = langid.sample(docs, 100, 2).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in few} == {"en": 1, "de": 1}
    model = langid.train(docs, 100, 10**6)
    assert model.langs == ["de", "en"] and len(model.words[0]) == 59


def test_lmscore(spark):
    table = [(i, " ".join(words(20 + i, i, 40))) for i in range(30)] + [(90, None), (91, ""), (92, "Never-seen W1"), (92, "Never-seen W1")]
    docs = spark.createDataFrame(table, DOCS)
    got = lmscore.score(docs, tokenizer_path("piece_bpe_32k.model"), F.col("doc_id") % 3 != 0).collect()
    # One end counts as a token of every document.
    tokens = [[*(t or "").lower().split(), "\0end"] for _, t in table]
    c = Counter(w for (i, _), ws in zip(table, tokens, strict=True) if i % 3 for w in ws)
    total = sum(c.values())
    want = {}
    for (i, _), ws in zip(table, tokens, strict=True):
        base = sum(math.log10((c[w] + 0.1) / (total + 0.1 * (len(c) + 1))) for w in ws)
        want[i] = (len(ws), sum(c[w] > 0 for w in ws), total, base)
    assert len(got) == len(table)
    for r in got:
        n, known, n_train, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, n_train)
        assert abs(r["base_score"] - base) < 1e-6 and math.isfinite(r["score"]) and r["score"] <= 0


def test_packing(spark):
    from tokenizers import Tokenizer

    table = [(i, " ".join(words(100 + 7 * i, i)), "ab"[i % 3 > 0]) for i in range(40)]
    table += [(90, None, "a"), (91, "", None), (92, " odd  spaces \n here ", "rare"), (93, "x" * 5000, "b")]
    table += [(94, "end <|endoftext|> of <|endoftext|>x", "a"), (95, "Ġa b\n\nc é d\u00a0e \u3000 f", "a"), (96, "long text, " * 300_000, "b")]
    docs = spark.createDataFrame(table, DOCS + ", source string").repartition(3)
    got = packing.pack(docs, tokenizer_path()).collect()
    encoder = Tokenizer.from_file(tokenizer_path())
    for i, text, _ in table:
        ids = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        mine = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in mine) == ids
        assert all(r["doc_tokens"] == len(ids) // 4 and r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) for r in mine)
    windows = {}
    for r in got:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s, pieces in windows.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == 1024 or s == max(windows)
    assert packing.pack(docs.limit(0), tokenizer_path()).count() == 0


def test_encoder_forgets_without_a_difference():
    from tokenizers import Tokenizer

    texts = [" ".join(words(50, i, 3000)) + "\nnext line" for i in range(200)]
    small, plain = packing.Encoder(tokenizer_path(), 20_000), Tokenizer.from_file(tokenizer_path())
    for a in range(0, 200, 10):
        for text, got in zip(texts[a : a + 10], small.encode(texts[a : a + 10]), strict=True):
            assert np.frombuffer(got, small.kind).tolist() == plain.encode(text, add_special_tokens=False).ids
        assert small.held <= 20_000 + 1000 and len(small.young) + len(small.old) < 300


def test_schedule_takes_what_is_due():
    r = random.Random(3)
    for trial in range(20):
        totals = [r.choice([1, 5, 40, 300]) for _ in range(r.randrange(1, 8))]
        weights = [float(t) if trial % 2 else r.choice([1.0, 2.0, 7.0]) for t in totals]
        schedule = packing.Schedule(totals, weights, 16)
        share = np.array(weights) / sum(weights)
        due = sorted(((k + 0.5) / share[q], schedule.lane[q], q) for q, t in enumerate(totals) for k in range(t))
        for w in range(-(-sum(totals) // 16) + 1):
            want = Counter(q for _, _, q in due[: 16 * w])
            own = schedule.taken(np.full(len(totals), w), schedule.lane)[0]
            assert own.sum() == min(16 * w, sum(totals))
            # Tokens due at one moment may differ by rounding of that moment, by one of a queue.
            assert all(abs(int(x) - want[q]) <= 1 for q, x in enumerate(own))


def test_packing_gives_every_source_its_share(spark):
    # 600 even sources, more than there are tokens in half a window, and one named in the targets.
    table = [(1000 * i + k, " ".join(words(30, i)), f"s{i:03d}") for i in range(600) for k in range(2)]
    docs = spark.createDataFrame([*table, (7, " ".join(words(12, 7)), "tiny")], DOCS + ", source string").repartition(3)
    got = packing.pack(docs, tokenizer_path()).toPandas()
    total = got["length"].sum()
    for queue, mine in got.groupby("queue"):
        share = mine["length"].sum() / total * 1024
        taken = mine.groupby("sequence_id")["length"].sum().reindex(range(got["sequence_id"].max()), fill_value=0)
        assert (abs(taken - share) <= 2).all(), queue
    first = packing.pack(docs, tokenizer_path(), {"tiny": 0.5, "s000": 0.5}).toPandas()
    assert first[first["queue"] == "tiny"]["sequence_id"].max() == 0
    for found in (got, first):
        ends = found.sort_values(["sequence_id", "offset"])
        at = (ends["sequence_id"] * 1024 + ends["offset"]).to_numpy()
        assert (at == np.append(0, np.cumsum(ends["length"])[:-1])).all() and found["length"].sum() == total
