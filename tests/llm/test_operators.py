"""Operators against brute force on small tables, with nulls, ties, repeated rows and empty tables."""

from __future__ import annotations

import numpy as np

from affinia.llm import bitsearch, lines, mixing, nndescent

VECTORS = [(i, np.random.default_rng(i // 2).standard_normal(8).tolist(), i % 4 // 2) for i in range(60)]
VECTORS += [(100, None, 0), (101, [0.0] * 8, 0), (102, [float("nan")] * 8, 0), (103, VECTORS[0][1], None), (104, VECTORS[0][1], 0)]
SCHEMA = "vec_id bigint, embedding array<double>, label int"


def test_lines(spark):
    run = "one two\nthree four\nfive six"
    table = [(1, f"start\n{run}\nend"), (2, f"other\n{run}\nlast"), (3, None), (4, ""), (2, f"other\n{run}\nlast"), (5, "end\nstart")]
    docs = spark.createDataFrame(table, "doc_id bigint, text string")
    got = [tuple(r) for r in lines.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "kept_text").collect()]
    both = (2, 5, 3, "other\nlast")
    first = (1, 5, 0, table[0][1])
    assert sorted(got) == [first, both, both, (3, 0, 0, ""), (4, 0, 0, ""), (5, 2, 0, "end\nstart")]
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_lines_counts_the_words_of_a_run(spark):
    def line(tag, n):
        return " ".join(f"{tag}{i}" for i in range(n))

    two, few, four = f"{line('a', 35)}\n{line('b', 30)}", f"{line('c', 9)}\n{line('d', 9)}", [line(t, 14) for t in "efg"]
    table = [(i, f"start {i}\n{two}\nmiddle {i}\n{few}\nend {i}\n" + "\n".join(four)) for i in range(3)]
    docs = spark.createDataFrame(table, "doc_id bigint, text string")
    # Three lines count by their words where min_lines is more, as do two; two short lines never do.
    for min_lines in (3, 5, 8):
        got = {r["doc_id"]: r["kept_text"] for r in lines.dedup_lines(docs, min_lines=min_lines).collect()}
        assert got == {i: table[i][1] if i == 0 else f"start {i}\nmiddle {i}\n{few}\nend {i}" for i in range(3)}


def test_bitsearch(spark):
    table = spark.createDataFrame(VECTORS, SCHEMA)
    got = bitsearch.nearest(table, table["vec_id"] % 20 == 0, 5).orderBy("query_id", "rank").collect()
    held = [v for v in VECTORS if v[0] not in (100, 101, 102)]
    for q in (0, 20, 40):
        mine = next(v[1] for v in held if v[0] == q)
        want = sorted((-float(np.dot(v[1], mine)), v[0]) for v in held if v[0] != q)[:5]
        assert [r["vec_id"] for r in got if r["query_id"] == q] == [i for _, i in want]
    assert bitsearch.nearest(table.limit(0), table["vec_id"] % 20 == 0, 5).count() == 0


def test_nndescent(spark):
    got = {r[0]: tuple(r)[1:] for r in nndescent.near_duplicates(spark.createDataFrame(VECTORS, SCHEMA)).collect()}
    # Ids 2k and 2k + 1 hold one vector; 104 repeats that of 0 and 1, and 103 has no label.
    assert got[0] == (2, 0, True) and got[1] == (2, 0, False) and got[104] == (2, 0, False)
    assert all(got[i] == (0, i, True) for i in (100, 101, 102, 103))
    assert all(got[i] == (1, i - i % 2, i % 2 == 0) for i in range(2, 60))


def test_nndescent_joins_groups_with_saturated_lists(spark):
    # Two groups of nine: 0.99 within, 0.94 across. Every list of eight fills inside its own group.
    table = []
    for g in range(150):
        q = np.linalg.qr(np.random.default_rng(g).standard_normal((64, 64)))[0]
        for half in range(2):
            for i in range(9):
                v = np.sqrt(0.94) * q[0] + np.sqrt(0.05) * q[1 + half] + np.sqrt(0.01) * q[3 + 9 * half + i]
                table.append((18 * g + 9 * half + i, v.tolist(), g % 2))
    got = nndescent.near_duplicates(spark.createDataFrame(table, SCHEMA).repartition(4)).collect()
    assert sorted(map(tuple, got)) == [(i, 17, i - i % 18, i % 18 == 0) for i in range(2700)]


def test_mixing(spark):
    table = [(i, ("sun rain wind " if i % 3 else "iron coal tin ") * (1 + i % 5)) for i in range(300)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(table, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id bigint, sky int")
    from pyspark.sql import functions as F

    model = mixing.train(docs, labels, F.when(F.col("sky") == 1, "sky").otherwise("earth"), ["sky", "earth"])
    got = mixing.mix(docs, model, {"sky": 0.4, "earth": 0.6}).toPandas()
    assert len(got) == 302 and (got["rate"] >= 0).all()
    # Documents that the classifier has not seen get their own domain.
    late = got[(got["doc_id"] >= 60) & (got["doc_id"] < 300)]
    assert all((p[0] > 0.5) == (i % 3 > 0) for i, p in zip(late["doc_id"], late["posteriors"]))
    sums = (got["rate"] * got["tokens"]).values @ np.stack(got["posteriors"].to_list())
    assert np.allclose(sums / got["tokens"].sum(), [0.4, 0.6], atol=1e-3)
    assert mixing.mix(docs.limit(0), model, {"sky": 0.4, "earth": 0.6}).count() == 0


def test_mixing_reads_a_text_by_one_worker(spark, capsys):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, f"star {i}" if i % 2 else "stone river") for i in range(20)], "doc_id int, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id int, sky int")
    model = mixing.train(docs, labels, F.when(F.col("sky") == 1, "sky").otherwise("earth"), ["sky", "earth"])
    mixed = mixing.mix(docs, model, {"sky": 0.4, "earth": 0.6})
    mixed.where("copies > 0").explain()
    plan = capsys.readouterr().out
    assert plan.count("EvalPython") == 1, plan
    for r in mixed.collect():
        assert r.tokens == 2 and abs(sum(r.posteriors) - 1) < 1e-9 and r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1)


def test_mixing_reads_no_text_for_the_rates(spark, capsys):
    from pyspark.sql import functions as F

    texts = ["Star  star\tSTAR moon", None, "", "Stein \u00c4hre stein"]
    docs = spark.createDataFrame([(i, t, i * 2) for i, t in enumerate(texts)], "doc_id int, text string, more int")
    model = mixing.train(docs, docs.where("doc_id in (0, 3)").select("doc_id"), F.lit("all"), ["all"])
    mixed = mixing.mix(docs, model, {"all": 1.0})
    mixed.explain()
    plan = [line for line in capsys.readouterr().out.splitlines() if "EvalPython" in line]
    assert len(plan) == 1 and "posteriors" in plan[0].split("]")[0] and "text" not in plan[0].split("]")[0], plan
    got = sorted(map(tuple, mixed.select("doc_id", "text", "more", "tokens", "rate", "copies").collect()))
    assert got == [(i, t, i * 2, len((t or "").split()), 1.0, 1) for i, t in enumerate(texts)]
    at, x = mixing.features(texts[0])
    assert len(at) == 2 and np.allclose(np.sort(x) * np.sqrt(np.log(2) ** 2 + np.log(4) ** 2), [np.log(2), np.log(4)])


def test_a_worker_holds_one_object_at_a_time():
    from affinia.llm import common

    first = common.held("a", lambda: [1])
    assert common.held("a", lambda: [2]) is first
    assert common.held("b", lambda: [3]) == [3] and list(common._held) == ["b"]
    common.let_go()
    assert not common._held
