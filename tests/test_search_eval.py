"""Fusion, budget, vector top-k, BM25 and eval edge cases (OP-31..35, 42, W1, W2)."""

import math
import os
import random
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from engram.operators import evaluate as E
from engram.operators import search as S

HIT = "query_id long, doc_id long, rank int"


def test_rrf_one_leg_ties_empty_and_order(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], HIT)
    b = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], HIT)
    empty = spark.createDataFrame([], HIT)
    f1 = {(r["doc_id"]): r["rank"] for r in S.rrf_fuse({"a": a, "b": b, "c": empty}, 10).collect()}
    f2 = {(r["doc_id"]): r["rank"] for r in S.rrf_fuse({"b": b, "a": a}, 10).collect()}
    assert f1 == f2 == {11: 1, 10: 2, 12: 3}  # 10 and 12 tie on rrf; id breaks it


def lines_df(spark, costs):
    return spark.createDataFrame([(1, 1, i, "x" * (4 * c)) for i, c in enumerate(costs)],
                                 "query_id long, rank int, line_no int, line string")


@pytest.mark.parametrize("costs,budget,kept", [
    ([900, 1], 800, 0),        # first fact over budget -> nothing
    ([400, 400], 800, 2),      # exact fit kept
    ([500, 400, 1], 800, 1),   # small fact after an overflow is not kept (prefix stop)
    ([1], 0, 0),               # budget 0
])
def test_budget_prefix_stop(spark, costs, budget, kept):
    assert S.recall_budget(lines_df(spark, costs), budget).count() == kept


def test_cost_floor(spark):
    df = spark.createDataFrame([(1, 1, 0, "ab")], "query_id long, rank int, line_no int, line string")
    assert S.recall_budget(df, 10).first()["cost"] == 1


def test_vector_search_matches_numpy(spark):
    rnd = np.random.default_rng(3)
    v = rnd.normal(size=(300, 8)).astype(np.float32)
    v[5] = v[4]  # an exact tie
    q = rnd.normal(size=(4, 8))
    vecs = spark.createDataFrame([(i, v[i].tolist()) for i in range(len(v))], "vec_id long, embedding array<float>")
    qs = spark.createDataFrame([(j, q[j].tolist()) for j in range(len(q))], "query_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): r["doc_id"] for r in S.vector_search(vecs.repartition(7), qs, 5).collect()}
    vd = v.astype(np.float64)
    for j in range(len(q)):
        s = np.round(vd @ q[j] / np.linalg.norm(vd, axis=1) / np.linalg.norm(q[j]), 9)
        order = sorted(range(len(v)), key=lambda i: (-s[i], i))[:5]
        assert [got[(j, k + 1)] for k in range(5)] == order


def test_bm25_matches_formula(spark):
    docs = [(1, "apple banana apple"), (2, "banana cherry"), (3, "cherry cherry cherry date"), (4, "")]
    qs = [(7, "Apple cherry"), (8, "zzz")]
    got = {(r["query_id"], r["doc_id"]): r["score"] for r in S.bm25_scores(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(qs, "query_id long, text string")).collect()}
    toks = {d: t.split() for d, t in docs}
    n, avgdl = len(docs), sum(len(t) for t in toks.values()) / len(docs)
    exp = {}
    for qid, qt in qs:
        for d, t in toks.items():
            sc, hit = 0.0, False
            for term in set(qt.lower().split()):
                df = sum(term in x for x in toks.values())
                tf = t.count(term)
                if tf:
                    hit = True
                    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                    sc += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / avgdl))
            if hit:
                exp[(qid, d)] = round(sc, 9)
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k], abs=1e-9)


def test_top_k_skewed_group(spark):
    rnd = random.Random(1)
    rows = [(1, i, float(rnd.randint(0, 50))) for i in range(3000)] + [(2, 1, 1.0)]
    df = spark.createDataFrame(rows, "query_id long, doc_id long, score double")
    got = [r["doc_id"] for r in S.leg_rank(df, 7).filter("query_id = 1").orderBy("rank").collect()]
    exp = [d for _, d, _ in sorted(rows[:-1], key=lambda r: (-r[2], r[1]))[:7]]
    assert got == exp


def test_eval_cases(spark):
    cases = spark.createDataFrame([(1, "q1", []), (2, "q2", ["Apple", "kiwi"]), (3, "q3", ["x"])],
                                  "case_id long, query string, expect array<string>")
    res = spark.createDataFrame([(2, 100, 1), (1, 100, 1)], HIT)
    texts = spark.createDataFrame([(100, "An APPLE a day")], "doc_id long, text string")
    m = E.eval_match(cases, res, texts, 20)
    hits = {(r["case_id"], r["needle"]): r["hit"] for r in m.collect()}
    assert hits == {(2, "apple"): True, (2, "kiwi"): False, (3, "x"): False}
    r = E.eval_recall(cases, m).first()
    assert (r["passed"], r["total"], r["ok"]) == (1, 3, False)
    with pytest.raises(ValueError):
        E.eval_recall(cases.limit(0), m)
    h = E.facts_text(spark.createDataFrame([(1, 100, 2), (1, 101, 1)], HIT),
                     spark.createDataFrame([(100, "B"), (101, "A")], "doc_id long, text string"), 2).first()
    assert h["haystack"] == "a\nb"
    _ = F


GRAPHED = "graph string, doc_id long, text string"


def test_tiers_do_not_mix_and_count_apart(spark):
    units = spark.createDataFrame([("a", 1, "apple pie"), ("a", 2, "plum"), ("b", 3, "apple tart apple"), ("b", 4, "")], GRAPHED)
    qs = spark.createDataFrame([(1, "a", "apple"), (2, "b", "apple"), (3, "c", "apple")], "query_id long, graph string, text string")
    alone = {g: {r["doc_id"]: r["score"] for r in S.bm25_scores(units.filter(F.col("graph") == g), qs.filter(F.col("graph") == g)).collect()}
             for g in ("a", "b")}
    both = {(r["query_id"], r["doc_id"]): r["score"] for r in S.bm25_scores(units, qs).collect()}
    assert both == {(1, 1): alone["a"][1], (2, 3): alone["b"][3]}
    vecs = spark.createDataFrame([("a", 1, [1.0, 0.0]), ("b", 3, [1.0, 0.0])], "graph string, vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(1, "a", [2.0, 0.1])], "query_id long, graph string, embedding array<double>")
    assert [r["doc_id"] for r in S.vector_search(vecs, asked, 5).collect()] == [1]


def test_a_leg_changes_the_ranking(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], HIT)
    b = spark.createDataFrame([(1, 11, 1)], HIT)
    one = [r["doc_id"] for r in S.rrf_fuse({"a": a}, 5).orderBy("rank").collect()]
    two = [r["doc_id"] for r in S.rrf_fuse({"a": a, "b": b}, 5).orderBy("rank").collect()]
    assert one == [10, 11] and two == [11, 10]


def test_scoring_exchanges_only_postings(spark):
    post = S.postings(spark.createDataFrame([(i, f"w{i % 5} w{i % 3}") for i in range(50)], "doc_id long, text string"))
    qs = spark.createDataFrame([(1, "w1 w2")], "query_id long, text string")
    plan = S.score_postings(post, qs)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query_id" not in plan


def test_index_is_kept_until_its_files_change(spark, tmp_path):
    from engram.operators import lexical as LX
    from engram.session import drop_path

    at, made = f"{tmp_path}/d.parquet", []

    def write(rows):
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/new")
        part = next(f for f in os.listdir(f"{tmp_path}/new") if f.endswith(".parquet"))
        os.makedirs(at, exist_ok=True)
        shutil.copyfile(f"{tmp_path}/new/{part}", f"{at}/same-name.parquet")

    def index():
        src = spark.read.parquet(at)
        return LX.lexical_index(spark, "t", src, lambda: made.append(1) or src)

    write([(1, "a b"), (2, "b c")])
    one, two = index(), index()
    assert made == [1] and one.inputFiles() == two.inputFiles() and one.count() == 6
    write([(1, "a z"), (2, "b c"), (3, "zz")])        # the same file name, other content
    q = spark.createDataFrame([(1, "zz")], "query_id long, text string")
    assert [r["doc_id"] for r in S.bm25_search(index(), q, 5).collect()] == [3] and made == [1, 1]
    assert not any(os.path.exists(f.removeprefix("file:")) for f in one.inputFiles())   # the old version is gone
    LX.drop_kept(spark)
    index()
    assert made == [1, 1, 1]
    drop_path(spark, f"{tmp_path}/nothing-there")


def test_scope_counts_and_ranks_alone(spark):
    units = spark.createDataFrame([(1, "x", "apple pie"), (2, "y", "apple"), (3, "x", "plum"), (4, None, "apple")],
                                  "doc_id long, group_id string, text string")
    q = spark.createDataFrame([(1, "apple")], "query_id long, text string")
    post = S.postings(units, ["doc_id", "group_id"])
    alone = S.bm25_search(S.postings(units.filter("group_id = 'x'")), q, 5).collect()
    assert S.bm25_search(S.scoped(post, ["x"]), q, 5).collect() == alone and [r["doc_id"] for r in alone] == [1]
    assert S.bm25_search(S.scoped(post, None), q, 5).count() == S.bm25_search(S.scoped(post, []), q, 5).count() == 3


def test_units_are_scored_without_a_row_per_query_and_unit(spark):
    """Units (ids twice, null and alike included) give the rows that postings give, and no plan
    joins queries to postings."""
    units = [("a" if i % 3 else "b", i, "g", " ".join(f"w{(i * j) % 11}" for j in range(1, 2 + i % 9))) for i in range(120)]
    units += [("a", 5, "g", "w1 w1 w2"), ("a", 5, "h", "w3"), ("a", 7, "g", units[7][3]), ("b", 6, "g", ""), ("a", None, "g", "w1"), ("a", None, "h", "w1 w2")]
    df = spark.createDataFrame(units, "graph string, doc_id long, group_id string, text string")
    qs = spark.createDataFrame([(1, "a", "w1 w2 w3"), (2, "b", "w4"), (3, "a", "none"), (4, "a", "w5 w5 w1"), (4, "a", "w1"), (5, "c", "w1"), (6, "a", None)],
                               "query_id long, graph string, text string")
    ids = ["doc_id", "group_id"]
    post, kept = S.postings(df, ids), S.unit_terms(df, ids)
    plain = lambda df: sorted(map(str, df.withColumn("tf", F.expr("if(term is null, 1, tf)")).select(*post.columns).collect()))
    assert plain(S.posting_rows(kept)) == plain(post)
    for k in (1, 4, 500):
        for groups in (None, ["g"]):
            got = S.bm25_search(S.scoped(kept, groups), qs, k)
            assert sorted(map(str, got.collect())) == sorted(map(str, S.bm25_search(S.scoped(post, groups), qs, k).collect()))
    plan = S.bm25_search(S.unit_terms(df.filter("doc_id >= 8"), ids), qs, 4)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan


def test_best_units_over_blocks(spark, monkeypatch):
    """Blocks of a few rows: ties to the smaller id whatever block it stands in."""
    monkeypatch.setattr(S, "VECTOR_BLOCK_BYTES", 64)
    vecs = spark.createDataFrame([("a", i, [float(i % 4), 1.0]) for i in range(60)] + [("a", 99, [0.0, 0.0])], "graph string, vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(1, "a", [3.0, 1.0]), (2, "a", [0.0, 2.0])], "query_id long, graph string, embedding array<double>")
    got = S.vector_search(vecs, asked, 3).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["doc_id"]) for r in got] == [(1, 3), (1, 7), (1, 11), (2, 0), (2, 4), (2, 8)]


def test_a_line_is_taken_apart_once(spark, tmp_path):
    """Topic: the longest word, the first of equal ones; the words of a line are split once."""
    from engram.plans import derive
    from engram.sources.tables import Tables

    rows = [(1, "a ccc bbb\n...\n\nx", "en", "src1"), (2, None, "en", "src2"), (3, "Zz zzz ZZZ", None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    facts = derive.line_facts(Tables(spark, str(tmp_path)))
    assert sorted((r["doc_id"] % derive.LINES, r["topic"]) for r in facts.collect()) == [(0, "ccc"), (0, "zzz"), (1, None), (3, "x")]
    assert facts.select("topic")._jdf.queryExecution().optimizedPlan().toString().count("split(lower") == 1


def test_embedder_works_in_slices_of_text(monkeypatch):
    import pandas as pd

    from engram.operators import ontology as O

    texts = pd.Series(["a b a", None, "", "c " * 50, "!", "b"] * 3)
    whole = O.hashing_embedder(8)(texts)
    monkeypatch.setattr(O, "EMBED_CHARS", 5)
    sliced = O.hashing_embedder(8)(texts)
    assert [list(v) for v in whole] == [list(v) for v in sliced] and str(sliced[0].dtype) == "float32"
    (at, sign), = {O.term_slot("c", 8)}
    assert sliced[3][at] == 50 * sign and not any(sliced[1]) and not any(sliced[4])
