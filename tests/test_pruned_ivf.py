"""Block-pruned BM25 and cell search against the exact operators (OP-31, OP-32)."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from engram.operators import impact as IM
from engram.operators import ivf as IV
from engram.operators import search as S


@pytest.mark.parametrize("k", [1, 5, 40])
def test_pruned_equals_full_scoring(spark, k):
    r = random.Random(k)
    vocab = [f"w{i}" for i in range(300)]
    weight = [1 / (i + 1) for i in range(300)]

    def text(n):
        return " ".join(r.choices(vocab, weight, k=n))
    units = [(r.choice("ab"), i, text(r.choice([1, 5, 20, 200]))) for i in range(2500)] + [("a", 9000, ""), ("a", 9001, None), ("b", 9002, "w0 " * 500)]
    qs = [(q, r.choice("abc"), text(r.choice([1, 3, 8]))) for q in range(30)] + [(100, "a", ""), (101, "a", "unknown")]
    qs += [(200 + q, "a", f"w{150 + q} w0 w1") for q in range(20)]
    post = S.postings(spark.createDataFrame(units, "graph string, doc_id long, text string"))
    queries = spark.createDataFrame(qs, "query_id long, graph string, text string")
    blocks, stats = IM.impact_index(post, shard_units=8)
    want = sorted(map(tuple, S.bm25_search(post, queries, k).select("query_id", "doc_id", "score", "rank").collect()))
    for first in (1, 16):       # whatever the floor is taken from, the rows are the same
        got = IM.bm25_pruned(blocks, stats, queries, k, first).select("query_id", "doc_id", "score", "rank").collect()
        assert sorted(map(tuple, got)) == want
    counts = F.sum("blocks").alias("n"), F.sum(F.when(F.col("kept"), F.col("blocks"))).alias("kept")
    n = IM.kept_shards(blocks, stats, queries, k)[1].agg(*counts).head()
    rare = IM.kept_shards(blocks, stats, queries.filter("query_id >= 200"), k)[1].agg(*counts).head()
    print("kept", k, n.kept, n.n, rare.kept, rare.n)
    if k < 40:      # a rare word settles it; most of the common words' blocks are not read
        assert n.kept < 0.8 * n.n and rare.kept < 0.5 * rare.n


def test_pruned_on_empty_tables(spark):
    none = S.postings(spark.createDataFrame([], "graph string, doc_id long, text string"))
    q = spark.createDataFrame([(1, "a", "x")], "query_id long, graph string, text string")
    assert IM.bm25_pruned(*IM.impact_index(none), q, 3).collect() == []


def test_cells_find_most_and_all_of_them_everything(spark):
    r = np.random.default_rng(3)
    centres = r.normal(size=(20, 24))
    rows = [("a" if i % 3 else "b", i, (centres[i % 20] + 0.4 * r.normal(size=24)).astype(np.float32).tolist()) for i in range(3000)]
    rows += [("a", 5000, [0.0] * 24)]
    asked = [(q, "a" if q % 2 else "b", (centres[q % 20] + 0.4 * r.normal(size=24)).tolist()) for q in range(40)]
    v = spark.createDataFrame(rows, "graph string, vec_id long, embedding array<float>")
    q = spark.createDataFrame(asked, "query_id long, graph string, embedding array<double>")
    path, cells = IV.build_index(v, 16)
    exact = S.vector_search(v, q, 10)
    few = IV.recall(IV.search(spark, path, cells, q, 10, 3), exact).head()
    assert few.queries == 40 and few.answers == 400 and few.recall >= 0.9
    every = IV.search(spark, path, cells, q, 10, len(cells))
    key = ["query_id", "doc_id", "score", "rank"]
    assert sorted(map(tuple, every.select(*key).collect())) == sorted(map(tuple, exact.select(*key).collect()))


def test_blocks_are_cut_from_whole_units(spark):
    r = random.Random(8)
    units = [(r.choice("ab"), r.choice([i, i, 7, None]), " ".join(r.choices("abcdefgh", k=r.randrange(9)))) for i in range(300)]
    qs = spark.createDataFrame([(q, r.choice("ab"), " ".join(r.choices("abcdefghx", k=3))) for q in range(12)] + [(50, "a", None)],
                               "query_id long, graph string, text string")
    corpus = spark.createDataFrame(units, "graph string, doc_id long, text string")
    post = S.postings(corpus)
    whole, stats = IM.impact_index(S.unit_terms(corpus), shard_units=16)       # took postings only, moved one by one
    parts, stats2 = IM.impact_index(post, shard_units=16)
    key = lambda rows: sorted((str(x.graph), x.shard, x.term, x.n, round(x.top, 9), sorted(zip([round(i, 9) for i in x.impacts], map(str, x.ids)))) for x in rows)
    assert key(whole.collect()) == key(parts.collect())
    assert sorted(map(tuple, stats.collect())) == sorted(map(tuple, stats2.select(*stats.columns).collect()))
    want = sorted(map(str, S.bm25_search(post, qs, 4).select("query_id", "doc_id", "score", "rank").collect()))
    assert sorted(map(str, IM.bm25_pruned(whole, stats, qs, 4, 2).select("query_id", "doc_id", "score", "rank").collect())) == want


def test_the_sample_is_bounded_and_stays_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(IV, "SAMPLE", 500)
    r = np.random.default_rng(1)
    v = spark.createDataFrame([(i, r.normal(size=4).tolist()) for i in range(4000)], "vec_id long, embedding array<float>")
    seen = []
    whole = IV._directions
    monkeypatch.setattr(IV, "_directions", lambda df: seen.append(whole(df)) or seen[-1])
    assert IV.fit_cells(v, 8).shape == (8, 4)
    assert 300 < seen[0].count() < 700 and seen[0].rdd.getNumPartitions() > 1        # one task held it all
    assert all(abs(sum(x * x for x in row.unit) - 1) < 1e-9 for row in seen[0].collect())
