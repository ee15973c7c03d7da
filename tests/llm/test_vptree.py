import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from engram.llm import vptree

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank string, cell string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "clash", "clash")
                                  for i, v in rows], SCHEMA)


def brute(rows, step=50, k=5):
    """query -> [(vec_id, cosine)] by comparing everything."""
    use = {}
    for i, v in rows:
        if i is None or v is None or not len(v) or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = np.float32(v).astype(np.float64)
        if x.any() and (i not in use or tuple(x) < tuple(use[i])):
            use[i] = x
    out = {}
    for q, a in use.items():
        if q % step == 0:
            near = [(-(a * b).sum() / np.sqrt((a * a).sum()) / np.sqrt((b * b).sum()), i)
                    for i, b in use.items() if i != q and len(a) == len(b)]
            out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in near)[:k]]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(13)
    centres = r.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.3 * r.normal(size=16)).astype(np.float32)) for i in range(1200)]
    same = rows[5][1]
    rows += [(2000 + i, same) for i in range(400)]                       # a large group of equal vectors
    rows += [(3000 + i, rows[i][1] * np.float32(4)) for i in range(60)]  # the same directions
    rows += [(4000, None), (4050, [0.0] * 16), (4100, [1.0, None] + [0.0] * 14), (4150, [float("nan")] * 16),
             (4200, [float("inf")] * 16), (4250, []), (None, same), (4300, [1.0, 2.0, 3.0]), (4301, [3.0, 2.0, 1.0]),
             (4350, [1.0]), (7, rows[7][1]), (100, rows[100][1]), (4400, -same), (4450, [3e38] * 16), (4500, [1e-38] * 16)]
    return rows


@pytest.mark.parametrize(("shard_rows", "shard_queries"), [(8192, 16384), (100, 3)])
def test_factor_one_is_exact(spark, rows, shard_rows, shard_queries):
    got = answers(vptree.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0, factor=1.0, shard_rows=shard_rows, shard_queries=shard_queries))
    want = brute(rows)
    assert got.keys() == {q for q, a in want.items() if a}
    for q in got:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


def test_tree_against_all_rows():
    r = np.random.default_rng(3)
    x = r.normal(size=(3000, 5))
    x[100:200] = x[50]
    t = vptree.Tree(np.arange(3000), x, leaf=4)
    q = x[::25] + 0.01 * r.normal(size=(120, 5))
    q[:5] = x[50]
    at, score = t.search(q, np.full(len(q), np.inf), 6, 1.0)
    s = (q @ x.T) / np.linalg.norm(q, axis=1)[:, None] / np.linalg.norm(x, axis=1)
    want = np.lexsort((np.broadcast_to(np.arange(3000), s.shape), -s.round(12)), axis=1)[:, :6]
    assert (at == want).all() and np.allclose(score, np.take_along_axis(s, want, 1), atol=1e-12)
    few, _ = t.search(q[:1], np.array([np.inf]), 6, 1.0)
    assert (few == want[:1]).all()


def test_recall_of_the_production_factor(spark):
    """Directions without any structure are the hardest case for the triangle inequality."""
    r = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(r.normal(size=(6000, 64)).astype(np.float32))]
    got, want = answers(vptree.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0, shard_rows=1000)), brute(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    for q in want:
        assert len(got[q]) == 5
        exact = dict(want[q])
        assert all(abs(exact[i] - s) < 1e-12 for i, s in got[q] if i in exact)


def test_queries_of_their_own_and_empty_tables(spark, rows):
    asked = frame(spark, [(9001, rows[3][1]), (2001, rows[5][1]), (9002, [0.0] * 16)])
    got = answers(vptree.nearest(frame(spark, rows), asked, factor=1.0))
    assert got.keys() == {9001, 2001} and got[9001][0][0] == 3
    assert [i for i, _ in got[2001]] == [5, 2000, 2002, 2003, 2004]
    none = frame(spark, rows[:1]).limit(0)
    assert vptree.nearest(none, F.col("vec_id") % 50 == 0).collect() == []
    assert vptree.nearest(none, asked).collect() == []
    assert vptree.nearest(frame(spark, rows[:1]), F.col("vec_id") % 50 == 0).collect() == []
