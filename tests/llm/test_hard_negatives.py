import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from engram.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y, "clash", "clash")
                                  for i, v, y in rows], SCHEMA)


def mined(spark, rows, **kw):
    out = H.hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0, F.col("label"), **kw).collect()
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in out)


def brute(rows):
    use = {}
    for i, v, y in rows:
        if i is None or v is None or y is None or not len(v) or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = tuple(math.floor(256 * float(np.float32(c))) for c in v)
        if sum(c * c for c in x) < 2 ** 62:
            use[i] = min(use.get(i, (y, [float(c) for c in v], x)), (y, [float(c) for c in v], x))
    out = []
    for a, (ya, _, xa) in use.items():
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(xa, x)), i, y) for i, (y, _, x) in use.items() if i != a and len(x) == len(xa))
        for sp, p, _ in [s for s in scored if s[2] == ya][:5]:
            fit = [(n, -sn) for sn, n, y in scored if y != ya and 80 * -sp <= 100 * -sn <= 100 * -sp]
            out += [(a, p, k + 1, n, -sp, sn) for k, (n, sn) in enumerate(fit[:5])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(12)
    centres = r.normal(size=(4, 20)) * 0.2
    rows = [(i, (centres[i % 4] + 0.15 * r.normal(size=20)).astype(np.float32), int(r.integers(0, 4))) for i in range(1500)]
    same = rows[200][1]
    rows += [(2000 + i, same, i % 3) for i in range(450)]                  # a large group of equal vectors
    rows += [(3000, None, 1), (3100, same, None), (3200, [float("nan")] * 20, 1), (3300, [None, *same[1:]], 1), (3400, [], 1),
             (3500, [0.0] * 20, 1), (3600, [3e38] * 20, 1), (None, same, 1), (3700, [0.1, 0.2, 0.3], 1), (3701, [0.1, 0.2, 0.3], 1),
             (3702, [0.1, 0.2, 0.29], 2), (100, rows[100][1], rows[100][2]), (300, same, 0), (3800, [2.0 ** 20] * 20, 1),
             (3801, [2.0 ** 20] * 20, 1), (3802, [2.0 ** 20 - 1] * 20, 2), (3900, -same, 9), (3901, same, 9)]
    return rows


@pytest.mark.parametrize("kw", [{}, {"block_rows": 100, "block_anchors": 4}])
def test_against_all_pairs(spark, rows, kw):
    assert mined(spark, rows, **kw) == brute(rows)


def test_intervals_hold_and_filter():
    """Every exact product lies in its interval, and most rows of a clustered set are filtered."""
    r = np.random.default_rng(7)
    kept = []
    for dim in (3, 64, 100):
        group = r.integers(0, 10, 2000)
        x = np.floor(256 * (r.normal(size=(10, dim))[group] + 0.1 * r.normal(size=(2000, dim))))
        x[:5] = 0
        centres = H.fitted(x, 12)
        of = H.nearest_centre(x, centres)
        q = x[3:60]
        for cell in range(12):
            here = np.flatnonzero(of == cell)
            if not len(here):
                continue
            codes = H.Codes(here, np.zeros(len(here), np.int32), x[here], *H.encode(x[here], centres[cell]), centres[cell])
            lo, hi = codes.intervals(q)
            exact = q @ x[here].T
            assert (lo <= exact).all() and (exact <= hi).all()
            if dim > 3:
                best = np.sort(q[5:] @ x.T, axis=1)[:, -5]
                kept += ((hi[5:] >= best[:, None]).mean(axis=1) * len(here) / len(x)).tolist()
    assert sum(kept) / (2 * len(q[5:])) < 0.2


def test_empty_tables(spark, rows):
    none = frame(spark, rows[:1]).limit(0)
    out = H.hard_negatives(none, F.col("vec_id") % 100 == 0, F.col("label"))
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and out.collect() == []
    assert mined(spark, rows[:1]) == []
