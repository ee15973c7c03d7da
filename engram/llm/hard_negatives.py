"""Hard negatives by rotated one-bit codes.

Vectors (whole numbers) are taken relative to the nearest of a few centres m, which are
fitted on a bounded sample: <x, q> = <x - m, q - m> + <x - m, m> + <m, q>. The rest
z = x - m is rotated by a fixed random orthogonal matrix and coded by the signs of its
components: c = signs / sqrt(D) is a unit vector, and the stored alignment a = <z, c>
splits z into a c + r with |r|^2 = |z|^2 - a^2. For an anchor's rest p = q - m, rotated and
rounded to ``BITS`` bits a component (rounding error e), popcounts of its bit planes with
the code give b = <p', c>, and by Cauchy-Schwarz

    |<z, p> - a b|  <=  |r| sqrt(|p'|^2 - b^2) + |z| |e|.

The interval is certain, not likely, so nothing is lost by what follows:

1. Positives: of the anchor's label, a row survives if its upper end reaches the k-th
   largest lower end; survivors are scored exactly.
2. Negatives of a positive with score p: a row of another label survives if its interval
   meets [low p, p] and its upper end reaches the k-th largest lower end among rows whose
   whole interval lies inside. Survivors are scored exactly, in whole numbers.

Anchors meet the stored codes in blocks: the rows of a centre are dealt into blocks of
``BLOCK_ROWS``, and each block's task holds its rows while the anchors pass in batches;
blocks that many anchors visit are copied. A task reports k rows an anchor (and positive), merged by a
window with a partial limit. Nothing is collected but the sample of the centres. The
intervals are as wide as the rests are long: clustered vectors are mostly filtered, on
vectors without any structure nearly all are scored.

Defined results: rows with a null id, label or vector, with an empty vector or any null or
non-finite component take no part, nor do rows whose scaled vector is 2^31 long or more
(their scores may not fit a long); of rows that share an id the one with the smallest
label, then vector, stands for it; vectors of different lengths are never compared; ties go
to the smaller id; fewer rows than asked for are all returned; empty tables give an empty
result; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from engram.llm.common import query, table, written
from engram.llm.vectors import meet, one_row_an_id, rows_of, stacked
from engram.session import ship_package

BITS = 6
BLOCK_ROWS = 8192           # rows of a block
CENTRE_ROWS = 2048          # rows a centre, on average
MAX_CENTRES = 256
SAMPLE = 16384              # rows that the centres are fitted on
BLOCK_ANCHORS = 16384       # anchors a copy of a block serves
TOGETHER = 64               # anchors whose intervals are held at once
EXACT = 2.0 ** 53           # whole doubles are exact below


@lru_cache(8)
def rotation(size: int) -> np.ndarray:
    """A fixed random orthogonal matrix (rows beyond the vector's length meet padding)."""
    q, r = np.linalg.qr(np.random.default_rng(12).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def rotated(x: np.ndarray) -> np.ndarray:
    """Rows turned by the rotation, padded with zeros to whole 64-bit words."""
    size = -(-x.shape[1] // 64) * 64
    return np.pad(x, ((0, 0), (0, size - x.shape[1]))) @ rotation(size).T


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words."""
    return np.packbits(bits, axis=1).view(np.uint64)


def fitted(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """``k`` centres of the rows (k-means from evenly spread rows)."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        of = nearest_centre(x, c)
        n = np.bincount(of, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, of, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return np.rint(c)


def nearest_centre(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(axis=1)[None, :] - 2 * (x @ c.T), axis=1)


def encode(x: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and alignments of rows relative to their centres."""
    y = rotated(x - centre)
    return packed(y >= 0), np.abs(y).sum(axis=1) / np.sqrt(y.shape[1])


class Codes:
    """The stored rows of a block, all of one centre."""

    def __init__(self, ids, label, rows, code, align, centre):
        order = np.argsort(ids, kind="stable")
        self.ids, self.label, self.rows, self.code, self.align = (x[order] for x in (ids, label, rows, code, align))
        self.centre, rest = centre, self.rows - centre
        self.norm = np.sqrt((rest * rest).sum(axis=1))
        self.off = np.sqrt(np.maximum(0.0, self.norm ** 2 - self.align ** 2))
        self.base = rest @ centre
        self.ones = np.bitwise_count(self.code).sum(axis=1, dtype=np.int64)
        self.top = float(np.abs(self.rows).max(initial=0))

    def intervals(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper ends of the products of anchors (rows of ``q``) and stored rows."""
        y = rotated(q - self.centre)
        d, low = y.shape[1], y.min(axis=1, keepdims=True)
        step = np.maximum((y.max(axis=1, keepdims=True) - low) / (2 ** BITS - 1), 1e-300)
        u = np.rint((y - low) / step).astype(np.int64)
        near = low + step * u
        lost = np.sqrt(((y - near) ** 2).sum(axis=1))
        hits = np.zeros((len(q), len(self.ids)), np.int32)
        for bit in range(BITS):
            plane = packed((u >> bit) & 1 == 1)
            for w in range(plane.shape[1]):
                hits += np.bitwise_count(plane[:, w:w + 1] & self.code[None, :, w]).astype(np.int32) << bit
        b = (step * (2 * hits - u.sum(axis=1, keepdims=True)) + low * (2 * self.ones - d)[None, :]) / np.sqrt(d)
        shift = (q @ self.centre)[:, None]
        mid = b * self.align + self.base + shift
        np.multiply(b, b, out=b)
        np.subtract((near ** 2).sum(axis=1, keepdims=True), b, out=b)
        wide = np.sqrt(np.maximum(b, 0.0, out=b), out=b)
        wide *= self.off
        # the last terms cover the rounding of the doubles themselves
        wide += self.norm * (lost + 1e-9 * np.sqrt((y * y).sum(axis=1)))[:, None]
        wide += 1e-9 * (np.abs(self.base) + np.abs(shift)) + 1e-6
        return mid - wide, mid + wide

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact products in whole numbers."""
        if self.top * float(np.abs(q).max(initial=0)) * len(q) < EXACT:
            most = 2 * len(at) > len(self.rows)
            return ((self.rows @ q)[at] if most else self.rows[at] @ q).astype(np.int64)
        return self.rows[at].astype(np.int64) @ q.astype(np.int64)

    def best(self, at: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """Positions of the k best (ties: smaller id; rows are in order of id)."""
        return np.lexsort((at, -score))[:k]


def _kth(x: np.ndarray, k: int) -> float:
    return float(np.partition(x, len(x) - k)[len(x) - k]) if len(x) >= k else -np.inf


def whole(flat: np.ndarray, at: np.ndarray, here: np.ndarray, n: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``here`` of length n as whole numbers, and those whose products fit a long."""
    x = np.floor(scale * flat[at[here][:, None] + np.arange(n)]) + 0.0
    with np.errstate(over="ignore"):
        fits = (x * x).sum(axis=1) < 2.0 ** 62
    return here[fits], x[fits]


def _centres(rows: DataFrame, scale: int) -> tuple[int, np.ndarray]:
    """Centres of the commonest vector length, fitted on ``SAMPLE`` rows at most."""
    size = F.size("vec")
    top = rows.groupBy(size.alias("d")).agg(F.count(F.lit(1)).alias("n")).filter("d > 0").orderBy(F.desc("n"), "d").limit(1).collect()
    if not top:
        return 0, np.zeros((0, 0))
    d, n = top[0]["d"], top[0]["n"]
    some = rows.filter(size == d).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").collect()
    _, x = whole(np.array([r["vec"] for r in some]).ravel(), np.arange(len(some)) * d, np.arange(len(some)), d, scale)
    if not len(x):
        return 0, np.zeros((0, 0))
    return d, fitted(x, min(MAX_CENTRES, len(x), -(-n // CENTRE_ROWS)))


def _encoded(df: DataFrame, scale: int, d: int, centres: np.ndarray) -> DataFrame:
    """(id, label, dim, cell, row, code, align) of (id, x0 = label, vec)."""
    def run(batches):
        for b in batches:
            flat, at = rows_of(b.column(2))
            size = np.diff(at)
            rows, codes = [None] * b.num_rows, [None] * b.num_rows
            cell, align, keep = np.full(b.num_rows, -1), np.zeros(b.num_rows), np.zeros(b.num_rows, bool)
            for n in np.unique(size[size > 0]).tolist():
                here, x = whole(flat, at, np.flatnonzero(size == n), n, scale)
                if not len(here):
                    continue
                centre = np.zeros((1, n))
                if n == d:
                    cell[here] = of = nearest_centre(x, centres)
                    centre = centres[of]
                code, align[here] = encode(x, centre)
                keep[here] = True
                for i, r, c in zip(here.tolist(), x, code):
                    rows[i], codes[i] = r.tobytes(), c.tobytes()
            out = pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(size, pa.int32()), pa.array(cell, pa.int32()), pa.array(rows, pa.binary()),
                 pa.array(codes, pa.binary()), pa.array(align, pa.float64())],
                names=["id", "label", "dim", "cell", "row", "code", "align"])
            yield out.filter(pa.array(keep))
    return df.select("id", "x0", "vec").mapInArrow(run, "id bigint, label int, dim int, cell int, row binary, code binary, align double")


def _loader(centres: np.ndarray):
    def load(t: pa.Table) -> Codes:
        rows = stacked(t.column("row").to_pylist())
        code = np.frombuffer(b"".join(t.column("code").to_pylist()), np.uint64).reshape(t.num_rows, -1)
        cell = t.column("cell")[0].as_py()
        return Codes(t.column("id").to_numpy(), t.column("label").to_numpy(), rows, code, t.column("align").to_numpy(),
                     centres[cell] if cell >= 0 else np.zeros(rows.shape[1]))
    return load


def _tiles(stored: DataFrame, anchors: DataFrame, block_rows: int, block_anchors: int) -> DataFrame:
    """Rows and anchors of every block: (shard, kind, ...). Only the plan is broadcast: a
    few hundred centres with their numbers of blocks and of copies."""
    n = stored.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"))
    a = anchors.groupBy("dim").agg(F.count(F.lit(1)).alias("a"))
    plan = F.broadcast(n.join(a, "dim").select("dim", "cell", F.ceil(F.col("n") / block_rows).alias("blocks"),
                                               F.ceil(F.col("a") / block_anchors).alias("copies")))
    r = stored.join(plan, ["dim", "cell"]).select("*", F.pmod(F.xxhash64("id"), "blocks").alias("block"),
                                                  F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    q = anchors.drop("cell").join(plan, "dim").select("*", F.pmod(F.xxhash64("id"), "copies").alias("copy"),
                                                      F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    shard = F.concat_ws(":", "dim", "cell", "block", "copy").alias("shard")
    return (r.select(shard, F.lit(0).cast("tinyint").alias("kind"), "id", "label", "cell", "row", "code", "align",
                     F.lit(None).cast("array<struct<id:bigint,score:bigint>>").alias("wants"))
            .unionByName(q.select(shard, F.lit(1).cast("tinyint").alias("kind"), "id", "label", "cell", "row",
                                  F.lit(None).cast("binary").alias("code"), F.lit(0.0).alias("align"), "wants")))


def _slices(codes: Codes, b: pa.RecordBatch):
    """Anchors with their intervals, ``TOGETHER`` at a time."""
    q, ids, label = stacked(b.column("row").to_pylist()), b.column("id").to_numpy(), b.column("label").to_numpy()
    for at in range(0, len(q), TOGETHER):
        lo, hi = codes.intervals(q[at:at + TOGETHER])
        for i in range(len(lo)):
            yield at + i, ids[at + i], label[at + i], q[at + i], lo[i], hi[i]


def _positives(k: int):
    def ask(codes: Codes, b: pa.RecordBatch) -> pa.RecordBatch:
        out = [[], [], []]
        for _, me, label, q, lo, hi in _slices(codes, b):
            at = np.flatnonzero((codes.label == label) & (codes.ids != me))
            at = at[hi[at] >= _kth(lo[at], k)]
            score = codes.scores(at, q)
            best = codes.best(at, score, k)
            for x, v in zip(out, (np.full(len(best), me), codes.ids[at[best]], score[best])):
                x.append(v)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out],
                                          names=["anchor_id", "id", "score"])
    return ask


def _negatives(k: int, low: int, high: int):
    def ask(codes: Codes, b: pa.RecordBatch) -> pa.RecordBatch:
        wants, out = b.column("wants").to_pylist(), [[], [], [], [], []]
        for i, me, label, q, lo, hi in _slices(codes, b):
            other = codes.label != label
            need = np.zeros(len(other), bool)
            for w in wants[i]:
                floor, ceil = low * w["score"] / 100, high * w["score"] / 100
                inside = lo[other & (lo >= floor) & (hi <= ceil)]
                need |= other & (hi >= max(floor, _kth(inside, k))) & (lo <= ceil)
            at = np.flatnonzero(need)
            score = codes.scores(at, q)
            for w in wants[i]:
                p = w["score"]
                fit = np.flatnonzero((100 * score >= low * p) & (100 * score <= high * p)) if abs(p) < 1 << 55 and _small(score) else \
                    np.array([j for j, s in enumerate(score.tolist()) if low * p <= 100 * s <= high * p], np.int64)
                best = fit[codes.best(at[fit], score[fit], k)]
                for x, v in zip(out, (np.full(len(best), me), np.full(len(best), w["id"]), np.full(len(best), p),
                                      codes.ids[at[best]], score[best])):
                    x.append(v)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out],
                                          names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])
    return ask


def _small(score: np.ndarray) -> bool:
    """100 times any of them fits a long."""
    return not len(score) or int(np.abs(score).max()) < 1 << 55


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding",
                   positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
                   block_rows: int = BLOCK_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label, the first
    ``negatives`` rows of other labels that score ``low`` to ``high`` percent of the positive.

    -> (anchor_id, positive_id, rank, negative_id, positive_score, negative_score); scores are
    inner products of floor(scale * x). ``is_anchor`` is a condition on ``id_col``."""
    ship_package(vectors.sparkSession)
    rows = one_row_an_id(vectors.filter(label.isNotNull()), F.col(vec_col), id_col, label.cast("int"))
    rows = written(rows, "hard-rows")
    d, centres = _centres(rows, scale)
    stored, load = written(_encoded(rows, scale, d, centres), "codes"), _loader(centres)
    chosen = stored.withColumnRenamed("id", id_col).filter(is_anchor).withColumnRenamed(id_col, "id")
    none = F.lit(None).cast("array<struct<id:bigint,score:bigint>>")
    found = meet(_tiles(stored, chosen.withColumn("wants", none), block_rows, block_anchors),
                 "anchor_id bigint, id bigint, score bigint", load, _positives(positives))
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    wants = (found.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= positives).groupBy("anchor_id")
             .agg(F.array_sort(F.collect_list(F.struct("id", "score"))).alias("wants")))
    asked = written(chosen.join(wants.withColumnRenamed("anchor_id", "id"), "id"), "anchors")
    hard = meet(_tiles(stored, asked, block_rows, block_anchors),
                "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint",
                load, _negatives(negatives, low, high))
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (hard.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


SQL_OP12 = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id
      WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""


@query("op12_hard_negatives", SQL_OP12)
def op12_hard_negatives(spark: SparkSession, data_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 100."""
    vectors = table(spark, data_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0, label)
