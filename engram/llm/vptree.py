"""Nearest neighbours by cosine: vantage-point trees per shard.

Chord distance sqrt(2 - 2 cos) between directions is a metric in which nearer means a
larger cosine, so the triangle inequality prunes: a set of points whose distances to a
vantage point lie in [lo, hi] has nothing nearer to q than max(lo - d(q), d(q) - hi).
A set is left out if that bound times ``factor`` exceeds the distance of the k-th best
found so far. ``factor`` 1 leaves out only what cannot matter (exact search); larger
values prune more and may miss.

1. Equal vectors are one class: its smallest ``k + 1`` ids stand for all of them, which
   is enough for every answer. Vectors move as classes, so a vector that fills a third of
   the table is one row.
2. Cells: the top levels of one vantage-point tree, fitted on a bounded sample
   (``SAMPLE_PER_CELL`` rows a cell, at most ``MAX_CELLS`` cells). Every class is assigned;
   each cell's true distance ranges to its vantage points come from all classes. A cell is
   dealt into shards of about ``shard_rows`` classes, each with a tree of its own.
3. Each query first searches its home cell. The k-th best distance found there and the
   cells' ranges choose the other cells it visits, by the same rule as inside a tree.
4. Tasks stream: a shard's vectors come first and become the tree, then its queries pass
   by batches. Shards that many queries visit are copied, so no task holds more than a
   shard and a batch. Every shard returns k + 1 rows a query at most; a window with a
   partial limit merges them.

Scores are computed on the original vectors in double precision (a product of sums, no
matrix library, so equal pairs get equal scores wherever they meet).

Defined results: rows with a null id or with a vector that is null, empty, zero or holds
null or non-finite components take no part; of rows that share an id, the smallest vector
stands for it; vectors of different lengths are never compared; ties go to the smaller id;
fewer candidates than ``k`` are all returned; empty tables give an empty result; other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from engram.llm.common import query, table, written
from engram.llm.vectors import meet, one_row_an_id, rows_of, scaled, stacked
from engram.session import ship_package

SHARD_ROWS = 8192           # classes of a shard, hence of a tree
SHARD_QUERIES = 16384       # queries a copy of a shard serves
LEAF = 64
MAX_CELLS = 4096
SAMPLE_PER_CELL = 32
SLACK = 1e-7                # chord distances of equal directions are off by up to 1e-8
SPARE = 4                   # candidates kept beyond k + 1 until they are scored exactly
#: Production setting of ``factor``; recall is measured in tests and README.
FACTOR = 4.0


# ---------------------------------------------------------------- trees
def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def chord(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between rows of two sets of directions."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def vantage(x: np.ndarray) -> int:
    """Of eight rows spread over the set, the one whose distances vary most."""
    tried = np.unique(np.linspace(0, len(x) - 1, 8).astype(int))
    return int(tried[np.argmax(chord(x[tried], x[:: max(1, len(x) // 256)]).var(axis=1))])


class Tree:
    """A vantage-point tree over the rows of a shard."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows, self.leaf = ids[order], rows[order], leaf
        self.norm = np.sqrt((self.rows * self.rows).sum(axis=1))
        self.unit = self.rows / self.norm[:, None]
        self.root = self._grow(np.arange(len(ids)))

    def _grow(self, at: np.ndarray):
        if len(at) <= self.leaf:
            return at
        v = at[vantage(self.unit[at])]
        d = chord(self.unit[at], self.unit[v:v + 1])[:, 0]
        order = np.argsort(d, kind="stable")
        half = len(at) // 2
        near, far = order[:half], order[half:]
        return (v, d[far[0]], (d[near[0]], d[near[-1]], self._grow(np.sort(at[near]))),
                (d[far[0]], d[far[-1]], self._grow(np.sort(at[far]))))

    def search(self, q: np.ndarray, tau: np.ndarray, k: int, factor: float):
        """Row numbers (-1: none) and exact scores of the k best rows of each query.
        ``tau``: distance of the k-th best known from elsewhere."""
        m, keep = len(q), k + SPARE
        unit = _unit(q)
        score = np.full((m, keep), -np.inf)
        row = np.full((m, keep), len(self.ids))
        bound = tau.copy()

        def look(at, act):
            s = np.concatenate((score[act], unit[act] @ self.unit[at].T), axis=1)
            r = np.concatenate((row[act], np.broadcast_to(at, (len(act), len(at)))), axis=1)
            best = np.lexsort((r, -s), axis=1)[:, :keep]
            score[act], row[act] = np.take_along_axis(s, best, 1), np.take_along_axis(r, best, 1)
            kth = score[act, k - 1]
            bound[act] = np.minimum(bound[act], np.where(kth > -np.inf, np.sqrt(np.maximum(0, 2 - 2 * kth)), np.inf))

        def visit(node, act):
            if not len(act):
                return
            if isinstance(node, np.ndarray):
                return look(node, act)
            v, border, near, far = node
            d = chord(unit[act], self.unit[v:v + 1])[:, 0]
            inside = d < border
            visit(near[2], act[inside])
            visit(far[2], act[~inside])
            for (lo, hi, child), others in ((far, inside), (near, ~inside)):
                a, da = act[others], d[others]
                visit(child, a[np.maximum(lo - da, da - hi) * factor <= bound[a] + SLACK])

        visit(self.root, np.arange(m))
        found = row < len(self.ids)
        at = np.where(found, row, 0)
        exact = ((q[:, None, :] * self.rows[at]).sum(axis=2)
                 / (np.sqrt((q * q).sum(axis=1))[:, None] * self.norm[at]))
        exact = np.where(found, exact, -np.inf)
        best = np.lexsort((row, -exact), axis=1)[:, :k]
        found = np.take_along_axis(found, best, 1)
        return np.where(found, np.take_along_axis(row, best, 1), -1), np.take_along_axis(exact, best, 1)


class Cells:
    """The top levels of a vantage-point tree: assigns directions to cells."""

    def __init__(self, sample: np.ndarray, levels: int):
        self.levels, self.dim = levels, sample.shape[1]
        n = (1 << levels) - 1
        self.points, self.border = np.zeros((n, self.dim)), np.zeros(n)
        self._fit(0, _unit(sample))

    def _fit(self, node: int, x: np.ndarray):
        if node >= len(self.border):
            return
        if not len(x):                      # cells below an empty side stay empty
            x = self.points[(node - 1) // 2][None, :]
        v = vantage(x)
        d = chord(x, x[v:v + 1])[:, 0]
        self.points[node], self.border[node] = x[v], np.median(d)
        self._fit(2 * node + 1, x[d < self.border[node]])
        self._fit(2 * node + 2, x[d >= self.border[node]])

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each row, and its distances to the vantage points on the way there."""
        node, ways = np.zeros(len(x), np.int64), np.zeros((len(x), self.levels))
        unit = _unit(x)
        for level in range(self.levels):
            p = self.points[node]
            ways[:, level] = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", unit, p)))
            node = 2 * node + 1 + (ways[:, level] >= self.border[node])
        return node - len(self.border), ways

    def bounds(self, x: np.ndarray, cells: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least distance that each row can have to each of the cells, by their ranges."""
        out = np.zeros((len(x), len(cells)))
        if self.levels:
            d = chord(_unit(x), self.points)
            node = cells + len(self.border)
            for level in range(self.levels - 1, -1, -1):
                node = (node - 1) // 2
                out = np.maximum(out, np.maximum(lo[None, :, level] - d[:, node], d[:, node] - hi[None, :, level]))
        return out


# ---------------------------------------------------------------- Spark side
def _assigned(df: DataFrame, cells: Cells | None, keep: list[str]) -> DataFrame:
    """(keep..., row, cell, ways): scaled vectors as binary, with their cell. Vectors of other
    lengths than the cells' get the cell -length and no distances."""
    schema = ", ".join([*(f"{c} {df.schema[c].dataType.simpleString()}" for c in keep), "row binary, cell bigint, ways array<double>"])

    def run(batches):
        for b in batches:
            flat, at = rows_of(b.column(len(keep)))
            size = np.diff(at)
            rows, cell, ways = [None] * b.num_rows, -size, [None] * b.num_rows
            for n in np.unique(size).tolist():
                here = np.flatnonzero(size == n)
                x = scaled(flat[at[here][:, None] + np.arange(n)])
                for i, r in zip(here.tolist(), x):
                    rows[i] = r.tobytes()
                if cells is not None and n == cells.dim:
                    cell[here], w = cells.assign(x)
                    for i, r in zip(here.tolist(), w.tolist()):
                        ways[i] = r
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(keep))), pa.array(rows, pa.binary()), pa.array(cell, pa.int64()),
                 pa.array(ways, pa.list_(pa.float64()))], names=[*keep, "row", "cell", "ways"])
    return df.select(*keep, "vec").mapInArrow(run, schema)


_FOUND = "qid bigint, cls bigint, score double"


def _search(parts: DataFrame, k: int, factor: float) -> DataFrame:
    """Best classes of each query in each shard. ``parts``: (shard, kind, id, row, tau) with a
    shard's vectors (kind 0) before its queries (kind 1) once sorted."""
    def load(stored):
        return Tree(stored.column("id").to_numpy(), stacked(stored.column("row").to_pylist()))

    def ask(tree, b):
        at, score = tree.search(stacked(b.column("row").to_pylist()), b.column("tau").to_numpy(), k, factor)
        ok = at >= 0
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(b.column("id").to_numpy(), ok.sum(axis=1)), pa.int64()),
             pa.array(tree.ids[at[ok]], pa.int64()), pa.array(score[ok], pa.float64())], names=["qid", "cls", "score"])
    return meet(parts, _FOUND, load, ask)


def _parts(stored: DataFrame, routed: DataFrame, sizes: dict[int, int], shard_rows: int, queries: int) -> DataFrame:
    """Vectors and the queries routed to their cells, by shard: (cell, chunk of the cell's
    vectors, part of its queries). The counts a cell (at most a few thousand) are literals."""
    spark = stored.sparkSession
    asked = {r["cell"]: r["n"] for r in routed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame([(c, -(-n // shard_rows), -(-asked[c] // queries)) for c, n in sizes.items() if c in asked],
                                 "cell bigint, chunks int, parts int")
    v = stored.join(F.broadcast(plan), "cell").select(
        "cell", F.pmod(F.xxhash64("cls"), "chunks").cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(0).cast("tinyint").alias("kind"), F.col("cls").alias("id"), "row", F.lit(0.0).alias("tau"))
    q = routed.join(F.broadcast(plan), "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.pmod(F.xxhash64("qid"), "parts").cast("int").alias("part"),
        F.lit(1).cast("tinyint").alias("kind"), F.col("qid").alias("id"), "row", "tau")
    return v.unionByName(q).select(F.concat_ws(":", "cell", "chunk", "part").alias("shard"), "kind", "id", "row", "tau")


def _elsewhere(asked: DataFrame, cells: Cells | None, table_: tuple, factor: float) -> DataFrame:
    """(qid, row, tau, cell) of the cells besides its own that a query must visit."""
    names, lo, hi = table_

    def run(batches):
        for b in batches:
            rows, tau, home = b.column(1).to_pylist(), b.column(2).to_numpy(), b.column(3).to_numpy()
            for s in range(0, len(rows), 512):
                here = np.array([i for i in range(s, min(len(rows), s + 512)) if home[i] >= 0], np.int64)
                if not len(here):
                    continue
                low = cells.bounds(stacked([rows[i] for i in here]), names, lo, hi)
                at, to = np.nonzero((low * factor <= tau[here][:, None] + SLACK) & (names[None, :] != home[here][:, None]))
                got = here[at]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(got)), b.column(1).take(pa.array(got)), b.column(2).take(pa.array(got)),
                     pa.array(names[to], pa.int64())], names=["qid", "row", "tau", "cell"])
    return asked.select("qid", "row", "tau", "cell").mapInArrow(run, "qid bigint, row binary, tau double, cell bigint")


def nearest(vectors: DataFrame, queries: DataFrame | Column, k: int = 5, factor: float = FACTOR, id_col: str = "vec_id",
            vec_col: str = "embedding", shard_rows: int = SHARD_ROWS, shard_queries: int = SHARD_QUERIES) -> DataFrame:
    """The ``k`` nearest vectors of each query by cosine -> (query_id, rank, vec_id, score).

    ``queries``: a condition that selects them among ``vectors``, or a table of its own with
    the same two columns. A vector with the query's id is no answer of its own query."""
    spark = vectors.sparkSession
    ship_package(spark)

    def rows(df):
        return one_row_an_id(df, F.col(vec_col), id_col).filter(F.exists("vec", lambda x: x != 0))

    every = written(rows(vectors), "vp-rows")
    asked = rows(vectors.filter(queries) if isinstance(queries, Column) else queries)
    first = Window.partitionBy("vec").orderBy("id")
    classes = (every.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1)
               .groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("cls", F.element_at("ids", 1)))
    classes = written(classes, "vp-classes")
    who = written(asked.select(F.col("id").alias("query_id"), "vec"), "vp-queries")
    kinds = who.groupBy("vec").agg(F.min("query_id").alias("qid"))
    who = who.join(kinds, "vec").select("query_id", "qid")

    size = F.size("vec")
    dims = classes.groupBy(size.alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    cells = None
    if dims:
        d, n = dims[0]["d"], dims[0]["n"]
        levels = min(int(np.log2(MAX_CELLS)), max(0, int(np.ceil(np.log2(n / shard_rows)))))
        some = classes.filter(size == d).orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE_PER_CELL << levels).select("vec")
        cells = Cells(scaled(np.array([r["vec"] for r in some.collect()])), levels)
    stored = written(_assigned(classes, cells, ["cls"]), "vp-stored")
    levels = cells.levels if cells else 0
    ranges = stored.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *[f(F.col("ways")[i]).alias(f"{name}{i}") for i in range(levels)
                                                                      for name, f in (("lo", F.min), ("hi", F.max))]).collect()
    sizes = {r["cell"]: r["n"] for r in ranges}
    own = sorted((r for r in ranges if r["cell"] >= 0), key=lambda r: r["cell"])
    names = np.array([r["cell"] for r in own], np.int64)
    lo, hi = (np.array([[r[f"{x}{i}"] for i in range(levels)] for r in own], np.float64).reshape(len(own), levels) for x in ("lo", "hi"))

    home = written(_assigned(kinds, cells, ["qid"]).select("qid", "row", "cell", F.lit(float("inf")).alias("tau")), "vp-home")
    near = written(_search(_parts(stored, home, sizes, shard_rows, shard_queries), k + 1, factor), "vp-found")
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "cls")
    kth = (near.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).filter(F.col("r") == k + 1)
           .select("qid", F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("score"))).alias("kth")))
    away = written(_elsewhere(home.join(kth, "qid", "left").withColumn("tau", F.coalesce("kth", "tau")), cells, (names, lo, hi), factor), "vp-away")
    far = _search(_parts(stored, away, sizes, shard_rows, shard_queries), k + 1, factor)

    top = near.unionByName(far).withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).select("qid", "cls", "score")
    ids = top.join(classes.select("cls", "ids"), "cls").select("qid", "score", F.explode("ids").alias("id"))
    answers = (ids.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "id"))).filter(F.col("r") <= k + 1)
               .groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("r", "id", "score"))).alias("a")))
    mine = F.slice(F.filter("a", lambda x: x["id"] != F.col("query_id")), 1, k)
    return (who.join(answers, "qid").select("query_id", F.posexplode(mine).alias("at", "x"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")))


@query("op13_nearest_neighbours")
def op13_nearest_neighbours(spark: SparkSession, data_dir: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50."""
    vectors = table(spark, data_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 50 == 0)
