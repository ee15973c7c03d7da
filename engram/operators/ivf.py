"""Approximate vector search by an inverted file (OP-32): k-means cells, exact inside them.

The cells are fitted on a bounded sample of directions; every vector is filed under its
nearest centre and written by cell. A query looks into the ``probes`` cells whose centres
are nearest and scores every vector there exactly (``search.vector_search`` with the cell
as part of the key), so scores are true and only vectors of other cells can be missed.
The exact search stays the default; ``recall`` measures what this one loses.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engram.operators import search as S
from engram.session import scratch_path, ship_package

SAMPLE = 200_000        # vectors that the cells are fitted on
HASHES = 1 << 30
MAX_CELLS = 4_096


def _directions(vectors: DataFrame) -> DataFrame:
    """The vectors (none of them zero) at length 1, dealt over all cores."""
    spark = vectors.sparkSession
    ship_package(spark)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = S._matrix(batch.column("embedding"))
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                ends = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], names=["unit"])
    return vectors.select("embedding").repartition(spark.sparkContext.defaultParallelism).mapInArrow(run, "unit array<double>")


def fit_cells(vectors: DataFrame, cells: int, id_col: str = "vec_id", seed: int = 7) -> np.ndarray:
    """Centres (rows) of at most ``cells`` cells, fitted by Spark on about ``SAMPLE`` directions, those
    with the lowest hashes of their ids. They are chosen row by row, so the sample stays in
    the partitions that its vectors lie in."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    usable = vectors.filter(F.exists("embedding", lambda x: x != 0))
    n = usable.count()
    if n > SAMPLE:
        usable = usable.filter(F.pmod(F.xxhash64(id_col), F.lit(HASHES)) < int(HASHES * SAMPLE / n))
    some = _directions(usable).select(array_to_vector("unit").alias("features"))
    model = KMeans(k=max(2, min(cells, MAX_CELLS)), seed=seed, maxIter=15).fit(some)
    return np.array(model.clusterCenters())


def _nearest(rows: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centres of each vector (ties: the lower number)."""
    out = [np.zeros((0, min(n, len(centres))), np.int32)]
    for at in range(0, len(rows), 4096):
        x = rows[at:at + 4096]
        length = np.sqrt((x * x).sum(axis=1, keepdims=True))
        d = (centres * centres).sum(axis=1)[None, :] - 2 * (x / np.where(length > 0, length, 1)) @ centres.T
        out.append((np.argmin(d, axis=1)[:, None] if n == 1 else np.argsort(d, axis=1, kind="stable")[:, :n]).astype(np.int32))
    return np.concatenate(out)


def in_cells(df: DataFrame, centres: np.ndarray, n: int) -> DataFrame:
    """Rows with their ``n`` nearest cells, one row each (``cell``)."""
    ship_package(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(centres)     # MAX_CELLS rows at most

    def run(batches):
        for batch in batches:
            if batch.num_rows:      # the vectors pass as they are
                near = _nearest(S._matrix(batch.column("embedding")), held.value, n)
                cells = pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1) * near.shape[1], pa.int32()), pa.array(near.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=[*batch.schema.names, "cells"])
    out = df.mapInArrow(run, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in df.schema), "cells array<int>"]))
    return out.withColumn("cell", F.explode("cells")).drop("cells")


def build_index(vectors: DataFrame, cells: int, id_col: str = "vec_id") -> tuple[str, np.ndarray]:
    """Write (graph, doc_id, embedding) by cell; returns the path and the centres."""
    v = vectors.select("graph", F.col(id_col).cast("long").alias("doc_id"), "embedding").filter(F.exists("embedding", lambda x: x != 0))
    centres = fit_cells(v, cells, "doc_id")
    path = scratch_path(v.sparkSession, "ivf")
    in_cells(v, centres, 1).repartition("cell", F.pmod(F.xxhash64("doc_id"), F.lit(4))).write.partitionBy("cell").parquet(path)
    return path, centres


def search(spark, path: str, centres: np.ndarray, queries: DataFrame, k: int, probes: int) -> DataFrame:
    """Top-k of each query (query_id, graph, embedding) from its ``probes`` nearest cells."""
    asked = in_cells(queries.select("query_id", "graph", "embedding"), centres, probes)
    wanted = [r["cell"] for r in asked.select("cell").distinct().collect()]     # MAX_CELLS numbers at most
    stored = spark.read.schema("graph string, doc_id long, embedding array<float>, cell int").parquet(path).filter(F.col("cell").isin(wanted))
    key = F.concat_ws("\u001f", "graph", F.col("cell").cast("string"))
    return S.vector_search(stored.withColumn("graph", key), asked.withColumn("graph", key), k, id_col="doc_id")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: queries, answers of the exact search, the share of them that were found."""
    pair = ["query_id", "doc_id"]
    got = exact.select(*pair).join(found.select(*pair).withColumn("hit", F.lit(1)), pair, "left")
    return got.agg(F.countDistinct("query_id").alias("queries"), F.count(F.lit(1)).alias("answers"),
                   (F.count("hit") / F.count(F.lit(1))).alias("recall"))
