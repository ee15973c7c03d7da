"""Shared pieces: Arrow row maps, written intermediate tables, query registry."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from engram.session import scratch_path, ship_package

#: Rows handed to a row function at once: bounds a worker's memory.
SLICE_ROWS = 512

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``(spark, data_dir) -> DataFrame`` under ``name`` with its DuckDB twin."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write to the shared folder and reread: cuts the lineage without a local
    checkpoint, so a lost executor costs nothing but its running tasks."""
    path = scratch_path(df.sparkSession, "llm", name)
    w = df.write.option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_row(df: DataFrame, inputs: list[str], outputs: str | T.StructType, make: Callable,
           keep: list[str] | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add columns computed from ``inputs`` in Python, slice by slice.

    ``make()`` runs once per task and returns ``fn(*lists) -> tuple of lists``,
    one list per output column. Columns in ``keep`` (default: all) pass through
    as Arrow data untouched; a kept column named like an output column gives
    way to the output. Row order, repeated rows and nulls are kept.
    """
    ship_package(df.sparkSession)
    if isinstance(outputs, str):
        outputs = T.StructType.fromDDL(outputs)
    names = set(outputs.fieldNames())
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    src = df.select(*[df[c].alias(f"k{i}") for i, c in enumerate(kept)],
                    *[df[c].alias(f"i{i}") for i, c in enumerate(inputs)])
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in kept] + list(outputs))
    types = [to_arrow_type(f.dataType) for f in outputs]
    n_kept, n_in = len(kept), len(inputs)

    def run(batches):
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                got = fn(*[part.column(n_kept + i).to_pylist() for i in range(n_in)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(n_kept)]
                    + [pa.array(x, t) for x, t in zip(got, types, strict=True)], names=schema.names)

    return src.mapInArrow(run, schema)
