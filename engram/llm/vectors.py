"""Vector tables: which rows can be compared, and how they travel."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def comparable(vec: Column) -> Column:
    """The vector is there and every component is a finite number."""
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vec.isNotNull() & ok, F.lit(False))


def one_row_an_id(df: DataFrame, vec: Column, id_col: str, *extra: Column) -> DataFrame:
    """(id, [extra...], vec): comparable rows with an id; of rows that share an id the one with
    the smallest extras, then vector, stands for it. Vectors become array<double>."""
    names = [f"x{i}" for i in range(len(extra))]
    row = F.struct(*[c.alias(n) for c, n in zip(extra, names)], vec.cast("array<double>").alias("vec"))
    return (df.filter(F.col(id_col).isNotNull() & comparable(vec))
            .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(row).alias("r")).select("id", "r.*"))


def rows_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Flat doubles and offsets of an Arrow list column without nulls."""
    at = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]], at - at[0]


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two (no rounding) that brings the largest component near 1, so
    squares neither overflow nor vanish."""
    top = np.abs(x).max(axis=1, initial=0)
    return np.ldexp(x, -np.frexp(top)[1][:, None])


def stacked(blobs: list[bytes]) -> np.ndarray:
    """Rows of doubles from equally long binary values."""
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)


def meet(parts: DataFrame, schema: str, load: Callable, ask: Callable, batch_rows: int = 1024) -> DataFrame:
    """Stored rows meet queries, shard by shard, as a stream.

    ``parts``: (shard, kind, ...) with the stored rows of a shard as kind 0 and its queries as
    kind 1. Inside a task a shard's stored rows come first and become ``load(batches)``;
    then ``ask(state, batch)`` answers slices of its queries. A task holds one shard's rows
    and one batch of queries, whatever the number of queries."""
    def run(batches):
        shard, held, state = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            names = b.column(0).dictionary_encode()
            code, kind = names.indices.to_numpy(), b.column(1).to_numpy()
            cut = np.flatnonzero((code[1:] != code[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows]):
                if (name := names.dictionary[int(code[lo])].as_py()) != shard:
                    shard, held, state = name, [], None
                if kind[lo] == 0:
                    held.append(b.slice(lo, hi - lo))
                elif held:
                    state = state or load(pa.Table.from_batches(held))
                    for at in range(lo, hi, batch_rows):
                        yield ask(state, b.slice(at, min(batch_rows, hi - at)))
    return parts.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(run, schema)
