"""Kept tables: the lexical index, facts and vectors are made at write time, not per query.

A kept table belongs to one version of a corpus (its name and the files it is read from,
with their sizes and modification times); it is written once as Parquet into the shared
folder and reused by every later search of the application. When the files change, the
next use builds the new version and removes the old one's folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engram.operators.search import postings, unit_terms
from engram.session import drop_path, scratch_path

_KEPT: dict[tuple[str, str, str], tuple[str, str]] = {}


def version_of(source: DataFrame) -> str:
    """Digest of the files a corpus is read from: their names, sizes and modification times,
    added up by Spark, so no list of files reaches the driver. Reads no column of the data."""
    m = F.col("_metadata")
    one = F.xxhash64(m["file_path"], m["file_size"], m["file_modification_time"])
    row = (source.select(one.alias("h")).distinct().agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"))).head()
    return hashlib.sha256(f"{row['n']}:{row['s']}".encode()).hexdigest()[:16]


def _place(source: DataFrame) -> str:
    """Which corpus it is, whatever its version: the folder its first file lies in."""
    row = source.select(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("p")).agg(F.min("p")).head()
    return row[0] or ""


def kept_table(spark: SparkSession, name: str, source: DataFrame, build: Callable[[], DataFrame]) -> DataFrame:
    """The table called ``name`` made from the files behind ``source``; built on first use
    and whenever those files have changed."""
    key, version = (spark.sparkContext.applicationId, name, _place(source)), version_of(source)
    kept = _KEPT.get(key)
    if kept is None or kept[0] != version:
        path = scratch_path(spark, "index", f"{name}-{version}")
        build().write.parquet(path)
        _KEPT[key] = (version, path)
        if kept is not None:
            drop_path(spark, kept[1])
    return spark.read.parquet(_KEPT[key][1])


def drop_kept(spark: SparkSession) -> None:
    """Remove every kept table of this application."""
    for key in [k for k in _KEPT if k[0] == spark.sparkContext.applicationId]:
        drop_path(spark, _KEPT.pop(key)[1])


def lexical_index(spark: SparkSession, name: str, source: DataFrame, units: Callable[[], DataFrame],
                  id_col="doc_id", text_col: str = "text", by_unit: bool = False) -> DataFrame:
    """Postings of ``units()``, kept for the files behind ``source``; ``by_unit``: a row per unit
    with its terms (``search.unit_terms``), which is made without an exchange of them."""
    if by_unit:
        return kept_table(spark, f"{name}-units", source, lambda: unit_terms(units(), id_col, text_col))
    return kept_table(spark, f"{name}-postings", source,
                      lambda: postings(units(), id_col, text_col).sortWithinPartitions("graph", "term"))
