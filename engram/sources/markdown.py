"""Markdown corpus scan (OP-01) and eval-case files (OP-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def markdown_scan(spark: SparkSession, directory: str) -> DataFrame:
    """OP-01: every ``*.md`` below ``directory`` -> (rel_path, text).

    Bytes are decoded as UTF-8 with bad sequences replaced, and ``\\r\\n`` / lone
    ``\\r`` become ``\\n`` (text-mode read). Raises when no file is found.
    Note: Spark's file listing skips names starting with '_' or '.', which a
    plain recursive glob would include.
    """
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", "*.md").load(directory))
    root = directory.rstrip("/")
    rel = F.regexp_replace(F.col("path"), r"^file:", "")
    rel = F.regexp_replace(rel, "^" + _re_escape(root.removeprefix("file:")) + "/", "")
    text = F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "\r\n?", "\n")
    out = df.select(rel.alias("rel_path"), text.alias("text"))
    if out.limit(1).count() == 0:
        raise FileNotFoundError(f"{directory}: nothing to ingest, not one markdown file")
    return out


def _re_escape(s: str) -> str:
    import re

    return re.escape(s)


def load_eval_cases(spark: SparkSession, path: str) -> DataFrame:
    """OP-04: JSON-lines eval cases ``{"query": ..., "expect": [...]}``; a missing
    ``expect`` becomes an empty list; an empty file is an error."""
    df = spark.read.schema("query string, expect array<string>").json(path)
    df = df.withColumn("expect", F.coalesce(F.col("expect"), F.array().cast("array<string>")))
    if df.limit(1).count() == 0:
        raise ValueError(f"{path} holds no eval case")
    return df.withColumn("case_id", F.monotonically_increasing_id())
