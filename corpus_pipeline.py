"""Training-corpus pipeline over ``documents``.

Each stage takes what its predecessor kept, written as Parquet and reread; all but
the last return the columns of ``documents``. Clean documents pass every stage:
only rule failures, all but one of each near-duplicate group, and documents with
benchmark passages go; personal data is replaced inside the texts that stay.

Defined results, for every stage: an empty table gives an empty table; rows that repeat an
id are judged one by one, by their text (of equal rows that the near-duplicate stage keeps,
all stay: they carry the id that the group keeps); null and empty texts have no words and go
with the quality rules; a null id, language or source takes its row along like any other
value; texts are read whole. Further columns pass through untouched whatever their names: the
operators see them under names of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engram.llm import bpe, decontaminate, near_dedup, pii, quality_rules
from engram.llm.common import table, written


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows under names that no operator uses, and those names by the old ones."""
    names = {c: f"in{k}__{c}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _back(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(n).alias(c) for c, n in names.items()])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's perplexity band."""
    d, n = _apart(docs)
    return _back(quality_rules.quality_rules(d, n["text"], n["lang"]).filter("kept"), n)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group (five-word
    shingles, similarity 0.8 or more)."""
    d, n = _apart(docs)
    return _back(near_dedup.near_duplicates(d, n["doc_id"], n["text"]).filter("kept"), n)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    d, n = _apart(docs)
    return _back(decontaminate.decontaminate(d, table(spark, sf_dir, "benchmark"), n["text"], action="remove_documents"), n)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and disclosing terms replaced by labels."""
    d, n = _apart(docs)
    d = pii.sanitise(d, n["text"]).withColumn(n["text"], F.col("sanitised"))
    return _back(d.withColumn(n["n_chars"], F.length(n["text"]).cast(docs.schema["n_chars"].dataType)), n)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    path, pattern = bpe.default_vocabulary()
    return bpe.digests(bpe.round_trip(docs, path, pattern, keep=["doc_id"]))


STAGES = [("quality rules", good_quality), ("near duplicates", one_of_each_group),
          ("benchmark decontamination", clean_of_benchmark), ("personal data", without_personal_data),
          ("byte-level BPE", encode)]

#: Perplexity bands, similarity components and BPE ids are not SQL-expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, "pipeline")
    return docs
