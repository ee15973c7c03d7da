"""Retrieval evaluation: haystack, needle match, recall gate (OP-04, 19, 35, 42)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engram.functions.text import NON_WORD


def eval_cases_from_items(items: DataFrame, min_len: int = 7, absent_needle: str = "memory") -> DataFrame:
    """Eval cases made from benchmark items: the query is the item text, the
    expected needles are its first two words of ``min_len``+ letters. The
    lowest item id gets an empty ``expect`` (passes), the highest one also
    expects ``absent_needle`` (fails). -> (case_id, query, expect)."""
    bounds = items.agg(F.min("item_id").alias("lo"), F.max("item_id").alias("hi")).first()
    words = F.slice(F.filter(F.split(F.col("text"), NON_WORD, -1), lambda w: F.length(w) >= min_len), 1, 2)
    expect = (F.when(F.col("item_id") == F.lit(bounds["lo"]), F.array().cast("array<string>"))
              .when(F.col("item_id") == F.lit(bounds["hi"]), F.concat(words, F.array(F.lit(absent_needle))))
              .otherwise(words))
    return items.select(F.col("item_id").alias("case_id"), F.col("text").alias("query"),
                        expect.alias("expect"))


#: Result rows (queries x max facts) up to which they are broadcast to the texts.
MAX_BROADCAST_RESULTS = 2_000_000


def result_rows(results: DataFrame, units: DataFrame, at_most: int) -> DataFrame:
    """Result rows with the columns of their units. The results are the small side
    (``at_most`` = queries x max facts, known without running the search) and go to the
    units, so the corpus never moves; beyond the bound both sides are exchanged."""
    return units.join(F.broadcast(results) if at_most <= MAX_BROADCAST_RESULTS else results, "doc_id")


def result_texts(results: DataFrame, texts: DataFrame, at_most: int) -> DataFrame:
    """Text of each result row."""
    return result_rows(results, texts.select("doc_id", "text"), at_most)


def facts_text(results: DataFrame, texts: DataFrame, at_most: int) -> DataFrame:
    """OP-19: newline-joined, lower-cased result texts per query, in rank order.
    ``results``: (query_id, doc_id, rank), bounded by max_facts per query."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "text")))
    return result_texts(results, texts, at_most).groupBy("query_id").agg(
        F.lower(F.concat_ws("\n", F.transform(ordered, lambda s: s["text"]))).alias("haystack"))


def eval_match(cases: DataFrame, results: DataFrame, texts: DataFrame, at_most: int) -> DataFrame:
    """OP-35: is each expected needle contained in the query's haystack?

    Needles never contain a newline, so "in the joined haystack" equals "in
    one of the result texts": an equi-join on the case id, then ``contains``
    per (needle, result) — at most max_facts rows per needle, no nested loop.
    -> (case_id, needle_pos, needle, hit).
    """
    needles = cases.select("case_id", F.posexplode("expect").alias("needle_pos", "needle")).withColumn(
        "needle", F.lower("needle"))
    res = (result_texts(results.select("query_id", "doc_id"), texts, at_most)
           .select(F.col("query_id").alias("case_id"), F.lower("text").alias("ltext")))
    m = needles.join(res, "case_id", "left").withColumn(
        "_hit", F.coalesce(F.col("ltext").contains(F.col("needle")), F.lit(False)))
    return m.groupBy("case_id", "needle_pos", "needle").agg(F.bool_or("_hit").alias("hit"))


def eval_recall(cases: DataFrame, matches: DataFrame) -> DataFrame:
    """OP-42: a case passes iff no needle is missing (empty expect passes);
    ``ok`` iff every case passed. An empty case set is an error."""
    if cases.limit(1).count() == 0:
        raise ValueError("no eval cases")
    per_case = (cases.select("case_id").join(
        matches.groupBy("case_id").agg(F.bool_and("hit").alias("_all")), "case_id", "left")
        .select("case_id", F.coalesce(F.col("_all"), F.lit(True)).alias("passed")))
    return per_case.agg(F.sum(F.col("passed").cast("long")).alias("passed"),
                        F.count(F.lit(1)).alias("total")).withColumn(
        "ok", F.col("passed") == F.col("total"))
