"""Entity search (OP-29 over OP-33): names by words, names by letters, and what the facts
about an entity say.

- words: BM25 over the names (``search.postings``);
- letters: Dice coefficient of the distinct letter trigrams of query and name, from posting
  lists (gram -> entities) made at write time, so misspelt names are found;
- facts: cosine of the query's vector and the entity's, the sum of its facts' vectors.

Each leg is filtered to the wanted types before it ranks; the legs are fused by rank.

Scale: names with their grams and vectors are made once per version of the corpus. A search
scores names block by block inside the task, like the lexical leg, so (query, name) pairs
are rows nowhere; vectors never move. An entity that has a third of all facts is summed with
map-side partial sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from engram.functions.common import rounded_score
from engram.operators import search as S
from engram.operators.search import MAX_BROADCAST_QUERY_TERMS, leg_rank
from engram.session import ship_package


def grams(c: Column) -> Column:
    """Distinct trigrams of the lower-cased text with two blanks before and one behind."""
    p = F.concat(F.lit("  "), F.lower(c), F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substr(p, i, F.lit(3))))


def gram_postings(names: DataFrame) -> DataFrame:
    """(graph, gram, doc_id, entity_type, n): posting lists of (graph, doc_id, entity_type, name);
    n = distinct grams of the name. Null names have none."""
    return (names.filter(F.col("name").isNotNull()).select("graph", "doc_id", "entity_type", grams(F.col("name")).alias("g"))
            .select("graph", "doc_id", "entity_type", F.size("g").alias("n"), F.explode("g").alias("gram")))


def gram_rows(names: DataFrame) -> DataFrame:
    """(graph, doc_id, entity_type, n, terms): the names behind ``gram_postings``, a row each with
    its grams. Names alike in all but the grams are one row, as they count as one."""
    g = names.filter(F.col("name").isNotNull()).select("graph", "doc_id", "entity_type", grams(F.col("name")).alias("g"))
    return (g.select("graph", "doc_id", "entity_type", F.size("g").alias("n"), "g").groupBy("graph", "doc_id", "entity_type", "n")
            .agg(F.flatten(F.collect_list("g")).alias("terms")))


def _search_rows(rows: DataFrame, q: DataFrame, depth: int) -> DataFrame | None:
    """Scores by ``gram_rows``: a task holds a block of (name, query) pairs and ships the best
    ``depth`` names of each query; None if there are too many query grams to hold."""
    spark = rows.sparkSession
    ship_package(spark)
    asked = q.limit(S.MAX_HELD_QUERY_TERMS + 1).collect()
    if len(asked) > S.MAX_HELD_QUERY_TERMS or not isinstance(rows.schema["doc_id"].dataType, T.LongType):
        return None
    words = sorted({r["gram"] for r in asked})
    position = {w: i for i, w in enumerate(words)}
    held = spark.sparkContext.broadcast((words, S._chunks([((r["query_id"], r["nq"]), r["graph"], position[r["gram"]], 1.0) for r in asked],
                                                          {r["graph"]: None for r in asked})))
    kind = q.schema["query_id"].dataType
    id_type = to_arrow_type(kind)

    def top(batches):
        vocab, chunks = pa.array(held.value[0], pa.string()), held.value[1]
        best: dict = {}
        for batch in batches:
            unit, term, tf = S._tf(batch, vocab)
            graph = np.asarray(batch.column("graph").to_pylist(), object)
            n, ids = batch.column("n").to_numpy(), batch.column("doc_id").to_numpy()
            for g, parts in chunks.items():
                mine = (graph == g)[unit]
                for c, chunk in enumerate(parts):
                    nq = np.array([x for _, x in chunk[0]])
                    kept = best.setdefault((g, c), (chunk[0], S._Best(len(nq), depth)))[1]
                    for at, shared in S._unit_scores(unit[mine], term[mine], tf[mine].astype(np.float64), chunk):
                        kept.add(ids[at], np.where(shared > 0, 2.0 * shared / (n[at][:, None] + nq[None, :]), -np.inf))
        for names, kept in best.values():
            at, ids, s = kept.cut()
            yield pa.record_batch([pa.array([x for x, _ in names], id_type).take(pa.array(at)), pa.array(ids, pa.int64()), pa.array(s, pa.float64())],
                                  names=["query_id", "doc_id", "score"])
    return rows.select("graph", "doc_id", "n", "terms").mapInArrow(top, f"query_id {kind.simpleString()}, doc_id long, score double")


def gram_leg(postings: DataFrame, queries: DataFrame, depth: int) -> DataFrame:
    """Names that share letters with a query (query_id, graph, text) -> (query_id, doc_id, score, rank),
    over ``gram_rows`` or ``gram_postings``."""
    if "terms" in postings.columns:
        q = _query_grams(queries)
        found = _search_rows(postings.filter(F.col("doc_id").isNotNull()), q, depth)
        rest = postings if found is None else postings.filter(F.col("doc_id").isNull())
        if found is None or not rest.isEmpty():
            other = _gram_scores(rest.withColumn("gram", F.explode("terms")), q)
            found = other if found is None else found.unionByName(other)
        return leg_rank(found, depth)
    return leg_rank(_gram_scores(postings, _query_grams(queries)), depth)


def _query_grams(queries: DataFrame) -> DataFrame:
    return (queries.filter(F.col("text").isNotNull()).select("query_id", "graph", grams(F.col("text")).alias("g"))
            .select("query_id", "graph", F.size("g").alias("nq"), F.explode("g").alias("gram")))


def _gram_scores(postings: DataFrame, q: DataFrame) -> DataFrame:
    near = F.broadcast if q.count() <= MAX_BROADCAST_QUERY_TERMS else (lambda df: df)
    hits = postings.join(near(q.select("graph", "gram").distinct()), ["graph", "gram"]).repartition("doc_id")
    return (hits.join(near(q), ["graph", "gram"]).groupBy("query_id", "doc_id", "n", "nq").agg(F.count(F.lit(1)).alias("shared"))
            .select("query_id", "doc_id", rounded_score(2.0 * F.col("shared") / (F.col("n") + F.col("nq"))).alias("score")))


def entity_vectors(facts: DataFrame) -> DataFrame:
    """(graph, doc_id, entity_type, embedding): summed vectors of the facts of each entity.
    ``facts``: (graph, doc_id, entity_type, embedding), a row per fact and entity it hangs on."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    return (facts.groupBy("graph", "doc_id", "entity_type").agg(Summarizer.sum(array_to_vector("embedding")).alias("v"))
            .select("graph", "doc_id", "entity_type", vector_to_array("v").alias("embedding")))


def of_types(df: DataFrame, entity_types: list[str] | None) -> DataFrame:
    """Rows of the wanted types; none given: all."""
    return df.filter(F.col("entity_type").isin(list(entity_types))) if entity_types else df
