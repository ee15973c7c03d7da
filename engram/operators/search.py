"""Hybrid retrieval: BM25, vector and graph legs, rank fusion, top-k, token budget
(OP-16, 29, 31, 32, 33, 34, W1, W2, U2).

Tiers are isolated: units and queries carry a ``graph`` and every leg matches,
counts and ranks inside it only; statistics (N, df, avgdl) are per graph.

Scale notes
- The lexical index is built once per corpus and kept (``engram.operators.lexical``),
  a row per unit (``unit_terms``) or a row per unit and term (``postings``).
- A search over units moves no posting: each Arrow batch of units is scored with numpy
  against the query terms, block by block within a byte budget, and a task ships the k
  best of every query, so the (query, unit) pairs are rows nowhere. Units whose id
  comes twice are added up by id first, in an exchange of their scores.
- A search over postings exchanges those of its terms once, by unit id. Scores then add
  up inside the task, and the per-query window's partial limit ships k rows a task.
- Corpus statistics are one row a graph, read back as literals.
- Exact vector search runs per partition with numpy over the (small,
  size-bounded) query matrix in blocks of a fixed byte budget and emits k
  candidates per query and task; vectors never shuffle, only ids and scores do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engram.config import BM25_B, BM25_K1, RECALL_BUDGET, RRF_K, SCORE_DIGITS
from engram.functions.common import rounded_score, top_k_per_group
from engram.functions.text import est_tokens, tokens
from engram.session import reliable_checkpoint, ship_package

MAX_BROADCAST_QUERY_TERMS = 1_000_000   # rows of (query, graph, term): some 100 MB at most
MAX_HELD_QUERY_TERMS = 200_000          # of them that are packed for the tasks: some 20 MB
MAX_BROADCAST_IDS = 1_000_000           # ids that come twice
QUERY_CHUNK = 1 << 20                   # terms x queries scored together: 8 MB of doubles
MAX_QUERY_VECTORS = 8_192   # per broadcast batch: 8192 x 768 doubles = 48 MiB
VECTOR_BLOCK_BYTES = 32 << 20   # score matrix of one block of units or vectors


# ---------------------------------------------------------------- BM25
def _ids(id_col) -> list[str]:
    return [id_col] if isinstance(id_col, str) else list(id_col)


def _with_graph(df: DataFrame) -> DataFrame:
    return df if "graph" in df.columns else df.withColumn("graph", F.lit(""))


def postings(corpus: DataFrame, id_col="doc_id", text_col: str = "text") -> DataFrame:
    """(graph, ids..., dl, term, tf) from whole texts; a unit's null term carries its
    length alone, so units without words count too. Built once, reusable."""
    ids = _ids(id_col)
    toks = _with_graph(corpus).select("graph", *ids, tokens(F.coalesce(F.col(text_col), F.lit(""))).alias("_t"))
    return (toks.select("graph", *ids, F.size("_t").alias("dl"),
                        F.explode(F.concat("_t", F.array(F.lit(None).cast("string")))).alias("term"))
            .groupBy("graph", *ids, "dl", "term").agg(F.count(F.lit(1)).alias("tf")))


def score_postings(post: DataFrame, queries: DataFrame, id_col="doc_id",
                   k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """BM25 of every (query, unit) of one graph sharing a term -> (query_id, ids..., score).

    idf = ln(1 + (N - df + 0.5) / (df + 0.5)); distinct query terms; the score
    is rounded to SCORE_DIGITS so ties are ties in every engine.
    """
    ids = _ids(id_col)
    qterms = _with_graph(queries).select("query_id", "graph", F.explode(
        F.array_distinct(tokens(F.coalesce(F.col("text"), F.lit(""))))).alias("term"))
    small = qterms.count() <= MAX_BROADCAST_QUERY_TERMS
    near = F.broadcast if small else (lambda df: df)
    vocab = near(qterms.select("graph", "term").distinct())
    stats = {r["graph"]: (float(r["n"]), float(r["avgdl"] or 0.0) or 1.0)
             for r in post.filter(F.col("term").isNull()).groupBy("graph")
             .agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl")).collect()}
    if not stats:
        return post.select(F.lit(0).cast("long").alias("query_id"), *ids, F.lit(0.0).alias("score")).limit(0)

    def of_graph(i: int):
        return F.element_at(F.create_map(*[F.lit(x) for g, v in stats.items() for x in (g, v[i])]), F.col("graph"))

    df_t = (post.filter(F.col("term").isNotNull()).select("graph", "term").join(vocab, ["graph", "term"])
            .groupBy("graph", "term").agg(F.count(F.lit(1)).alias("df")))
    idf = (qterms.join(near(df_t), ["graph", "term"])
           .withColumn("idf", F.log(1 + (of_graph(0) - F.col("df") + 0.5) / (F.col("df") + 0.5)))
           .select("query_id", "graph", "term", "idf"))
    # the one exchange: postings of query terms, by unit
    hits = post.filter(F.col("term").isNotNull()).join(vocab, ["graph", "term"]).repartition(*ids)
    norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("dl") / of_graph(1))
    contrib = F.col("idf") * F.col("tf") * F.lit(k1 + 1) / (F.col("tf") + norm)
    return (hits.join(near(idf), ["graph", "term"])
            .groupBy("query_id", *ids).agg(rounded_score(F.sum(contrib)).alias("score")))


def bm25_scores(corpus: DataFrame, queries: DataFrame, id_col="doc_id", text_col: str = "text",
                k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """Scores over a corpus that has no kept index."""
    return score_postings(postings(corpus, id_col, text_col), queries, id_col, k1, b)


# ---------------------------------------------------------------- BM25 by unit
def unit_terms(corpus: DataFrame, id_col="doc_id", text_col: str = "text") -> DataFrame:
    """(graph, ids..., dl, terms, shared): the units behind ``postings``, a row each with its
    terms, repeats included. Units that are alike in graph, ids and length are one row, as
    they are one posting there. ``shared``: the first id is null or stands in other rows too."""
    ids = _ids(id_col)
    toks = _with_graph(corpus).select("graph", *ids, tokens(F.coalesce(F.col(text_col), F.lit(""))).alias("terms"))
    units = toks.select("graph", *ids, F.size("terms").alias("dl"), "terms")
    key = F.struct(ids[0])      # structs compare null fields as equal
    twice = reliable_checkpoint(corpus.groupBy(key.alias("_k")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_k"))
    n = twice.count()
    if n == 0:
        return units.withColumn("shared", F.col(ids[0]).isNull())
    near = F.broadcast(twice) if n <= MAX_BROADCAST_IDS else twice
    on = key == F.col("_k")
    many = (units.join(near, on, "left_semi").groupBy("graph", *ids, "dl").agg(F.flatten(F.collect_list("terms")).alias("terms")))
    return (units.join(near, on, "left_anti").withColumn("shared", F.col(ids[0]).isNull())
            .unionByName(many.withColumn("shared", F.lit(True))))


def posting_rows(units: DataFrame) -> DataFrame:
    """``postings`` from ``unit_terms``."""
    ids = [c for c in units.columns if c not in ("graph", "dl", "terms", "shared")]
    return (units.select("graph", *ids, "dl", F.explode(F.concat("terms", F.array(F.lit(None).cast("string")))).alias("term"))
            .groupBy("graph", *ids, "dl", "term").agg(F.count(F.lit(1)).alias("tf")))


class _Best:
    """The k best units of each of some queries so far (ties: lowest id)."""

    def __init__(self, n: int, k: int):
        self.n, self.k, self.floor, self.held, self.parts = n, k, np.full(n, -np.inf), 0, []

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: units x queries; nan or -inf is no match."""
        at, q = np.nonzero(scores >= (self.floor - 2 * 10.0 ** -SCORE_DIGITS)[None, :])
        s = np.round(scores[at, q], SCORE_DIGITS)
        ok = np.isfinite(s) & (s >= self.floor[q])
        self.parts.append((q[ok], ids[at[ok]], s[ok]))
        self.held += int(ok.sum())
        if self.held > 4 * self.k * self.n:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, ids, s = (np.concatenate(c) for c in zip(*self.parts)) if self.parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        order = np.lexsort((ids, -s, q))
        q, ids, s = q[order], ids[order], s[order]
        counts = np.bincount(q, minlength=self.n)
        rank = np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.floor[q[rank == self.k - 1]] = s[rank == self.k - 1]
        q, ids, s = (c[rank < self.k] for c in (q, ids, s))
        self.parts, self.held = [(q, ids, s)], len(q)
        return q, ids, s


def _tf(batch: pa.RecordBatch, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, term, tf) of a batch's query terms, by unit; units and terms as positions."""
    lists = batch.column("terms")
    code = pc.fill_null(pc.index_in(lists.flatten(), value_set=vocab), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    unit = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    key, tf = np.unique((unit * len(vocab) + code)[code >= 0], return_counts=True)
    return key // max(1, len(vocab)), key % max(1, len(vocab)), tf


def _chunks(rows: list[tuple], graphs: dict) -> dict:
    """graph -> [(query ids, term, query, idf)]: queries in chunks of at most ``QUERY_CHUNK``
    terms x queries (a larger query alone), ``term`` and ``query`` as positions."""
    out: dict = {}
    for g in graphs:
        by_query: dict = {}
        for q, graph, t, idf in rows:
            if graph == g:
                by_query.setdefault(q, []).append((t, idf))
        out[g], chunk, n = [], [], 0
        for q, terms in [*by_query.items(), (None, None)]:
            if chunk and (terms is None or (n + len(terms)) * (len(chunk) + 1) > QUERY_CHUNK):
                t, j, x = zip(*((t, j, x) for j, (_, ts) in enumerate(chunk) for t, x in ts))
                out[g].append(([q for q, _ in chunk], np.array(t, np.int64), np.array(j, np.int64), np.array(x)))
                chunk, n = [], 0
            if terms is not None:
                chunk.append((q, terms))
                n += len(terms)
    return out


def _unit_scores(unit, term, w, chunk):
    """Blocks (units, scores: units x queries of the chunk) of one graph's (unit, term, weight)."""
    q_ids, at, query, idf = chunk
    own, local = np.unique(at, return_inverse=True)
    held = np.zeros((len(own), len(q_ids)))
    np.add.at(held, (local, query), idf)        # a query that comes twice counts twice
    pos = np.searchsorted(own, term)
    met = own[np.minimum(pos, len(own) - 1)] == term
    unit, pos, w = unit[met], pos[met], w[met]
    if not len(unit):
        return
    starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    step = max(1, VECTOR_BLOCK_BYTES // (8 * len(q_ids)))
    a = 0
    while a < len(starts):      # whole units, about ``step`` of their terms
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + step)))
        lo, hi = starts[a], starts[b] if b < len(starts) else len(unit)
        yield unit[starts[a:b]], np.add.reduceat(held[pos[lo:hi]] * w[lo:hi, None], starts[a:b] - lo, axis=0)
        a = b


def _search_units(units: DataFrame, queries: DataFrame, k: int, id_col: str, k1: float, b: float) -> DataFrame | None:
    """``bm25_search`` over ``unit_terms``; None if there are too many query terms to hold."""
    spark = units.sparkSession
    ship_package(spark)
    qterms = _with_graph(queries).select("query_id", "graph", F.explode(
        F.array_distinct(tokens(F.coalesce(F.col("text"), F.lit(""))))).alias("term"))
    asked = qterms.limit(MAX_HELD_QUERY_TERMS + 1).collect()
    if len(asked) > MAX_HELD_QUERY_TERMS or not isinstance(units.schema[id_col].dataType, T.LongType):
        return None
    stats = {r["graph"]: (float(r["n"]), float(r["avgdl"] or 0.0) or 1.0)
             for r in units.groupBy("graph").agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl")).collect()}
    words = sorted({r["term"] for r in asked})
    position = {w: i for i, w in enumerate(words)}
    vocab = spark.sparkContext.broadcast(words)

    def count(batches):
        held, seen = pa.array(vocab.value, pa.string()), {}
        for batch in batches:
            unit, term, _ = _tf(batch, held)
            graph = np.asarray(batch.column("graph").to_pylist(), object)[unit]
            for g in set(graph):
                seen[g] = seen.get(g, 0) + np.bincount(term[graph == g], minlength=len(held))
        for g, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.record_batch([pa.array([g] * len(at), pa.string()), pa.array(at), pa.array(n[at])], names=["graph", "term", "n"])

    df = {(r["graph"], r["term"]): r["n"] for r in units.select("graph", "terms").mapInArrow(count, "graph string, term long, n long")
          .groupBy("graph", "term").agg(F.sum("n").alias("n")).collect()}      # query terms a graph at most
    rows = []
    for r in asked:
        n = df.get((r["graph"], position[r["term"]]))
        if n:
            rows.append((r["query_id"], r["graph"], position[r["term"]], float(np.log(1 + (stats[r["graph"]][0] - n + 0.5) / (n + 0.5)))))
    packed = spark.sparkContext.broadcast((_chunks(rows, {r[1]: None for r in rows}), {g: s[1] for g, s in stats.items()}))
    kind = queries.schema["query_id"].dataType
    id_type = pa.int64() if isinstance(kind, T.LongType) else pa.int32() if isinstance(kind, T.IntegerType) else pa.string()
    schema = f"query_id {kind.simpleString()}, doc_id long, score double"

    def blocks(batches):
        """(graph, chunk number, query ids, batch, units, scores)"""
        held = pa.array(vocab.value, pa.string())
        chunks, avgdl = packed.value
        for batch in batches:
            unit, term, tf = _tf(batch, held)
            graph = np.asarray(batch.column("graph").to_pylist(), object)
            dl = batch.column("dl").to_numpy(zero_copy_only=False)
            for g, parts in chunks.items():
                mine = (graph == g)[unit]
                u, t, n = unit[mine], term[mine], tf[mine]
                w = n * (k1 + 1) / (n + k1 * (1 - b + b * dl[u] / avgdl[g]))
                for c, chunk in enumerate(parts):
                    for at, s in _unit_scores(u, t, w, chunk):
                        yield g, c, chunk[0], batch, at, s

    def found(q, ids, s):
        return pa.record_batch([q, ids, pa.array(s, pa.float64())], names=["query_id", "doc_id", "score"])

    def top(batches):
        best: dict = {}
        for g, c, q_ids, batch, at, s in blocks(batches):
            if (g, c) not in best:
                best[g, c] = (pa.array(q_ids, id_type), _Best(len(q_ids), k))
            best[g, c][1].add(batch.column("doc_id").to_numpy()[at], np.where(s > 0, s, -np.inf))
        for names, kept in best.values():
            q, ids, s = kept.cut()
            yield found(names.take(pa.array(q)), pa.array(ids, pa.int64()), s)

    def every(batches):
        for _, _, q_ids, batch, at, s in blocks(batches):
            u, q = np.nonzero(s > 0)
            yield found(pa.array(q_ids, id_type).take(pa.array(q)), batch.column("doc_id").take(pa.array(at[u])), s[u, q])

    whole = units.select("graph", F.col(id_col).alias("doc_id"), "dl", "terms", "shared")
    hits = whole.filter(~F.col("shared")).drop("shared").mapInArrow(top, schema)
    shared = whole.filter("shared").drop("shared")
    if not shared.isEmpty():
        hits = hits.unionByName(shared.mapInArrow(every, schema).groupBy("query_id", "doc_id").agg(rounded_score(F.sum("score")).alias("score")))
    return leg_rank(hits, k)


def bm25_search(post: DataFrame, queries: DataFrame, k: int, id_col: str = "doc_id",
                k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """OP-31: top-k units per query by BM25 over an index (``unit_terms`` or ``postings``)
    -> (query_id, doc_id, score, rank)."""
    if "terms" in post.columns:
        found = _search_units(post, queries, k, id_col, k1, b)
        if found is not None:
            return found
        post = posting_rows(post)
    scored = score_postings(post, queries, id_col, k1, b)
    if id_col != "doc_id":
        scored = scored.withColumnRenamed(id_col, "doc_id")
    return leg_rank(scored, k)


def scoped(units: DataFrame, group_ids: list[str] | None) -> DataFrame:
    """Units of the given namespaces (``group_id``); none given: all of them. Applied before a
    leg counts or ranks, so statistics and ranks are those of the scope."""
    return units.filter(F.col("group_id").isin(list(group_ids))) if group_ids else units


# ---------------------------------------------------------------- vectors
def embedding_guard(vectors: DataFrame, dim: int, embedder: str | None = None,
                    embedder_col: str | None = None) -> DataFrame:
    """OP-16: only vectors of one embedder and one dimension are comparable.
    Adds ``accepted`` and ``reject_reason`` (nothing is dropped silently)."""
    emb = F.col("embedding")
    reason = (F.when(emb.isNull(), F.lit("missing vector"))
              .when(F.size(emb) != dim, F.concat(F.lit("dimension "), F.size(emb).cast("string"),
                                                 F.lit(f" != {dim}"))))
    if embedder_col and embedder:
        reason = reason.when(F.col(embedder_col) != F.lit(embedder), F.lit(f"embedder != {embedder}"))
    return vectors.withColumn("reject_reason", reason).withColumn(
        "accepted", F.col("reject_reason").isNull())


def label_centroids(vectors: DataFrame, label_col: str = "label") -> DataFrame:
    """Mean vector per label -> (query_id, embedding) (ML Summarizer, JVM-side)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    agg = vectors.groupBy(label_col).agg(
        Summarizer.mean(array_to_vector(F.col("embedding"))).alias("_m"))
    return agg.select(F.col(label_col).cast("long").alias("query_id"),
                      vector_to_array("_m").alias("embedding"))


def _matrix(lists) -> np.ndarray:
    """The vectors of a batch, a row each; all have one length."""
    n = len(lists)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if n == 0 or lists.null_count or (pc.list_value_length(lists).to_numpy() != len(flat) // n).any():
        return np.vstack([np.asarray(a, np.float64) for a in lists.to_pylist()])     # says which shapes differ
    return flat.reshape(n, -1)


def vector_search(vectors: DataFrame, queries: DataFrame, k: int,
                  id_col: str = "vec_id") -> DataFrame:
    """OP-32: exact cosine top-k per query inside its graph -> (query_id, doc_id, score, rank).

    The query table is bounded (checked) and shipped to every task; each Arrow
    batch of vectors computes V·Qᵀ with numpy, block by block within a byte budget,
    and keeps k rows per query, then a per-query window merges them.
    """
    queries, vectors = _with_graph(queries), _with_graph(vectors)
    nq = queries.count()
    if nq > MAX_QUERY_VECTORS:
        # exact in bounded batches: every query is still scored against all vectors
        n = nq // MAX_QUERY_VECTORS + 1
        qb = queries.withColumn("_b", F.pmod(F.xxhash64("query_id"), F.lit(n)))
        out = None
        for i in range(n):
            part = vector_search(vectors, qb.filter(F.col("_b") == i).drop("_b"), k, id_col)
            out = part if out is None else out.unionByName(part)
        return out
    by_graph = {}
    for r in queries.select("graph", "query_id", "embedding").collect():
        by_graph.setdefault(r["graph"], []).append((r["query_id"], np.asarray(r["embedding"], np.float64)))
    packed = {}
    for g, rows in by_graph.items():
        q = np.vstack([v for _, v in rows])
        qn = np.linalg.norm(q, axis=1)
        qn[qn == 0] = np.nan
        packed[g] = (np.array([i for i, _ in rows], np.int64), q, qn)
    bq = vectors.sparkSession.sparkContext.broadcast(packed)

    def score_partition(batches):
        best: dict = {}
        for batch in batches:
            graph = np.asarray(batch.column("graph").to_pylist(), object)
            for g, (q_ids, q, qn) in bq.value.items():
                rows = np.flatnonzero(graph == g)
                kept = best.setdefault(g, _Best(len(q_ids), k))
                step = max(1, VECTOR_BLOCK_BYTES // (8 * max(1, len(q_ids))))
                for at in range(0, len(rows), step):
                    block = batch.take(pa.array(rows[at:at + step]))
                    v = _matrix(block.column("embedding"))
                    vn = np.linalg.norm(v, axis=1)
                    vn[vn == 0] = np.nan
                    kept.add(block.column("doc_id").to_numpy(), (v @ q.T) / vn[:, None] / qn[None, :])
        for g, kept in best.items():
            q, ids, s = kept.cut()
            yield pa.record_batch([pa.array(bq.value[g][0][q]), pa.array(ids, pa.int64()), pa.array(s)], names=["query_id", "doc_id", "score"])

    cands = vectors.select("graph", F.col(id_col).cast("long").alias("doc_id"), "embedding").mapInArrow(
        score_partition, "query_id long, doc_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    return cands.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# ---------------------------------------------------------------- fusion
def leg_rank(hits: DataFrame, depth: int) -> DataFrame:
    """OP-W2: rank inside one leg (score desc, id) keeping ``depth`` rows."""
    return top_k_per_group(hits.select("query_id", "doc_id", "score"), ["query_id"],
                           [F.desc("score"), F.asc("doc_id")], depth,
                           salt_col=F.xxhash64("doc_id"))


def leg_union(ranked_legs: dict[str, DataFrame]) -> DataFrame:
    """OP-U2: all legs as (leg, query_id, doc_id, rank)."""
    out = None
    for name, df in ranked_legs.items():
        df = df.select(F.lit(name).alias("leg"), "query_id", "doc_id", "rank")
        out = df if out is None else out.unionByName(df)
    return out


def rrf_fuse(ranked_legs: dict[str, DataFrame], k: int, rrf_k: int = RRF_K) -> DataFrame:
    """OP-33: reciprocal-rank fusion of ranked legs -> top-k (query_id, doc_id, rrf, rank).

    Independent of leg order (a commutative sum); a document in one leg only
    gets that leg's term.
    """
    u = leg_union(ranked_legs)
    fused = u.groupBy("query_id", "doc_id").agg(
        rounded_score(F.sum(1.0 / (F.lit(rrf_k) + F.col("rank")))).alias("rrf"))
    return top_k_per_group(fused, ["query_id"], [F.desc("rrf"), F.asc("doc_id")], k,
                           salt_col=F.xxhash64("doc_id"))


def search_memory_facts(ranked_legs: dict[str, DataFrame], max_facts: int) -> DataFrame:
    """OP-34: count-bounded top facts for a whole table of queries in one job."""
    return rrf_fuse(ranked_legs, max_facts)


# ---------------------------------------------------------------- budget
def recall_budget(lines: DataFrame, budget: int = RECALL_BUDGET) -> DataFrame:
    """OP-W1: keep the prefix (rank order) whose token total fits the budget.

    Each line costs ``max(1, len // 4)`` ≥ 1, so the running sum strictly grows
    and "stop at the first overflow" equals ``running_sum <= budget``. The
    window is per query over at most over-fetch results.
    ``lines``: (query_id, rank, line_no, line).
    """
    w = (Window.partitionBy("query_id").orderBy("rank", "line_no")
         .rowsBetween(Window.unboundedPreceding, 0))
    return (lines.withColumn("cost", est_tokens(F.col("line")))
            .withColumn("used", F.sum("cost").over(w))
            .filter(F.col("used") <= budget))


def best_unit_per_doc(unit_hits: DataFrame) -> DataFrame:
    """Collapse unit-level hits (e.g. chunks) to documents by their best score."""
    return unit_hits.groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))

