"""BM25 over postings in blocks with block maxima, so that a top-k search skips blocks (OP-31).

An impact is what a posting adds to a score, less the term's idf:
tf (k1 + 1) / (tf + k1 (1 - b + b dl / avgdl)). Units are dealt into shards of about
``SHARD_UNITS``; a block holds a term's postings in one shard, by falling impact, and knows
the largest. A term that a third of all units hold is many blocks, each a row of its own.

No unit of a shard can score more than the shard's bound for the query, the sum over the
query's terms of idf times the block's largest impact. A search reads bounds first (columns
of the same files, no postings), scores the ``FIRST`` shards of the highest bounds whole, and
has a floor: the k-th best score found there. Shards whose bound is below the floor hold
no unit of the top k and are skipped; the others are scored whole. The result is the same
as scoring everything.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from engram.config import BM25_B, BM25_K1, SCORE_DIGITS
from engram.functions.common import rounded_score, top_k_per_group
from engram.functions.text import tokens
from engram.operators.search import MAX_BROADCAST_QUERY_TERMS, MAX_HELD_QUERY_TERMS, leg_rank
from engram.session import reliable_checkpoint, ship_package

SHARD_UNITS = 128
BLOCK_SCHEMA = "graph string, shard int, term string, n int, top double, impacts array<double>, ids array<long>"
SCORE_CELLS = 1 << 20       # units x queries of a shard that are scored together
FIRST = 16          # shards a query that the floor is taken from
SLACK = 10.0 ** -SCORE_DIGITS


def impact_index(post: DataFrame, id_col: str = "doc_id", k1: float = BM25_K1, b: float = BM25_B, shard_units: int = SHARD_UNITS,
                 together: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(blocks, stats) of ``search.postings`` or ``search.unit_terms``: blocks (graph, shard, term,
    n, top, impacts, ids: parallel arrays, an id once) and stats (graph, term, df, units).
    Units with an equal ``together`` (default: the id) share a shard: like units side by side
    make bounds tighter. Units move once, whole, to their shard and are cut into blocks there;
    postings as such move only if they are what is given."""
    by_unit = "terms" in post.columns
    units = ((post if by_unit else post.filter(F.col("term").isNull())).groupBy("graph").agg(F.count(F.lit(1)).alias("units"), F.avg("dl").alias("avgdl"))
             .withColumn("shards", F.ceil(F.col("units") / shard_units)))
    norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("dl") / F.when(F.col("avgdl") > 0, F.col("avgdl")).otherwise(1.0))
    where = F.pmod(F.xxhash64(F.col(id_col) if together is None else together), F.col("shards")).cast("int").alias("shard")
    sized = post.join(F.broadcast(units), "graph")      # a row a graph
    if by_unit:
        ship_package(post.sparkSession)

        def cut(key, table):
            return _blocks_of(key, table, k1)
        blocks = (sized.select("graph", where, F.col(id_col).alias("id"), norm.alias("norm"), "terms")
                  .groupBy("graph", "shard").applyInArrow(cut, BLOCK_SCHEMA))
        held = post.select("graph", F.explode(F.array_distinct("terms")).alias("term"))
    else:
        p = (sized.filter(F.col("term").isNotNull())
             .select("graph", where, "term", (F.col("tf") * F.lit(k1 + 1) / (F.col("tf") + norm)).alias("impact"), F.col(id_col).alias("id"))
             .groupBy("graph", "shard", "term", "id").agg(F.sum("impact").alias("impact")))
        blocks = (p.groupBy("graph", "shard", "term").agg(F.sort_array(F.collect_list(F.struct("impact", "id")), asc=False).alias("p"))
                  .select("graph", "shard", "term", F.size("p").alias("n"), F.col("p")[0]["impact"].alias("top"),
                          F.col("p.impact").alias("impacts"), F.col("p.id").alias("ids")))
        held = post.filter(F.col("term").isNotNull()).select("graph", "term")
    df = held.groupBy("graph", "term").agg(F.count(F.lit(1)).alias("df"))
    return blocks, df.join(F.broadcast(units.select("graph", "units")), "graph")


def _blocks_of(key: tuple, units: pa.Table, k1: float) -> pa.Table:
    """The blocks of one shard from its units (id, norm, terms)."""
    units = units.combine_chunks()
    lists = units.column("terms").combine_chunks()
    words = pc.dictionary_encode(lists.flatten())
    code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    vocab = max(1, len(words.dictionary))
    row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    cell, tf = np.unique(row * vocab + code, return_counts=True)
    row, code = cell // vocab, cell % vocab
    impact = tf * (k1 + 1) / (tf + units.column("norm").to_numpy()[row])
    names = pc.dictionary_encode(units.column("id").combine_chunks(), null_encoding="encode")
    own = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row]
    pair, at = np.unique(code * max(1, len(names.dictionary)) + own, return_inverse=True)     # units of one id are one posting
    impact = np.bincount(at, impact, minlength=len(pair))
    code, own = pair // max(1, len(names.dictionary)), pair % max(1, len(names.dictionary))
    order = np.lexsort((own, -impact, code))
    code, own, impact = code[order], own[order], impact[order]
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
    ends = pa.array(np.r_[starts, len(code)], pa.int32())
    n = len(starts)
    return pa.table([pa.repeat(pa.scalar(key[0].as_py(), pa.string()), n), pa.repeat(pa.scalar(key[1].as_py(), pa.int32()), n),
                     words.dictionary.take(pa.array(code[starts])), pa.array(np.diff(np.r_[starts, len(code)]), pa.int32()), pa.array(impact[starts]),
                     pa.ListArray.from_arrays(ends, pa.array(impact)), pa.ListArray.from_arrays(ends, names.dictionary.take(pa.array(own)))],
                    names=["graph", "shard", "term", "n", "top", "impacts", "ids"])


def shard_bounds(blocks: DataFrame, stats: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(query_id, graph, term, idf) and (query_id, graph, shard, bound, blocks)."""
    q = queries.select("query_id", "graph", F.explode(F.array_distinct(tokens(F.coalesce(F.col("text"), F.lit(""))))).alias("term"))
    near = F.broadcast if q.count() <= MAX_BROADCAST_QUERY_TERMS else (lambda df: df)
    idf = near(stats.join(near(q), ["graph", "term"]).select(
        "query_id", "graph", "term", F.log(1 + (F.col("units") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")))
    bounds = (blocks.select("graph", "shard", "term", "top").join(idf, ["graph", "term"])
              .groupBy("query_id", "graph", "shard").agg(F.sum(F.col("idf") * F.col("top")).alias("bound"), F.count(F.lit(1)).alias("blocks")))
    return idf, bounds


def _scored(blocks: DataFrame, idf: DataFrame, shards: DataFrame) -> DataFrame:
    """Scores of the units of a few (query, shard): every block of the query's terms there."""
    hits = (blocks.select("graph", "shard", "term", "impacts", "ids").join(F.broadcast(shards.select("query_id", "graph", "shard")), ["graph", "shard"])
            .join(idf, ["query_id", "graph", "term"]))
    return (hits.select("query_id", "idf", F.explode(F.arrays_zip("impacts", "ids")).alias("p")).groupBy("query_id", F.col("p.ids").alias("doc_id"))
            .agg(rounded_score(F.sum(F.col("idf") * F.col("p.impacts"))).alias("score")))


def _floors(blocks: DataFrame, idf: DataFrame, bounds: DataFrame, k: int, first: int) -> DataFrame:
    """(query_id, floor): the k-th best score in the ``first`` shards of the highest bounds."""
    best = top_k_per_group(bounds, ["query_id"], [F.desc("bound"), F.asc("graph"), F.asc("shard")], first, salt_col=F.xxhash64("shard"))
    top = leg_rank(_scored(blocks, idf, best), k)
    return top.filter(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))


def _kept(bounds: DataFrame, floors: DataFrame) -> DataFrame:
    reach = F.col("bound") + SLACK >= F.coalesce("floor", F.lit(0.0))
    return bounds.join(floors, "query_id", "left").withColumn("kept", reach)


def kept_shards(blocks: DataFrame, stats: DataFrame, queries: DataFrame, k: int, first: int = FIRST) -> tuple[DataFrame, DataFrame]:
    """The query terms with idf, and every (query, shard) with ``kept``: may a unit of the top k
    stand in it?"""
    idf, bounds = shard_bounds(blocks, stats, queries)
    return idf, _kept(bounds, _floors(blocks, idf, bounds, k, first))


def bm25_pruned(blocks: DataFrame, stats: DataFrame, queries: DataFrame, k: int, first: int = FIRST) -> DataFrame:
    """OP-31: top-k units of each query -> (query_id, doc_id, score, rank); the rows of
    ``search.bm25_search``, from the blocks that matter. The query terms' blocks of the
    shards that some query keeps move once, to their shard; a shard is scored for the queries
    that keep it and gives back what reaches their floors, k units a query at most."""
    idf, bounds = shard_bounds(blocks, stats, queries)
    floors = reliable_checkpoint(_floors(blocks, idf, bounds, k, first))        # a row a query
    asked = idf.limit(MAX_HELD_QUERY_TERMS + 1).collect()
    shards = _kept(bounds, F.broadcast(floors)).filter("kept")
    if len(asked) > MAX_HELD_QUERY_TERMS:       # too many to hold: by rows
        hits = (blocks.select("graph", "shard", "term", "impacts", "ids").join(idf, ["graph", "term"])
                .join(shards.select("query_id", "graph", "shard"), ["query_id", "graph", "shard"]))
        scored = (hits.select("query_id", "idf", F.explode(F.arrays_zip("impacts", "ids")).alias("p")).groupBy("query_id", F.col("p.ids").alias("doc_id"))
                  .agg(rounded_score(F.sum(F.col("idf") * F.col("p.impacts"))).alias("score")))
        return leg_rank(scored, k)
    ship_package(blocks.sparkSession)
    floor = {r["query_id"]: r["floor"] for r in floors.collect()}
    by_graph: dict = {}
    for r in asked:
        by_graph.setdefault(r["graph"], []).append((r["query_id"], r["term"], r["idf"]))
    kind = queries.schema["query_id"].dataType
    packed = {}
    for g, rows in by_graph.items():
        words, names = sorted({t for _, t, _ in rows}), list({q: None for q, _, _ in rows})
        at, of = {w: i for i, w in enumerate(words)}, {q: i for i, q in enumerate(names)}
        term, query, x = zip(*((at[t], of[q], x) for q, t, x in rows))
        packed[g] = (words, names, np.array(term), np.array(query), np.array(x), np.array([floor.get(q, 0.0) for q in names]))
    held = blocks.sparkSession.sparkContext.broadcast(packed)
    id_type, q_type = blocks.schema["ids"].dataType.elementType, to_arrow_type(kind)

    def score(key, table):
        return _score_shard(held.value[key[0].as_py()], table, k, q_type)
    vocab = idf.select("graph", "term").distinct()
    near = F.broadcast(vocab)
    kept = shards.select("graph", "shard").distinct()
    hits = (blocks.select("graph", "shard", "term", "top", "impacts", "ids").join(near, ["graph", "term"]).join(kept, ["graph", "shard"], "left_semi")
            .groupBy("graph", "shard").applyInArrow(score, f"query_id {kind.simpleString()}, doc_id {id_type.simpleString()}, score double"))
    return leg_rank(hits, k)


def _score_shard(asked: tuple, table: pa.Table, k: int, q_type: pa.DataType) -> pa.Table:
    """What the units of one shard score for the queries whose floors its bounds reach."""
    words, names, term, query, idf, floor = asked
    ids = table.column("ids").combine_chunks()
    units = pc.dictionary_encode(ids.flatten(), null_encoding="encode")
    own, n = units.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(units.dictionary)
    impact = table.column("impacts").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
    code = pc.index_in(table.column("term").combine_chunks(), value_set=pa.array(words, pa.string())).to_numpy(zero_copy_only=False)
    place = np.full(len(words), -1)
    place[code] = np.arange(len(code))
    here = place[term] >= 0
    block, query, idf = place[term[here]], query[here], idf[here]
    bound = np.bincount(query, idf * table.column("top").to_numpy()[block], minlength=len(names))
    met = np.flatnonzero((bound > 0) & (bound + SLACK >= floor))
    start = np.cumsum(sizes) - sizes
    out = []
    for a in range(0, len(met), max(1, SCORE_CELLS // max(1, n))):
        part = met[a:a + max(1, SCORE_CELLS // max(1, n))]
        column = np.full(len(names), -1)
        column[part] = np.arange(len(part))
        mine = column[query] >= 0
        b, c, x = block[mine], column[query[mine]], idf[mine]
        # every posting of every (block, query)
        at = np.repeat(start[b] - (np.cumsum(sizes[b]) - sizes[b]), sizes[b]) + np.arange(sizes[b].sum())
        s = np.bincount(np.repeat(c, sizes[b]) * n + own[at], np.repeat(x, sizes[b]) * impact[at], minlength=len(part) * n).reshape(len(part), n)
        q, u = np.nonzero((s > 0) & (s + SLACK >= floor[part][:, None]))
        s = np.round(s[q, u], SCORE_DIGITS)
        rank = pc.rank(units.dictionary, null_placement="at_start").to_numpy()[u] if len(u) else u
        order = np.lexsort((rank, -s, q))
        q, u, s = q[order], u[order], s[order]
        counts = np.bincount(q, minlength=len(part))
        top = np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts) < k
        out.append((part[q[top]], u[top], s[top]))
    q, u, s = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return pa.table([pa.array(names, q_type).take(pa.array(q, pa.int64())), units.dictionary.take(pa.array(u, pa.int64())), pa.array(s, pa.float64())],
                    names=["query_id", "doc_id", "score"])
