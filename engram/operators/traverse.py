"""Traversal over the typed memory graph (OP-30, the graph leg of OP-33).

Nodes are entities and episodes. Two kinds of edges join them, and both are walked in
either direction: MENTIONS (episode - entity) and RELATES_TO (entity - entity, a fact).

Scale notes
- ``store_edges`` writes the edges once, bucketed by the node they leave from, so the
  joins of every hop read them where they lie and only the frontier moves. A hub's edges
  are dealt over several salted keys, so no bucket holds more than about ``hub_degree``
  edges of one node; the frontier row of a hub is copied to all of them.
- ``entity_leg`` needs the first ``depth`` facts of each node only: all facts that a
  query reaches by one node over the same number of steps have one score, and ties
  go to the smaller id. Lists of the smallest ids are kept per node, and a hub's
  neighbours are cut to the ``depth`` of them whose lists start first, which is exact.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from engram.functions.common import rounded_score, top_k_per_group
from engram.session import drop_path, reliable_checkpoint, scratch_path

HUB_DEGREE = 1_000_000          # edges of one node under one key
MAX_BROADCAST_HUBS = 500_000
MAX_BROADCAST_NODES = 1_000_000
MAX_BROADCAST_FRONTIER = 100_000    # nodes of a hop that go to the edges instead of being dealt by bucket


# ---------------------------------------------------------------- typed edges
def typed_edges(mentions: DataFrame, facts: DataFrame) -> DataFrame:
    """(graph, kind, node, label, to_kind, to_node): every edge in both directions.

    ``mentions``: (graph, episode_uuid, entity_uuid); ``facts``: (graph, source_uuid, target_uuid)."""
    def both(df, label, a_kind, a, b_kind, b):
        ends = [(a_kind, a, b_kind, b), (b_kind, b, a_kind, a)]
        return df.select("graph", F.explode(F.array(*[F.struct(
            F.lit(k).alias("kind"), F.col(x).alias("node"), F.lit(label).alias("label"),
            F.lit(k2).alias("to_kind"), F.col(y).alias("to_node")) for k, x, k2, y in ends])).alias("e")).select("graph", "e.*")

    return both(mentions, "MENTIONS", "episode", "episode_uuid", "entity", "entity_uuid").unionByName(
        both(facts, "RELATES_TO", "entity", "source_uuid", "entity", "target_uuid"))


@dataclass
class EdgeStore:
    """Edges written once: a bucketed table and the list of hubs."""
    table: str
    hubs: DataFrame
    n_hubs: int

    def hub_side(self) -> DataFrame:
        return F.broadcast(self.hubs) if self.n_hubs <= MAX_BROADCAST_HUBS else self.hubs


def _key(salt) -> F.Column:
    return F.xxhash64("graph", "kind", F.col("node").cast("string"), salt)


def store_edges(edges: DataFrame, hub_degree: int = HUB_DEGREE, buckets: int | None = None) -> EdgeStore:
    """Write ``typed_edges`` bucketed by node into the shared folder."""
    spark = edges.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # what the edges are made from is worked out once: hubs are counted in the written rows
    once = scratch_path(spark, "edges-once")
    edges.filter(F.col("node").isNotNull() & F.col("to_node").isNotNull()).write.parquet(once)
    edges = spark.read.schema(edges.schema).parquet(once)
    hubs = reliable_checkpoint(edges.groupBy("graph", "kind", "node").agg(F.count(F.lit(1)).alias("n"))
                               .filter(F.col("n") > hub_degree)
                               .select("graph", "kind", "node", F.ceil(F.col("n") / hub_degree).cast("int").alias("parts")))
    store = EdgeStore(f"engram_edges_{uuid.uuid4().hex}", hubs, hubs.count())
    salt = F.pmod(F.xxhash64("to_kind", F.col("to_node").cast("string")), F.coalesce("parts", F.lit(1)))
    keyed = (edges.join(store.hub_side(), ["graph", "kind", "node"], "left")
             .withColumn("key", _key(salt.cast("int"))).drop("parts"))
    (keyed.repartition(n, "key").write.option("path", scratch_path(spark, "edges")).bucketBy(n, "key").sortBy("key")
     .format("parquet").saveAsTable(store.table))
    drop_path(spark, once)
    return store


def drop_edges(spark, store: EdgeStore) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {store.table}")


def step(frontier: DataFrame, store: EdgeStore, labels: list[str] | None = None, small: bool = False) -> DataFrame:
    """Distinct nodes one edge away from ``frontier`` (graph, kind, node); a ``small`` one is
    sent to the edges, so that those are only read."""
    spark = frontier.sparkSession
    ahead = (frontier.select("graph", "kind", "node").join(store.hub_side(), ["graph", "kind", "node"], "left")
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
             .select(_key(F.col("salt")).alias("key"), F.col("graph").alias("g"), F.col("kind").alias("k"), F.col("node").alias("n")))
    edges = spark.table(store.table)
    if labels is not None:
        edges = edges.filter(F.col("label").isin(labels))
    # the key finds the bucket; the node itself decides
    met = edges.join(F.broadcast(ahead) if small else ahead, "key").filter((F.col("graph") == F.col("g")) & (F.col("kind") == F.col("k")) & (F.col("node") == F.col("n")))
    return met.select("graph", F.col("to_kind").alias("kind"), F.col("to_node").alias("node")).distinct()


def graph_expand(seeds: DataFrame, store: EdgeStore, hops: int, labels: list[str] | None = None) -> DataFrame:
    """OP-30: nodes within ``hops`` undirected steps of the seeds -> (graph, kind, node, hop).

    ``seeds``: (graph, kind, node), hop 0. Each hop's new nodes are written to the shared
    checkpoint folder, so no hop is computed twice. ``labels`` restricts the edge types."""
    frontier = reliable_checkpoint(seeds.select("graph", "kind", "node").distinct())
    visited, out = frontier, frontier.withColumn("hop", F.lit(0))
    for h in range(1, hops + 1):
        small = frontier.count() <= MAX_BROADCAST_FRONTIER
        frontier = reliable_checkpoint(step(frontier, store, labels, small).join(visited, ["graph", "kind", "node"], "left_anti"))
        visited, out = visited.unionByName(frontier), out.unionByName(frontier.withColumn("hop", F.lit(h)))
    return out


# ---------------------------------------------------------------- the graph leg
def _entity(c: str) -> F.Column:
    return F.concat(F.lit("entity:"), F.col(c))


def _episode(c: str) -> F.Column:
    return F.concat(F.lit("episode:"), F.col(c).cast("string"))


def fact_links(facts: DataFrame) -> DataFrame:
    """(graph, node, other): distinct undirected edges behind ``facts`` (graph, doc_id,
    source, target, episode): RELATES_TO between source and target, MENTIONS between the
    episode and each of them. A fact without target has the source alone."""
    pairs = [(_entity("source"), _entity("target")), (_episode("episode"), _entity("source")), (_episode("episode"), _entity("target"))]
    pairs += [(b, a) for a, b in pairs]
    return (facts.select("graph", F.explode(F.array(*[F.struct(a.alias("node"), b.alias("other")) for a, b in pairs])).alias("e"))
            .select("graph", "e.node", "e.other").filter("node is not null and other is not null and node <> other").distinct())


def fact_reach(facts: DataFrame, depth: int) -> DataFrame:
    """(graph, node, doc_id, r): the first ``depth`` facts by id of every node. A fact hangs
    on its source, its target and the episode it was said in."""
    nodes = F.explode(F.array_distinct(F.array_compact(F.array(_entity("source"), _entity("target"), _episode("episode")))))
    return top_k_per_group(facts.select("graph", nodes.alias("node"), "doc_id"), ["graph", "node"], [F.asc("doc_id")], depth,
                           rank_col="r", salt_col=F.xxhash64("doc_id"))


def entity_leg(seeds: DataFrame, facts: DataFrame, links: DataFrame, reach: DataFrame, depth: int, n_seeds: int) -> DataFrame:
    """Facts around the entities of a leg's best hits -> (query_id, doc_id, score, rank).

    ``seeds``: (query_id, doc_id, rank), ``n_seeds`` rows at most; their facts' sources and
    targets are the seed entities. A fact that hangs on a seed entity scores 1 / rank of
    the hit; one that hangs on a neighbour (an entity related to it, or an episode that
    mentions it) scores 1 / (rank + 1). The best way counts."""
    near = F.broadcast if n_seeds <= MAX_BROADCAST_NODES else (lambda df: df)
    hit = facts.select("graph", "doc_id", "source", "target").join(near(seeds.select("query_id", "doc_id", "rank")), "doc_id")
    start = reliable_checkpoint(hit.select("query_id", "graph", "rank", F.explode(F.array_compact(F.array(
        _entity("source"), _entity("target")))).alias("node")).groupBy("query_id", "graph", "node").agg(F.min("rank").alias("rank")))
    nodes = near(start.select("graph", "node").distinct())
    here = reach.join(nodes, ["graph", "node"]).select("graph", "node", "doc_id", F.lit(0).alias("hop"))
    lead = reach.filter("r = 1").select("graph", F.col("node").alias("other"), F.col("doc_id").alias("lead"))
    beside = links.join(nodes, ["graph", "node"]).join(lead, ["graph", "other"])
    beside = top_k_per_group(beside, ["graph", "node"], [F.asc("lead"), F.asc("other")], depth, rank_col="o", salt_col=F.xxhash64("other"))
    there = (beside.select("graph", "node", "other").join(reach.select("graph", F.col("node").alias("other"), "doc_id"), ["graph", "other"])
             .select("graph", "node", "doc_id").distinct())
    there = top_k_per_group(there, ["graph", "node"], [F.asc("doc_id")], depth, rank_col="o", salt_col=F.xxhash64("doc_id"))
    lists = here.unionByName(there.select("graph", "node", "doc_id", F.lit(1).alias("hop")))
    scored = (lists.join(near(start), ["graph", "node"]).groupBy("query_id", "doc_id")
              .agg(rounded_score(1.0 / F.min(F.col("rank") + F.col("hop"))).alias("score")))
    return top_k_per_group(scored, ["query_id"], [F.desc("score"), F.asc("doc_id")], depth, salt_col=F.xxhash64("doc_id"))
