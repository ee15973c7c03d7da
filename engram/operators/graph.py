"""Graph maintenance: compaction, cascade delete, provenance,
stats, growth, label scans, entity-type filter (traversal is in ``traverse``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from engram.operators.temporal import cutoff_expr
from engram.session import reliable_checkpoint

MAX_BROADCAST_ENTITIES = 1_000_000      # deleted entities that go to the facts


# ---------------------------------------------------------------- OP-05 / U1
def all_nodes(episodes: DataFrame, entities: DataFrame) -> DataFrame:
    return (episodes.select("graph", "uuid", F.lit("Episodic").alias("label"))
            .unionByName(entities.select("graph", "uuid", F.lit("Entity").alias("label"))))


def all_edges(mentions: DataFrame, facts: DataFrame) -> DataFrame:
    return (mentions.select("graph", F.lit("MENTIONS").alias("label"))
            .unionByName(facts.select("graph", F.lit("RELATES_TO").alias("label"))))


def graph_scan(episodes, entities, mentions, facts) -> DataFrame:
    """OP-05: node and edge counts by label per graph (one scan per table)."""
    nodes = all_nodes(episodes, entities).select("graph", F.lit("node").alias("kind"), "label")
    edges = all_edges(mentions, facts).select("graph", F.lit("edge").alias("kind"), "label")
    return nodes.unionByName(edges).groupBy("graph", "kind", "label").agg(
        F.count(F.lit(1)).alias("n"))


def all_graphs(per_tier: dict[str, DataFrame]) -> DataFrame:
    """OP-U1: one frame over several graphs, each tagged with its graph name."""
    frames = [df.withColumn("graph", F.lit(g)) for g, df in per_tier.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ---------------------------------------------------------------- OP-38
def graph_stats(episodes, entities, mentions, facts, graphs: list[str]) -> DataFrame:
    """OP-38: nodes (all labels), edges (all types), episodes per requested graph.

    One union of narrow projections, one partial+final hash aggregate; the
    requested list is left-joined so an unknown graph shows nulls (printed '?').
    """
    tagged = (episodes.select("graph", F.lit(1).alias("node"), F.lit(0).alias("edge"), F.lit(1).alias("ep"))
              .unionByName(entities.select("graph", F.lit(1).alias("node"), F.lit(0).alias("edge"), F.lit(0).alias("ep")))
              .unionByName(mentions.select("graph", F.lit(0).alias("node"), F.lit(1).alias("edge"), F.lit(0).alias("ep")))
              .unionByName(facts.select("graph", F.lit(0).alias("node"), F.lit(1).alias("edge"), F.lit(0).alias("ep"))))
    counts = tagged.groupBy("graph").agg(
        F.sum("node").cast("long").alias("nodes"), F.sum("edge").cast("long").alias("edges"),
        F.sum("ep").cast("long").alias("episodes"))
    spark = episodes.sparkSession
    wanted = spark.createDataFrame([(g, i) for i, g in enumerate(graphs)], "graph string, pos int")
    return wanted.join(counts, "graph", "left").select(
        "graph", "pos", "nodes", "edges", "episodes")


# ---------------------------------------------------------------- OP-43 / 26
def compaction_report(episodes, facts, now, days: int, apply: bool = False) -> DataFrame:
    """OP-43: per graph total episodes, older than cutoff, oldest, fact count, verdict."""
    cut = cutoff_expr(now, days)
    ep = episodes.groupBy("graph").agg(
        F.count(F.lit(1)).alias("total_episodes"),
        F.count_if(F.col("created_at") < cut).alias("old_episodes"),
        F.min("created_at").alias("oldest"))
    fc = facts.groupBy("graph").agg(F.count(F.lit(1)).alias("facts"))
    out = ep.join(fc, "graph", "full").fillna(0, ["total_episodes", "old_episodes", "facts"])
    verdict = (F.when(F.col("old_episodes") == 0, F.lit("nothing to compact"))
               .otherwise(F.lit("applied" if apply else "dry run")))
    return out.withColumn("verdict", verdict)


def compact_episodes(episodes, mentions, facts, now, days: int):
    """OP-26: drop episodes older than the cutoff and their MENTIONS edges.

    Entities and facts are untouched (stale ids stay in ``facts.episodes``).
    The age test is row-local, so kept episodes need no join; only mentions are
    anti-joined with the old ids. Returns (episodes', mentions', report).
    """
    cut = cutoff_expr(now, days)
    is_old = F.coalesce(F.col("created_at") < cut, F.lit(False))
    old_ids = episodes.filter(is_old).select("graph", F.col("uuid").alias("episode_uuid"))
    kept = episodes.filter(~is_old)
    kept_mentions = mentions.join(old_ids, ["graph", "episode_uuid"], "left_anti")
    report = compaction_counts(episodes, is_old, mentions, old_ids, facts)
    return kept, kept_mentions, report


def compaction_counts(episodes, is_old, mentions, old_ids, facts) -> DataFrame:
    """Before/after counts per graph from ONE union and ONE aggregate: each
    table is read once and tagged; the mention tag comes from a left join
    with the old ids (the same join the compaction itself needs)."""
    z = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    ep = episodes.select("graph", one.alias("eb"), F.when(is_old, 0).otherwise(1).cast("long").alias("ea"),
                         z.alias("mb"), z.alias("ma"), z.alias("fb"))
    flagged = mentions.join(old_ids.withColumn("_old", F.lit(1)), ["graph", "episode_uuid"], "left")
    mn = flagged.select("graph", z.alias("eb"), z.alias("ea"), one.alias("mb"),
                        F.when(F.col("_old").isNull(), 1).otherwise(0).cast("long").alias("ma"), z.alias("fb"))
    fc = facts.select("graph", z.alias("eb"), z.alias("ea"), z.alias("mb"), z.alias("ma"), one.alias("fb"))
    return ep.unionByName(mn).unionByName(fc).groupBy("graph").agg(
        F.sum("eb").alias("episodes_before"), F.sum("ea").alias("episodes_after"),
        F.sum("mb").alias("mentions_before"), F.sum("ma").alias("mentions_after"),
        F.sum("fb").alias("facts_before"))


def apply_compaction(episodes, mentions, live_facts, now, days: int, out_root: str) -> DataFrame:
    """OP-26 with ``--apply``: write the compacted episodes and mentions to a new
    location (never in place), then count again what is live.

    ``live_facts()`` reads the live fact table; it is counted before the first write
    and, anew, after the last one, and a difference in any graph is an error. Returns
    the report (one row a graph)."""
    before = {r["graph"]: r["n"] for r in live_facts().groupBy("graph").agg(F.count(F.lit(1)).alias("n")).collect()}
    cut = cutoff_expr(now, days)
    is_old = F.coalesce(F.col("created_at") < cut, F.lit(False))
    old_ids = episodes.filter(is_old).select("graph", F.col("uuid").alias("episode_uuid"))
    root = out_root.rstrip("/")
    episodes.filter(~is_old).write.mode("errorifexists").parquet(f"{root}/episodes")
    mentions.join(old_ids, ["graph", "episode_uuid"], "left_anti").write.mode("errorifexists").parquet(f"{root}/mentions")
    spark = episodes.sparkSession
    z, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    names = {"episodes_before": episodes, "episodes_after": spark.read.schema(episodes.schema).parquet(f"{root}/episodes"),
             "mentions_before": mentions, "mentions_after": spark.read.schema(mentions.schema).parquet(f"{root}/mentions"),
             "facts_before": None, "facts_after": live_facts()}
    union = spark.createDataFrame([(g, 0, 0, 0, 0, n, 0) for g, n in before.items()],
                                  "graph string, " + ", ".join(f"{c} long" for c in names))
    for name, df in names.items():
        if df is not None:
            union = union.unionByName(df.select("graph", *[(one if c == name else z).alias(c) for c in names]))
    report = (union.groupBy("graph").agg(*[F.sum(c).alias(c) for c in names])
              .withColumn("facts_unchanged", F.col("facts_before") == F.col("facts_after")))
    assert_facts_unchanged(report)
    return report


def assert_facts_unchanged(report: DataFrame) -> None:
    """The self-check after compaction: fact counts must not move."""
    moved = [r["graph"] for r in report.filter(~F.col("facts_unchanged")).select("graph").collect()]
    if moved:
        raise RuntimeError(f"compaction must not touch facts, but their number differs in {', '.join(map(str, moved))}")


# ---------------------------------------------------------------- OP-27
def remove_episode_cascade(deleted: DataFrame, mentions: DataFrame, facts: DataFrame,
                           fact_endpoints: tuple[str, str] | None = None):
    """OP-27, set form of ``delete_episode`` for a batch of episode ids.

    ``deleted``: (graph, episode_uuid). Facts whose first provenance episode is
    deleted go; entities whose every mention is by a deleted episode go (an
    entity without mentions stays); with ``fact_endpoints`` facts touching a
    deleted entity go too. Agrees with deleting the episodes one at a time in
    any order. Returns (deleted_entities, deleted_facts).

    Skew: the per-entity test is a hash aggregate (partial counts map-side), so
    an entity mentioned by a third of all episodes costs no more than others.
    """
    flag = deleted.select("graph", "episode_uuid", F.lit(1).alias("_del"))
    m = mentions.join(flag, ["graph", "episode_uuid"], "left")
    per_entity = m.groupBy("graph", "entity_uuid").agg(
        F.count(F.lit(1)).alias("n_mentions"),
        F.count("_del").alias("n_deleted"))
    gone_entities = per_entity.filter(
        (F.col("n_mentions") == F.col("n_deleted")) & (F.col("n_deleted") > 0)
    ).select("graph", F.col("entity_uuid").alias("uuid"))

    first = facts.withColumn("episode_uuid", F.try_element_at("episodes", F.lit(1)))
    if fact_endpoints is None or not len(fact_endpoints):
        gone_facts = first.join(deleted.select("graph", "episode_uuid"), ["graph", "episode_uuid"],
                                "left_semi").drop("episode_uuid")
        return gone_entities, gone_facts
    # one pass over the facts: they are exchanged by episode, the deleted entities come to them
    gone_entities = reliable_checkpoint(gone_entities)
    near = F.broadcast if gone_entities.count() <= MAX_BROADCAST_ENTITIES else (lambda df: df)
    hit, flags = first.join(deleted.select("graph", "episode_uuid", F.lit(True).alias("_ep")).distinct(), ["graph", "episode_uuid"], "left"), ["_ep"]
    for end in fact_endpoints:
        flags.append(f"_at_{end}")
        hit = hit.join(near(gone_entities.select("graph", F.col("uuid").alias(end), F.lit(True).alias(flags[-1]))), ["graph", end], "left")
    gone_facts = (hit.filter(F.coalesce(*flags, F.lit(False))).select(*facts.columns)
                  .dropDuplicates(["graph", "uuid"]))
    return gone_entities, gone_facts


# ---------------------------------------------------------------- OP-28
def dangling_provenance(facts: DataFrame, episodes: DataFrame) -> DataFrame:
    """OP-28: facts whose ``episodes`` list names episodes no longer stored."""
    refs = facts.select("graph", "uuid", F.explode("episodes").alias("episode_uuid"))
    present = episodes.select("graph", F.col("uuid").alias("episode_uuid"))
    missing = refs.join(present, ["graph", "episode_uuid"], "left_anti")
    return missing.groupBy("graph", "uuid").agg(F.count(F.lit(1)).alias("n_dangling"))


# ---------------------------------------------------------------- OP-W4
def graph_growth(episodes: DataFrame, unit: str = "month") -> DataFrame:
    """OP-W4: new and cumulative episodes per period; silent periods appear.

    The calendar per graph comes from ``sequence(min, max)``; windows are
    partitioned by graph over one row per period (small), never over episodes.
    """
    per = episodes.filter(F.col("created_at").isNotNull()).withColumn(
        "period", F.date_trunc(unit, F.col("created_at")).cast("timestamp_ntz"))
    counts = per.groupBy("graph", "period").agg(F.count(F.lit(1)).alias("new_episodes"))
    bounds = counts.groupBy("graph").agg(F.min("period").alias("lo"), F.max("period").alias("hi"))
    cal = bounds.select("graph", F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL 1 {unit.upper()}"))).alias("period"))
    filled = cal.join(counts, ["graph", "period"], "left").fillna(0, ["new_episodes"])
    w = Window.partitionBy("graph").orderBy("period")
    return (filled
            .withColumn("total_episodes", F.sum("new_episodes").over(
                w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
            .withColumn("delta", (F.col("total_episodes") - F.lag("total_episodes").over(w)).cast("long"))
            .withColumn("is_flat", F.col("new_episodes") == 0))


# ---------------------------------------------------------------- OP-29
def filter_entity_types(entities: DataFrame, entity_types: list[str] | None) -> DataFrame:
    """OP-29: restrict to ontology types; an empty or missing list means no filter."""
    if not entity_types:
        return entities
    return entities.filter(F.col("entity_type").isin(list(entity_types)))
