"""Registered queries: graph maintenance and traversal (OP-05, 25..30, 38, 43, W4, U1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from engram.functions.common import tier_of_parity
from engram.operators import graph as G
from engram.operators import temporal as T
from engram.operators import traverse as TR
from engram.plans import derive
from engram.plans.registry import register
from engram.plans.sql_snippets import ENTITIES_CTE, EPISODES_CTE, FACTS_CTE, PURCHASES_CTE, mentions_cte
from engram.session import scratch_path
from engram.sources.tables import Tables

NOW = "2001-08-01 00:00:00"
DAYS = 426                      # cutoff 2000-06-01 00:00:00
CUTOFF = "2000-06-01 00:00:00"
GRAPHS = ["personal", "client", "archive"]   # 'archive' does not exist -> nulls
NODE_TYPES = ["PROMO", "BUILDING"]
SEED_NAME, SEED_BRAND = "hot gear", "Brand#3"
HOPS = 3


@register("age_filter", sql=f"""
WITH {EPISODES_CTE}
SELECT graph, group_id, uuid, created_at FROM episodes
WHERE created_at < TIMESTAMP '{CUTOFF}'""")
def q_age_filter(spark, d):
    eps = derive.episodes(Tables(spark, d))
    return T.age_filter(eps, NOW, DAYS).select("graph", "group_id", "uuid", "created_at")


@register("compaction_report", sql=f"""
WITH {EPISODES_CTE}, {FACTS_CTE},
ep AS (SELECT graph, count(*) AS total_episodes,
              count(*) FILTER (WHERE created_at < TIMESTAMP '{CUTOFF}') AS old_episodes,
              min(created_at) AS oldest FROM episodes GROUP BY graph),
fc AS (SELECT graph, count(*) AS facts FROM facts GROUP BY graph)
SELECT coalesce(ep.graph, fc.graph) AS graph, coalesce(total_episodes, 0) AS total_episodes,
       coalesce(old_episodes, 0) AS old_episodes, oldest, coalesce(facts, 0) AS facts,
       CASE WHEN coalesce(old_episodes, 0) = 0 THEN 'nothing to compact' ELSE 'dry run' END AS verdict
FROM ep FULL JOIN fc ON ep.graph = fc.graph""")
def q_compaction_report(spark, d):
    t = Tables(spark, d)
    return G.compaction_report(derive.episodes(t), derive.facts(t), NOW, DAYS, apply=False)


@register("compact_episodes", sql=f"""
WITH {EPISODES_CTE}, {mentions_cte()}, {FACTS_CTE},
old AS (SELECT graph, uuid AS episode_uuid FROM episodes WHERE created_at < TIMESTAMP '{CUTOFF}'),
kept AS (SELECT * FROM episodes WHERE NOT coalesce(created_at < TIMESTAMP '{CUTOFF}', false)),
km AS (SELECT * FROM mentions m WHERE NOT EXISTS (
         SELECT 1 FROM old o WHERE o.graph = m.graph AND o.episode_uuid = m.episode_uuid)),
c1 AS (SELECT graph, count(*) AS episodes_before FROM episodes GROUP BY graph),
c2 AS (SELECT graph, count(*) AS episodes_after FROM kept GROUP BY graph),
c3 AS (SELECT graph, count(*) AS mentions_before FROM mentions GROUP BY graph),
c4 AS (SELECT graph, count(*) AS mentions_after FROM km GROUP BY graph),
c5 AS (SELECT graph, count(*) AS facts_before FROM facts GROUP BY graph),
c6 AS (SELECT graph, count(*) AS facts_after FROM facts GROUP BY graph)
SELECT graph, episodes_before, episodes_after, mentions_before, mentions_after,
       facts_before, facts_after, facts_before = facts_after AS facts_unchanged
FROM c1 JOIN c2 USING (graph) JOIN c3 USING (graph) JOIN c4 USING (graph) JOIN c5 USING (graph) JOIN c6 USING (graph)""")
def q_compact_episodes(spark, d):
    """Applied for real: facts are a live table, counted before and again after the write."""
    t = Tables(spark, d)
    live, root = scratch_path(spark, "live", "facts"), scratch_path(spark, "compacted")
    derive.facts(t).select("graph", "uuid").write.parquet(live)
    return G.apply_compaction(derive.episodes(t), derive.mentions(t), lambda: spark.read.parquet(live), NOW, DAYS, root)


CASCADE_CTE = f"""
{EPISODES_CTE}, {mentions_cte()}, {FACTS_CTE},
deleted AS (SELECT graph, uuid AS episode_uuid FROM episodes WHERE created_at < TIMESTAMP '{CUTOFF}')
"""


@register("cascade_entities", sql=f"""
WITH {CASCADE_CTE},
per AS (SELECT m.graph, m.entity_uuid, count(*) AS n, count(d.episode_uuid) AS nd
        FROM mentions m LEFT JOIN deleted d
          ON d.graph = m.graph AND d.episode_uuid = m.episode_uuid
        GROUP BY m.graph, m.entity_uuid)
SELECT graph, entity_uuid AS uuid FROM per WHERE n = nd AND nd > 0""")
def q_cascade_entities(spark, d):
    t = Tables(spark, d)
    deleted = T.age_filter(derive.episodes(t), NOW, DAYS).select(
        "graph", F.col("uuid").alias("episode_uuid"))
    ents, _ = G.remove_episode_cascade(deleted, derive.mentions(t), derive.facts(t))
    return ents


@register("cascade_facts", sql=f"""
WITH {CASCADE_CTE}
SELECT f.graph, f.uuid, f.subject FROM facts f
WHERE EXISTS (SELECT 1 FROM deleted d WHERE d.graph = f.graph AND d.episode_uuid = f.uuid)""")
def q_cascade_facts(spark, d):
    t = Tables(spark, d)
    deleted = T.age_filter(derive.episodes(t), NOW, DAYS).select(
        "graph", F.col("uuid").alias("episode_uuid"))
    _, facts = G.remove_episode_cascade(deleted, derive.mentions(t), derive.facts(t))
    return facts.select("graph", "uuid", "subject")


@register("cascade_purchases", sql=f"""
WITH {CASCADE_CTE}, {PURCHASES_CTE},
per AS (SELECT m.graph, m.entity_uuid, count(*) AS n, count(d.episode_uuid) AS nd
        FROM mentions m LEFT JOIN deleted d ON d.graph = m.graph AND d.episode_uuid = m.episode_uuid GROUP BY m.graph, m.entity_uuid),
gone AS (SELECT graph, entity_uuid AS uuid FROM per WHERE n = nd AND nd > 0)
SELECT p.graph, p.uuid, p.source_uuid, p.target_uuid FROM purchases p
WHERE EXISTS (SELECT 1 FROM deleted d WHERE d.graph = p.graph AND d.episode_uuid = p.episode)
   OR EXISTS (SELECT 1 FROM gone g WHERE g.graph = p.graph AND g.uuid IN (p.source_uuid, p.target_uuid))""")
def q_cascade_purchases(spark, d):
    """OP-27 with endpoints: facts that touch a deleted entity go with it."""
    t = Tables(spark, d)
    deleted = T.age_filter(derive.episodes(t), NOW, DAYS).select("graph", F.col("uuid").alias("episode_uuid"))
    _, facts = G.remove_episode_cascade(deleted, derive.mentions(t), derive.purchases(t), ("source_uuid", "target_uuid"))
    return facts.select("graph", "uuid", "source_uuid", "target_uuid")


@register("dangling_provenance", sql=f"""
WITH {EPISODES_CTE}, {FACTS_CTE},
kept AS (SELECT graph, uuid FROM episodes WHERE NOT coalesce(created_at < TIMESTAMP '{CUTOFF}', false)),
refs AS (SELECT graph, uuid, unnest([uuid]) AS episode_uuid FROM facts)
SELECT r.graph, r.uuid, count(*) AS n_dangling FROM refs r
WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.graph = r.graph AND k.uuid = r.episode_uuid)
GROUP BY r.graph, r.uuid""")
def q_dangling_provenance(spark, d):
    t = Tables(spark, d)
    kept, _, _ = G.compact_episodes(derive.episodes(t), derive.mentions(t), derive.facts(t), NOW, DAYS)
    return G.dangling_provenance(derive.facts(t), kept)


@register("graph_stats", sql=f"""
WITH {EPISODES_CTE}, {ENTITIES_CTE}, {mentions_cte()}, {FACTS_CTE},
tagged AS (SELECT graph, 1 AS node, 0 AS edge, 1 AS ep FROM episodes
           UNION ALL SELECT graph, 1, 0, 0 FROM entities
           UNION ALL SELECT graph, 0, 1, 0 FROM mentions
           UNION ALL SELECT graph, 0, 1, 0 FROM facts),
counts AS (SELECT graph, CAST(sum(node) AS BIGINT) AS nodes, CAST(sum(edge) AS BIGINT) AS edges,
                  CAST(sum(ep) AS BIGINT) AS episodes FROM tagged GROUP BY graph),
wanted AS (SELECT * FROM (VALUES ('personal', 0), ('client', 1), ('archive', 2)) t(graph, pos))
SELECT w.graph, w.pos, c.nodes, c.edges, c.episodes FROM wanted w LEFT JOIN counts c ON c.graph = w.graph""")
def q_graph_stats(spark, d):
    t = Tables(spark, d)
    return G.graph_stats(derive.episodes(t), derive.entities(t), derive.mentions(t),
                         derive.facts(t), GRAPHS)


@register("graph_scan", sql=f"""
WITH {EPISODES_CTE}, {ENTITIES_CTE}, {mentions_cte()}, {FACTS_CTE},
u AS (SELECT graph, 'node' AS kind, 'Episodic' AS label FROM episodes
      UNION ALL SELECT graph, 'node', 'Entity' FROM entities
      UNION ALL SELECT graph, 'edge', 'MENTIONS' FROM mentions
      UNION ALL SELECT graph, 'edge', 'RELATES_TO' FROM facts)
SELECT graph, kind, label, count(*) AS n FROM u GROUP BY graph, kind, label""")
def q_graph_scan(spark, d):
    t = Tables(spark, d)
    return G.graph_scan(derive.episodes(t), derive.entities(t), derive.mentions(t), derive.facts(t))


def _growth_sql(unit: str) -> str:
    return f"""
WITH {EPISODES_CTE},
counts AS (SELECT graph, date_trunc('{unit}', created_at) AS period, count(*) AS new_episodes
           FROM episodes WHERE created_at IS NOT NULL GROUP BY ALL),
bounds AS (SELECT graph, min(period) AS lo, max(period) AS hi FROM counts GROUP BY graph),
cal AS (SELECT graph, unnest(generate_series(lo, hi, INTERVAL 1 {unit})) AS period FROM bounds),
filled AS (SELECT c.graph, c.period, coalesce(n.new_episodes, 0) AS new_episodes
           FROM cal c LEFT JOIN counts n ON n.graph = c.graph AND n.period = c.period),
cum AS (SELECT *, CAST(sum(new_episodes) OVER (PARTITION BY graph ORDER BY period
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_episodes
        FROM filled)
SELECT graph, period, new_episodes, total_episodes,
       CAST(total_episodes - lag(total_episodes) OVER (PARTITION BY graph ORDER BY period) AS BIGINT) AS delta,
       new_episodes = 0 AS is_flat
FROM cum"""


@register("graph_growth", sql=_growth_sql("month"))
def q_graph_growth(spark, d):
    return G.graph_growth(derive.episodes(Tables(spark, d)), unit="month")


@register("graph_growth_daily", sql=_growth_sql("day"))
def q_graph_growth_daily(spark, d):
    return G.graph_growth(derive.episodes(Tables(spark, d)), unit="day")


@register("search_nodes_filter", sql=f"""
WITH {ENTITIES_CTE}
SELECT graph, uuid, name, entity_type FROM entities
WHERE graph = 'personal' AND entity_type IN ('PROMO', 'BUILDING')""")
def q_search_nodes_filter(spark, d):
    ents = derive.entities(Tables(spark, d)).filter(F.col("graph") == "personal")
    return G.filter_entity_types(ents, NODE_TYPES).select("graph", "uuid", "name", "entity_type")


@register("graph_expand", sql=f"""
WITH RECURSIVE {mentions_cte()}, {PURCHASES_CTE},
one_way AS (SELECT graph, 'episode' AS kind, episode_uuid AS node, 'entity' AS to_kind, entity_uuid AS to_node FROM mentions
            UNION ALL SELECT graph, 'entity', source_uuid, 'entity', target_uuid FROM purchases),
edges AS (SELECT * FROM one_way UNION ALL SELECT graph, to_kind, to_node, kind, node FROM one_way),
walk AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'personal' ELSE 'client' END AS graph, 'entity' AS kind, p_partkey AS node, 0 AS hop
         FROM part WHERE p_name = '{SEED_NAME}' AND p_brand = '{SEED_BRAND}'
         UNION
         SELECT e.graph, e.to_kind, e.to_node, w.hop + 1 FROM walk w
         JOIN edges e ON e.graph = w.graph AND e.kind = w.kind AND e.node = w.node WHERE w.hop < {HOPS})
SELECT graph, kind, node, min(hop) AS hop FROM walk GROUP BY graph, kind, node""")
def q_graph_expand(spark, d):
    """Over mentions and facts: without the purchases, no customer would be reached."""
    t = Tables(spark, d)
    seeds = (t.part.filter((F.col("p_name") == SEED_NAME) & (F.col("p_brand") == SEED_BRAND))
             .select(tier_of_parity(F.col("p_partkey")).alias("graph"), F.lit("entity").alias("kind"), F.col("p_partkey").alias("node")))
    store = TR.store_edges(TR.typed_edges(derive.mentions(t), derive.purchases(t)))
    out = TR.graph_expand(seeds, store, HOPS)
    TR.drop_edges(spark, store)     # every hop is written by now
    return out


@register("all_graphs", sql=f"""
WITH {EPISODES_CTE}
SELECT graph, count(*) AS episodes, min(created_at) AS oldest, max(created_at) AS newest
FROM episodes GROUP BY graph""")
def q_all_graphs(spark, d):
    eps = derive.episodes(Tables(spark, d))
    per_tier = {g: eps.filter(F.col("graph") == g).drop("graph") for g in ("personal", "client")}
    return G.all_graphs(per_tier).groupBy("graph").agg(
        F.count(F.lit(1)).alias("episodes"), F.min("created_at").alias("oldest"),
        F.max("created_at").alias("newest"))
