"""Registered queries: write queue, streams, snapshots (OP-07, 45, 46, 47, 48)."""

from __future__ import annotations

from pyspark.sql import functions as F

from engram.functions.common import ntz
from engram.operators import admission as A
from engram.operators.queue import queue_admission
from engram.plans import derive
from engram.plans.catalog_text import LINE_RE2, MD_CTE, WR_CTE, WS, _norm_sql  # noqa: F401
from engram.plans.registry import register
from engram.plans.sql_snippets import ENTITIES_CTE, EPISODES_CTE, FACTS_CTE, mentions_cte
from engram.sinks.snapshot import (
    append_episodes,
    export_snapshot,
    live_path,
    manifest,
    read_episodes,
    restore_snapshot,
    upsert_episodes,
)
from engram.session import scratch_path
from engram.sources.access_log import log_stream
from engram.sources.tables import Tables, read_table
from engram.streaming import pipelines as P
from engram.streaming.runner import file_stream, run_available_now, run_in_parts, run_resumed

CAP = 3

QUEUE_SQL = f"""
WITH RECURSIVE ev AS (
  SELECT CAST(user_id AS VARCHAR) AS group_id, event_id,
         CASE WHEN event_type = 'purchase' THEN 'done' ELSE 'add' END AS kind,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
  FROM events),
st AS (
  SELECT group_id, n, event_id, kind, 0 AS p_before,
         CASE WHEN kind = 'add' THEN least(1, {CAP}) ELSE 0 END AS p_after
  FROM ev WHERE n = 1
  UNION ALL
  SELECT e.group_id, e.n, e.event_id, e.kind, s.p_after,
         CASE WHEN e.kind = 'add' THEN least(s.p_after + 1, {CAP}) ELSE greatest(s.p_after - 1, 0) END
  FROM st s JOIN ev e ON e.group_id = s.group_id AND e.n = s.n + 1)
SELECT group_id, event_id, kind, CAST(p_before AS BIGINT) AS pending_before,
       CASE WHEN kind = 'done' THEN 'done' WHEN p_before >= {CAP} THEN 'rejected' ELSE 'accepted' END AS decision,
       CASE WHEN kind = 'add' AND p_before >= {CAP}
            THEN 'queue full for group ' || group_id || ' ({CAP} pending)' END AS reason
FROM st"""

OUT = ["group_id", "event_id", "kind", "pending_before", "decision", "reason"]


@register("queue_admission", sql=QUEUE_SQL)
def q_queue_admission(spark, d):
    return queue_admission(derive.queue_events(Tables(spark, d)), CAP, bucket="day").select(*OUT)


def _events_stream(spark, d):
    schema = read_table(spark, d, "events").schema
    return file_stream(spark, f"{d.rstrip('/')}/events*.parquet", schema)


@register("stream_queue_admission", sql=QUEUE_SQL)
def q_stream_queue_admission(spark, d):
    """Three stretches of time, one after the other, through a resumed stream."""
    base, ev = scratch_path(spark, "admission"), derive.queue_events(Tables(spark, d))
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).head()
    cuts = [ntz(lo + (hi - lo) * k / 3) for k in (1, 2)] if lo else []
    parts = [F.col("ts") < cuts[0], (F.col("ts") >= cuts[0]) & (F.col("ts") < cuts[1]), F.col("ts") >= cuts[1]] if cuts else [F.lit(True)]
    run_in_parts(ev, "admission", parts, lambda s: s, P.admission_batches(base, CAP))
    return spark.read.parquet(f"{base}/decisions").select(*OUT)


INGEST_CAPS = {"personal": 40, "client": 0}
ARRIVALS = 4    # the requests arrive in this many parts, by doc_id


@register("stream_ingest", sql=f"""WITH {WR_CTE},
guarded AS (SELECT *, NOT coalesce(graph = 'personal' AND regexp_matches(
  coalesce(name, '') || chr(10) || coalesce(source_description, '') || chr(10) || coalesce(episode_body, ''),
  '{A.LICENSE_PATTERN}'), false) AS passed FROM wre),
queued AS (SELECT *, row_number() OVER (PARTITION BY graph, effective_group_id, passed ORDER BY doc_id % {ARRIVALS}, doc_id) AS place FROM guarded),
judged AS (SELECT *, CASE WHEN NOT passed THEN 'tier guard: matches reject_pattern'
                          WHEN graph = 'personal' AND place > {INGEST_CAPS['personal']}
                          THEN 'queue full for group ' || effective_group_id || ' ({INGEST_CAPS['personal']} pending)' END AS reject_reason FROM queued)
SELECT doc_id, graph, effective_group_id, effective_source_description, reject_reason, reject_reason IS NULL AS stored FROM judged""")
def q_stream_ingest(spark, d):
    """Guard, group, backpressure and attribution over several micro-batches; the counts of
    the queues are carried from one to the next."""
    requests, base = derive.write_requests(Tables(spark, d)), scratch_path(spark, "ingest")
    run_in_parts(requests, "ingest", [F.col("doc_id") % ARRIVALS == k for k in range(ARRIVALS)],
                 lambda s: P.ingest_stream(s, {"personal": A.LICENSE_PATTERN, "client": None}), P.ingest_batches(base, INGEST_CAPS))
    cols = ["doc_id", "graph", "effective_group_id", "effective_source_description"]
    kept = spark.read.parquet(f"{base}/episodes").select(*cols, F.lit(None).cast("string").alias("reject_reason"))
    refused = spark.read.parquet(f"{base}/rejects").select(*cols, "reject_reason")
    return kept.unionByName(refused).withColumn("stored", F.col("reject_reason").isNull())


ACT_SQL = """
WITH lines AS (
  SELECT CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS t,
         'h:' || CAST(8000 + user_id % 3 AS VARCHAR) AS host,
         CASE WHEN event_type = 'error' THEN 401 ELSE 200 END AS status
  FROM events),
typed AS (SELECT t, CASE regexp_extract(host, ':([^:]*)$', 1) WHEN '8000' THEN 'personal'
                        WHEN '8001' THEN 'client' ELSE '?' END AS tier,
                 CAST(CAST(floor(status / 100) AS BIGINT) AS VARCHAR) || 'xx' AS klass, status
          FROM lines WHERE t IS NOT NULL),
w AS (SELECT (t // 3600) * 3600 AS window_start, tier, klass, count(*) AS requests,
             count(*) FILTER (WHERE status = 401) AS unauthorized FROM typed GROUP BY ALL)
SELECT window_start, tier, klass, requests, unauthorized FROM w
WHERE window_start + 3600 <= (SELECT max(t) FROM typed) - 600"""


@register("stream_activity", sql=ACT_SQL)
def q_stream_activity(spark, d):
    lines = derive.log_lines_from_events(_events_stream(spark, d)).select("line")
    out = run_available_now(P.activity_stream(lines, "1 hour", "10 minutes"), "activity")
    return spark.read.parquet(out)


@register("stream_dedup", sql=f"""WITH {WR_CTE},
b AS (SELECT DISTINCT graph, effective_group_id, sha256({_norm_sql('episode_body')}) AS text_key FROM wre),
s AS (SELECT DISTINCT 'personal' AS graph, 'personal' AS effective_group_id,
             sha256({_norm_sql('text')}) AS text_key FROM benchmark)
SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.graph = b.graph
   AND s.effective_group_id = b.effective_group_id AND s.text_key = b.text_key)""")
def q_stream_dedup(spark, d):
    schema = read_table(spark, d, "documents").schema
    docs = file_stream(spark, f"{d.rstrip('/')}/documents*.parquet", schema)
    req = A.effective_group(derive.requests_from_documents(docs))
    store = Tables(spark, d).benchmark.select(
        F.lit("personal").alias("graph"), F.lit("personal").alias("effective_group_id"),
        F.col("text").alias("episode_body"))
    # one write a second; keys are forgotten two days of event time after their last sight
    req = req.withColumn("event_time", F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")))
    flow = P.dedup_stream(req, store, ["graph", "effective_group_id"], "event_time", "2 days").select(
        "graph", "effective_group_id", "text_key")
    out = run_available_now(flow, "dedup")
    return spark.read.parquet(out)


SNAP_SQL = f"""
WITH {EPISODES_CTE}, {ENTITIES_CTE}, {mentions_cte()}, {FACTS_CTE}
SELECT 'episodes' AS "table", graph, count(*) AS "rows" FROM episodes GROUP BY graph
UNION ALL SELECT 'entities', graph, count(*) FROM entities GROUP BY graph
UNION ALL SELECT 'mentions', graph, count(*) FROM mentions GROUP BY graph
UNION ALL SELECT 'facts', graph, count(*) FROM facts GROUP BY graph"""


def _graph_tables(t):
    return {"episodes": derive.episodes(t), "entities": derive.entities(t),
            "mentions": derive.mentions(t), "facts": derive.facts(t)}


@register("snapshot_export", sql=SNAP_SQL)
def q_snapshot_export(spark, d):
    root = scratch_path(spark, "snapshots")
    return export_snapshot(_graph_tables(Tables(spark, d)), root, "snap").select("table", "graph", "rows")


@register("snapshot_restore", sql=SNAP_SQL)
def q_snapshot_restore(spark, d):
    """OP-08: export, restore into a fresh live location (explicit confirm), and
    recount what is live afterwards."""
    tables = _graph_tables(Tables(spark, d))
    root, live = scratch_path(spark, "snapshots"), scratch_path(spark, "live")
    export_snapshot(tables, root, "snap")
    restore_snapshot(spark, root, "snap", live, confirm=True)
    return manifest({n: spark.read.schema(df.schema).parquet(live_path(spark, live, n)) for n, df in tables.items()}
                    ).select("table", "graph", "rows")


@register("episode_sink", sql=f"""WITH {MD_CTE}, {WR_CTE}
SELECT c.rel_path, c.pos, CASE WHEN c.pos = 0 THEN c.rel_path ELSE c.rel_path || ' [' || CAST(c.pos + 1 AS VARCHAR) || ']' END AS name,
       w.graph, w.effective_group_id AS group_id
FROM chunks c JOIN wre w ON w.doc_id = c.doc_id""")
def q_episode_sink(spark, d):
    """OP-06: chunk episodes appended to the store (partitioned by tier and
    group), read back from what was written."""
    from engram.operators import chunking as C

    t = Tables(spark, d)
    req = A.effective_group(derive.write_requests(t)).select(
        "doc_id", "graph", F.col("effective_group_id").alias("group_id"))
    eps = C.episode_names(C.chunk_markdown(derive.markdown_texts(t).select("doc_id", "rel_path", "text")))
    path = scratch_path(spark, "episodes")
    stored = eps.join(req, "doc_id")
    append_episodes(stored, path)
    return read_episodes(spark, path, stored.schema).select("rel_path", "pos", "name", "graph", "group_id")


@register("episode_upsert", sql="""
WITH w AS (SELECT doc_id AS uuid, lang AS name, 1 AS wave, doc_id AS seq FROM documents WHERE doc_id % 4 <> 0
           UNION ALL SELECT doc_id, source, 2, doc_id FROM documents WHERE doc_id % 3 = 0
           UNION ALL SELECT doc_id - doc_id % 10, 'again ' || CAST(doc_id AS VARCHAR), 2, doc_id + 1000000000 FROM documents WHERE doc_id % 5 = 1)
SELECT uuid, name, wave FROM w QUALIFY row_number() OVER (PARTITION BY uuid ORDER BY wave DESC, seq DESC) = 1""")
def q_episode_upsert(spark, d):
    """OP-06 with repeated uuids: two batches, the second with stored and repeated ones."""
    docs, path = Tables(spark, d).documents, scratch_path(spark, "upserted")
    first = docs.filter("doc_id % 4 <> 0").select(F.col("doc_id").alias("uuid"), F.col("lang").alias("name"), F.lit(1).alias("wave"), F.col("doc_id").alias("seq"))
    again = (docs.filter("doc_id % 3 = 0").selectExpr("doc_id AS uuid", "source AS name", "2 AS wave", "doc_id AS seq")
             .unionByName(docs.filter("doc_id % 5 = 1").selectExpr("doc_id - doc_id % 10 AS uuid", "concat('again ', doc_id) AS name", "2 AS wave", "doc_id + 1000000000 AS seq")))
    for batch in (first, again):
        upsert_episodes(batch, path, ["seq"])
    return spark.read.parquet(path).select("uuid", "name", "wave")


ALERT_SQL = """
WITH lines AS (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS t, CASE (8000 + user_id % 3) WHEN 8000 THEN 'personal' WHEN 8001 THEN 'client' ELSE '?' END AS tier,
                      event_type = 'error' AS bad FROM events WHERE event_type <> 'signup'),
bad AS (SELECT tier, t, CASE WHEN t - lag(t) OVER (PARTITION BY tier ORDER BY t) < {gap} THEN 0 ELSE 1 END AS fresh FROM lines WHERE bad),
runs AS (SELECT tier, t, sum(fresh) OVER (PARTITION BY tier ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM bad)
SELECT tier, min(t) AS opened, max(t) AS last_seen, count(*) AS unauthorized FROM runs GROUP BY tier, run
HAVING count(*) >= {least} AND max(t) + {gap} <= (SELECT max(t) FROM lines) - 600"""
GAP, LEAST = 7200, 3


@register("stream_alerts", sql=ALERT_SQL.format(gap=GAP, least=LEAST))
def q_stream_alerts(spark, d):
    """OP-47: 401 outages over log files that arrive one after the other, read as text."""
    lines, src = derive.access_log(Tables(spark, d)), scratch_path(spark, "log")
    lo, hi = lines.agg(F.min("event_ts"), F.max("event_ts")).head()
    ckpt = out = None
    parts = [F.lit(True)] if not lo else [(F.col("event_ts") >= ntz(lo + (hi - lo) * k / 3) if k else F.lit(True))
                                          & (F.col("event_ts") < ntz(lo + (hi - lo) * (k + 1) / 3) if k < 2 else F.lit(True)) for k in range(3)]
    for part in parts:
        lines.filter(part).select("line").write.mode("append").text(src)
        flow = P.unauthorized_outages(log_stream(spark, src), f"{GAP} seconds", LEAST, "10 minutes")
        out, ckpt = run_resumed(flow, "alerts", out, ckpt)
    return spark.read.parquet(out)
