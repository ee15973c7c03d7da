"""Registered queries: text, chunking and the write path
(OP-09, 10, 11, 12, 13, 14, 17, 18, 22, 23, 36, 40, 41, S3, U3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from engram.functions.common import global_rank
from engram.functions.text import est_tokens, is_blank, split_lines
from engram.operators import admission as A
from engram.operators import chunking as C
from engram.plans import derive
from engram.plans.registry import register
from engram.sources.tables import Tables

# ---- DuckDB helpers (twins of the Spark expressions) ------------------------
_WS_CODES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203),
             8232, 8233, 8239, 8287, 12288]
WS = "||".join(f"chr({c})" for c in _WS_CODES)
WS_RE2 = (r"[\t\n\x0B\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
          r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
LINE_RE2 = r"\r\n|[\n\x0B\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"

MD_CTE = f"""
md AS (SELECT doc_id, source || '/' || CAST(doc_id AS VARCHAR) || '.md' AS rel_path,
         '# ' || source || ' ' || CAST(doc_id AS VARCHAR) || chr(10) || substring(text, 1, 200)
         || chr(10) || '## body' || chr(10) || substring(text, 201) AS text
       FROM documents),
msplit AS (SELECT doc_id, rel_path, string_split(regexp_replace(text, '(?m)^(#{{1,2}} )', chr(1) || '\\1', 'g'), chr(1)) AS l
           FROM md),
mparts AS (SELECT doc_id, rel_path, unnest(l) AS part, unnest(range(1, len(l) + 1)) AS i FROM msplit),
mkept AS (SELECT doc_id, rel_path, i, trim(part, {WS}) AS p FROM mparts WHERE length(trim(part, {WS})) > 0),
mslices AS (SELECT doc_id, rel_path, i, p, unnest(generate_series(0, (length(p) - 1) // 6000)) AS k FROM mkept),
chunks AS (SELECT doc_id, rel_path,
                  CAST(row_number() OVER (PARTITION BY rel_path ORDER BY i, k) - 1 AS INTEGER) AS pos,
                  substring(p, k * 6000 + 1, 6000) AS episode_body FROM mslices)
"""

WR_CTE = f"""
wr AS (SELECT doc_id,
         CASE WHEN CAST(regexp_extract(source, '(\\d+)', 1) AS BIGINT) % 2 = 0 THEN 'personal' ELSE 'client' END AS graph,
         CAST(doc_id AS VARCHAR) AS name, text AS episode_body, 'text' AS source,
         source AS source_description,
         CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' ELSE 'project-' || lang END AS group_id,
         CASE WHEN doc_id % 2 = 0 THEN lang END AS agent_id
       FROM documents),
wre AS (SELECT *, coalesce(nullif(group_id, ''),
                   CASE graph WHEN 'personal' THEN 'personal' WHEN 'client' THEN 'client' END) AS effective_group_id,
               CASE WHEN coalesce(length(agent_id) > 0, false)
                    THEN trim('[agent:' || agent_id || '] ' || coalesce(source_description, ''), {WS})
                    ELSE source_description END AS effective_source_description
        FROM wr)
"""

GUARD_TEXT_SQL = "coalesce(name, '') || chr(10) || coalesce(source_description, '') || chr(10) || coalesce(episode_body, '')"


def _norm_sql(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '{WS_RE2}+', ' ', 'g'), {WS})"


def _hygiene_case_sql(col: str) -> str:
    arms = " ".join(f"WHEN regexp_matches({col}, '{pat}') THEN '{name}'" for name, pat in A.HYGIENE_RULES)
    return f"CASE {arms} END"


# ---- chunking ---------------------------------------------------------------
@register("chunk_markdown", sql=f"WITH {MD_CTE} SELECT rel_path, pos, episode_body FROM chunks")
def q_chunk_markdown(spark, d):
    return C.chunk_markdown(derive.markdown_texts(Tables(spark, d)).select("rel_path", "text"))


@register("episode_name", sql=f"""WITH {MD_CTE}
SELECT rel_path, pos, CASE WHEN pos = 0 THEN rel_path ELSE rel_path || ' [' || CAST(pos + 1 AS VARCHAR) || ']' END AS name,
       'markdown ingest: ' || rel_path AS source_description FROM chunks""")
def q_episode_name(spark, d):
    ch = C.chunk_markdown(derive.markdown_texts(Tables(spark, d)).select("rel_path", "text"))
    return C.episode_names(ch).select("rel_path", "pos", "name", "source_description")


@register("ingest_dry_run", sql=f"""WITH {MD_CTE}
SELECT (SELECT count(*) FROM md) AS files, (SELECT count(*) FROM chunks) AS episodes""")
def q_ingest_dry_run(spark, d):
    return C.ingest_dry_run(derive.markdown_texts(Tables(spark, d)))


@register("path_order", sql="""
SELECT source || '/' || CAST(doc_id AS VARCHAR) || '.md' AS rel_path,
       row_number() OVER (ORDER BY string_split(source || '/' || CAST(doc_id AS VARCHAR) || '.md', '/')) AS ordinal
FROM documents""")
def q_path_order(spark, d):
    files = derive.markdown_texts(Tables(spark, d)).select("rel_path")
    return global_rank(files, [C.path_order_key()], "ordinal").select("rel_path", "ordinal")


# ---- token / line helpers ---------------------------------------------------
@register("est_tokens", sql="SELECT doc_id, CAST(greatest(1, length(text) // 4) AS BIGINT) AS n_tokens FROM documents")
def q_est_tokens(spark, d):
    return Tables(spark, d).documents.select("doc_id", est_tokens(F.col("text")).alias("n_tokens"))


@register("fact_lines", sql=f"""
WITH s AS (SELECT doc_id, regexp_split_to_array(text, '{LINE_RE2}') AS l FROM documents),
u AS (SELECT doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS line_no FROM s)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM u WHERE length(trim(line, {WS})) > 0""")
def q_fact_lines(spark, d):
    docs = Tables(spark, d).documents
    return (docs.select("doc_id", F.posexplode(split_lines(F.col("text"))).alias("line_no", "line"))
            .filter(~is_blank(F.col("line"))))


# ---- write path -------------------------------------------------------------
def _requests(spark, d):
    return A.attribute_agent(A.effective_group(derive.write_requests(Tables(spark, d))))


@register("effective_group", sql=f"WITH {WR_CTE} SELECT doc_id, graph, group_id, effective_group_id FROM wre")
def q_effective_group(spark, d):
    return _requests(spark, d).select("doc_id", "graph", "group_id", "effective_group_id")


@register("agent_attribution", sql=f"""WITH {WR_CTE}
SELECT doc_id, agent_id, source_description, effective_source_description FROM wre""")
def q_agent_attribution(spark, d):
    return _requests(spark, d).select("doc_id", "agent_id", "source_description",
                                      "effective_source_description")


@register("tier_guard", sql=f"""WITH {WR_CTE}
SELECT doc_id, graph, NOT hit AS accepted,
       CASE WHEN hit THEN 'tier guard: matches reject_pattern' END AS reject_reason
FROM (SELECT *, coalesce(graph = 'personal' AND regexp_matches({GUARD_TEXT_SQL}, '{A.LICENSE_PATTERN}'), false) AS hit
      FROM wr)""")
def q_tier_guard(spark, d):
    g = A.tier_guard(derive.write_requests(Tables(spark, d)),
                     {"personal": A.LICENSE_PATTERN, "client": None})
    return g.select("doc_id", "graph", "accepted", "reject_reason")


@register("write_hygiene", sql=f"""WITH {WR_CTE}
SELECT doc_id, hygiene_label, CASE WHEN hygiene_label IS NULL THEN 'store' ELSE 'reject' END AS verdict
FROM (SELECT doc_id, {_hygiene_case_sql('episode_body')} AS hygiene_label FROM wr)""")
def q_write_hygiene(spark, d):
    return A.write_hygiene(derive.write_requests(Tables(spark, d))).select(
        "doc_id", "hygiene_label", "verdict")


SE_CTE = """
se AS (SELECT event_id,
         CASE WHEN event_type IN ('click', 'view')
              THEN '{"who": "' || CAST(user_id AS VARCHAR) || '", "what": "' || event_type
                   || '", "when": "' || CAST(ts AS VARCHAR) || '", "source": "events"}'
              ELSE 'user ' || CAST(user_id AS VARCHAR) || ' ' || event_type END AS episode_body
       FROM events)
"""


@register("structured_episode", sql=f"""WITH {SE_CTE},
p AS (SELECT *, CASE WHEN json_valid(episode_body) THEN json_type(episode_body) = 'OBJECT' ELSE false END AS is_structured FROM se)
SELECT event_id, is_structured,
       CASE WHEN is_structured THEN json_extract_string(episode_body, '$.who') END AS who,
       CASE WHEN is_structured THEN json_extract_string(episode_body, '$.what') END AS what,
       CASE WHEN is_structured THEN json_extract_string(episode_body, '$.source') END AS source,
       CAST(CASE WHEN is_structured THEN json_extract_string(episode_body, '$.when') END AS TIMESTAMP) AS "when"
FROM p""")
def q_structured_episode(spark, d):
    e = Tables(spark, d).events
    body = F.when(F.col("event_type").isin("click", "view"), F.concat(
        F.lit('{"who": "'), F.col("user_id").cast("string"), F.lit('", "what": "'), F.col("event_type"),
        F.lit('", "when": "'), F.col("ts").cast("string"), F.lit('", "source": "events"}'))
    ).otherwise(F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit(" "), F.col("event_type")))
    se = e.select("event_id", body.alias("episode_body"))
    return A.structured_episode(se).select("event_id", "is_structured", "who", "what", "source", "when")


@register("novel_memories", sql=f"""WITH {WR_CTE},
b AS (SELECT graph, effective_group_id, sha256({_norm_sql('episode_body')}) AS text_key, doc_id FROM wre),
f AS (SELECT graph, effective_group_id, text_key, min(doc_id) AS doc_id FROM b GROUP BY ALL),
s AS (SELECT DISTINCT graph, effective_group_id, sha256({_norm_sql("'  ' || episode_body || chr(10)")}) AS text_key
      FROM wre WHERE group_id = 'project-de')
SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.graph = f.graph
   AND s.effective_group_id = f.effective_group_id AND s.text_key = f.text_key)""")
def q_novel_memories(spark, d):
    """Check-first against a store that already holds one project's texts, with other
    white space around them: the normalised text decides."""
    batch = _requests(spark, d)
    store = batch.filter(F.col("group_id") == "project-de").select(
        "graph", "effective_group_id", F.concat(F.lit("  "), "episode_body", F.lit("\n")).alias("episode_body"))
    return A.novel_memories(batch, store, ["graph", "effective_group_id"], ["doc_id"])


@register("agent_audit", sql=f"""WITH {WR_CTE},
a AS (SELECT graph, doc_id, regexp_extract(effective_source_description, '^\\[agent:([^\\]]+)\\]', 1) AS x FROM wre)
SELECT graph, CASE WHEN coalesce(length(x), 0) > 0 THEN x ELSE 'anonymous' END AS agent,
       count(*) AS writes, min(doc_id) AS first_id, max(doc_id) AS last_id
FROM a GROUP BY ALL""")
def q_agent_audit(spark, d):
    return A.agent_audit(_requests(spark, d))


@register("cross_tier_bodies", sql=f"""WITH {WR_CTE}
SELECT sha256(episode_body) AS body_hash FROM wr WHERE graph = 'personal'
INTERSECT SELECT sha256(episode_body) FROM wr WHERE graph = 'client'""")
def q_cross_tier_bodies(spark, d):
    return A.cross_tier_bodies(derive.write_requests(Tables(spark, d)))


LEAK_PATTERNS = [("license", A.LICENSE_PATTERN), *A.HYGIENE_RULES]


def _leak_sql() -> str:
    arms = " UNION ALL ".join(
        f"SELECT doc_id, 'pattern:{n}' AS reason FROM wr WHERE graph = 'personal' AND regexp_matches({GUARD_TEXT_SQL}, '{p}')"
        for n, p in LEAK_PATTERNS)
    return f"""WITH {WR_CTE},
shared AS (SELECT sha256(episode_body) AS h FROM wr WHERE graph = 'personal'
           INTERSECT SELECT sha256(episode_body) FROM wr WHERE graph = 'client')
{arms}
UNION ALL SELECT doc_id, 'cross_tier_body' FROM wr WHERE graph = 'personal' AND sha256(episode_body) IN (SELECT h FROM shared)"""


@register("tier_leak_audit", sql=_leak_sql())
def q_tier_leak_audit(spark, d):
    return A.tier_leak_audit(derive.write_requests(Tables(spark, d)), LEAK_PATTERNS)
