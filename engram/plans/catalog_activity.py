"""Registered queries: access-log activity (OP-02, 20, 21, 39, 44, S2)."""

from __future__ import annotations

from engram.operators import activity as AC
from engram.plans import derive
from engram.plans.registry import register
from engram.sources.tables import Tables

N_LINES = 2000
ORDER = ["event_ts", "event_id"]

def log_cte(lines: str) -> str:
    """Parsed and typed requests of ``lines`` (the CTE ``log`` or its ``tail``)."""
    return f"""
log AS (SELECT event_id, ts AS event_ts,
          CASE WHEN event_type = 'signup' THEN 'INFO signup user ' || CAST(user_id AS VARCHAR)
               ELSE CAST(json_object('ts', CAST(floor(epoch(ts)) AS BIGINT),
                                     'request', json_object('host', 'h:' || CAST(8000 + user_id % 3 AS VARCHAR)),
                                     'status', CASE WHEN event_type = 'error' THEN 401 ELSE 200 END) AS VARCHAR)
          END AS line
        FROM events),
tail AS (SELECT * FROM log ORDER BY event_ts DESC, event_id DESC LIMIT {N_LINES}),
parsed AS (SELECT event_id, line FROM {lines} WHERE starts_with(trim(line), '{{') AND json_valid(trim(line))),
typed AS (SELECT event_id, line, host,
            CASE CASE WHEN contains(host, ':') THEN regexp_extract(host, ':([^:]*)$', 1) ELSE '' END
                 WHEN '8000' THEN 'personal' WHEN '8001' THEN 'client' ELSE '?' END AS tier,
            CASE WHEN json_type(line, '$.status') IN ('UBIGINT', 'BIGINT')
                      AND CAST(json_extract(line, '$.status') AS BIGINT) <> 0
                 THEN CAST(CAST(floor(CAST(json_extract(line, '$.status') AS BIGINT) / 100) AS BIGINT) AS VARCHAR) || 'xx'
                 ELSE '?' END AS klass,
            TRY_CAST(json_extract_string(line, '$.status') AS BIGINT) AS status
          FROM (SELECT *, coalesce(json_extract_string(line, '$.request.host'), '') AS host FROM parsed))
"""


LOG_CTE, WHOLE_CTE = log_cte("tail"), log_cte("log")


def _lines(spark, d):
    return derive.access_log(Tables(spark, d))


def _typed(spark, d):
    """The whole log; the tail is a feature of the report alone."""
    return AC.typed_requests(_lines(spark, d))


@register("tail_n", sql=f"WITH {LOG_CTE} SELECT event_id, line FROM tail")
def q_tail_n(spark, d):
    return AC.tail_lines(_lines(spark, d), ORDER, N_LINES).select("event_id", "line")


@register("access_log_scan", sql=f"WITH {LOG_CTE} SELECT event_id, line FROM parsed")
def q_access_log_scan(spark, d):
    return AC.parse_access_log(AC.tail_lines(_lines(spark, d), ORDER, N_LINES)).select("event_id", "line")


@register("tier_of_host", sql=f"WITH {WHOLE_CTE} SELECT event_id, host, tier FROM typed")
def q_tier_of_host(spark, d):
    return _typed(spark, d).select("event_id", "host", "tier")


@register("status_class", sql=f"WITH {WHOLE_CTE} SELECT event_id, status, klass FROM typed")
def q_status_class(spark, d):
    return _typed(spark, d).select("event_id", "status", "klass")


@register("activity_report", sql=f"""WITH {LOG_CTE},
g AS (SELECT tier, klass, count(*) AS requests FROM typed GROUP BY tier, klass)
SELECT tier, klass, requests, CAST(sum(requests) OVER () AS BIGINT) AS total FROM g""")
def q_activity_report(spark, d):
    return AC.activity_report(AC.typed_requests(_lines(spark, d), ORDER, N_LINES))


@register("unauthorized_rate", sql=f"""WITH {WHOLE_CTE}
SELECT tier, count(*) AS requests, count(*) FILTER (WHERE status = 401) AS unauthorized,
       avg(CASE WHEN status = 401 THEN 1.0 ELSE 0.0 END)::DOUBLE AS rate
FROM typed GROUP BY tier""")
def q_unauthorized_rate(spark, d):
    return AC.unauthorized_rate(_typed(spark, d))
