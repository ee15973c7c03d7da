"""Registered queries: facts over time (OP-W3, 24, 37, S1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from engram.operators import temporal as T
from engram.plans import derive
from engram.plans.registry import register
from engram.plans.sql_snippets import FACTS_CTE
from engram.sources.tables import Tables

FACT_COLS = ["graph", "group_id", "uuid", "subject", "value", "fact", "valid_at", "invalid_at"]
AS_OF = "1998-01-01 00:00:00"


@register("resolve_supersession", sql=f"""
WITH {FACTS_CTE}
SELECT graph, group_id, uuid, subject, value, fact, valid_at, invalid_at FROM facts""")
def q_resolve_supersession(spark, d):
    return derive.facts(Tables(spark, d)).select(*FACT_COLS)


@register("current_facts", sql=f"""
WITH {FACTS_CTE}
SELECT graph, group_id, uuid, subject, value, fact, valid_at, invalid_at
FROM facts WHERE invalid_at IS NULL""")
def q_current_facts(spark, d):
    return T.current_facts(derive.facts(Tables(spark, d))).select(*FACT_COLS)


@register("superseded_facts", sql=f"""
WITH {FACTS_CTE}
SELECT graph, group_id, uuid, subject, value, fact, valid_at, invalid_at
FROM facts WHERE invalid_at IS NOT NULL""")
def q_superseded_facts(spark, d):
    return T.superseded_facts(derive.facts(Tables(spark, d))).select(*FACT_COLS)


@register("facts_as_of", sql=f"""
WITH {FACTS_CTE}
SELECT graph, group_id, uuid, subject, value, fact, valid_at, invalid_at
FROM facts
WHERE valid_at <= TIMESTAMP '{AS_OF}'
  AND (invalid_at IS NULL OR invalid_at > TIMESTAMP '{AS_OF}')""")
def q_facts_as_of(spark, d):
    return T.facts_as_of(derive.facts(Tables(spark, d)), AS_OF).select(*FACT_COLS)


@register("contradictions", sql=f"""
WITH {FACTS_CTE}
SELECT uuid, fact, valid_at AS valid_from, invalid_at AS invalidated
FROM facts WHERE invalid_at IS NOT NULL AND graph = 'personal'
ORDER BY invalid_at DESC, uuid ASC LIMIT 25""")
def q_contradictions(spark, d):
    return T.contradictions(derive.facts(Tables(spark, d), graph="personal"), graph="personal", limit=25)


@register("facts_as_of_table", sql=f"""
WITH {FACTS_CTE},
instants AS (
  SELECT o_custkey AS subject, max(o_orderdate) - INTERVAL 400 DAY AS as_of
  FROM orders GROUP BY o_custkey)
SELECT f.subject, i.as_of, f.uuid, f.value, f.valid_at, f.invalid_at
FROM facts f JOIN instants i ON f.subject = i.subject
WHERE f.valid_at <= i.as_of AND (f.invalid_at IS NULL OR f.invalid_at > i.as_of)""")
def q_facts_as_of_table(spark, d):
    """What each customer's priority was 400 days before their last order."""
    t = Tables(spark, d)
    instants = (t.orders.groupBy(F.col("o_custkey").alias("subject"))
                .agg((F.max("o_orderdate") - F.expr("INTERVAL 400 DAYS")).alias("as_of")))
    return (T.facts_as_of_table(derive.facts(t), instants, ["subject"])
            .select("subject", "as_of", "uuid", "value", "valid_at", "invalid_at"))
