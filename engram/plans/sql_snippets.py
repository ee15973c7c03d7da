"""DuckDB twins of the model-table derivations (plans/derive.py), as CTE text."""

TIER = "CASE WHEN {k} % 2 = 0 THEN 'personal' ELSE 'client' END"

FACTS_CTE = f"""
obs AS (
  SELECT {TIER.format(k='o_custkey')} AS graph, o_orderstatus AS group_id,
         o_orderkey AS uuid, o_custkey AS subject, o_orderpriority AS value,
         o_orderdate AS valid_at,
         lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev
  FROM orders WHERE o_orderdate IS NOT NULL),
facts AS (
  SELECT graph, group_id, uuid, subject, value, valid_at,
         lead(valid_at) OVER (PARTITION BY subject ORDER BY valid_at, uuid) AS invalid_at,
         'customer ' || CAST(subject AS VARCHAR) || ' has priority ' || value AS fact
  FROM obs WHERE prev IS DISTINCT FROM value)
"""

EPISODES_CTE = f"""
episodes AS (
  SELECT {TIER.format(k='o_custkey')} AS graph, o_orderstatus AS group_id,
         o_orderkey AS uuid, o_orderdate AS created_at
  FROM orders)
"""

ENTITIES_CTE = f"""
entities AS (
  SELECT {TIER.format(k='p_partkey')} AS graph, p_partkey AS uuid, p_name AS name,
         p_type AS entity_type FROM part
  UNION ALL
  SELECT {TIER.format(k='c_custkey')} AS graph, -c_custkey AS uuid, c_name AS name,
         c_mktsegment AS entity_type FROM customer)
"""


def mentions_cte(min_quantity: float | None = None, name: str = "mentions") -> str:
    where = "" if min_quantity is None else f"WHERE l_quantity >= {min_quantity}"
    return f"""
{name} AS (
  SELECT {TIER.format(k='o.o_custkey')} AS graph, p.episode_uuid, p.entity_uuid
  FROM (SELECT DISTINCT l_orderkey AS episode_uuid, l_partkey AS entity_uuid
        FROM lineitem {where}) p
  JOIN orders o ON o.o_orderkey = p.episode_uuid)
"""


PURCHASES_CTE = f"""
purchases AS (
  SELECT {TIER.format(k='o_custkey')} AS graph, CAST(o_custkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS uuid,
         -o_custkey AS source_uuid, l_partkey AS target_uuid, o_orderdate AS valid_at, o_orderkey AS episode
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  QUALIFY row_number() OVER (PARTITION BY o_custkey, l_partkey ORDER BY o_orderdate NULLS FIRST, o_orderkey) = 1)
"""
