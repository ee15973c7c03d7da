"""Registered queries: ontology, typed attributes, rules, hooks, citations
(OP-15, 44b, 44c, 49, 50, 51)."""

from __future__ import annotations

from pyspark.sql import functions as F

from engram.operators import admission as A
from engram.operators import ontology as O
from engram.operators import resolve as RS
from engram.operators import temporal as T
from engram.plans import derive
from engram.plans.catalog_text import WR_CTE
from engram.plans.registry import register
from engram.plans.sql_snippets import TIER
from engram.sources.tables import Tables

SIGNAL_FIELDS = [("k", "int"), ("weight", "float"), ("flag", "bool"), ("label", "str")]
MARKER = "from"


def _signals(spark, d):
    """Typed payloads from events: k is declared int; weight is declared float and
    carries text for sign-ups (mistyped -> null); flag and label are given by some
    events; extra is undeclared (ignored)."""
    e = Tables(spark, d).events
    kind = F.col("event_type")
    payload = F.concat(F.lit('{"k": '), F.get_json_object("props", "$.k"), F.lit(', "weight": '),
                       F.when(kind == "signup", F.lit('"heavy"')).otherwise(F.concat((F.col("user_id") % 8).cast("string"), F.lit(".5"))),
                       F.when(kind == "click", F.lit(', "flag": true')).when(kind == "view", F.lit(', "flag": false')).otherwise(F.lit("")),
                       F.when(kind == "error", F.concat(F.lit(', "label": "'), kind, F.lit('"'))).otherwise(F.lit("")),
                       F.lit(', "extra": '), F.col("user_id").cast("string"), F.lit("}"))
    return e.select("event_id", payload.alias("payload"))


SIGNAL_CTE = """
sig AS (SELECT event_id, '{"k": ' || CAST(json_extract(props, '$.k') AS VARCHAR) || ', "weight": '
               || CASE WHEN event_type = 'signup' THEN '"heavy"' ELSE CAST(user_id % 8 AS VARCHAR) || '.5' END
               || CASE event_type WHEN 'click' THEN ', "flag": true' WHEN 'view' THEN ', "flag": false' ELSE '' END
               || CASE WHEN event_type = 'error' THEN ', "label": "error"' ELSE '' END
               || ', "extra": ' || CAST(user_id AS VARCHAR) || '}' AS payload FROM events),
typed AS (SELECT event_id, TRY_CAST(json_extract_string(payload, '$.k') AS BIGINT) AS k,
                 TRY_CAST(json_extract_string(payload, '$.weight') AS DOUBLE) AS weight,
                 TRY_CAST(json_extract_string(payload, '$.flag') AS BOOLEAN) AS flag,
                 json_extract_string(payload, '$.label') AS label FROM sig)
"""


@register("typed_attributes", sql=f"WITH {SIGNAL_CTE} SELECT event_id, k, weight, flag, label FROM typed")
def q_typed_attributes(spark, d):
    return O.typed_attributes(_signals(spark, d), "payload", SIGNAL_FIELDS).select(
        "event_id", "k", "weight", "flag", "label")


@register("attribute_coverage", sql=f"""WITH {SIGNAL_CTE},
long AS (SELECT 'Signal' AS entity_type, 'k' AS field, CAST(k AS VARCHAR) AS value FROM typed
         UNION ALL SELECT 'Signal', 'weight', CAST(weight AS VARCHAR) FROM typed
         UNION ALL SELECT 'Signal', 'flag', CAST(flag AS VARCHAR) FROM typed
         UNION ALL SELECT 'Signal', 'label', label FROM typed)
SELECT entity_type, field, count(value) AS filled, count(*) AS total, count(value) / count(*) AS fill_rate
FROM long GROUP BY entity_type, field""")
def q_attribute_coverage(spark, d):
    typed = O.typed_attributes(_signals(spark, d), "payload", SIGNAL_FIELDS).withColumn(
        "entity_type", F.lit("Signal"))
    return O.attribute_coverage(typed, "entity_type", [f for f, _ in SIGNAL_FIELDS])


SPOKEN_GUARD = {"personal": "(?i)PLAN 3", "client": "feature 2"}
SPOKEN_CTE = f"""
spoken AS (SELECT event_id AS doc_id, user_id AS subject, ts AS valid_at, {TIER.format(k='user_id')} AS graph,
  event_type AS name, 'event' AS source_description,
  CASE event_type WHEN 'purchase' THEN 'I want product ' || k WHEN 'view' THEN 'we decided to keep plan ' || k
                  WHEN 'click' THEN 'they want feature ' || k WHEN 'error' THEN 'The portal must have retry ' || k
                  ELSE 'Talk about ' || event_type END AS episode_body
  FROM (SELECT *, coalesce(CAST(json_extract_string(props, '$.k') AS VARCHAR), 'none') AS k FROM events)),
wr AS (SELECT * FROM spoken WHERE NOT (graph = 'personal' AND regexp_matches(name || chr(10) || source_description || chr(10) || episode_body, '{SPOKEN_GUARD["personal"]}')
                                   OR graph = 'client' AND regexp_matches(name || chr(10) || source_description || chr(10) || episode_body, '{SPOKEN_GUARD["client"]}')))"""


def _rule_arms(rules: list | None = None) -> str:
    return " UNION ALL ".join(
        f"SELECT doc_id, graph, '{t}' AS entity_type, {p} AS priority, {sign} AS polarity, "
        f"regexp_extract_all(episode_body, '{pat.replace(chr(39), chr(39) * 2)}', 1) AS vals "
        f"FROM wr WHERE graph = '{g}'" for g, t, p, pat, sign in rules or O.TRIGGER_RULES + O.EXTRA_RULES)


def _rule_cte(wr_cte: str = WR_CTE) -> str:
    """CTEs ending in ``extracted(doc_id, graph, entity_type, priority, value)``."""
    return f"""{wr_cte},
hits AS (SELECT * FROM ({_rule_arms()}) WHERE len(vals) > 0),
best AS (SELECT doc_id, graph, min(priority) AS priority FROM hits GROUP BY doc_id, graph),
chosen AS (SELECT h.doc_id, h.graph, h.entity_type, h.priority, h.polarity, unnest(h.vals) AS value
           FROM hits h JOIN best b ON b.doc_id = h.doc_id AND b.graph = h.graph AND b.priority = h.priority),
extracted AS (SELECT doc_id, graph, entity_type, priority, value, polarity FROM chosen
  UNION ALL
  SELECT doc_id, graph, 'Topic', 99, NULL, 0 FROM wr w
  WHERE graph = 'personal' AND NOT EXISTS (SELECT 1 FROM best b WHERE b.doc_id = w.doc_id AND b.graph = w.graph))"""


def _rule_sql() -> str:
    return f"WITH {_rule_cte()} SELECT doc_id, graph, entity_type, priority, value, polarity FROM extracted"


def _ontology_values_sql() -> str:
    rows = ", ".join(f"('{g}', '{name}', {len(fields)})" for g, types in O.ONTOLOGY.items()
                     for name, fields in types)
    return f"ont AS (SELECT * FROM (VALUES {rows}) t(graph, entity_type, n_fields))"


@register("ontology_load", sql=f"""WITH {_rule_cte()}, {_ontology_values_sql()},
ext AS (SELECT graph, entity_type, count(DISTINCT doc_id) AS episodes FROM extracted GROUP BY ALL)
SELECT o.graph, o.entity_type, o.n_fields, coalesce(e.episodes, 0) AS episodes
FROM ont o LEFT JOIN ext e ON e.graph = o.graph AND e.entity_type = o.entity_type""")
def q_ontology_load(spark, d):
    """OP-03: the configured ontology (per tier) with how many episodes each type
    was extracted from — the tiny ontology table is broadcast into the join."""
    ont = O.ontology_frame(spark)
    ext = (O.rule_extract(derive.write_requests(Tables(spark, d)))
           .groupBy("graph", "entity_type").agg(F.countDistinct("doc_id").alias("episodes")))
    return (ont.join(ext, ["graph", "entity_type"], "left")
            .select("graph", "entity_type", F.size("fields").alias("n_fields"),
                    F.coalesce(F.col("episodes"), F.lit(0)).alias("episodes")))


@register("rule_extract", sql=_rule_sql())
def q_rule_extract(spark, d):
    return O.rule_extract(derive.write_requests(Tables(spark, d))).select(
        "doc_id", "graph", "entity_type", "priority", "value", "polarity")


def _heard(spark, d):
    """Spoken statements that pass the tier guard."""
    return A.tier_guard(derive.spoken_requests(Tables(spark, d)), SPOKEN_GUARD).filter("accepted")


@register("rule_extract_spoken", sql=f"WITH {_rule_cte(SPOKEN_CTE)} SELECT doc_id, graph, entity_type, priority, value, polarity FROM extracted")
def q_rule_extract_spoken(spark, d):
    """OP-49 on statements that speak the stated trigger phrases."""
    return O.rule_extract(_heard(spark, d)).select("doc_id", "graph", "entity_type", "priority", "value", "polarity")


WORD_RULE = "(?i)(?:^|[^A-Za-z0-9_\u00c0-\u024f])("      # a word of the benchmark, wherever one starts
_MANY = _rule_cte().replace("hits AS (SELECT * FROM (", f"""many AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z\u00e0-\u024f]{{7,}}')) AS w FROM benchmark)),
hits AS (SELECT * FROM (SELECT doc_id, graph, 'Topic' AS entity_type, 50 AS priority, 1 AS polarity,
           regexp_extract_all(episode_body, '{WORD_RULE}' || w || ')', 1) AS vals FROM wr JOIN many ON contains(lower(episode_body), w)
         UNION ALL """)


@register("rule_extract_table", sql=f"WITH {_MANY} SELECT doc_id, graph, entity_type, priority, value, polarity FROM extracted")
def q_rule_extract_table(spark, d):
    """OP-49 from a rule table: the literal rules and one for every long benchmark word, a tier each."""
    t = Tables(spark, d)
    words = t.benchmark.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z\u00e0-\u024f]{7,}"), F.lit(0))).alias("w")).distinct()
    tiers = F.explode(F.array(F.lit("personal"), F.lit("client"))).alias("graph")
    named = words.select(tiers, "w").select("graph", F.lit("Topic").alias("entity_type"), F.lit(50).alias("priority"), F.array("w").alias("needles"),
                                            F.concat(F.lit(WORD_RULE), "w", F.lit(")")).alias("pattern"), F.lit(1).alias("polarity"),
                                            F.lit(1).alias("before"))
    return O.rule_extract_table(derive.write_requests(t), O.trigger_rule_table(spark, before=True).unionByName(named))


@register("facts_from_text", sql=f"""WITH {_rule_cte(SPOKEN_CTE)},
obs AS (SELECT w.graph, w.subject, e.entity_type AS relation, e.value, w.valid_at, w.doc_id AS uuid,
               lag(e.value) OVER k AS prev, row_number() OVER k AS n
        FROM extracted e JOIN wr w ON w.doc_id = e.doc_id
        WINDOW k AS (PARTITION BY w.graph, w.subject, e.entity_type ORDER BY w.valid_at, w.doc_id)),
runs AS (SELECT * FROM obs WHERE n = 1 OR prev IS DISTINCT FROM value)
SELECT graph, subject, relation, value, uuid, valid_at,
       lead(valid_at) OVER (PARTITION BY graph, subject, relation ORDER BY valid_at, uuid) AS invalid_at FROM runs""")
def q_facts_from_text(spark, d):
    """The write path down to facts: statement -> guard -> extraction -> supersession."""
    obs = (O.rule_extract(_heard(spark, d), keep=("subject", "valid_at"))
           .select("graph", "subject", F.col("entity_type").alias("relation"), "value", F.col("doc_id").alias("uuid"), "valid_at"))
    return T.resolve_supersession(obs).select("graph", "subject", "relation", "value", "uuid", "valid_at", "invalid_at")


def _way(noun: str) -> str:
    odd = noun[:2] + noun[1] + noun[2:]
    return (f"CASE event_id % 7 WHEN 1 THEN '{noun.upper()}-' || k WHEN 2 THEN '{odd} ' || k WHEN 3 THEN '{noun.title()}  ' || k "
            f"ELSE '{noun} ' || k END")


_PLAIN = r"trim(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
GRAPH_CTE = f"""
wr AS (SELECT event_id AS doc_id, ts AS valid_at, {TIER.format(k='user_id')} AS graph,
         CASE event_id % 7 WHEN 4 THEN 'USER-' || CAST(user_id AS VARCHAR) WHEN 5 THEN '  user ' || CAST(user_id AS VARCHAR)
                           ELSE 'user ' || CAST(user_id AS VARCHAR) END AS speaker,
         CASE event_type WHEN 'purchase' THEN 'I want ' || {_way('product')}
           WHEN 'view' THEN 'Today we decided to keep ' || {_way('subscription')} || '. Nothing else'
           WHEN 'click' THEN 'So they want ' || {_way('feature')} WHEN 'error' THEN {_way('retry policy')} || ' is required.'
           ELSE 'ruled out ' || {_way('channel')} END AS episode_body
       FROM (SELECT *, coalesce(CAST(json_extract_string(props, '$.k') AS VARCHAR), 'none') AS k FROM events)),
hits AS (SELECT * FROM ({_rule_arms(O.TRIGGER_RULES)}) WHERE len(vals) > 0),
best AS (SELECT doc_id, min(priority) AS priority FROM hits GROUP BY doc_id),
caught AS (SELECT h.doc_id, h.graph, h.entity_type, h.polarity, unnest(h.vals) AS value
           FROM hits h JOIN best b ON b.doc_id = h.doc_id AND b.priority = h.priority),
said AS (SELECT doc_id, graph, CASE graph WHEN 'personal' THEN 'Person' ELSE 'Stakeholder' END AS entity_type, {_PLAIN.format(x='speaker')} AS name FROM wr
         UNION ALL SELECT doc_id, graph, entity_type, {_PLAIN.format(x='value')} FROM caught),
named AS (SELECT graph, entity_type, name, count(*) AS n, regexp_replace(name, '\P{{L}}+', '', 'g') AS letters, regexp_replace(name, '\P{{N}}+', '', 'g') AS digits
          FROM said WHERE name <> '' GROUP BY ALL),
alike AS (SELECT a.graph, a.entity_type, a.name AS a, b.name AS b FROM named a JOIN named b
          ON a.graph = b.graph AND a.entity_type = b.entity_type AND a.digits = b.digits
          WHERE CASE WHEN least(length(a.letters), length(b.letters)) >= 5 THEN levenshtein(a.letters, b.letters) <= 1 ELSE a.letters = b.letters END),
reach AS (SELECT graph, entity_type, a, b FROM alike
          UNION SELECT r.graph, r.entity_type, r.a, l.b FROM reach r JOIN alike l ON l.graph = r.graph AND l.entity_type = r.entity_type AND l.a = r.b),
rooted AS (SELECT graph, entity_type, a AS name, min(b) AS root FROM reach GROUP BY ALL),
known AS (SELECT r.graph, r.entity_type, r.name, r.root, n.n,
            substr(sha256(r.graph || '|' || r.entity_type || '|' || r.root), 1, 16) AS uuid
          FROM rooted r JOIN named n ON n.graph = r.graph AND n.entity_type = r.entity_type AND n.name = r.name),
entities AS (SELECT graph, uuid, name, entity_type FROM known
             QUALIFY row_number() OVER (PARTITION BY graph, entity_type, root ORDER BY n DESC, name) = 1),
mentions AS (SELECT DISTINCT s.graph, s.doc_id AS episode_uuid, k.uuid AS entity_uuid
             FROM said s JOIN known k ON k.graph = s.graph AND k.entity_type = s.entity_type AND k.name = s.name),
obs AS (SELECT DISTINCT c.graph, s.uuid AS subject, CASE WHEN c.polarity > 0 THEN lower(c.entity_type) ELSE 'not ' || lower(c.entity_type) END AS relation,
          v.uuid AS value, c.doc_id AS uuid, w.valid_at
        FROM caught c JOIN wr w ON w.doc_id = c.doc_id
        JOIN known s ON s.graph = c.graph AND s.entity_type = CASE c.graph WHEN 'personal' THEN 'Person' ELSE 'Stakeholder' END AND s.name = {_PLAIN.format(x='w.speaker')}
        JOIN known v ON v.graph = c.graph AND v.entity_type = c.entity_type AND v.name = {_PLAIN.format(x='c.value')}),
runs AS (SELECT *, lag(value) OVER k AS prev, row_number() OVER k AS i FROM obs
         WINDOW k AS (PARTITION BY graph, subject, relation ORDER BY valid_at, uuid)),
kept AS (SELECT * FROM runs WHERE i = 1 OR prev IS DISTINCT FROM value)"""


def _extracted(spark, d):
    return RS.graph_tables(O.extract_graph(derive.statements(Tables(spark, d))))


@register("extracted_entities", sql=f"WITH RECURSIVE {GRAPH_CTE} SELECT graph, uuid, name, entity_type FROM entities")
def q_extracted_entities(spark, d):
    """OP-50: the entities behind all the names that statements hold."""
    return _extracted(spark, d)[0]


@register("extracted_mentions", sql=f"WITH RECURSIVE {GRAPH_CTE} SELECT graph, episode_uuid, entity_uuid FROM mentions")
def q_extracted_mentions(spark, d):
    return _extracted(spark, d)[1]


@register("extracted_facts", sql=f"""WITH RECURSIVE {GRAPH_CTE}
SELECT graph, subject, relation, value, uuid, valid_at,
       lead(valid_at) OVER (PARTITION BY graph, subject, relation ORDER BY valid_at, uuid) AS invalid_at FROM kept""")
def q_extracted_facts(spark, d):
    """Text to facts between entities: extraction, resolution, supersession."""
    return T.resolve_supersession(_extracted(spark, d)[2]).select("graph", "subject", "relation", "value", "uuid", "valid_at", "invalid_at")


@register("extractor_hook", sql=f"""WITH {WR_CTE}
SELECT doc_id, graph, entity_type, unnest(vals) AS value FROM ({_rule_arms()}) WHERE len(vals) > 0""")
def q_extractor_hook(spark, d):
    return O.extractor_hook(derive.write_requests(Tables(spark, d)))


@register("embedder_hook", sql=f"""
WITH words AS (SELECT doc_id, md5(unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda t: length(t) > 0))) AS h
               FROM documents),
dims AS (SELECT doc_id, CAST('0x' || substr(h, 1, 2) AS INTEGER) % 64 AS dim,
                sum(CASE WHEN substr(h, 3, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END) AS x FROM words GROUP BY ALL)
SELECT d.doc_id, 64 AS dim, round(sqrt(coalesce(sum(x * x), 0)), 6) AS norm,
       CAST(coalesce(sum((v.dim + 1) * x), 0) AS BIGINT) AS checksum
FROM documents d LEFT JOIN dims v ON v.doc_id = d.doc_id GROUP BY d.doc_id""")
def q_embedder_hook(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "text")
    e = O.embedder_hook(docs, "text", dim=64)
    return e.select("doc_id", F.size("embedding").alias("dim"),
                    F.round(F.sqrt(F.aggregate("embedding", F.lit(0.0),
                                               lambda acc, x: acc + x * x)), 6).alias("norm"),
                    F.expr("cast(aggregate(transform(embedding, (x, i) -> cast(x as double) * (i + 1)), 0D, "
                           "(a, x) -> a + x) as bigint)").alias("checksum"))


@register("citation_rate", sql=f"""
SELECT conv_id, count(*) AS assistant_turns,
       count(*) FILTER (WHERE coalesce(contains(lower(text), '{MARKER}'), false)) AS citing_turns,
       count(*) FILTER (WHERE coalesce(contains(lower(text), '{MARKER}'), false)) / count(*) AS rate
FROM conversations WHERE role = 'assistant' GROUP BY conv_id""")
def q_citation_rate(spark, d):
    return O.citation_rate(Tables(spark, d).conversations, MARKER)


@register("citation_rate_overall", sql=f"""
SELECT count(DISTINCT conv_id) AS conversations, count(*) AS assistant_turns,
       count(*) FILTER (WHERE coalesce(contains(lower(text), '{MARKER}'), false)) AS citing_turns,
       count(*) FILTER (WHERE coalesce(contains(lower(text), '{MARKER}'), false)) / count(*) AS rate
FROM conversations WHERE role = 'assistant'""")
def q_citation_rate_overall(spark, d):
    return O.overall_citation_rate(O.citation_rate(Tables(spark, d).conversations, MARKER))
