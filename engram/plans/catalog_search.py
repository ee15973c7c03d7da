"""Registered queries: retrieval and evaluation
(OP-04, 16, 19, 29, 31, 32, 33, 34, 35, 42, W1, W2, U2).

Corpus = facts stated by documents (one per non-blank line); queries = every
benchmark item, asked in one tier. Three legs are fused: BM25, cosine of hashed
term vectors, and traversal from the entities of the best BM25 hits. Recall may be
scoped to namespaces (``group_id``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from engram.config import EVAL_MAX_FACTS, RECALL_BUDGET, RECALL_OVER_FETCH
from engram.functions.text import is_blank, split_lines
from engram.operators import evaluate as E
from engram.operators import graph as G
from engram.operators import impact as IM
from engram.operators import ivf as IV
from engram.operators import lexical as LX
from engram.operators import nodes as ND
from engram.operators import ontology as O
from engram.operators import search as S
from engram.operators import traverse as TR
from engram.plans import derive
from engram.plans.catalog_text import LINE_RE2, WS
from engram.plans.registry import register
from engram.plans.sql_snippets import ENTITIES_CTE, TIER
from engram.session import scratch_path
from engram.sources.tables import Tables

DEPTH = 50          # per-leg depth before fusion; more than any k that is asked for
SEEDS = 3           # lexical hits that the graph leg starts from
NODES_K = 10
NODE_TYPES = ["PROMO", "ECONOMY", "BUILDING"]
GROUPS = ["project-en", "project-de"]
VEC_K = 10
VEC_DIM = 64        # the test vectors' dimension (768 in the reference config)


# ---------------------------------------------------------------- Spark side
def _facts(spark, d):
    """The fact store: made once per version of the documents."""
    t = Tables(spark, d)
    return LX.kept_table(spark, "facts", t.documents, lambda: derive.line_facts(t))


def _index(spark, d):
    return LX.lexical_index(spark, "facts", Tables(spark, d).documents, lambda: _facts(spark, d), ["doc_id", "group_id"], by_unit=True)


def _vectors(spark, d):
    """Fact embeddings, made at write time by the embedder hook."""
    return LX.kept_table(spark, "fact-vectors", Tables(spark, d).documents, lambda: O.embedder_hook(
        _facts(spark, d), "text", dim=VEC_DIM).select("graph", "group_id", "doc_id", "embedding"))


def _edges(spark, d, groups=None):
    """The facts of a scope as edges, their links and the first facts of every node."""
    facts = S.scoped(_facts(spark, d), groups).select("graph", "doc_id", "episode", F.col("subject").alias("source"), F.col("topic").alias("target"))
    docs, scope = Tables(spark, d).documents, "" if groups is None else "-" + "+".join(sorted(groups))
    return (facts, LX.kept_table(spark, f"fact-links{scope}", docs, lambda: TR.fact_links(facts).sortWithinPartitions("graph", "node")),
            LX.kept_table(spark, f"fact-reach{scope}", docs, lambda: TR.fact_reach(facts, DEPTH).sortWithinPartitions("graph", "node")))


def _queries(spark, d):
    return derive.fact_queries(Tables(spark, d))


def _at_most(spark, d, k):
    """Result rows of a search, known before it runs."""
    return _queries(spark, d).count() * k


def _lexical_leg(spark, d, groups=None):
    """Written once: it is a leg of its own and the seed of the graph leg."""
    leg = S.bm25_search(S.scoped(_index(spark, d), groups), _queries(spark, d), DEPTH)
    path = scratch_path(spark, "lexical-leg")
    leg.write.parquet(path)
    return spark.read.schema(leg.schema).parquet(path)


def _vector_leg(spark, d, groups=None):
    asked = O.embedder_hook(_queries(spark, d), "text", dim=VEC_DIM)
    return S.vector_search(S.scoped(_vectors(spark, d), groups), asked, DEPTH, id_col="doc_id")


def _graph_leg(spark, d, lexical, groups=None):
    facts, links, reach = _edges(spark, d, groups)
    return TR.entity_leg(lexical.filter(F.col("rank") <= SEEDS), facts, links, reach, DEPTH, _at_most(spark, d, SEEDS))


def _legs(spark, d, groups=None):
    lexical = _lexical_leg(spark, d, groups)
    return {"lexical": lexical, "vector": _vector_leg(spark, d, groups), "graph": _graph_leg(spark, d, lexical, groups)}


def _fused(spark, d, k, groups=None):
    """The fused top-k, written once: reports read it as often as they like."""
    top = S.search_memory_facts(_legs(spark, d, groups), k)
    path = scratch_path(spark, "fused")
    top.write.parquet(path)
    return spark.read.schema(top.schema).parquet(path)


# ---------------------------------------------------------------- SQL side
def _tok_sql(x: str) -> str:
    return ("list_filter(regexp_split_to_array(lower(" + x + "), '[^\\p{L}\\p{N}]+'), "
            "lambda t: length(t) > 0)")


def bm25_sql(p: str, corpus: str, queries: str, depth: int) -> str:
    """CTEs ``{p}_*`` up to ``{p}_leg`` over corpus(graph, fact_id, text), queries(query_id, graph, text)."""
    return f"""
{p}_tok AS (SELECT graph, fact_id, {_tok_sql('text')} AS toks FROM {corpus}),
{p}_stats AS (SELECT graph, CAST(count(*) AS DOUBLE) AS n, avg(len(toks)) AS avgdl FROM {p}_tok GROUP BY graph),
{p}_post AS (SELECT graph, fact_id, dl, term, count(*) AS tf
             FROM (SELECT graph, fact_id, len(toks) AS dl, unnest(toks) AS term FROM {p}_tok) GROUP BY ALL),
{p}_df AS (SELECT graph, term, count(*) AS df FROM {p}_post GROUP BY ALL),
{p}_qt AS (SELECT DISTINCT query_id, graph, term FROM (SELECT query_id, graph, unnest({_tok_sql('text')}) AS term FROM {queries})),
{p}_idf AS (SELECT q.query_id, q.graph, q.term, ln(1 + (s.n - d.df + 0.5) / (d.df + 0.5)) AS idf, s.avgdl
            FROM {p}_qt q JOIN {p}_df d ON d.term = q.term AND d.graph = q.graph JOIN {p}_stats s ON s.graph = q.graph),
{p}_scores AS (SELECT i.query_id, p.fact_id,
                 round(sum(i.idf * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * p.dl / i.avgdl))), 9) AS score
               FROM {p}_idf i JOIN {p}_post p ON p.term = i.term AND p.graph = i.graph GROUP BY ALL),
{p}_leg AS (SELECT query_id, fact_id, score,
              CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, fact_id) AS INTEGER) AS rank
            FROM {p}_scores QUALIFY rank <= {depth})"""


FACT_QUERIES_CTE = f"""
fact_queries AS (SELECT item_id AS query_id, {TIER.format(k='item_id')} AS graph, text FROM benchmark)"""

_LONGEST = "list_max(list_transform(tk, lambda t: length(t)))"

LINE_FACTS_CTE = f"""
said AS (SELECT doc_id AS episode, source AS subject, lang, {TIER.format(k="CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT)")} AS graph,
                regexp_split_to_array(text, '{LINE_RE2}') AS l FROM documents),
all_facts AS (SELECT graph, subject, episode, coalesce(CASE WHEN episode % 3 = 2 THEN 'project-' || lang END, graph) AS group_id,
                episode * {derive.LINES} + i AS fact_id, line AS text,
                tk[list_position(list_transform(tk, lambda t: length(t)), {_LONGEST})] AS topic
              FROM (SELECT *, {_tok_sql('line')} AS tk
                    FROM (SELECT graph, subject, episode, lang, unnest(l) AS line, unnest(range(0, len(l))) AS i FROM said))
              WHERE length(trim(line, {WS})) > 0),
line_facts AS (SELECT * FROM all_facts WHERE true)"""


def _vector_sql(name: str, source: str, key: str) -> str:
    return f"""
{name}_dims AS (SELECT graph, {key}, dim, sum(sign) AS x
  FROM (SELECT graph, {key}, CAST('0x' || substr(h, 1, 2) AS INTEGER) % {VEC_DIM} AS dim,
               CASE WHEN substr(h, 3, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS sign
        FROM (SELECT graph, {key}, md5(term) AS h
              FROM (SELECT graph, {key}, unnest({_tok_sql('text')}) AS term FROM {source}))) GROUP BY ALL),
{name}_norm AS (SELECT graph, {key}, sqrt(sum(x * x)) AS norm FROM {name}_dims GROUP BY ALL HAVING sum(x * x) > 0)"""


LEGS_CTE = f"""
{FACT_QUERIES_CTE}, {LINE_FACTS_CTE},
{bm25_sql('bm', 'line_facts', 'fact_queries', DEPTH)},
{_vector_sql('fv', 'line_facts', 'fact_id')}, {_vector_sql('qv', 'fact_queries', 'query_id')},
dots AS (SELECT q.query_id, f.fact_id, sum(q.x * f.x) AS dot
         FROM qv_dims q JOIN fv_dims f ON f.graph = q.graph AND f.dim = q.dim GROUP BY ALL),
leg_vector AS (SELECT q.query_id, f.fact_id, round(coalesce(d.dot, 0) / f.norm / q.norm, 9) AS score,
                 CAST(row_number() OVER (PARTITION BY q.query_id
                      ORDER BY round(coalesce(d.dot, 0) / f.norm / q.norm, 9) DESC, f.fact_id) AS INTEGER) AS rank
               FROM qv_norm q JOIN fv_norm f ON f.graph = q.graph
               LEFT JOIN dots d ON d.query_id = q.query_id AND d.fact_id = f.fact_id QUALIFY rank <= {DEPTH}),
hung AS (SELECT graph, fact_id, unnest(['entity:' || subject, 'entity:' || topic, 'episode:' || CAST(episode AS VARCHAR)]) AS node FROM line_facts),
pairs AS (SELECT DISTINCT a.graph, a.node, b.node AS other FROM hung a JOIN hung b ON b.graph = a.graph AND b.fact_id = a.fact_id
          WHERE a.node <> b.node),
seed_nodes AS (SELECT b.query_id, h.graph, h.node, min(b.rank) AS rank FROM bm_leg b JOIN hung h ON h.fact_id = b.fact_id
               WHERE b.rank <= {SEEDS} AND h.node LIKE 'entity:%' GROUP BY ALL),
starts AS (SELECT DISTINCT graph, node FROM seed_nodes),
around AS (SELECT s.graph, s.node, 0 AS hop, h.fact_id FROM starts s JOIN hung h ON h.graph = s.graph AND h.node = s.node
           UNION SELECT s.graph, s.node, 1, h.fact_id FROM starts s JOIN pairs p ON p.graph = s.graph AND p.node = s.node
                 JOIN hung h ON h.graph = p.graph AND h.node = p.other),
reached AS (SELECT s.query_id, a.fact_id, round(1.0::DOUBLE / min(s.rank + a.hop), 9) AS score
            FROM seed_nodes s JOIN around a ON a.graph = s.graph AND a.node = s.node GROUP BY ALL),
leg_graph AS (SELECT query_id, fact_id, score,
                CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, fact_id) AS INTEGER) AS rank
              FROM reached QUALIFY rank <= {DEPTH}),
legs AS (SELECT 'lexical' AS leg, query_id, fact_id, rank FROM bm_leg
         UNION ALL SELECT 'vector', query_id, fact_id, rank FROM leg_vector
         UNION ALL SELECT 'graph', query_id, fact_id, rank FROM leg_graph),
fused AS (SELECT query_id, fact_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS rrf
          FROM legs GROUP BY query_id, fact_id)
"""


def fused_top_sql(k: int, name: str = "top") -> str:
    return f"""{name} AS (SELECT query_id, fact_id, rrf,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, fact_id) AS INTEGER) AS rank
       FROM fused QUALIFY rank <= {k})"""


def _ids(df, *cols):
    return df.select("query_id", F.col("doc_id").alias("fact_id"), *cols)


# ---------------------------------------------------------------- queries
@register("bm25_search", sql=f"WITH {LEGS_CTE} SELECT query_id, fact_id, score, rank FROM bm_leg")
def q_bm25_search(spark, d):
    return _ids(_lexical_leg(spark, d), "score", "rank")


def _impact(spark, d):
    """Impact-ordered blocks of the fact index, made at write time."""
    docs = Tables(spark, d).documents
    # the lines of a document share a shard
    blocks, stats = IM.impact_index(_index(spark, d), together=F.floor(F.col("doc_id") / derive.LINES))
    return (LX.kept_table(spark, "fact-impacts", docs, lambda: blocks),
            LX.kept_table(spark, "fact-terms", docs, lambda: stats))


@register("bm25_pruned", sql=f"WITH {LEGS_CTE} SELECT query_id, fact_id, score, rank FROM bm_leg WHERE rank <= {NODES_K}")
def q_bm25_pruned(spark, d):
    """The first ten of the lexical leg from the blocks that can hold them."""
    return _ids(IM.bm25_pruned(*_impact(spark, d), _queries(spark, d), NODES_K), "score", "rank")


IVF_CELLS, IVF_PROBES = 32, 12


@register("vector_search_ivf", sql=f"""WITH {LEGS_CTE}
SELECT count(DISTINCT query_id) AS queries, count(*) AS answers, true AS recall_ok FROM leg_vector WHERE rank <= {NODES_K}""")
def q_vector_search_ivf(spark, d):
    """OP-32 by cells: how many of the exact answers it finds (0.9 of them at least)."""
    vectors = _vectors(spark, d).select("graph", "doc_id", "embedding")
    asked = O.embedder_hook(_queries(spark, d), "text", dim=VEC_DIM)
    path, centres = IV.build_index(vectors, IVF_CELLS, "doc_id")
    found = IV.search(spark, path, centres, asked, NODES_K, IVF_PROBES)
    exact = S.vector_search(vectors, asked, NODES_K, id_col="doc_id")
    return IV.recall(found, exact).select("queries", "answers", (F.col("recall") >= 0.9).alias("recall_ok"))


@register("leg_rank", sql=f"WITH {LEGS_CTE} SELECT query_id, fact_id, score, rank FROM leg_graph")
def q_leg_rank(spark, d):
    return _ids(_graph_leg(spark, d, _lexical_leg(spark, d)), "score", "rank")


@register("fact_vector_search", sql=f"WITH {LEGS_CTE} SELECT query_id, fact_id, score, rank FROM leg_vector")
def q_fact_vector_search(spark, d):
    return _ids(_vector_leg(spark, d), "score", "rank")


@register("leg_union", sql=f"WITH {LEGS_CTE} SELECT leg, query_id, fact_id, rank FROM legs")
def q_leg_union(spark, d):
    return _ids(S.leg_union(_legs(spark, d)), "leg", "rank")


@register("hybrid_search", sql=f"WITH {LEGS_CTE}, {fused_top_sql(RECALL_OVER_FETCH)} SELECT * FROM top")
def q_hybrid_search(spark, d):
    return _ids(S.rrf_fuse(_legs(spark, d), RECALL_OVER_FETCH), "rrf", "rank")


@register("search_memory_facts", sql=f"""WITH {LEGS_CTE}, {fused_top_sql(EVAL_MAX_FACTS)}
SELECT t.query_id, f.graph, t.fact_id, f.subject, f.episode, t.rrf, t.rank FROM top t JOIN line_facts f ON f.fact_id = t.fact_id""")
def q_search_memory_facts(spark, d):
    """Facts (subject, episode and tier included) for each query, in its tier."""
    facts = _facts(spark, d).select("graph", "doc_id", "subject", "episode")
    found = E.result_rows(_fused(spark, d, EVAL_MAX_FACTS), facts, _at_most(spark, d, EVAL_MAX_FACTS))
    return _ids(found, "graph", "subject", "episode", "rrf", "rank")


_IN_GROUPS = "group_id IN (" + ", ".join(map(repr, GROUPS)) + ")"


@register("search_memory_facts_scoped", sql=f"""WITH {LEGS_CTE.replace("FROM all_facts WHERE true", "FROM all_facts WHERE " + _IN_GROUPS)}, {fused_top_sql(EVAL_MAX_FACTS)}
SELECT t.query_id, f.graph, f.group_id, t.fact_id, f.topic, t.rrf, t.rank FROM top t JOIN line_facts f ON f.fact_id = t.fact_id""")
def q_search_memory_facts_scoped(spark, d):
    """Recall inside some namespaces: every leg counts, ranks and walks in the scope alone."""
    facts = S.scoped(_facts(spark, d), GROUPS).select("graph", "group_id", "doc_id", "topic")
    found = E.result_rows(_fused(spark, d, EVAL_MAX_FACTS, GROUPS), facts, _at_most(spark, d, EVAL_MAX_FACTS))
    return _ids(found, "graph", "group_id", "topic", "rrf", "rank")


@register("search_nodes", sql=f"""WITH {ENTITIES_CTE},
typed AS (SELECT graph, uuid AS fact_id, name AS text FROM entities WHERE entity_type IN ({', '.join(map(repr, NODE_TYPES))})),
node_queries AS (SELECT graph, min(uuid) AS query_id, name AS text FROM entities WHERE uuid > 0 GROUP BY graph, name),
{bm25_sql('sn', 'typed', 'node_queries', NODES_K)}
SELECT query_id, fact_id AS uuid, score, rank FROM sn_leg""")
def q_search_nodes(spark, d):
    """OP-29: every distinct part name, searched among the entities of some types in its tier."""
    ents = derive.entities(Tables(spark, d))
    queries = (ents.filter(F.col("uuid") > 0).groupBy("graph", F.col("name").alias("text"))
               .agg(F.min("uuid").alias("query_id")))
    typed = G.filter_entity_types(ents, NODE_TYPES).select("graph", F.col("uuid").alias("doc_id"), F.col("name").alias("text"))
    return S.bm25_search(S.postings(typed), queries, NODES_K).select("query_id", F.col("doc_id").alias("uuid"), "score", "rank")


# ---------------------------------------------------------------- entities
def _entity_store(spark, d):
    """Entities of the line facts, their gram lists and their vectors, made at write time."""
    docs, facts = Tables(spark, d).documents, _facts(spark, d)
    named = derive.fact_entities(facts)
    nodes = LX.kept_table(spark, "nodes", docs, lambda: derive.node_ids(named))
    lists = LX.kept_table(spark, "node-grams", docs, lambda: ND.gram_rows(nodes))

    def summed():
        vec = _vectors(spark, d).select(F.col("doc_id").alias("fact_id"), "embedding")
        said = named.join(nodes, ["graph", "entity_type", "name"]).select("graph", "doc_id", "entity_type", "fact_id")
        return ND.entity_vectors(said.join(vec, "fact_id"))
    words = LX.kept_table(spark, "node-words", docs, lambda: S.unit_terms(
        nodes.withColumnRenamed("name", "text"), ["doc_id", "entity_type"]))
    return nodes, words, lists, LX.kept_table(spark, "node-vectors", docs, summed)


def _node_legs(spark, d, types):
    _, words, lists, vectors = _entity_store(spark, d)
    q = derive.node_queries(Tables(spark, d))
    return {"words": S.bm25_search(ND.of_types(words, types), q, DEPTH),
            "letters": ND.gram_leg(ND.of_types(lists, types), q, DEPTH),
            "facts": S.vector_search(ND.of_types(vectors, types), O.embedder_hook(q, "text", dim=VEC_DIM), DEPTH, id_col="doc_id")}


ENTITY_TYPES = ["Topic", "SystemComponent"]
_GRAMS = "list_distinct(list_transform(range(1, length({p}) - 1), lambda i: substr({p}, i, 3)))"


def _node_sql(types: list[str]) -> str:
    kinds = ", ".join(map(repr, types))
    return f"""
{LINE_FACTS_CTE},
ents AS (SELECT graph, fact_id, 'Organization' AS entity_type, subject AS name FROM line_facts WHERE subject IS NOT NULL
         UNION ALL SELECT graph, fact_id, CASE graph WHEN 'personal' THEN 'Topic' ELSE 'SystemComponent' END, topic FROM line_facts WHERE topic IS NOT NULL),
nodes AS (SELECT graph, entity_type, name, 2 * lead + CASE entity_type WHEN 'Organization' THEN 0 ELSE 1 END AS node
          FROM (SELECT graph, entity_type, name, min(fact_id) AS lead FROM ents WHERE entity_type IN ({kinds}) GROUP BY graph, entity_type, name)),
qw AS (SELECT item_id AS query_id, {TIER.format(k='item_id')} AS graph, list_filter({_tok_sql('text')}, lambda w: length(w) >= 7) AS w FROM benchmark),
node_queries AS (SELECT query_id, graph, concat_ws(' ', substr(w[1], 1, 2) || substr(w[1], 4), w[2]) AS text FROM qw),
names AS (SELECT graph, node AS fact_id, name AS text FROM nodes),
{bm25_sql('nw', 'names', 'node_queries', DEPTH)},
ng AS (SELECT graph, node, unnest({_GRAMS.format(p='p')}) AS gram, len({_GRAMS.format(p='p')}) AS n
       FROM (SELECT graph, node, '  ' || lower(name) || ' ' AS p FROM nodes)),
qg AS (SELECT graph, query_id, unnest({_GRAMS.format(p='p')}) AS gram, len({_GRAMS.format(p='p')}) AS n
       FROM (SELECT graph, query_id, '  ' || lower(text) || ' ' AS p FROM node_queries)),
dice AS (SELECT q.query_id, n.node AS fact_id, round(2.0::DOUBLE * count(*) / (n.n + q.n), 9) AS score
         FROM qg q JOIN ng n ON n.graph = q.graph AND n.gram = q.gram GROUP BY q.query_id, n.node, n.n, q.n),
leg_letters AS (SELECT query_id, fact_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, fact_id) AS INTEGER) AS rank
                FROM dice QUALIFY rank <= {DEPTH}),
{_vector_sql('lf', 'line_facts', 'fact_id')}, {_vector_sql('nq', 'node_queries', 'query_id')},
nv AS (SELECT n.graph, n.node, v.dim, sum(v.x) AS x FROM nodes n JOIN ents e ON e.graph = n.graph AND e.entity_type = n.entity_type AND e.name = n.name
       JOIN lf_dims v ON v.fact_id = e.fact_id GROUP BY ALL),
nn AS (SELECT graph, node, sqrt(sum(x * x)) AS norm FROM nv GROUP BY ALL HAVING sum(x * x) > 0),
near AS (SELECT q.query_id, v.node, sum(q.x * v.x) AS dot FROM nq_dims q JOIN nv v ON v.graph = q.graph AND v.dim = q.dim GROUP BY ALL),
leg_facts AS (SELECT q.query_id, n.node AS fact_id, CAST(row_number() OVER (PARTITION BY q.query_id
                ORDER BY round(coalesce(a.dot, 0) / n.norm / q.norm, 9) DESC, n.node) AS INTEGER) AS rank
              FROM nq_norm q JOIN nn n ON n.graph = q.graph LEFT JOIN near a ON a.query_id = q.query_id AND a.node = n.node QUALIFY rank <= {DEPTH}),
legs AS (SELECT query_id, fact_id, rank FROM nw_leg UNION ALL SELECT * FROM leg_letters UNION ALL SELECT * FROM leg_facts),
fused AS (SELECT query_id, fact_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS rrf FROM legs GROUP BY ALL),
{fused_top_sql(NODES_K)}"""


@register("search_nodes_hybrid", sql=f"""WITH {_node_sql(ENTITY_TYPES)}
SELECT t.query_id, n.graph, t.fact_id AS uuid, n.entity_type, n.name, t.rrf, t.rank FROM top t JOIN nodes n ON n.node = t.fact_id""")
def q_search_nodes_hybrid(spark, d):
    """OP-29 over OP-33: misspelt names among the entities of two types, in each query's tier."""
    top = S.rrf_fuse(_node_legs(spark, d, ENTITY_TYPES), NODES_K)
    nodes = _entity_store(spark, d)[0]
    return E.result_rows(top, nodes, Tables(spark, d).benchmark.count() * NODES_K).select(
        "query_id", "graph", F.col("doc_id").alias("uuid"), "entity_type", "name", "rrf", "rank")


@register("recall_budget", sql=f"""WITH {LEGS_CTE}, {fused_top_sql(RECALL_OVER_FETCH)},
s AS (SELECT t.query_id, t.rank, regexp_split_to_array(d.text, '{LINE_RE2}') AS l
      FROM top t JOIN line_facts d ON d.fact_id = t.fact_id),
u AS (SELECT query_id, rank, unnest(l) AS line, unnest(range(0, len(l))) AS line_no FROM s),
c AS (SELECT query_id, rank, CAST(line_no AS INTEGER) AS line_no,
             CAST(greatest(1, length(line) // 4) AS BIGINT) AS cost
      FROM u WHERE length(trim(line, {WS})) > 0),
r AS (SELECT *, sum(cost) OVER (PARTITION BY query_id ORDER BY rank, line_no
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM c)
SELECT query_id, rank, line_no, cost, CAST(used AS BIGINT) AS used FROM r WHERE used <= {RECALL_BUDGET}""")
def q_recall_budget(spark, d):
    lines = (E.result_texts(_fused(spark, d, RECALL_OVER_FETCH), _facts(spark, d), _at_most(spark, d, RECALL_OVER_FETCH))
             .select("query_id", "rank", F.posexplode(split_lines(F.col("text"))).alias("line_no", "line"))
             .filter(~is_blank(F.col("line"))))
    return S.recall_budget(lines, RECALL_BUDGET).select("query_id", "rank", "line_no", "cost",
                                                        F.col("used").cast("long").alias("used"))


EVAL_CTE = """
ids AS (SELECT min(item_id) AS lo, max(item_id) AS hi FROM benchmark),
words AS (SELECT item_id, list_filter(regexp_split_to_array(text, '[^\\p{L}\\p{N}]+'),
                                      lambda w: length(w) >= 7)[1:2] AS ws FROM benchmark),
cases AS (SELECT b.item_id AS case_id, b.text AS query,
            CASE WHEN b.item_id = ids.lo THEN []::VARCHAR[]
                 WHEN b.item_id = ids.hi THEN list_concat(w.ws, ['memory'])
                 ELSE w.ws END AS expect
          FROM benchmark b JOIN words w ON w.item_id = b.item_id CROSS JOIN ids)
"""


def _cases(spark, d):
    return E.eval_cases_from_items(Tables(spark, d).benchmark)


@register("eval_case_load", sql=f"""WITH {EVAL_CTE}
SELECT case_id, query, CAST(len(expect) AS INTEGER) AS n_expect, array_to_string(expect, '|') AS expect_text FROM cases""")
def q_eval_case_load(spark, d):
    return _cases(spark, d).select("case_id", "query", F.size("expect").alias("n_expect"),
                                   F.array_join("expect", "|").alias("expect_text"))


@register("facts_text", sql=f"""WITH {LEGS_CTE}, {fused_top_sql(EVAL_MAX_FACTS)},
h AS (SELECT t.query_id, lower(string_agg(d.text, chr(10) ORDER BY t.rank)) AS haystack
      FROM top t JOIN line_facts d ON d.fact_id = t.fact_id GROUP BY t.query_id)
SELECT query_id, CAST(length(haystack) AS INTEGER) AS haystack_chars, sha256(haystack) AS haystack_sha256 FROM h""")
def q_facts_text(spark, d):
    h = E.facts_text(_fused(spark, d, EVAL_MAX_FACTS), _facts(spark, d), _at_most(spark, d, EVAL_MAX_FACTS))
    return h.select("query_id", F.length("haystack").alias("haystack_chars"),
                    F.sha2("haystack", 256).alias("haystack_sha256"))


MATCH_SQL = f"""{EVAL_CTE}, {LEGS_CTE}, {fused_top_sql(EVAL_MAX_FACTS)},
needles AS (SELECT case_id, CAST(pos - 1 AS INTEGER) AS needle_pos, lower(expect[pos]) AS needle
            FROM (SELECT case_id, expect, unnest(range(1, len(expect) + 1)) AS pos FROM cases)),
res AS (SELECT t.query_id AS case_id, lower(d.text) AS ltext FROM top t JOIN line_facts d ON d.fact_id = t.fact_id),
matches AS (SELECT n.case_id, n.needle_pos, n.needle, bool_or(coalesce(contains(r.ltext, n.needle), false)) AS hit
            FROM needles n LEFT JOIN res r ON r.case_id = n.case_id GROUP BY ALL)
"""


def _matches(spark, d):
    return E.eval_match(_cases(spark, d), _fused(spark, d, EVAL_MAX_FACTS), _facts(spark, d), _at_most(spark, d, EVAL_MAX_FACTS))


@register("eval_match", sql=f"WITH {MATCH_SQL} SELECT case_id, needle_pos, needle, hit FROM matches")
def q_eval_match(spark, d):
    return _matches(spark, d)


@register("eval_recall", sql=f"""WITH {MATCH_SQL},
per AS (SELECT c.case_id, coalesce(bool_and(m.hit), true) AS passed
        FROM cases c LEFT JOIN matches m ON m.case_id = c.case_id GROUP BY c.case_id)
SELECT CAST(sum(CAST(passed AS BIGINT)) AS BIGINT) AS passed, count(*) AS total,
       sum(CAST(passed AS BIGINT)) = count(*) AS ok FROM per""")
def q_eval_recall(spark, d):
    return E.eval_recall(_cases(spark, d), _matches(spark, d))


# ---------------------------------------------------------------- vectors
@register("embedding_guard", sql=f"""
WITH mixed AS (SELECT vec_id, CASE WHEN label % 4 = 1 THEN embedding[1:32] WHEN label % 4 <> 3 THEN embedding END AS embedding FROM embeddings)
SELECT vec_id, CASE WHEN embedding IS NULL THEN 'missing vector'
                    WHEN len(embedding) <> {VEC_DIM} THEN 'dimension ' || CAST(len(embedding) AS VARCHAR) || ' != {VEC_DIM}'
               END AS reject_reason,
       embedding IS NOT NULL AND len(embedding) = {VEC_DIM} AS accepted
FROM mixed""")
def q_embedding_guard(spark, d):
    """A store that mixes embedders: some labels' vectors are half as long, some are missing."""
    e, kind = Tables(spark, d).embeddings, F.col("label") % 4
    mixed = e.withColumn("embedding", F.when(kind == 1, F.slice("embedding", 1, 32)).when(kind != 3, F.col("embedding")))
    return S.embedding_guard(mixed, VEC_DIM).select("vec_id", "reject_reason", "accepted")


@register("vector_search", sql=f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) = {VEC_DIM}),
comp AS (SELECT label, i, avg(x) AS m
         FROM (SELECT label, unnest(e) AS x, unnest(range(len(e))) AS i FROM v) GROUP BY label, i),
q AS (SELECT CAST(label AS BIGINT) AS query_id, list(m ORDER BY i) AS e FROM comp GROUP BY label),
s AS (SELECT q.query_id, v.vec_id AS doc_id,
             round(list_dot_product(v.e, q.e) / sqrt(list_dot_product(v.e, v.e)) / sqrt(list_dot_product(q.e, q.e)), 9) AS score
      FROM q CROSS JOIN v)
SELECT query_id, doc_id, score,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
FROM s QUALIFY rank <= {VEC_K}""")
def q_vector_search(spark, d):
    vecs = S.embedding_guard(Tables(spark, d).embeddings, VEC_DIM).filter("accepted")
    queries = S.label_centroids(vecs)
    return S.vector_search(vecs, queries, VEC_K).select("query_id", "doc_id", "score", "rank")
