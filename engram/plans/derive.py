"""Model tables derived from the driver's tables (see FIXTURES.md, part B).

These are stand-ins for a real memory store: every model table is computed by
Spark from the given parquet tables, so the work of every query grows with
them. Ids stay BIGINT (cheap joins); entity ids of customers are negated so
parts and customers share one id space.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engram.functions.common import tier_of_parity
from engram.functions.text import is_blank, split_lines, tokens
from engram.operators.temporal import resolve_supersession
from engram.sources.tables import Tables


def episodes(t: Tables) -> DataFrame:
    """Graph-side episodes: one per order."""
    o = t.orders
    return o.select(
        tier_of_parity(F.col("o_custkey")).alias("graph"),
        F.col("o_orderstatus").alias("group_id"),
        F.col("o_orderkey").alias("uuid"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderpriority").alias("episode_body"),
        F.lit("text").alias("source"),
        F.lit("orders").alias("source_description"),
        F.col("o_orderdate").alias("created_at"),
    )


def entities(t: Tables) -> DataFrame:
    """Entities: parts (type = p_type) and customers (type = c_mktsegment)."""
    parts = t.part.select(
        tier_of_parity(F.col("p_partkey")).alias("graph"),
        F.col("p_partkey").alias("uuid"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("entity_type"))
    custs = t.customer.select(
        tier_of_parity(F.col("c_custkey")).alias("graph"),
        (-F.col("c_custkey")).alias("uuid"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("entity_type"))
    return parts.unionByName(custs)


def mentions(t: Tables, min_quantity: float | None = None) -> DataFrame:
    """Episode -> entity edges: distinct (order, part) of lineitem, in the order's graph."""
    li = t.lineitem
    if min_quantity is not None:
        li = li.filter(F.col("l_quantity") >= min_quantity)
    pairs = li.select(F.col("l_orderkey").alias("episode_uuid"),
                      F.col("l_partkey").alias("entity_uuid")).distinct()
    eps = t.orders.select(F.col("o_orderkey").alias("episode_uuid"),
                          tier_of_parity(F.col("o_custkey")).alias("graph"))
    return pairs.join(eps, "episode_uuid").select("graph", "episode_uuid", "entity_uuid")


def priority_observations(t: Tables) -> DataFrame:
    """Each order states its customer's priority at the order date."""
    o = t.orders
    return o.select(
        tier_of_parity(F.col("o_custkey")).alias("graph"),
        F.col("o_orderstatus").alias("group_id"),
        F.col("o_orderkey").alias("uuid"),
        F.col("o_custkey").alias("subject"),
        F.lit("priority").alias("relation"),
        F.col("o_orderpriority").alias("value"),
        F.col("o_orderdate").alias("valid_at"),
        F.array(F.col("o_orderkey")).alias("episodes"),
    )


def facts(t: Tables, graph: str | None = None) -> DataFrame:
    """Facts: runs of equal priority per customer, closed by the next run. ``graph``
    keeps one tier's observations before anything is resolved (it is a key part)."""
    obs = priority_observations(t)
    f = resolve_supersession(obs if graph is None else obs.filter(F.col("graph") == graph))
    return f.withColumn("fact", F.concat(
        F.lit("customer "), F.col("subject").cast("string"),
        F.lit(" has priority "), F.col("value")))


def purchases(t: Tables) -> DataFrame:
    """Facts that relate two entities: a customer bought a part, first stated by the order
    with the smallest (date, key), in the order's graph."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = t.lineitem.select("l_orderkey", "l_partkey")
    first = F.min(F.struct(F.col("o_orderdate").alias("valid_at"), F.col("o_orderkey").alias("episode")))
    return (li.join(o, li["l_orderkey"] == o["o_orderkey"]).groupBy("o_custkey", "l_partkey").agg(first.alias("f"))
            .select(tier_of_parity(F.col("o_custkey")).alias("graph"),
                    F.concat_ws("-", "o_custkey", "l_partkey").alias("uuid"),
                    (-F.col("o_custkey")).alias("source_uuid"), F.col("l_partkey").alias("target_uuid"),
                    F.col("f.valid_at").alias("valid_at"), F.array("f.episode").alias("episodes"),
                    F.concat(F.lit("customer "), F.col("o_custkey").cast("string"), F.lit(" bought part "),
                             F.col("l_partkey").cast("string")).alias("fact")))


def markdown_texts(t: Tables) -> DataFrame:
    """Markdown files made from documents: a title heading, the first 200
    characters, a '## body' heading, then the rest."""
    d = t.documents
    rel = F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md"))
    text = F.concat(
        F.lit("# "), F.col("source"), F.lit(" "), F.col("doc_id").cast("string"), F.lit("\n"),
        F.substring(F.col("text"), 1, 200), F.lit("\n## body\n"),
        F.expr("substring(text, 201)"))
    return d.select(F.col("doc_id"), rel.alias("rel_path"), text.alias("text"))


LINES = 1 << 24      # lines of a document that fact ids have room for


def line_facts(t: Tables) -> DataFrame:
    """Facts stated by documents: every non-blank line is a fact that relates its document's
    source (the subject) to its longest word (the topic), said in the document (the episode),
    in the namespace that the document was written to. id = document * 2^24 + line; a
    document with more lines is refused, so ids never meet."""
    d = t.documents
    num = F.regexp_extract(F.col("source"), r"(\d+)", 1).cast("long")
    graph = tier_of_parity(num)
    # the longest word, the first of equal ones; the words are taken apart once
    ranked = F.transform(tokens(F.col("text")), lambda t, i: F.struct(F.length(t).alias("n"), (-i).alias("i"), t.alias("word")))
    line = F.when(F.col("line_no") < LINES, F.col("line_no")).otherwise(F.raise_error(F.lit("a document has more than 2^24 lines")))
    return (d.select(graph.alias("graph"), F.col("source").alias("subject"), F.col("doc_id").alias("episode"),
                     F.coalesce(F.when(F.col("doc_id") % 3 == 2, F.concat(F.lit("project-"), F.col("lang"))), graph).alias("group_id"),
                     F.posexplode(split_lines(F.col("text"))).alias("line_no", "text"))
            .filter(~is_blank(F.col("text")))
            .withColumn("topic", F.array_max(ranked)["word"])
            .withColumn("doc_id", F.col("episode") * LINES + line))


TOPIC_TYPES = {"personal": "Topic", "client": "SystemComponent"}


def fact_entities(facts: DataFrame) -> DataFrame:
    """(graph, fact_id, entity_type, name): the two entities each line fact relates, its source
    (an organization) and its topic."""
    topic = F.when(F.col("graph") == "personal", F.lit(TOPIC_TYPES["personal"])).otherwise(F.lit(TOPIC_TYPES["client"]))
    both = F.array(F.struct(F.lit("Organization").alias("entity_type"), F.col("subject").alias("name")),
                   F.struct(topic.alias("entity_type"), F.col("topic").alias("name")))
    return facts.select("graph", F.col("doc_id").alias("fact_id"), F.explode(both).alias("e")).select(
        "graph", "fact_id", "e.entity_type", "e.name").filter("name is not null")


def node_ids(named: DataFrame) -> DataFrame:
    """(graph, entity_type, name, doc_id): an id per entity, twice its first fact's id, plus one
    for topics (a fact is the first of one source and one topic at most)."""
    return (named.groupBy("graph", "entity_type", "name").agg(F.min("fact_id").alias("first"))
            .select("graph", "entity_type", "name", (2 * F.col("first") + F.when(F.col("entity_type") == "Organization", 0).otherwise(1)).alias("doc_id")))


def node_queries(t: Tables) -> DataFrame:
    """Every benchmark item asks for an entity: its two first words of seven letters or more,
    the first with its third letter left out."""
    words = F.filter(tokens(F.col("text")), lambda w: F.length(w) >= 7)
    first = F.get(words, 0)
    misspelt = F.concat(F.substr(first, F.lit(1), F.lit(2)), F.substr(first, F.lit(4)))
    return t.benchmark.select(F.col("item_id").alias("query_id"), tier_of_parity(F.col("item_id")).alias("graph"),
                              F.concat_ws(" ", misspelt, F.get(words, 1)).alias("text"))


def fact_queries(t: Tables) -> DataFrame:
    """Every benchmark item asks in one tier (by parity of its id)."""
    return t.benchmark.select(F.col("item_id").alias("query_id"), tier_of_parity(F.col("item_id")).alias("graph"), "text")


def write_requests(t: Tables) -> DataFrame:
    """add_memory calls made from documents."""
    return requests_from_documents(t.documents)


def requests_from_documents(d: DataFrame) -> DataFrame:
    """Row-local mapping documents -> write requests (works on batch and stream)."""
    src_num = F.regexp_extract(F.col("source"), r"(\d+)", 1).cast("long")
    return d.select(
        F.col("doc_id"),
        tier_of_parity(src_num).alias("graph"),
        F.col("doc_id").cast("string").alias("name"),
        F.col("text").alias("episode_body"),
        F.lit("text").alias("source"),
        F.col("source").alias("source_description"),
        F.when(F.col("doc_id") % 3 == 0, F.lit(None).cast("string"))
         .when(F.col("doc_id") % 3 == 1, F.lit(""))
         .otherwise(F.concat(F.lit("project-"), F.col("lang"))).alias("group_id"),
        F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("agent_id"),
    )


def spoken_requests(t: Tables) -> DataFrame:
    """Short statements made from events, so that every trigger phrase is spoken: each
    user says one sentence an event, in the tier of the user's parity."""
    e = t.events
    k = F.coalesce(F.get_json_object("props", "$.k"), F.lit("none"))
    said = (F.when(F.col("event_type") == "purchase", F.concat(F.lit("I want product "), k))
            .when(F.col("event_type") == "view", F.concat(F.lit("we decided to keep plan "), k))
            .when(F.col("event_type") == "click", F.concat(F.lit("they want feature "), k))
            .when(F.col("event_type") == "error", F.concat(F.lit("The portal must have retry "), k))
            .otherwise(F.concat(F.lit("Talk about "), F.col("event_type"))))
    return e.select(F.col("event_id").alias("doc_id"), F.col("user_id").alias("subject"), F.col("ts").alias("valid_at"),
                    tier_of_parity(F.col("user_id")).alias("graph"), F.col("event_type").alias("name"),
                    F.lit("event").alias("source_description"), said.alias("episode_body"))


def statements(t: Tables) -> DataFrame:
    """Statements with a named speaker, names written in several ways: blanks, dashes, capitals
    and one letter too many, so that resolving them is needed. One statement an event."""
    e = t.events
    k = F.coalesce(F.get_json_object("props", "$.k"), F.lit("none"))
    way = F.col("event_id") % 7

    def named(noun: str) -> F.Column:
        odd = noun[:2] + noun[1] + noun[2:]
        return (F.when(way == 1, F.concat(F.lit(noun.upper() + "-"), k)).when(way == 2, F.concat(F.lit(odd + " "), k))
                .when(way == 3, F.concat(F.lit(noun.title() + "  "), k)).otherwise(F.concat(F.lit(noun + " "), k)))
    said = (F.when(F.col("event_type") == "purchase", F.concat(F.lit("I want "), named("product")))
            .when(F.col("event_type") == "view", F.concat(F.lit("Today we decided to keep "), named("subscription"), F.lit(". Nothing else")))
            .when(F.col("event_type") == "click", F.concat(F.lit("So they want "), named("feature")))
            .when(F.col("event_type") == "error", F.concat(named("retry policy"), F.lit(" is required.")))
            .otherwise(F.concat(F.lit("ruled out "), named("channel"))))
    who = F.col("user_id").cast("string")
    speaker = F.when(way == 4, F.concat(F.lit("USER-"), who)).when(way == 5, F.concat(F.lit("  user "), who)).otherwise(F.concat(F.lit("user "), who))
    return e.select(F.col("event_id").alias("doc_id"), F.col("ts").alias("valid_at"), tier_of_parity(F.col("user_id")).alias("graph"),
                    speaker.alias("speaker"), said.alias("episode_body"))


def access_log(t: Tables) -> DataFrame:
    """Gateway JSON access-log lines made from events, with their order key."""
    return log_lines_from_events(t.events)


def log_lines_from_events(e: DataFrame) -> DataFrame:
    """Row-local mapping events -> access-log lines (works on batch and stream)."""
    port = (F.lit(8000) + F.col("user_id") % 3).cast("string")
    rec = F.struct(
        F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").alias("ts"),
        F.struct(F.concat(F.lit("h:"), port).alias("host")).alias("request"),
        F.when(F.col("event_type") == "error", F.lit(401)).otherwise(F.lit(200)).alias("status"),
    )
    # sign-ups are logged as plain text lines: junk the parser must skip (they still count toward N)
    line = F.when(F.col("event_type") == "signup",
                  F.concat(F.lit("INFO signup user "), F.col("user_id").cast("string"))
                  ).otherwise(F.to_json(rec))
    return e.select("event_id", F.col("ts").alias("event_ts"), line.alias("line"))


def queue_events(t: Tables) -> DataFrame:
    """Write-queue stream: per user, purchase = an item leaves, anything else = add."""
    e = t.events
    return e.select(
        F.col("user_id").cast("string").alias("group_id"),
        F.col("ts"), F.col("event_id"),
        F.when(F.col("event_type") == "purchase", F.lit("done")).otherwise(F.lit("add")).alias("kind"))
