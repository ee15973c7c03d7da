"""Entity resolution: names that extractors found become entities, mentions and
observations (the second half of OP-50).

1. Names are compared in a plain form (lower case, every run of other characters one
   blank). Names of one tier and type are one entity if their digits are the same and
   their letters differ by at most one edit; short names must be equal.
2. Blocking: a name is filed under its letters and under each form with one letter less,
   so names one edit apart share a key. A key's group holds few names (at most the
   alphabet times the length), so no block is hot however often a name is said.
3. Linked names form components by min-label propagation with pointer jumping; every
   round's table is written to the shared folder.

An entity is known by the smallest plain name of its component: its id is a digest of
(graph, type, that name), so the same names get the same ids in every run; it is shown
under the name that was said most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engram.session import scratch_path

SHORT = 5       # letters below which names must be equal


def plain_name(c: Column) -> Column:
    """Lower case, runs of anything but letters and digits to one blank, trimmed."""
    return F.btrim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, "resolve", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component of undirected ``links`` (a, b).

    Every round a node takes the smallest root among its own and its neighbours' and then its
    root's root, so a chain of n nodes takes about log n rounds."""
    both = _written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    state = _written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    while True:
        near = (both.join(state.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("root").alias("near")))
        low = state.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = low.select(F.col("node").alias("root"), F.col("root").alias("jump"))
        nxt = _written(low.join(jump, "root", "left").select("node", "old", F.least("root", F.coalesce("jump", "root")).alias("root")), "roots")
        state = nxt.select("node", "root")
        if nxt.filter("old <> root").isEmpty():
            return state


def name_links(names: DataFrame) -> DataFrame:
    """(graph, entity_type, a, b): pairs a < b of plain names that are one entity.
    ``names``: distinct (graph, entity_type, name)."""
    letters = F.regexp_replace("name", r"\P{L}+", "")
    n = names.select("graph", "entity_type", "name", letters.alias("letters"), F.regexp_replace("name", r"\P{N}+", "").alias("digits"))
    shorter = F.transform(F.sequence(F.lit(1), F.length("letters")),
                          lambda i: F.concat(F.substr("letters", F.lit(1), i - 1), F.substr("letters", i + 1)))
    keys = F.when(F.length("letters") >= SHORT, F.array_distinct(F.concat(F.array("letters"), shorter))).otherwise(F.array("letters"))
    filed = n.withColumn("key", F.explode(keys))
    other = filed.select("graph", "entity_type", "digits", "key", F.col("name").alias("b"), F.col("letters").alias("letters_b"))
    pairs = filed.join(other, ["graph", "entity_type", "digits", "key"]).filter(F.col("name") < F.col("b"))
    long = F.least(F.length("letters"), F.length("letters_b")) >= SHORT
    same = F.when(long, F.levenshtein("letters", "letters_b") <= 1).otherwise(F.col("letters") == F.col("letters_b"))
    return pairs.filter(same).select("graph", "entity_type", F.col("name").alias("a"), "b").distinct()


def resolve_names(said: DataFrame) -> DataFrame:
    """(graph, entity_type, name, uuid, title): the entity of every plain name.

    ``said``: (graph, entity_type, name), a row per time a name was said; names without a
    letter or digit are left out."""
    counted = _written(said.select("graph", "entity_type", plain_name(F.col("name")).alias("name")).filter("name <> ''")
                       .groupBy("graph", "entity_type", "name").agg(F.count(F.lit(1)).alias("n")), "names")
    node = F.struct("graph", "entity_type", "name")
    links = name_links(counted).select(F.struct("graph", "entity_type", F.col("a").alias("name")).alias("a"),
                                       F.struct("graph", "entity_type", F.col("b").alias("name")).alias("b"))
    roots = components(links).select(F.col("node"), F.col("root.name").alias("root"))
    known = counted.withColumn("node", node).join(roots, "node", "left").withColumn("root", F.coalesce("root", "name")).drop("node")
    titles = known.groupBy("graph", "entity_type", "root").agg(
        F.min(F.struct((-F.col("n")).alias("n"), F.col("name").alias("title"))).alias("t"))
    return (known.join(titles, ["graph", "entity_type", "root"])
            .select("graph", "entity_type", "name", F.substr(F.sha2(F.concat_ws("|", "graph", "entity_type", "root"), 256), F.lit(1), F.lit(16)).alias("uuid"),
                    F.col("t.title").alias("title")))


def graph_tables(extracted: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entities, mentions, observations) of extracted episodes.

    ``extracted``: (graph, doc_id, valid_at, entities array<struct<name, entity_type>>,
    facts array<struct<source, source_type, relation, target, target_type>>). A mention is
    one row per episode and entity; an observation (graph, subject, relation, value, uuid,
    valid_at) names entities by id and feeds supersession."""
    e = _written(extracted.select("graph", "doc_id", "valid_at", "entities", "facts"), "extracted")
    named = e.select("graph", "doc_id", F.explode("entities").alias("x")).select("graph", "doc_id", "x.entity_type", "x.name")
    known = _written(resolve_names(named), "known")
    entities = known.select("graph", "uuid", F.col("title").alias("name"), "entity_type").distinct()
    key = ["graph", "entity_type", "plain"]
    ids = known.select("graph", "entity_type", F.col("name").alias("plain"), "uuid")
    mentions = (named.select("graph", F.col("doc_id").alias("episode_uuid"), "entity_type", plain_name(F.col("name")).alias("plain")).distinct()
                .join(ids, key).select("graph", "episode_uuid", F.col("uuid").alias("entity_uuid")).distinct())
    f = e.select("graph", "doc_id", "valid_at", F.explode("facts").alias("x")).select(
        "graph", "doc_id", "valid_at", "x.relation", plain_name(F.col("x.source")).alias("s"), F.col("x.source_type").alias("st"),
        plain_name(F.col("x.target")).alias("t"), F.col("x.target_type").alias("tt"))
    subject = ids.select("graph", F.col("entity_type").alias("st"), F.col("plain").alias("s"), F.col("uuid").alias("subject"))
    value = ids.select("graph", F.col("entity_type").alias("tt"), F.col("plain").alias("t"), F.col("uuid").alias("value"))
    observations = (f.join(subject, ["graph", "st", "s"]).join(value, ["graph", "tt", "t"])
                    .select("graph", "subject", "relation", "value", F.col("doc_id").alias("uuid"), "valid_at").distinct())
    return entities, mentions, observations
