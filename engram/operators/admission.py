"""Write path: guard, effective group, attribution, hygiene, structure, novelty,
audits (OP-12, 13, 14, 22, 23, 36, 40, 41, U3).

Per-tier settings are a handful of literals, so they are compiled into CASE /
map expressions (no join at all) rather than joined in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engram.config import DEFAULT_GROUP
from engram.functions.text import normalized, py_strip

# Our own rules (fixed values for the test data). Python, Java and RE2 agree on
# these patterns: no look-around, no \b, explicit classes.
LICENSE_PATTERN = r"(?i)licen[cs]e"
HYGIENE_RULES = [  # (label, pattern), first match wins
    ("credential", r"(?i)(token|password|passwd|secret|api[_-]?key)\s*[=:]\s*\S+"),
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("phone", r"\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}"),
    ("card_number", r"[0-9]{13,19}"),
]
#: Literals of which every match of a pattern holds at least one: a plain substring
#: search rules most texts out before the regex runs.
NEEDED = {pat: needed for (_, pat), needed in zip(HYGIENE_RULES, (("=", ":"), ("@",), ("+",), ()))}
AGENT_PREFIX = r"^\[agent:([^\]]+)\]"


def _tier_case(tier_col: Column, values: dict, default=None) -> Column:
    expr = None
    for tier, v in values.items():
        cond = tier_col == F.lit(tier)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def effective_group(df: DataFrame, defaults: dict | None = None, tier_col: str = "graph") -> DataFrame:
    """OP-12: supplied group, or the tier's default when null or empty."""
    defaults = defaults or DEFAULT_GROUP
    return df.withColumn("effective_group_id", F.coalesce(
        F.nullif(F.col("group_id"), F.lit("")), _tier_case(F.col(tier_col), defaults)))


def attribute_agent(df: DataFrame) -> DataFrame:
    """OP-13: '[agent:<id>] <description>' stripped, when agent_id is non-empty;
    otherwise the description unchanged (not stripped). A null description
    counts as empty."""
    has_agent = F.coalesce(F.length("agent_id") > 0, F.lit(False))
    attributed = py_strip(F.concat(F.lit("[agent:"), F.col("agent_id"), F.lit("] "),
                                   F.coalesce(F.col("source_description"), F.lit(""))))
    return df.withColumn("effective_source_description",
                         F.when(has_agent, attributed).otherwise(F.col("source_description")))


def unicode_pattern(pat: str) -> str:
    """The pattern with Unicode classes and case rules, as Python's ``re`` has them
    (without it ``(?i)señal`` lets "SEÑAL" through)."""
    return "(?U)" + pat


def matches(text: Column, pat: str) -> Column:
    """Does the pattern match anywhere? Same answer as the regex alone, cheaper."""
    hit = text.rlike(unicode_pattern(pat))
    some = None
    for literal in NEEDED.get(pat, ()):
        some = text.contains(literal) if some is None else some | text.contains(literal)
    return hit if some is None else some & hit


def guard_text() -> Column:
    """What the guard searches: name, raw description and body, newline-joined."""
    return F.concat_ws("\n", *[F.coalesce(F.col(c), F.lit(""))
                               for c in ("name", "source_description", "episode_body")])


def tier_guard(df: DataFrame, reject_patterns: dict, tier_col: str = "graph") -> DataFrame:
    """OP-14: reject a write whose text matches its tier's pattern anywhere.

    Runs on the raw description (before attribution), so agent_id is never
    matched. A tier without (or with an empty) pattern has no guard. Rows are
    never dropped: ``accepted`` + ``reject_reason``.
    """
    txt = guard_text()
    hit = None
    for tier, pat in reject_patterns.items():
        if not pat:
            continue
        cond = (F.col(tier_col) == F.lit(tier)) & matches(txt, pat)
        hit = cond if hit is None else (hit | cond)
    hit = F.coalesce(hit, F.lit(False)) if hit is not None else F.lit(False)
    return (df.withColumn("accepted", ~hit)
              .withColumn("reject_reason", F.when(hit, F.lit("tier guard: matches reject_pattern"))))


def write_hygiene(df: DataFrame, text_col: str = "episode_body",
                  rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """OP-23: label the first matching hygiene rule; verdict 'reject' or 'store'."""
    rules = rules or HYGIENE_RULES
    label = None
    for name, pat in rules:
        cond = matches(F.col(text_col), pat)
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
    return (df.withColumn("hygiene_label", label)
              .withColumn("verdict", F.when(F.col("hygiene_label").isNull(), F.lit("store"))
                          .otherwise(F.lit("reject"))))


STRUCTURED_SCHEMA = "who string, what string, when string, source string"


def structured_episode(df: DataFrame, body_col: str = "episode_body") -> DataFrame:
    """OP-22: JSON object bodies (who/what/when/source) become typed columns;
    prose passes through with ``is_structured = false``."""
    v = F.try_parse_json(F.col(body_col))
    is_obj = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    out = df.withColumn("is_structured", is_obj)
    for name, typ in (("who", "string"), ("what", "string"), ("source", "string")):
        out = out.withColumn(name, F.when(is_obj, F.try_variant_get(v, f"$.{name}", typ)))
    return out.withColumn("when", F.when(is_obj, F.try_variant_get(v, "$.when", "string"))
                          .cast("timestamp_ntz"))


def body_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def novel_memories(batch: DataFrame, store: DataFrame, key_cols: list[str],
                   order_cols: list[str]) -> DataFrame:
    """OP-36: check-first — drop in-batch duplicates (first by ``order_cols``
    wins) and anything already stored, per ``key_cols`` + normalised-text hash.

    The in-batch winner is found with a hash aggregate (``min`` of a struct),
    which combines map-side: a group of copies holding a third of all rows is
    reduced before the shuffle instead of landing in one window partition.
    """
    b = batch.withColumn("text_key", body_hash(normalized(F.col("episode_body"))))
    if len(order_cols) == 1:
        # a fixed-width min is a HashAggregate (no sort-based fallback)
        first = b.groupBy(*key_cols, "text_key").agg(F.min(order_cols[0]).alias(order_cols[0]))
    else:
        first = b.groupBy(*key_cols, "text_key").agg(
            F.min(F.struct(*[F.col(c) for c in order_cols])).alias("_first"))
        first = first.select(*key_cols, "text_key", *[F.col(f"_first.{c}").alias(c) for c in order_cols])
    s = store.select(*key_cols, body_hash(normalized(F.col("episode_body"))).alias("text_key")).distinct()
    return first.join(s, key_cols + ["text_key"], "left_anti")


def agent_of(desc: Column) -> Column:
    a = F.regexp_extract(desc, AGENT_PREFIX, 1)
    return F.when(F.coalesce(F.length(a), F.lit(0)) > 0, a).otherwise(F.lit("anonymous"))


def agent_audit(episodes: DataFrame, desc_col: str = "effective_source_description",
                id_col: str = "doc_id") -> DataFrame:
    """OP-40: writes per (graph, agent) from the '[agent:x]' prefix."""
    return (episodes.withColumn("agent", agent_of(F.col(desc_col)))
            .groupBy("graph", "agent")
            .agg(F.count(F.lit(1)).alias("writes"), F.min(id_col).alias("first_id"),
                 F.max(id_col).alias("last_id")))


def cross_tier_bodies(episodes: DataFrame, a: str = "personal", b: str = "client") -> DataFrame:
    """OP-U3: body hashes present in both tiers (must be empty in a clean store)."""
    ha = episodes.filter(F.col("graph") == a).select(body_hash(F.col("episode_body")).alias("body_hash"))
    hb = episodes.filter(F.col("graph") == b).select(body_hash(F.col("episode_body")).alias("body_hash"))
    return ha.intersect(hb)


def tier_leak_audit(episodes: DataFrame, personal_patterns: list[tuple[str, str]],
                    id_col: str = "doc_id") -> DataFrame:
    """OP-41: rows in the personal tier that must not be there — pattern hits,
    plus bodies also stored in the client tier. (id, reason) rows.

    Pattern reasons come from one row-local pass (an array of matching rule
    names, exploded); the cross-tier part is a semi-join with the hash
    intersection (distinct hashes on both sides, combined map-side)."""
    personal = episodes.filter(F.col("graph") == "personal")
    txt = guard_text()
    reasons = F.filter(F.array(*[F.when(matches(txt, pat), F.lit(f"pattern:{name}"))
                                 for name, pat in personal_patterns]), lambda r: r.isNotNull())
    hits = personal.select(id_col, F.explode(reasons).alias("reason"))
    shared = cross_tier_bodies(episodes)
    both = (personal.withColumn("body_hash", body_hash(F.col("episode_body")))
            .join(shared, "body_hash", "left_semi")
            .select(id_col, F.lit("cross_tier_body").alias("reason")))
    return hits.unionByName(both)
