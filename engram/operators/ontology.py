"""Ontology: entity types per tier, typed optional attributes, rule-based typing,
pluggable extractor/embedder hooks, attribute coverage, citation rate
(OP-03, 15, 44b, 44c, 49, 50, 51)."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Entity types and their optional typed fields, per tier.
# (All declared fields have the default type "str".)
ONTOLOGY = {
    "personal": [
        ("Preference", []),
        ("Person", []),
        ("Organization", []),
        ("Project", []),
        ("Tool", []),
        ("Decision", [("rationale", "str"), ("decided_at", "str")]),
        ("Goal", [("deadline", "str"), ("success_criterion", "str")]),
        ("Topic", []),
        ("Resource", []),
    ],
    "client": [
        ("Preference", []),
        ("Client", []),
        ("Stakeholder", []),
        ("Engagement", []),
        ("Deliverable", [("status", "str"), ("due_date", "str")]),
        ("Requirement", [("priority", "str")]),
        ("Decision", [("rationale", "str"), ("decided_by", "str")]),
        ("Risk", [("mitigation", "str"), ("owner", "str")]),
        ("SystemComponent", []),
    ],
}

# Trigger phrases stated in the type descriptions.
#   personal Preference: "I want/like/prefer/use X", "I don't want/avoid/dislike Y",
#                        "X is better than Y", "go with X", "skip X"
#   personal Decision:   "we decided to X", "going with X because Y", "ruled out Z"
#   client Preference:   "they want X", "the client prefers Y", "avoid Z"
#   client Requirement:  "must have X", "X is required", "needs to Y"
#   client Decision:     "we decided X", "agreed to Y", "ruled out Z"
# Preference is checked first; Topic is used only when nothing else fits.
# A phrase starts at a word's start, whatever stands before it; the object stands on the
# side the description names it; polarity is -1 where the phrase turns something down.
# (The classes are written out so that Java, RE2 and Python read them alike.)
_AT = "(?:^|[^A-Za-z0-9_\u00c0-\u024f])"
_END = "(?:$|[^A-Za-z0-9_\u00c0-\u024f])"
_NOT = "don['\u2019]t"
_REST = "([^.\\n]+)"
_BEFORE = "(?:^|[.\\n])[ \\t]*([^ \\t.\\n][^.\\n]*?)"
TRIGGER_RULES = [  # (graph, entity_type, priority, pattern capturing the object, polarity)
    ("personal", "Preference", 1, rf"(?i){_AT}(?:i (?:want|like|prefer|use)|go with) {_REST}", 1),
    ("personal", "Preference", 1, rf"(?i){_AT}(?:i {_NOT} want|i (?:avoid|dislike)|skip) {_REST}", -1),
    ("personal", "Preference", 1, rf"(?i){_BEFORE} is better than [^.\n]", 1),
    ("personal", "Decision", 2, rf"(?i){_AT}(?:we decided to|going with) {_REST}", 1),
    ("personal", "Decision", 2, rf"(?i){_AT}ruled out {_REST}", -1),
    ("client", "Preference", 1, rf"(?i){_AT}(?:they want|the client prefers) {_REST}", 1),
    ("client", "Preference", 1, rf"(?i){_AT}avoid {_REST}", -1),
    ("client", "Requirement", 2, rf"(?i){_AT}(?:must have|needs to) {_REST}", 1),
    ("client", "Requirement", 2, rf"(?i){_BEFORE} is required{_END}", 1),
    ("client", "Decision", 3, rf"(?i){_AT}(?:we decided|agreed to) {_REST}", 1),
    ("client", "Decision", 3, rf"(?i){_AT}ruled out {_REST}", -1),
]
FALLBACK_TYPE = {"personal": "Topic"}

# Our own additional rules (not from the reference): referenced licences are
# Resources, e-mail domains are Organizations.
EXTRA_RULES = [
    ("personal", "Resource", 5, r"(?i)(?:licensed|released) under (?:the )?([^.,\n]+)", 1),
    ("personal", "Organization", 6, r"@([A-Za-z0-9.-]+\.[A-Za-z]{2,})", 1),
    ("client", "Stakeholder", 6, r"@([A-Za-z0-9.-]+\.[A-Za-z]{2,})", 1),
]

# Lower-case texts of which every match of a literal rule's pattern holds at least one, and the
# characters that a match has before that text at most (None: no bound).
_NEEDLES = [(("i want", "i like", "i prefer", "i use", "go with"), 1), (("i don't want", "i don\u2019t want", "i avoid", "i dislike", "skip"), 1),
            ((" is better than ",), None), (("we decided to", "going with"), 1), (("ruled out",), 1), (("they want", "the client prefers"), 1),
            (("avoid",), 1), (("must have", "needs to"), 1), ((" is required",), None), (("we decided", "agreed to"), 1), (("ruled out",), 1),
            (("licensed under", "released under"), 0), (("@",), 0), (("@",), 0)]
NEEDLES = {pat: held for (_, _, _, pat, _), held in zip(TRIGGER_RULES + EXTRA_RULES, _NEEDLES, strict=True)}

SPARK_TYPES = {"str": T.StringType(), "int": T.LongType(), "float": T.DoubleType(),
               "bool": T.BooleanType()}


def ontology_frame(spark: SparkSession, ontology: dict | None = None) -> DataFrame:
    """OP-03: (graph, entity_type, description, fields) — one row per declared type.
    ``ontology``: graph -> [(name, fields[, description])], a field being (name, type[,
    description]); what is not described is null."""
    rows = [(g, name, (rest or (None,))[0], [(f, t, (d or (None,))[0]) for f, t, *d in fields])
            for g, types in (ontology or ONTOLOGY).items() for name, fields, *rest in types]
    return spark.createDataFrame(rows, "graph string, entity_type string, description string, "
                                 "fields array<struct<name:string,type:string,description:string>>")


def load_ontology_yaml(spark: SparkSession, path: str, graph: str) -> DataFrame:
    """OP-03 from a tier config file: the ``entity_types`` list (name,
    description, optional typed fields), at the top level or inside one
    section. Unknown field types fall back to str."""
    import yaml

    with open(path, encoding="utf-8") as fh:
        cfg = yaml.safe_load(fh) or {}
    types = _entity_types(cfg)
    ont = {graph: [(t["name"], [(f["name"], f.get("type", "str") if f.get("type", "str") in SPARK_TYPES else "str",
                                 f.get("description")) for f in (t.get("fields") or [])], t.get("description"))
                   for t in types]}
    return ontology_frame(spark, ont)


def _entity_types(cfg) -> list:
    if isinstance(cfg, dict):
        if isinstance(cfg.get("entity_types"), list):
            return cfg["entity_types"]
        for v in cfg.values():
            if isinstance(v, dict) and isinstance(v.get("entity_types"), list):
                return v["entity_types"]
    return []


def attribute_schema(fields: list[tuple[str, str]]) -> T.StructType:
    """OP-15: all-optional typed record; unknown type -> string."""
    return T.StructType([T.StructField(n, SPARK_TYPES.get(t, T.StringType()), True) for n, t in fields])


def typed_attributes(df: DataFrame, payload_col: str, fields: list[tuple[str, str]]) -> DataFrame:
    """OP-15: parse a JSON payload into the declared fields.

    Every field is read as text first and then ``try_cast`` to its type, so a
    mistyped value nulls only itself; undeclared keys are ignored; a missing
    field is null, never an error."""
    as_text = T.StructType([T.StructField(n, T.StringType(), True) for n, _ in fields])
    parsed = F.from_json(F.col(payload_col), as_text, {"mode": "PERMISSIVE"})
    out = df
    for name, typ in fields:
        spark_t = SPARK_TYPES.get(typ, T.StringType())
        out = out.withColumn(name, parsed[name].try_cast(spark_t) if typ != "str"
                             else parsed[name])
    return out


def attribute_coverage(df: DataFrame, type_col: str, fields: list[str]) -> DataFrame:
    """OP-44b: fill rate of optional attributes per (type, field), from the long form."""
    long = df.select(type_col, F.explode(F.create_map(*[x for f in fields for x in
                                                        (F.lit(f), F.col(f).cast("string"))]))
                     .alias("field", "value"))
    return long.groupBy(F.col(type_col).alias("entity_type"), "field").agg(
        F.count("value").alias("filled"), F.count(F.lit(1)).alias("total")).withColumn(
        "fill_rate", F.col("filled") / F.col("total"))


def rule_extract(episodes: DataFrame, rules: list | None = None, id_col: str = "doc_id",
                 text_col: str = "episode_body", fallback: dict | None = None, keep: tuple = ()) -> DataFrame:
    """OP-49: type each episode by the first priority of its tier with a match, and extract
    the objects of all rules of that priority; the fallback type (Topic) only when nothing
    fits. -> (id, graph, keep..., entity_type, priority, value, polarity).

    Row-local and single-pass: every rule of the row's tier whose needles the lower-cased
    text holds (``NEEDLES``; a rule without any is always tried) runs as a literal
    ``regexp_extract_all``; the hits form an array of (priority, type, polarity, values)
    structs, of which those of the smallest priority stay. No shuffle, no join, no UDF;
    other columns that are wanted later pass through (``keep``)."""
    rules = rules if rules is not None else TRIGGER_RULES + EXTRA_RULES
    fallback = FALLBACK_TYPE if fallback is None else fallback
    text, graph = F.col(text_col), F.col("graph")

    def may_match(g, pat):
        held = F.lit(False)
        for needle in NEEDLES.get(pat, ((), None))[0]:
            held = held | F.contains("_low", F.lit(needle))
        return (graph == F.lit(g)) & (held if pat in NEEDLES else F.lit(True))
    cands = [F.when(may_match(g, pat), F.struct(F.lit(prio).alias("priority"), F.lit(etype).alias("entity_type"), F.lit(sign).alias("polarity"),
                                                F.regexp_extract_all(text, F.lit(pat), F.lit(1)).alias("values")))
             for g, etype, prio, pat, sign in rules]
    hits = F.filter(F.array(*cands), lambda h: h.isNotNull() & (F.size(h["values"]) > 0))
    fb = None
    for g, etype in fallback.items():
        c = graph == F.lit(g)
        fb = F.when(c, F.lit(etype)) if fb is None else fb.when(c, F.lit(etype))
    fb_hit = F.struct(F.lit(99).alias("priority"), (fb if fb is not None else F.lit(None).cast("string")).alias("entity_type"),
                      F.lit(0).alias("polarity"), F.array(F.lit(None).cast("string")).alias("values"))
    out = (episodes.withColumn("_low", F.lower(text)).select(id_col, "graph", *keep, hits.alias("_h"))
           .withColumn("_h", F.when(F.size("_h") > 0, F.filter("_h", lambda h: h["priority"] == F.array_min("_h")["priority"]))
                       .otherwise(F.array(fb_hit)))
           .select(id_col, "graph", *keep, F.explode_outer("_h").alias("_h")).filter(F.col("_h.entity_type").isNotNull()))
    return out.select(id_col, "graph", *keep, F.col("_h.entity_type").alias("entity_type"), F.col("_h.priority").alias("priority"),
                      F.explode_outer(F.col("_h.values")).alias("value"), F.col("_h.polarity").alias("polarity"))


# ---------------------------------------------------------------- rules as data
MAX_RULES = 200_000         # rows of a rule table that are broadcast
RULE_SCHEMA = "graph string, entity_type string, priority int, needles array<string>, pattern string, polarity int"


def trigger_rule_table(spark: SparkSession, before: bool = False) -> DataFrame:
    """The literal rules as a table. ``needles``: lower-case texts of which every match holds at
    least one (none: the rule is always tried). With ``before``: a column of how many
    characters a match has before that text at most (null: not known)."""
    rows = [(g, t, p, list(NEEDLES[pat][0]), pat, sign, NEEDLES[pat][1]) for g, t, p, pat, sign in TRIGGER_RULES + EXTRA_RULES]
    table = spark.createDataFrame(rows, RULE_SCHEMA + ", before int")
    return table if before else table.drop("before")


# Characters that a pattern with (?i) takes for others than their lower-case form.
_ODD = re.compile("[\u0130\u0131\u017f]")


def _steady(needle: str) -> bool:
    """Does (?i) find this text only where the lower-cased text holds it (but for _ODD)?"""
    return needle == needle.lower() and all((c <= "\u024f" or not c.isalpha()) and c != "\u00b5" and not _ODD.match(c) for c in needle)


class RuleSet:
    """A rule table compiled into one automaton a tier over all needles; a text is read once to
    find the rules that may match and where their needles stand. Only their patterns run, and
    those with a known ``before`` only at the places where a match can begin."""

    def __init__(self, rows: list[tuple]):
        import ahocorasick

        self.rows = [(*r, None)[:7] for r in rows]      # ``before`` may be left out
        self.always, by_needle, self.automata, self.compiled = {}, {}, {}, {}
        self.near = [before is not None and all(map(_steady, needles or ())) for _, _, _, needles, _, _, before in self.rows]
        for k, (g, _, _, needles, _, _, _) in enumerate(self.rows):
            for n in set(needles or ()):
                by_needle.setdefault(g, {}).setdefault(n, []).append(k)
            if not needles:
                self.always.setdefault(g, []).append(k)
        for g, held in by_needle.items():
            self.automata[g] = ahocorasick.Automaton()
            for n, rules in held.items():
                self.automata[g].add_word(n, (len(n), rules))
            self.automata[g].make_automaton()

    def candidates(self, graph: str, low: str) -> list[tuple]:
        """(rule, where its needles begin) in the order of priority."""
        found = {k: [] for k in self.always.get(graph, ())}
        if graph in self.automata:
            for end, (n, rules) in self.automata[graph].iter(low):
                for k in rules:
                    found.setdefault(k, []).append(end + 1 - n)
        return sorted(found.items(), key=lambda f: (self.rows[f[0]][2], f[0]))

    def _matches(self, k: int, text: str, starts: list[int] | None):
        pattern = self.compiled.get(k)
        if pattern is None:
            pattern = self.compiled[k] = re.compile(self.rows[k][4])
        if starts is None:
            yield from pattern.finditer(text)
            return
        before, done = self.rows[k][6], 0       # the matches of ``finditer``: leftmost first, none within another
        for s in sorted(starts):
            for at in range(max(done, s - before), s + 1):
                m = pattern.match(text, at)
                if m:
                    yield m
                    done = m.end()
                    break

    def extract(self, graph: str, text: str | None) -> list[tuple]:
        """(type, priority, value, polarity) of every match of the first priority that has any."""
        text = text or ""
        low, out, best = text.lower(), [], None
        placed = text.isascii() or len(low) == len(text) and not _ODD.search(text)
        for k, starts in self.candidates(graph, low):
            _, etype, prio, _, _, sign, _ = self.rows[k]
            if best is not None and prio > best:
                break
            for m in self._matches(k, text, starts if placed and self.near[k] else None):
                best = prio
                out.append((etype, prio, m[1], sign))
        return out


def rule_extract_table(episodes: DataFrame, rules: DataFrame, id_col: str = "doc_id", text_col: str = "episode_body",
                       fallback: dict | None = None) -> DataFrame:
    """OP-49 with the rules in a table (``RULE_SCHEMA``, ``before`` too if it is known: see
    ``trigger_rule_table``), thousands of them: the rows of :func:`rule_extract`. The table
    is counted, compiled once per worker and broadcast; texts stay where they are."""
    n = rules.count()
    if n > MAX_RULES:
        raise ValueError(f"{n} rules; at most {MAX_RULES} are broadcast")
    fallback = FALLBACK_TYPE if fallback is None else fallback
    held = episodes.sparkSession.sparkContext.broadcast([tuple(r) for r in rules.select(
        "graph", "entity_type", "priority", "needles", "pattern", "polarity", *(["before"] if "before" in rules.columns else [])).collect()])

    def run(batches):
        compiled = RuleSet(held.value)
        for pdf in batches:
            rows = []
            for i, g, text in zip(pdf[id_col], pdf["graph"], pdf[text_col]):
                found = compiled.extract(g, text) or ([(fallback[g], 99, None, 0)] if g in fallback else [])
                rows += [(i, g, *f) for f in found]
            if rows:
                yield pd.DataFrame(rows, columns=[id_col, "graph", "entity_type", "priority", "value", "polarity"])
    kind = episodes.schema[id_col].dataType.simpleString()
    return episodes.select(id_col, "graph", text_col).mapInPandas(
        run, f"{id_col} {kind}, graph string, entity_type string, priority int, value string, polarity int")


# ---------------------------------------------------------------- hooks
EXTRACT_SCHEMA = "doc_id long, graph string, entity_type string, value string"
EXTRACT_BYTES = 8 << 20     # text that an extractor is given at once, but for a longer text alone


def _folded(text) -> str:
    """Lower case, and what (?i) takes for i and s besides."""
    return "" if not isinstance(text, str) else text.lower() if text.isascii() else text.translate({0x130: "i", 0x131: "i", 0x17f: "s"}).lower()


def regex_extractor(rules: list | None = None) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A model-free default extractor for the hook: vectorised pandas regex per batch, over
    the texts that hold a rule's needles."""
    rules = rules if rules is not None else TRIGGER_RULES + EXTRA_RULES

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        out, low = [], pdf["episode_body"].map(_folded)
        for graph, etype, _prio, pat, _sign in rules:
            mine = pdf["graph"] == graph
            if pat in NEEDLES:
                mine = mine & np.array([any(n in t for n in NEEDLES[pat][0]) for t in low], bool)
            sub = pdf[mine]
            if sub.empty:
                continue
            m = sub["episode_body"].str.extractall(pat)  # inline (?i) works in Python re
            if m.empty:
                continue
            m = m.reset_index(level=1, drop=True).join(sub[["doc_id", "graph"]])
            out.append(pd.DataFrame({"doc_id": m["doc_id"], "graph": m["graph"],
                                     "entity_type": etype, "value": m[0]}))
        if not out:
            return pd.DataFrame({"doc_id": pd.Series(dtype="int64"), "graph": pd.Series(dtype="str"),
                                 "entity_type": pd.Series(dtype="str"), "value": pd.Series(dtype="str")})
        return pd.concat(out, ignore_index=True)
    return fn


def _slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs of rows that hold about ``most`` bytes, a longer row alone."""
    total, a = np.cumsum(lengths), 0
    while a < len(lengths):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + most, side="right")))
        yield a, b - a
        a = b


def extractor_hook(episodes: DataFrame, extractor: Callable | None = None,
                   schema: str = EXTRACT_SCHEMA) -> DataFrame:
    """OP-50: run a user extractor over Arrow batches (``mapInArrow``). The callable is
    built once per Python worker (factory pattern), never per row; it takes and returns a
    pandas frame. A frame holds about ``EXTRACT_BYTES`` of text, whatever the batch holds,
    so a worker never has more texts than that as Python strings."""
    factory = extractor or regex_extractor
    given = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        fn = factory()
        for batch in batches:
            bytes_ = pc.fill_null(pc.binary_length(batch.column("episode_body")), 0).to_numpy(zero_copy_only=False)
            for a, n in _slices(bytes_, EXTRACT_BYTES):
                res = fn(batch.slice(a, n).to_pandas(date_as_object=True))
                if len(res):
                    yield pa.RecordBatch.from_pandas(res, schema=given, preserve_index=False)
    return episodes.select("doc_id", "graph", "episode_body").mapInArrow(run, schema)


GRAPH_SCHEMA = ("entities array<struct<name:string,entity_type:string>>, "
                "facts array<struct<source:string,source_type:string,relation:string,target:string,target_type:string,fact:string>>")


def statement_extractor(rules: list | None = None, speaker_type: dict | None = None) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A model-free default for ``extract_graph``: who speaks is an entity, what the tier's
    rules capture is one, and each capture is a fact about the speaker, whose relation is
    the capture's type ("not" before it where the phrase turns something down)."""
    rules = rules if rules is not None else TRIGGER_RULES
    by_tier: dict[str, list] = {}
    for graph, etype, prio, pat, sign in sorted(rules, key=lambda r: r[2]):
        by_tier.setdefault(graph, []).append((prio, etype, re.compile(pat), sign))
    kinds = speaker_type or {"personal": "Person", "client": "Stakeholder"}

    def one(graph, speaker, body):
        if speaker is None:
            return [], []
        kind = kinds.get(graph, "Person")
        entities, facts, best = [{"name": speaker, "entity_type": kind}], [], None
        for prio, etype, pat, sign in by_tier.get(graph, ()):
            if best is not None and prio > best:
                break
            for m in pat.finditer(body or ""):
                best, value = prio, m[1].strip()
                if value:
                    entities.append({"name": value, "entity_type": etype})
                    relation = etype.lower() if sign > 0 else "not " + etype.lower()
                    facts.append({"source": speaker, "source_type": kind, "relation": relation, "target": value, "target_type": etype,
                                  "fact": f"{speaker} {relation} {value}"})
        return entities, facts

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [one(*row) for row in zip(pdf["graph"], pdf["speaker"], pdf["episode_body"])]
        return pdf.drop(columns=["speaker", "episode_body"]).assign(entities=[e for e, _ in found], facts=[f for _, f in found])
    return fn


def extract_graph(episodes: DataFrame, extractor: Callable | None = None, keep: tuple = ("doc_id", "graph", "valid_at")) -> DataFrame:
    """OP-50: a user extractor over Arrow batches returns ``(entities[], facts[])`` for every
    episode. ``extractor()`` is called once per Python worker and must return a function that
    takes a frame with ``keep``, ``speaker`` and ``episode_body`` and gives back ``keep`` plus the
    two nested columns; an episode without findings has empty lists."""
    factory = extractor or statement_extractor
    src = episodes.select(*keep, "speaker", "episode_body")
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in src.schema if f.name in keep), GRAPH_SCHEMA])

    def run(batches):
        fn = factory()
        for pdf in batches:
            yield fn(pdf)
    return src.mapInPandas(run, schema)


EMBED_CHARS = 4_000_000     # text that is embedded together


@lru_cache(200_000)
def term_slot(term: str, dim: int) -> tuple[int, float]:
    """Dimension and sign of a term: the first two hex digits of its md5 choose the
    dimension, the third the sign (any engine with md5 can repeat it)."""
    h = hashlib.md5(term.encode()).hexdigest()
    return int(h[:2], 16) % dim, 1.0 if h[2] < "8" else -1.0


def hashing_embedder(dim: int = 64) -> Callable[[pd.Series], pd.Series]:
    """A model-free default text->vector: signed hashed term counts (whole numbers, so
    dot products are exact in any order; searches normalise)."""
    import regex

    words = regex.compile(r"[\p{L}\p{N}]+").findall

    def embed(texts: pd.Series) -> pd.Series:
        texts = [t or "" for t in texts]
        out, a = np.zeros((len(texts), dim), np.float32), 0
        while a < len(texts):       # rows of about EMBED_CHARS at a time
            b, chars = a, 0
            while b < len(texts) and (b == a or chars + len(texts[b]) <= EMBED_CHARS):
                chars += len(texts[b])
                b += 1
            found = [words(t.lower()) for t in texts[a:b]]
            kinds = {w: i for i, w in enumerate(set().union(*found))}
            code = np.fromiter((kinds[w] for f in found for w in f), np.int64)
            if len(code):
                at, sign = (np.array(x) for x in zip(*(term_slot(w, dim) for w in kinds)))
                row = np.repeat(np.arange(b - a), [len(f) for f in found])
                out[a:b] = np.bincount(row * dim + at[code], sign[code], minlength=(b - a) * dim).reshape(-1, dim)
            a = b
        return pd.Series(list(out))
    return embed


def embedder_hook(df: DataFrame, text_col: str, factory: Callable | None = None, dim: int = 64):
    """OP-51: pluggable text -> vector as an iterator ``pandas_udf``; the model
    (``factory()``) is created once per worker iterator, not per batch."""
    factory = factory or (lambda: hashing_embedder(dim))

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = factory()
        for s in batches:
            yield fn(s)
    return df.withColumn("embedding", embed(F.col(text_col)))


def overall_citation_rate(per_conversation: DataFrame) -> DataFrame:
    """OP-44c over all conversations: one row, from the per-conversation counts."""
    return per_conversation.agg(F.count(F.lit(1)).alias("conversations"), F.sum("assistant_turns").alias("assistant_turns"),
                                F.sum("citing_turns").alias("citing_turns"),
                                (F.sum("citing_turns") / F.sum("assistant_turns")).alias("rate"))


def citation_rate(turns: DataFrame, marker: str, conv_col: str = "conv_id") -> DataFrame:
    """OP-44c: share of assistant turns that cite memory (contain the marker)."""
    a = turns.filter(F.col("role") == "assistant").withColumn(
        "_cites", F.coalesce(F.lower(F.col("text")).contains(marker.lower()), F.lit(False)))
    return a.groupBy(conv_col).agg(
        F.count(F.lit(1)).alias("assistant_turns"),
        F.count_if("_cites").alias("citing_turns")).withColumn(
        "rate", F.col("citing_turns") / F.col("assistant_turns"))
