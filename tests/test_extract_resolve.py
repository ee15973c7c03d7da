"""Trigger rules by hand, nested extraction, entity resolution, entity search (OP-29, 49, 50)."""

import random

from pyspark.sql import functions as F

from engram.operators import nodes as ND
from engram.operators import ontology as O
from engram.operators import resolve as RS

# Written by hand from the phrases in the type descriptions.
SPOKEN = [
    ("personal", "I want tea. I prefer rebase", [("Preference", "tea", 1), ("Preference", "rebase", 1)]),
    ("personal", "Honestly i like green", [("Preference", "green", 1)]),
    ("personal", "Hawaii like weather", [("Topic", None, 0)]),
    ("personal", "I don't want meetings", [("Preference", "meetings", -1)]),
    ("personal", "I don’t want calls", [("Preference", "calls", -1)]),
    ("personal", "I avoid sugar\nskip lunch", [("Preference", "lunch", -1), ("Preference", "sugar", -1)]),
    ("personal", "Postgres is better than Oracle", [("Preference", "Postgres", 1)]),
    ("personal", "Tested both. Rust is better than Go.", [("Preference", "Rust", 1)]),
    ("personal", "go with plan B", [("Preference", "plan B", 1)]),
    ("personal", "we decided to move", [("Decision", "move", 1)]),
    ("personal", "ruled out Paris", [("Decision", "Paris", -1)]),
    ("personal", "I use Vim and ruled out Emacs", [("Preference", "Vim and ruled out Emacs", 1)]),
    ("personal", "", [("Topic", None, 0)]),
    ("client", "They want SSO. The client prefers SAML", [("Preference", "SAML", 1), ("Preference", "SSO", 1)]),
    ("client", "Please avoid PHP", [("Preference", "PHP", -1)]),
    ("client", "Login is required.", [("Requirement", "Login", 1)]),
    ("client", "Two-factor login is required for admins", [("Requirement", "Two-factor login", 1)]),
    ("client", "the portal must have logs", [("Requirement", "logs", 1)]),
    ("client", "It needs to scale", [("Requirement", "scale", 1)]),
    ("client", "we decided on Spark", [("Decision", "on Spark", 1)]),
    ("client", "agreed to Fridays", [("Decision", "Fridays", 1)]),
    ("client", "nothing of note", []),
    ("client", "unavoidable costs", []),
]


def test_trigger_phrases_by_hand(spark):
    df = spark.createDataFrame([(i, g, t) for i, (g, t, _) in enumerate(SPOKEN)], "doc_id long, graph string, episode_body string")
    got = {}
    for r in O.rule_extract(df, rules=O.TRIGGER_RULES).collect():
        got.setdefault(r.doc_id, []).append((r.entity_type, r.value, r.polarity))
    for i, (_, text, want) in enumerate(SPOKEN):
        assert sorted(got.get(i, []), key=str) == sorted(want, key=str), text
    hooked = {}
    src = df.select("doc_id", "graph", F.lit("user 1").alias("speaker"), "episode_body")
    for r in O.extract_graph(src, keep=("doc_id", "graph")).collect():
        hooked[r.doc_id] = [(f.target_type, f.target, -1 if f.relation.startswith("not ") else 1) for f in r.facts]
        assert r.entities[0].name == "user 1" and len(r.entities) == 1 + len(r.facts)
    for i, (_, text, want) in enumerate(SPOKEN):
        assert sorted(hooked[i], key=str) == sorted([w for w in want if w[1]], key=str), text


def test_rules_from_a_table_give_the_rows_of_the_literal_form(spark):
    df = spark.createDataFrame([(i, g, t) for i, (g, t, _) in enumerate(SPOKEN)] + [(900, "personal", None), (901, "other", "I want x"),
                               (902, "client", "mail a@b.org, licensed under the MIT"), (903, "personal", "RELEASED UNDER GPL")],
                               "doc_id long, graph string, episode_body string")
    table = O.trigger_rule_table(spark)
    key = lambda r: tuple(map(str, r))
    want = sorted(map(key, O.rule_extract(df).collect()))
    assert sorted(map(key, O.rule_extract_table(df, table).collect())) == want
    many = spark.createDataFrame([("other", "Topic", 5, [f"word{i}"], f"(word{i})(?![0-9])", 1) for i in range(5000)]
                                 + [("other", "Topic", 7, None, "(x)", 1)], O.RULE_SCHEMA)
    rules = O.RuleSet([tuple(r) for r in many.collect()])
    assert rules.extract("other", "a word17 and WORD18 word4999") == [("Topic", 5, "word17", 1), ("Topic", 5, "word4999", 1)]
    assert rules.extract("other", "x") == [("Topic", 7, "x", 1)] and len(rules.compiled) < 12   # few patterns ever run
    assert sorted(map(key, O.rule_extract_table(df, table.unionByName(many)).filter("graph <> 'other'").collect())) == [w for w in want if w[1] != "other"]


def test_extractor_of_ones_own(spark):
    made = []

    def factory():
        made.append(1)

        def fn(pdf):
            return pdf.drop(columns=["speaker", "episode_body"]).assign(
                entities=[[{"name": w, "entity_type": "Word"} for w in (t or "").split()] for t in pdf["episode_body"]], facts=[[] for _ in range(len(pdf))])
        return fn
    df = spark.createDataFrame([(1, "g", "a", "x y"), (2, "g", None, None)], "doc_id long, graph string, speaker string, episode_body string")
    got = {r.doc_id: [e.name for e in r.entities] for r in O.extract_graph(df, factory, keep=("doc_id", "graph")).collect()}
    assert got == {1: ["x", "y"], 2: []}
    assert O.extract_graph(df, keep=("doc_id", "graph")).filter("size(entities) = 0").count() == 1


def alike(a, b):
    la, lb = ("".join(c for c in x if c.isalpha()) for x in (a, b))
    if [c for c in a if c.isdigit()] != [c for c in b if c.isdigit()]:
        return False
    if min(len(la), len(lb)) < RS.SHORT:
        return la == lb
    if len(la) > len(lb):
        la, lb = lb, la
    if len(la) == len(lb):
        return sum(x != y for x, y in zip(la, lb)) <= 1
    return len(lb) == len(la) + 1 and any(lb[:i] + lb[i + 1:] == la for i in range(len(lb)))


def test_resolution_against_all_pairs(spark):
    r = random.Random(4)
    stems = ["product", "subscription", "feature", "abcd", "abce", "retry policy"]
    said = []
    for _ in range(400):
        s = list(r.choice(stems))
        for _ in range(r.choice([0, 0, 1, 1, 2])):
            at = r.randrange(len(s))
            s[at:at + r.choice([0, 1])] = r.choice(["", "x", "é"])
        text = "".join(s) + r.choice([" ", "-", "  "]) + str(r.randrange(3))
        said.append((r.choice("gh"), r.choice("TU"), r.choice([text, text.upper(), f" {text} "])))
    said += [("g", "T", "…"), ("g", "T", None), ("g", "T", "7"), ("g", "T", "a b"), ("g", "T", "ab")]
    out = RS.resolve_names(spark.createDataFrame(said, "graph string, entity_type string, name string")).collect()
    ids = {(x.graph, x.entity_type, x.name): x.uuid for x in out}
    names = sorted(ids)
    parent = {n: n for n in names}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            if a[:2] == b[:2] and alike(a[2], b[2]):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    groups = {}
    for n in names:
        groups.setdefault(find(n), set()).add(ids[n])
    assert all(len(u) == 1 for u in groups.values()) and len({*ids.values()}) == len(groups) > 20
    assert ("g", "T", "7") in ids and ids["g", "T", "a b"] == ids["g", "T", "ab"]
    assert not any(n[2] == "" for n in names)


def test_long_chains_and_empty_input(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in RS.components(chain).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    none = spark.createDataFrame([], "graph string, doc_id long, valid_at timestamp_ntz, entities array<struct<name:string,entity_type:string>>, "
                                 "facts array<struct<source:string,source_type:string,relation:string,target:string,target_type:string,fact:string>>")
    assert [df.count() for df in RS.graph_tables(none)] == [0, 0, 0]


def test_names_by_letters_and_types(spark):
    names = spark.createDataFrame([("g", 1, "T", "widget"), ("g", 2, "U", "widgets"), ("g", 3, "T", "gadget"), ("h", 4, "T", "widget"), ("g", 5, "T", None)],
                                  "graph string, doc_id long, entity_type string, name string")
    q = spark.createDataFrame([(1, "g", "wigdet"), (2, "g", None), (3, "z", "widget")], "query_id long, graph string, text string")
    lists = ND.gram_postings(names)
    got = {r.doc_id: r.score for r in ND.gram_leg(lists, q, 5).collect()}

    def dice(a, b):
        a, b = ({f"  {x} "[i:i + 3] for i in range(len(x) + 1)} for x in (a, b))
        return round(2 * len(a & b) / (len(a) + len(b)), 9)
    assert got == {1: dice("wigdet", "widget"), 2: dice("wigdet", "widgets"), 3: dice("wigdet", "gadget")}
    assert {r.doc_id for r in ND.gram_leg(ND.of_types(lists, ["T"]), q, 5).collect()} == {1, 3}
    facts = spark.createDataFrame([("g", 1, "T", [1.0, 2.0]), ("g", 1, "T", [0.5, -1.0]), ("g", 3, "T", [1.0, 0.0])],
                                  "graph string, doc_id long, entity_type string, embedding array<float>")
    assert {r.doc_id: r.embedding for r in ND.entity_vectors(facts).collect()} == {1: [1.5, 1.0], 3: [1.0, 0.0]}


def test_names_by_row_give_the_rows_of_the_posting_lists(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choices("abcé", k=r.randrange(1, 7)))
    names = spark.createDataFrame([(r.choice("gh"), r.choice([i, i, 9, None]), "T", r.choice([word(), None])) for i in range(200)],
                                  "graph string, doc_id long, entity_type string, name string")
    asked = [(i, r.choice("ghx"), r.choice([word(), word() + " " + word(), None])) for i in range(30)]
    q = spark.createDataFrame(asked + asked[:3], "query_id long, graph string, text string")
    key = lambda df: sorted((x.query_id, x.rank, x.score, str(x.doc_id)) for x in df.collect())
    rows = ND.gram_rows(names)
    for depth in (3, 500):
        got = ND.gram_leg(rows, q, depth)       # rows of (query, name) pairs were added up before
        assert key(got) == key(ND.gram_leg(ND.gram_postings(names), q, depth))
    assert "HashAggregate" not in ND.gram_leg(rows.localCheckpoint().filter("doc_id is not null"), q, 3)._jdf.queryExecution().executedPlan().toString()
