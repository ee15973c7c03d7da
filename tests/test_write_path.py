"""Guard, group, attribution, hygiene, structure (OP-12, 13, 14, 22, 23)."""

from engram.operators import admission as A

COLS = "graph string, name string, source_description string, episode_body string, group_id string, agent_id string"


def test_guard_fields_and_agent(spark):
    rows = [("personal", "CONFIDENTIAL plan", "d", "b", None, None),
            ("personal", "n", "nda stuff", "b", None, None),
            ("personal", "n", "d", "this is Confidential", None, None),
            ("personal", "n", "d", "b", None, "confidential-agent"),
            ("client", "confidential", "d", "b", None, None),
            ("personal", None, None, None, None, None)]
    df = spark.createDataFrame(rows, COLS)
    g = A.tier_guard(df, {"personal": r"(?i)(confidential|nda)", "client": ""})
    assert [r["accepted"] for r in g.collect()] == [False, False, False, True, True, True]


def test_no_pattern_no_guard(spark):
    df = spark.createDataFrame([("personal", "x", "y", "z", None, None)], COLS)
    assert A.tier_guard(df, {"personal": None}).first()["accepted"] is True


def test_effective_group(spark):
    df = spark.createDataFrame([("personal", "n", "d", "b", g, None) for g in (None, "", "proj")], COLS)
    got = [r["effective_group_id"] for r in A.effective_group(df, {"personal": "home"}).collect()]
    assert got == ["home", "home", "proj"]


def test_attribution(spark):
    rows = [("personal", "n", "desc", "b", None, None), ("personal", "n", "desc", "b", None, ""),
            ("personal", "n", "", "b", None, "x"), ("personal", "n", "desc ", "b", None, "pi"),
            ("personal", "n", None, "b", None, "a")]
    got = [r["effective_source_description"] for r in A.attribute_agent(spark.createDataFrame(rows, COLS)).collect()]
    assert got == ["desc", "desc", "[agent:x]", "[agent:pi] desc", "[agent:a]"]


def test_hygiene_first_rule_wins(spark):
    df = spark.createDataFrame([("token = \"abcdef123456\" mail a@b.com",), ("plain text",), ("x@y.org",)],
                               "episode_body string")
    got = [(r["hygiene_label"], r["verdict"]) for r in A.write_hygiene(df).collect()]
    assert got == [("credential", "reject"), (None, "store"), ("email", "reject")]


def test_structured_episode(spark):
    df = spark.createDataFrame([('{"who": "me", "what": "x", "when": "2024-01-01 00:00:00", "source": "s"}',),
                                ("prose",), ("[1, 2]",), ("{bad",)], "episode_body string")
    got = [(r["is_structured"], r["who"]) for r in A.structured_episode(df).collect()]
    assert got == [(True, "me"), (False, None), (False, None), (False, None)]


def test_novelty_keeps_first_and_skips_store(spark):
    batch = spark.createDataFrame([("g", 2, "Hello  World"), ("g", 1, "hello world"), ("g", 3, "new")],
                                  "graph string, doc_id long, episode_body string")
    store = spark.createDataFrame([("g", "NEW")], "graph string, episode_body string")
    got = sorted(r["doc_id"] for r in A.novel_memories(batch, store, ["graph"], ["doc_id"]).collect())
    assert got == [1]


def test_guard_folds_case_beyond_ascii(spark):
    df = spark.createDataFrame([(1, "personal", "SEÑAL"), (2, "personal", "nada")], "doc_id long, graph string, episode_body string")
    df = df.selectExpr("*", "'' as name", "'' as source_description")
    out = {r["doc_id"]: r["accepted"] for r in A.tier_guard(df, {"personal": r"(?i)señal"}).collect()}
    assert out == {1: False, 2: True}
