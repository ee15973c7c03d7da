"""Rules over many and long texts: what is tried where, and what a worker holds (OP-49, OP-50)."""

import random
import re

import pandas as pd

from engram.operators import ontology as O


def test_every_rule_is_evaluated_once_and_only_where_its_needles_are(spark):
    df = spark.createDataFrame([(1, "personal", "I WANT tea"), (2, "personal", None), (3, "client", "plain words")],
                               "doc_id long, graph string, episode_body string")
    found = O.rule_extract(df)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == len(O.TRIGGER_RULES + O.EXTRA_RULES)     # filters repeated them
    assert "Contains(_low" in plan
    assert sorted((r.doc_id, r.entity_type, r.value) for r in found.collect()) == [(1, "Preference", "tea"), (2, "Topic", None)]


def test_every_match_of_a_literal_rule_holds_a_needle(spark):
    texts = ["I like a. i PREFER b", "don't. I DON’T want c", "Skip d", "A is better than B", "x\nWe decided to go. ruled out e", "avoid f",
             "login is required", "It NEEDS TO g", "agreed to h. they want i", "RELEASED UNDER MIT, x", "a@b.org @c.de", "ſkip j", "İ like k", "", None]
    pdf = pd.DataFrame([(i, g, t) for i, (g, t) in enumerate((g, t) for g in ("personal", "client") for t in texts)], columns=["doc_id", "graph", "episode_body"])
    got = sorted(map(tuple, O.regex_extractor()(pdf).itertuples(index=False)))
    want = sorted((i, g, t, m) for i, g, b in pdf.itertuples(index=False) for g2, t, _, p, _ in O.TRIGGER_RULES + O.EXTRA_RULES
                  if g == g2 for m in re.findall(p, b or ""))
    assert got == want and len(got) > 15


class Once:
    """A pattern that may only be tried at a place."""

    def __init__(self, pattern):
        self.match = re.compile(pattern).match

    def finditer(self, text):
        raise AssertionError("the whole text was searched")


def test_patterns_run_only_where_their_needles_stand(spark):
    words = ["river", "stone", "rivers", "stoneé", "ri"]
    rows = [("g", "T", 5, [w], f"(?i)(?:^|[^A-Za-z0-9_À-ɏ])({w})", 1) for w in words]
    r = random.Random(5)
    plain, placed = O.RuleSet(rows), O.RuleSet([(*x, 1) for x in rows])
    table = [tuple(x) for x in O.trigger_rule_table(spark, before=True).collect()]
    literal, near = O.RuleSet([x[:6] for x in table]), O.RuleSet(table)
    phrases = ["I want ", "i don't want", "skip ", "x is better than y", ".", "\n", "avoid ", "ruled out ", "@a.bc", "they want", " "]
    for _ in range(400):
        text = "".join(r.choice([*words, " ", ".", "RIVER", "İ", "ſtone", "É", "_"]) for _ in range(r.randrange(12)))
        assert placed.extract("g", text) == plain.extract("g", text), text
        text = "".join(r.choice([*phrases, "tea", "ı want x"]) for _ in range(r.randrange(9)))
        for g in ("personal", "client"):
            assert near.extract(g, text) == literal.extract(g, text), text
    placed.compiled = {k: Once(x[4]) for k, x in enumerate(rows)}
    assert [v for _, _, v, _ in placed.extract("g", "River, a stone" + " and more" * 1000)] == ["River", "stone", "Ri"]


def test_an_extractor_gets_a_bounded_frame(spark):
    def frame_sizes():
        def fn(pdf):
            return pd.DataFrame({"doc_id": pdf["doc_id"], "graph": "g", "entity_type": "frame", "value": str(pdf["episode_body"].fillna("").str.len().sum())})
        return fn
    one = "x" * 1_000_000
    df = spark.range(40).selectExpr("id as doc_id", "'g' as graph", f"case when id % 7 = 3 then null else repeat('x', {len(one)}) end as episode_body").coalesce(1)
    rows = O.extractor_hook(df, frame_sizes).collect()
    assert sorted(r.doc_id for r in rows) == list(range(40))
    assert max(int(r.value) for r in rows) <= O.EXTRACT_BYTES      # the whole batch came at once
    long = df.selectExpr("doc_id", "graph", f"repeat('y', {O.EXTRACT_BYTES + 5}) as episode_body").limit(2)
    assert [int(r.value) for r in O.extractor_hook(long, frame_sizes).collect()] == [O.EXTRACT_BYTES + 5] * 2
