"""Typed edges, expansion over mentions and facts, the graph leg (OP-30, OP-33)."""

import random

import pytest
from pyspark.sql import functions as F

from engram.operators import traverse as TR

MEN = "graph string, episode_uuid long, entity_uuid long"
REL = "graph string, source_uuid long, target_uuid long"
NODE = "graph string, kind string, node long"


def brute(seeds, mentions, facts, hops):
    near = {}
    for g, e, n in mentions:
        near.setdefault((g, "episode", e), set()).add((g, "entity", n))
        near.setdefault((g, "entity", n), set()).add((g, "episode", e))
    for g, a, b in facts:
        if None not in (a, b):
            near.setdefault((g, "entity", a), set()).add((g, "entity", b))
            near.setdefault((g, "entity", b), set()).add((g, "entity", a))
    seen = {s: 0 for s in seeds}
    for h in range(1, hops + 1):
        for x in [x for x in seen if seen[x] == h - 1]:
            for y in near.get(x, ()):
                seen.setdefault(y, h)
    return seen


@pytest.mark.parametrize("hub_degree", [1_000_000, 7])
def test_expansion_over_both_kinds_of_edges(spark, hub_degree):
    r = random.Random(hub_degree)
    men = [(r.choice("ab"), r.randrange(40), r.choice([3, r.randrange(60)])) for _ in range(150)]
    rel = [(r.choice("ab"), r.randrange(60), r.choice([3, 50 + r.randrange(40)])) for _ in range(60)] + [("a", None, 3), ("a", 3, None)]
    seeds = [("a", "entity", 1), ("b", "entity", 55), ("b", "episode", 2), ("c", "entity", 3)]
    m, f, s = spark.createDataFrame(men, MEN), spark.createDataFrame(rel, REL), spark.createDataFrame(seeds + seeds[:1], NODE)
    store = TR.store_edges(TR.typed_edges(m, f), hub_degree=hub_degree, buckets=5)
    assert (store.n_hubs > 0) == (hub_degree == 7)
    for hops in (0, 1, 3):
        out = TR.graph_expand(s, store, hops).collect()
        assert {(x.graph, x.kind, x.node): x.hop for x in out} == brute(seeds, men, rel, hops) and len(out) == len({*map(tuple, out)})
    only = TR.graph_expand(s, store, 3, labels=["MENTIONS"]).collect()
    assert {(x.graph, x.kind, x.node): x.hop for x in only} == brute(seeds, men, [], 3)
    plan = TR.step(s, store)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan     # the edges are not exchanged again
    TR.drop_edges(spark, store)
    assert TR.graph_expand(spark.createDataFrame([], NODE), TR.store_edges(TR.typed_edges(m.limit(0), f.limit(0))), 2).count() == 0


FACT = "graph string, doc_id long, source string, target string, episode long"


def brute_leg(seeds, facts, depth):
    hang, links = {}, {}
    for g, i, s, t, e in facts:
        nodes = [x for x in ({f"entity:{s}"} if s else set()) | ({f"entity:{t}"} if t else set()) | {f"episode:{e}"}]
        for a in nodes:
            hang.setdefault((g, a), set()).add(i)
            links.setdefault((g, a), set()).update(b for b in nodes if b != a)
    of, out = {f[1]: f for f in facts}, []
    for q in {s[0] for s in seeds}:
        best = {}
        for _, i, rank in [s for s in seeds if s[0] == q]:
            g, _, s, t, _ = of[i]
            for node in [f"entity:{x}" for x in (s, t) if x]:
                for hop, there in [(0, node), *((1, o) for o in links[g, node])]:
                    for f in hang[g, there]:
                        best[f] = max(best.get(f, 0), round(1 / (rank + hop), 9))
        order = sorted(best, key=lambda f: (-best[f], f))[:depth]
        out += [(q, f, best[f], k + 1) for k, f in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("depth", [4, 50])
def test_graph_leg_against_every_path(spark, depth):
    """A hub source holds half of all facts; lists of ``depth`` ids a node lose nothing."""
    r = random.Random(depth)
    facts = [(r.choice("ab"), i, r.choice(["hub", f"s{r.randrange(12)}", f"s{r.randrange(12)}"]), r.choice([f"t{r.randrange(30)}", None, "hub"]), i // 7)
             for i in range(300)]
    facts += [("b", 300, None, "t1", 99), ("b", 301, None, None, 99)]
    seeds = [(q, r.randrange(302), k) for q in range(15) for k in (1, 2, 3)]
    f = spark.createDataFrame(facts, FACT)
    s = spark.createDataFrame(seeds, "query_id long, doc_id long, rank int")
    for bound in (45, 10 ** 9):
        out = TR.entity_leg(s, f, TR.fact_links(f), TR.fact_reach(f, depth), depth, bound).collect()
        assert sorted((x.query_id, x.doc_id, x.score, x["rank"]) for x in out) == brute_leg(seeds, facts, depth)
    assert TR.entity_leg(s.limit(0), f, TR.fact_links(f), TR.fact_reach(f, depth), depth, 0).filter(F.lit(True)).count() == 0


def test_a_small_frontier_goes_to_the_edges(spark):
    r = random.Random(2)
    men = [("a", r.randrange(40), r.randrange(60)) for _ in range(200)]
    m, f = spark.createDataFrame(men, MEN), spark.createDataFrame([("a", 1, 2)], REL)
    store = TR.store_edges(TR.typed_edges(m, f), hub_degree=7, buckets=5)
    s = spark.createDataFrame([("a", "entity", 1), ("a", "entity", 5)], NODE)
    sent = TR.step(s, store, small=True)
    assert "BroadcastHashJoin" in sent._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, sent.collect())) == sorted(map(tuple, TR.step(s, store).collect()))
    TR.drop_edges(spark, store)
