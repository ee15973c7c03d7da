"""Supersession, as-of, age filter, cascade delete (OP-W3, 24, 25, 27, 37, S1)."""

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from engram.operators import graph as G
from engram.operators import temporal as T

OBS = "graph string, subject long, relation string, uuid long, value string, valid_at timestamp_ntz"


def ts(d, h=0):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=d, hours=h)


def spec(rows):
    """Plain loop: collapse repeats, close each run at the next run's start."""
    out = []
    by = {}
    for r in rows:
        by.setdefault((r[0], r[1], r[2]), []).append(r)
    for key, rs in by.items():
        rs.sort(key=lambda r: (r[5], r[3]))
        starts, prev = [], object()
        for r in rs:
            if r[4] != prev:
                starts.append(r)
            prev = r[4]
        for i, r in enumerate(starts):
            nxt = starts[i + 1][5] if i + 1 < len(starts) else None
            out.append((r[3], r[4], r[5], nxt))
    return sorted(out)


def test_supersession_edge_cases(spark):
    rows = [("g", 1, "p", 1, "A", ts(0)), ("g", 1, "p", 2, "B", ts(40)), ("g", 1, "p", 3, "A", ts(80)),
            ("g", 2, "p", 4, "X", ts(0)), ("g", 2, "p", 5, "X", ts(1)), ("g", 2, "p", 6, "X", ts(90)),
            ("g", 3, "p", 7, "A", ts(5)), ("g", 3, "p", 8, "B", ts(5))]  # same-instant change
    got = sorted(tuple(r) for r in T.resolve_supersession(spark.createDataFrame(rows, OBS))
                 .select("uuid", "value", "valid_at", "invalid_at").collect())
    assert got == spec(rows)
    # zero-length validity is listed as superseded but is never valid as of any instant
    f = T.resolve_supersession(spark.createDataFrame(rows, OBS))
    assert T.facts_as_of(f, ts(5)).filter("uuid = 7").count() == 0
    assert T.superseded_facts(f).filter("uuid = 7").count() == 1


def test_supersession_random_many_buckets(spark):
    rnd = random.Random(7)
    rows = [("g", rnd.randint(1, 3), "p", i, rnd.choice("AB"), ts(rnd.randint(0, 400), rnd.randint(0, 23)))
            for i in range(600)]
    for bucket, hot_rows in (("day", 10**9), ("month", 10**9), ("year", 10**9), ("year", 150)):
        # hot_rows=150: the busiest subjects switch to hourly buckets, the rest stay yearly
        got = sorted(tuple(r) for r in T.resolve_supersession(
            spark.createDataFrame(rows, OBS), bucket=bucket, hot_rows=hot_rows)
            .select("uuid", "value", "valid_at", "invalid_at").collect())
        assert got == spec(rows), (bucket, hot_rows)


def test_contradictions_order_and_limit(spark):
    rows = [("g", 1, "p", i, "AB"[i % 2], ts(i)) for i in range(10)]
    f = T.resolve_supersession(spark.createDataFrame(rows, OBS)).withColumn("fact", F.col("value"))
    c = T.contradictions(f, "g", 3).collect()
    assert [r["uuid"] for r in c] == [8, 7, 6]


def test_age_filter_cutoff(spark):
    eps = spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2020, 1, 11)), (3, None)],
                                "uuid long, created_at timestamp_ntz")
    got = [r["uuid"] for r in T.age_filter(eps, "2020-01-21 00:00:00.9", 10).collect()]
    assert got == [1]  # created exactly at the cutoff stays; null never matches
    import pytest
    with pytest.raises(ValueError):
        T.age_filter(eps, "2020-01-21", -1)


def test_cascade_edge_cases(spark):
    mentions = spark.createDataFrame(
        [("g", 1, 100), ("g", 2, 100),      # entity 100: both mentions deleted -> goes
         ("g", 1, 200), ("g", 3, 200),      # entity 200: one kept -> stays
         ("g", 4, 300)],                    # entity 300: not touched
        "graph string, episode_uuid long, entity_uuid long")
    facts = spark.createDataFrame(
        [("g", 10, [3, 1]), ("g", 11, [1, 3]), ("g", 12, [])],
        "graph string, uuid long, episodes array<long>")
    deleted = spark.createDataFrame([("g", 1), ("g", 2)], "graph string, episode_uuid long")
    ents, fs = G.remove_episode_cascade(deleted, mentions, facts)
    assert sorted(r["uuid"] for r in ents.collect()) == [100]
    assert sorted(r["uuid"] for r in fs.collect()) == [11]
    # set form equals one-at-a-time deletes in any order
    seq_m = mentions
    gone = set()
    for e in (2, 1):
        d1 = spark.createDataFrame([("g", e)], "graph string, episode_uuid long")
        en, _ = G.remove_episode_cascade(d1, seq_m, facts)
        gone |= {r["uuid"] for r in en.collect()}
        seq_m = seq_m.join(d1, ["graph", "episode_uuid"], "left_anti")
    assert gone == {100}


def test_compaction_keeps_facts_and_is_idempotent(spark):
    eps = spark.createDataFrame([("g", 1, dt.datetime(2000, 1, 1)), ("g", 2, dt.datetime(2021, 5, 1))],
                                "graph string, uuid long, created_at timestamp_ntz")
    men = spark.createDataFrame([("g", 1, 9), ("g", 2, 9)], "graph string, episode_uuid long, entity_uuid long")
    facts = spark.createDataFrame([("g", 5, [1])], "graph string, uuid long, episodes array<long>")
    kept, km, rep = G.compact_episodes(eps, men, facts, "2021-06-01 00:00:00", 90)
    assert rep.first()["facts_before"] == 1
    assert [r["uuid"] for r in kept.collect()] == [2] and km.count() == 1
    kept2, km2, _ = G.compact_episodes(kept, km, facts, "2021-06-01 00:00:00", 90)
    assert kept2.count() == 1 and km2.count() == 1
    assert G.dangling_provenance(facts, kept).first()["n_dangling"] == 1


def test_growth_fills_silent_periods(spark):
    eps = spark.createDataFrame([("g", dt.datetime(2020, 1, 5)), ("g", dt.datetime(2020, 3, 5))],
                                "graph string, created_at timestamp_ntz")
    rows = G.graph_growth(eps, "month").orderBy("period").collect()
    assert [r["new_episodes"] for r in rows] == [1, 0, 1]
    assert [r["is_flat"] for r in rows] == [False, True, False]
    assert [r["total_episodes"] for r in rows] == [1, 1, 2]


def test_stats_unknown_graph_is_null(spark):
    e = spark.createDataFrame([("g", 1)], "graph string, uuid long")
    m = spark.createDataFrame([("g",)], "graph string")
    r = {x["graph"]: x for x in G.graph_stats(e, e, m, m, ["g", "nope"]).collect()}
    assert (r["g"]["nodes"], r["g"]["edges"], r["g"]["episodes"]) == (2, 2, 1)
    assert r["nope"]["nodes"] is None
    _ = F


def test_adaptive_bucket_splits_only_hot_keys(spark):
    from engram.functions.common import adaptive_bucket

    rows = [("hot", dt.datetime(2020, 1, 1) + dt.timedelta(minutes=7 * i)) for i in range(50)]
    rows += [("cold", dt.datetime(2020, 1, 1, 5)), ("cold", dt.datetime(2020, 1, 20))]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz")
    b = adaptive_bucket(df, ["k"], "t", coarse="month", fine="hour", hot_rows=10)
    n = {r["k"]: r["n"] for r in b.groupBy("k").agg(F.countDistinct("_bk").alias("n")).collect()}
    assert n == {"hot": 6, "cold": 1}
    assert b.count() == len(rows)


def test_apply_compaction_writes_new_location(spark):
    from engram.session import scratch_path

    eps = spark.createDataFrame([("g", 1, dt.datetime(2000, 1, 1)), ("g", 2, dt.datetime(2021, 5, 1))],
                                "graph string, uuid long, created_at timestamp_ntz")
    men = spark.createDataFrame([("g", 1, 9), ("g", 2, 9)], "graph string, episode_uuid long, entity_uuid long")
    facts = spark.createDataFrame([("g", 5, [1])], "graph string, uuid long, episodes array<long>")
    root = scratch_path(spark, "compacted")
    r = G.apply_compaction(eps, men, lambda: facts, "2021-06-01 00:00:00", 90, root).first()
    assert (r["episodes_before"], r["episodes_after"], r["mentions_after"], r["facts_unchanged"]) == (2, 1, 1, True)
    assert spark.read.parquet(f"{root}/episodes").count() == 1
    # the check counts live facts anew: a fact that vanishes during the run is an error
    live = iter([facts, facts.limit(0)])
    with pytest.raises(RuntimeError):
        G.apply_compaction(eps, men, lambda: next(live), "2021-06-01 00:00:00", 90, scratch_path(spark, "compacted"))


def test_null_keys_keep_their_history(spark):
    def day(n):
        return dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    rows = [("g", None, "r", 1, "A", day(0)), ("g", None, "r", 2, "B", day(1)), ("g", None, "r", 3, "C", day(40)),
            ("g", 7, "r", 4, "A", day(0)), ("g", 7, "r", 5, "A", day(45)), ("g", 7, "r", 6, None, day(50)), (None, 7, "r", 8, "X", None)]
    obs = spark.createDataFrame(rows, "graph string, subject long, relation string, uuid long, value string, valid_at timestamp_ntz")
    got = {(r["uuid"], r["invalid_at"]) for r in T.resolve_supersession(obs).collect()}
    assert got == {(1, day(1)), (2, day(40)), (3, None), (4, day(50)), (6, None)}
    assert [r["uuid"] for r in T.undated_observations(obs).collect()] == [8]


def test_supersession_plan_moves_data_twice_at_most(spark):
    obs = spark.createDataFrame([("g", 1, "r", 1, "A", dt.datetime(2020, 1, 1))],
                                "graph string, subject long, relation string, uuid long, value string, valid_at timestamp_ntz")
    plan = T.resolve_supersession(obs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_k") <= 4 and "hashpartitioning(graph" not in plan


def test_cascade_reads_the_facts_once(spark):
    """Facts go by episode or by either end, once each, in one pass over them."""
    deleted = spark.createDataFrame([("a", 1), ("a", 1)], "graph string, episode_uuid long")
    mentions = spark.createDataFrame([("a", 1, 10), ("a", 2, 11), ("a", 1, 11), ("b", 1, 10)], "graph string, episode_uuid long, entity_uuid long")
    facts = spark.createDataFrame([("a", "by episode", 11, 11, [1]), ("a", "by source", 10, 11, [2]), ("a", "by target", 11, 10, [2]), ("a", "by all", 10, 10, [1]),
                                   ("a", "kept", 11, None, [2]), ("b", "other graph", 10, 10, [1]), ("a", "no episode", 11, 11, None)],
                                  "graph string, uuid string, source_uuid long, target_uuid long, episodes array<long>")
    ents, gone = G.remove_episode_cascade(deleted, mentions, facts.repartition(2), ("source_uuid", "target_uuid"))
    assert [tuple(r) for r in ents.collect()] == [("a", 10)]
    assert sorted(r["uuid"] for r in gone.collect()) == ["by all", "by episode", "by source", "by target"]
    assert gone.columns == facts.columns
    assert gone._jdf.queryExecution().optimizedPlan().toString().count("by episode") <= 1 and "Union" not in gone._jdf.queryExecution().optimizedPlan().toString()
