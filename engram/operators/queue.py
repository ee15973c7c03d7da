"""Write-queue admission (OP-46): refuse an add when the group's pending count
is at the cap; a 'done' takes one item off the queue (never below zero).

Each event is a clamp-shift map on the pending count p:
    add  : p -> min(cap, p + 1)   (accepted iff p < cap)
    done : p -> max(0, p - 1)
Maps of the form x -> min(H, max(L, x + S)) are closed under composition, so a
run of events collapses to one (S, L, H) triple. That makes the sequential
rule splittable: events are cut into (group, time bucket) slices, each slice
is summarised, the small per-group list of summaries is folded into entry
states, and each slice is replayed from its entry state. No task ever holds
a whole hot group; only one slice plus one row per bucket.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engram.functions.common import adaptive_bucket

INF = math.inf
SUMMARY_SCHEMA = "_g string, _bk timestamp_ntz, s double, lo double, hi double"
ENTRY_SCHEMA = "_g string, _bk timestamp_ntz, entry long, after long"
PENDING_SCHEMA = "queue string, pending long"
DECISION_SCHEMA = ("group_id string, event_id long, ts timestamp_ntz, kind string, "
                   "pending_before long, decision string, reason string")


def _clamp(x: float, lo: float, hi: float) -> float:
    return min(hi, max(lo, x))


def _step(kind: str, cap: int) -> tuple[float, float, float]:
    if kind == "add":
        return (1.0, -INF, float(cap) if cap else INF)
    return (-1.0, 0.0, INF)


def _compose(f, g):
    """g after f, both (S, L, H)."""
    s1, l1, h1 = f
    s2, l2, h2 = g
    return (s1 + s2, _clamp(l1 + s2, l2, h2), _clamp(h1 + s2, l2, h2))


def _apply(f, x: float) -> float:
    s, lo, hi = f
    return _clamp(x + s, lo, hi)


def _runs(batches, key_cols):
    """Iterate (key, row-values) over partitions sorted by key — constant memory:
    nothing is buffered per key, so a hot key costs time, never memory."""
    for pdf in batches:
        if len(pdf) == 0:
            continue
        cols = [pdf[c].to_numpy() for c in key_cols]
        yield pdf, list(zip(*cols))


def queue_admission(events: DataFrame, cap: int, bucket: str = "day",
                    num_partitions: int | None = None, hot_bucket: str = "minute",
                    hot_rows: int = 5_000_000) -> DataFrame:
    """Batch OP-46 over ``events(group_id, ts, event_id, kind)``; cap 0 = unbounded.

    Three passes, each a hash exchange on (group, bucket) followed by a sort
    within partitions and one streaming fold per partition (``mapInPandas``):
    1. summarise every (group, bucket) slice to its (S, L, H) map;
    2. fold each group's short list of slice maps into entry states;
    3. replay each slice from its entry state.
    -> (group_id, event_id, ts, kind, pending_before, decision, reason).
    """
    return _passes(events, cap, None, bucket, num_partitions, hot_bucket, hot_rows, lambda df: df)[0]


def admit(events: DataFrame, cap: int, pending: DataFrame | None, keep, bucket: str = "day", num_partitions: int | None = None,
          hot_bucket: str = "minute", hot_rows: int = 5_000_000) -> tuple[DataFrame, DataFrame]:
    """OP-46 over one batch of a stream: (decisions, pending items a queue afterwards).

    ``pending`` (queue, pending) is what earlier batches left, ``keep(df)`` writes a small
    table and reads it back (entry states, one row a queue and bucket: both results use
    them). Events may name their ``queue`` (default: the group) and their own ``cap``. No
    task holds a queue's batch: slices are folded as they stream past."""
    decisions, entry = _passes(events, cap, pending, bucket, num_partitions, hot_bucket, hot_rows, keep)
    after = entry.groupBy(F.col("_g").alias("queue")).agg(F.max_by("after", "_bk").alias("pending"))
    if pending is not None:
        after = after.unionByName(pending.join(after.select("queue"), "queue", "left_anti"))
    return decisions, after


def _passes(events, cap, pending, bucket, num_partitions, hot_bucket, hot_rows, keep) -> tuple[DataFrame, DataFrame]:
    spark = events.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # non-nullable internal keys: a null group is its own group and a null time
    # sorts first, so no event is dropped (and no IS NOT NULL filter is inferred)
    # (a hot group — more than ``hot_rows`` events — is cut into finer buckets)
    own = F.col("queue") if "queue" in events.columns else F.col("group_id")
    ev = events.select("group_id", "ts", "event_id", "kind", F.coalesce(own, F.lit("\u0000")).alias("_g"),
                       (F.col("cap") if "cap" in events.columns else F.lit(cap)).cast("long").alias("cap"))
    ev = adaptive_bucket(ev, ["_g"], "ts", coarse=bucket, fine=hot_bucket, hot_rows=hot_rows)
    ev = ev.withColumn("_bk", F.coalesce(F.col("_bk"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")))
    # one hash exchange on (group, bucket), read by both full passes (identical
    # subtrees, so Spark reuses the shuffle output instead of shuffling twice)
    shuffled = ev.repartition(n, "_g", "_bk")
    sorted_ev = shuffled.sortWithinPartitions("_g", "_bk", "ts", "event_id")

    def summarise(batches):
        cur, f = None, None
        out_g, out_b, out_s, out_l, out_h = [], [], [], [], []
        for pdf, keys in _runs(batches, ["_g", "_bk"]):
            for key, k, most in zip(keys, pdf["kind"].to_numpy(), pdf["cap"].to_numpy()):
                if key != cur:
                    if cur is not None:
                        out_g.append(cur[0]); out_b.append(cur[1])
                        out_s.append(f[0]); out_l.append(f[1]); out_h.append(f[2])
                    cur, f = key, (0.0, -INF, INF)
                f = _compose(f, _step(k, int(most)))
        if cur is not None:
            out_g.append(cur[0]); out_b.append(cur[1])
            out_s.append(f[0]); out_l.append(f[1]); out_h.append(f[2])
        if out_g:
            yield pd.DataFrame({"_g": out_g, "_bk": out_b, "s": out_s, "lo": out_l, "hi": out_h})

    summaries = sorted_ev.mapInPandas(summarise, SUMMARY_SCHEMA)
    if pending is None:
        summaries = summaries.withColumn("start", F.lit(0.0))
    else:
        summaries = summaries.join(pending.select(F.col("queue").alias("_g"), F.col("pending").cast("double").alias("start")), "_g", "left").fillna(0.0, ["start"])

    def entries(batches):
        cur, x = None, 0.0
        for pdf, keys in _runs(batches, ["_g"]):
            out_e, out_a = [], []
            for (g,), s_, lo, hi, start in zip(keys, pdf["s"], pdf["lo"], pdf["hi"], pdf["start"]):
                if g != cur:
                    cur, x = g, start
                out_e.append(int(x))
                x = _apply((s_, lo, hi), x)
                out_a.append(int(x))
            yield pd.DataFrame({"_g": pdf["_g"], "_bk": pdf["_bk"], "entry": out_e, "after": out_a})

    # one row per (group, bucket): this fold runs over a short list per group
    entry = keep(summaries.repartition(n, "_g").sortWithinPartitions("_g", "_bk")
                 .mapInPandas(entries, ENTRY_SCHEMA))

    def replay(batches):
        cur, p = None, 0
        for pdf, keys in _runs(batches, ["_g", "_bk"]):
            before, decision, reason = [], [], []
            groups = pdf["group_id"].to_numpy()
            for key, k, e, g, most in zip(keys, pdf["kind"].to_numpy(), pdf["entry"].to_numpy(), groups, pdf["cap"].to_numpy()):
                if key != cur:
                    cur, p = key, int(e)
                before.append(p)
                if k == "add":
                    if most and p >= most:
                        decision.append("rejected")
                        reason.append(f"queue full for group {g} ({most} pending)")
                    else:
                        decision.append("accepted")
                        reason.append(None)
                        p += 1
                else:
                    decision.append("done")
                    reason.append(None)
                    p = max(0, p - 1)
            yield pd.DataFrame({"group_id": groups, "event_id": pdf["event_id"].to_numpy(),
                                "ts": pdf["ts"].to_numpy(), "kind": pdf["kind"].to_numpy(),
                                "pending_before": before, "decision": decision, "reason": reason})

    # the join keeps the (group, bucket) hash partitioning of ``shuffled``
    # (broadcast or shuffled entry side), so every slice stays in one task
    joined = shuffled.join(entry.drop("after"), ["_g", "_bk"])
    return joined.sortWithinPartitions("_g", "_bk", "ts", "event_id").mapInPandas(replay, DECISION_SCHEMA), entry
