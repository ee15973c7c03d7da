"""Time-valid facts: supersession, current/superseded views, as-of, review list.

A fact is an edge with ``valid_at``/``invalid_at``. A contradicted fact is not
deleted; it gets ``invalid_at`` and history is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from engram.config import CONTRADICTIONS_LIMIT
from engram.functions.common import adaptive_bucket, ntz

FACT_KEYS = ["graph", "subject", "relation"]


def resolve_supersession(observations: DataFrame, keys: list[str] | None = None,
                         bucket: str = "month", hot_bucket: str = "hour",
                         hot_rows: int = 5_000_000) -> DataFrame:
    """Turn time-stamped observations into facts with validity intervals (OP-W3).

    For one (graph, subject, relation) ordered by (valid_at, uuid): consecutive
    equal values collapse into the first one (a repeat is not a change); each
    kept row is valid until the next kept row's ``valid_at``; the last one stays
    open (``invalid_at`` null). A value may come back later (A, B, A) and then
    starts a new fact.

    Skew: a single subject may hold a large share of all rows, so the windows
    are partitioned by (key, time bucket) instead of key alone — monthly
    buckets, hourly for keys with more than ``hot_rows`` rows — and the bucket
    borders are stitched with per-bucket summaries (one row per key and bucket).
    No task ever sorts a whole hot key. Nothing is written in between, so the
    result is lazy.

    Null key parts are equal to each other (a subject that is null has one
    history); observations without ``valid_at`` are no facts and are returned by
    :func:`undated_observations`.
    """
    keys = keys or FACT_KEYS
    obs = adaptive_bucket(observations.filter(F.col("valid_at").isNotNull()), keys, "valid_at",
                          coarse=bucket, fine=hot_bucket, hot_rows=hot_rows)
    # one never-null key column: rows with a null key part keep their own history
    obs = obs.withColumn("_k", F.struct(*keys))
    part = ["_k", "_bk"]
    w_in = Window.partitionBy(*part).orderBy("valid_at", "uuid")

    # The one full exchange: change flags and the next change inside the bucket.
    p1 = (obs.withColumn("_is_first", F.row_number().over(w_in) == 1)
          .withColumn("_chg", ~F.col("_is_first") & ~F.lag("value").over(w_in).eqNullSafe(F.col("value")))
          .withColumn("_next_in", F.first(F.when(F.col("_chg"), F.col("valid_at")), ignorenulls=True).over(
              w_in.rowsBetween(1, Window.unboundedFollowing))))

    # One row per (key, bucket) in one aggregate over the same partitioning; the
    # windows here run per key over its buckets only, never over observations.
    at = F.struct("valid_at", "uuid")
    wk = Window.partitionBy("_k").orderBy("_bk")
    summary = (p1.groupBy(*part).agg(
        F.min_by("value", at).alias("_first_val"), F.min("valid_at").alias("_first_va"),
        F.max_by("value", at).alias("_last_val"),
        F.min(F.when(F.col("_chg"), F.col("valid_at"))).alias("_first_chg_va"))
        .withColumn("_is_first_bk", F.row_number().over(wk) == 1)
        .withColumn("_first_opens", F.col("_is_first_bk")
                    | ~F.col("_first_val").eqNullSafe(F.lag("_last_val").over(wk)))
        .withColumn("_first_start_va", F.when(F.col("_first_opens"), F.col("_first_va"))
                    .otherwise(F.col("_first_chg_va")))
        .withColumn("_next_start_va", F.first("_first_start_va", ignorenulls=True).over(
            wk.rowsBetween(1, Window.unboundedFollowing)))
        .select(*part, "_first_opens", "_next_start_va"))

    # A run starts at the first row of a bucket if its value differs from the
    # previous bucket's last one, and at every change; it ends at the next start
    # inside the bucket, else at the first start of a later bucket.
    starts = p1.join(summary, part).filter(F.when(F.col("_is_first"), F.col("_first_opens")).otherwise(F.col("_chg")))
    return (starts.withColumn("invalid_at", F.coalesce("_next_in", "_next_start_va"))
            .drop("_k", "_bk", "_chg", "_is_first", "_next_in", "_first_opens", "_next_start_va"))


def undated_observations(observations: DataFrame) -> DataFrame:
    """What :func:`resolve_supersession` cannot place in time: rows without ``valid_at``."""
    return observations.filter(F.col("valid_at").isNull()).withColumn("reject_reason", F.lit("no valid_at"))


def current_facts(facts: DataFrame) -> DataFrame:
    """OP-24: believed now — ``invalid_at`` is null."""
    return facts.filter(F.col("invalid_at").isNull())


def superseded_facts(facts: DataFrame) -> DataFrame:
    """OP-24: superseded — ``invalid_at`` set, even when it lies in the future."""
    return facts.filter(F.col("invalid_at").isNotNull())


def valid_at_instant(t: Column) -> Column:
    """Half-open validity: valid_at <= t < invalid_at (open end when null)."""
    return (F.col("valid_at") <= t) & (F.col("invalid_at").isNull() | (F.col("invalid_at") > t))


def facts_as_of(facts: DataFrame, as_of) -> DataFrame:
    """OP-37: facts believed valid at one instant."""
    return facts.filter(valid_at_instant(ntz(as_of)))


def facts_as_of_table(facts: DataFrame, instants: DataFrame, on: list[str]) -> DataFrame:
    """OP-37 for a table of instants ``(on..., as_of)``: equi-join on the subject
    key(s), then the interval condition — never a nested loop over all facts."""
    j = facts.join(instants, on, "inner")
    return j.filter(valid_at_instant(F.col("as_of")))


def contradictions(facts: DataFrame, graph: str | None = None,
                   limit: int = CONTRADICTIONS_LIMIT) -> DataFrame:
    """OP-S1: superseded facts of a graph, newest invalidation first.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each partition
    keeps its own top n, only those are merged. uuid breaks ties.
    """
    df = superseded_facts(facts)
    if graph is not None:
        df = df.filter(F.col("graph") == graph)
    return (df.orderBy(F.col("invalid_at").desc(), F.col("uuid").asc())
              .limit(limit)
              .select("uuid", "fact", F.col("valid_at").alias("valid_from"),
                      F.col("invalid_at").alias("invalidated")))


def age_filter(episodes: DataFrame, now, days: int) -> DataFrame:
    """OP-25: episodes with ``created_at < now - days`` (null never matches)."""
    return episodes.filter(F.col("created_at") < cutoff_expr(now, days))


def cutoff_expr(now, days: int) -> Column:
    if not isinstance(days, int) or isinstance(days, bool) or days < 0:
        raise ValueError(f"days must be a non-negative whole number, got {days!r}")
    from engram.functions.common import truncate_seconds

    return ntz(truncate_seconds(now)) - F.expr(f"INTERVAL {days} DAYS")
