"""Streaming workloads (OP-45, 46, 47, 48): the write path as a stream, live
activity windows, and check-first de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engram.functions.text import normalized
from engram.operators import activity as AC
from engram.operators import admission as A
from engram.operators.queue import PENDING_SCHEMA, admit
from engram.session import drop_path


def ingest_stream(requests: DataFrame, reject_patterns: dict) -> DataFrame:
    """OP-45, the row-local steps before the queue: guard -> effective group. Rows are kept
    with ``accepted`` and a reason. ``ingest_batches`` takes it from there."""
    return A.effective_group(A.tier_guard(requests, reject_patterns))


def _small(spark, path: str):
    def keep(df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    return keep


def _left_before(spark, base: str, epoch: int) -> DataFrame:
    """Pending items a queue after the epoch before; every epoch writes its own folder."""
    if epoch == 0:
        return spark.createDataFrame([], PENDING_SCHEMA)
    return spark.read.schema(PENDING_SCHEMA).parquet(f"{base}/pending/epoch={epoch - 1}")


def _remember(after: DataFrame, base: str, epoch: int) -> None:
    """The state of a stream: written per epoch, so a replayed epoch starts from the same
    counts; the epoch before last is no longer needed."""
    after.write.mode("overwrite").parquet(f"{base}/pending/epoch={epoch}")
    if epoch > 1:
        drop_path(after.sparkSession, f"{base}/pending/epoch={epoch - 2}")


def ingest_batches(base: str, caps: dict | None = None, order_col: str = "doc_id"):
    """OP-45, the rest, as a ``foreachBatch`` writer: backpressure -> attribution -> episodes
    and rejects, each in a folder of its epoch.

    ``caps``: tier -> pending items a (tier, group) queue may hold, 0 or missing =
    unbounded. A write that the guard refused never enters the queue. Only ids enter the
    admission passes (bodies stay where they are and meet the refusals at the end), a hot
    group is cut into slices of ``order_col`` like any other, and counts are carried from
    epoch to epoch in the shared folder. This stream has no completion events, so pending only
    grows; rows of one queue with equal order values are admitted or refused together."""
    sink, caps = episodes_sink(base), {t: c for t, c in (caps or {}).items() if c}

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            queue = F.concat_ws("\u001f", "graph", "effective_group_id")
            if caps:
                most = F.lit(0)
                for tier, c in caps.items():
                    most = F.when(F.col("graph") == tier, F.lit(c)).otherwise(most)
                events = batch.filter(F.col("accepted")).select(
                    F.col("effective_group_id").alias("group_id"), queue.alias("queue"), most.alias("cap"), F.lit("add").alias("kind"),
                    F.col(order_col).cast("long").alias("event_id"), F.timestamp_seconds(F.col(order_col)).cast("timestamp_ntz").alias("ts"))
                decisions, after = admit(events.filter("cap > 0"), 0, _left_before(spark, base, epoch_id), _small(spark, f"{base}/entries"))
                full = (decisions.filter("decision = 'rejected'").join(events.select("event_id", "group_id", "queue").distinct(), ["event_id", "group_id"])
                        .select(F.col("queue").alias("q"), F.col("event_id").alias("at"), "reason").distinct())
                batch_out = batch.join(full, queue.eqNullSafe(F.col("q")) & (F.col(order_col) == F.col("at")) & F.col("accepted"), "left")
                batch_out = (batch_out.withColumn("accepted", F.col("accepted") & F.col("reason").isNull())
                             .withColumn("reject_reason", F.coalesce("reject_reason", "reason")).drop("q", "at", "reason"))
            else:
                batch_out, after = batch, None
            sink(A.attribute_agent(batch_out), epoch_id)
            if after is not None:
                _remember(after, base, epoch_id)
        finally:
            batch.unpersist()
    return write


def admission_batches(base: str, cap: int):
    """OP-46 as a ``foreachBatch`` writer over add and done events: decisions per epoch, counts
    carried from epoch to epoch. Right when events arrive in time order; inside a batch
    they are ordered."""
    def write(events: DataFrame, epoch_id: int) -> None:
        spark = events.sparkSession
        events = events.select("group_id", "ts", "event_id", "kind").persist()
        try:
            decisions, after = admit(events, cap, _left_before(spark, base, epoch_id), _small(spark, f"{base}/entries"))
            decisions.write.mode("overwrite").parquet(f"{base}/decisions/epoch={epoch_id}")
            _remember(after, base, epoch_id)
        finally:
            events.unpersist()
    return write


def episodes_sink(base: str):
    """foreachBatch writer: accepted rows -> episodes, others -> rejects, partitioned by
    epoch and tier. Every epoch has its own folder that a replay overwrites, so a batch
    that is delivered twice is stored once; the batch is evaluated once."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        try:
            for name, rows in (("episodes", batch.filter("accepted").drop("accepted", "reject_reason")),
                               ("rejects", batch.filter(~F.col("accepted")))):
                rows.write.mode("overwrite").partitionBy("graph").parquet(f"{base}/{name}/epoch={epoch_id}")
        finally:
            batch.unpersist()
    return write


def typed_stream(lines: DataFrame) -> DataFrame:
    """Log lines as (tier, klass, status, event_time); lines without a time are left out.
    Event time is the record's ``ts`` (epoch seconds)."""
    rec = AC.parse_access_log(lines)
    return (rec.withColumn("host", AC.host_of(F.col("rec")))
            .withColumn("tier", F.when(F.col("host").isNull(), F.lit("?"))
                        .otherwise(AC.tier_of_host(F.col("host"))))
            .withColumn("klass", AC.status_class(F.col("rec")))
            .withColumn("status", F.try_variant_get(F.col("rec"), "$.status", "bigint"))
            .withColumn("event_time", F.timestamp_seconds(F.try_variant_get(F.col("rec"), "$.ts", "bigint")))
            .filter(F.col("event_time").isNotNull()))


def activity_stream(lines: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """OP-47: requests per (window, tier, status class) over a live log. Late rows beyond
    the watermark are dropped from counts; append mode emits closed windows."""
    return (typed_stream(lines).withWatermark("event_time", delay)
            .groupBy(F.window("event_time", window), "tier", "klass")
            .agg(F.count(F.lit(1)).alias("requests"),
                 F.count_if(F.col("status") == 401).alias("unauthorized"))
            .select(F.unix_seconds(F.col("window.start")).alias("window_start"), "tier", "klass",
                    "requests", "unauthorized"))


def unauthorized_outages(lines: DataFrame, gap: str, least: int, delay: str = "10 minutes") -> DataFrame:
    """One alert per tier and outage: a run of 401s with less than ``gap`` between them and at
    least ``least`` of them, reported when it has ended (nothing for ``gap``, by event time).

    A session window per tier holds one small row of state for each open outage, whatever
    the number of requests, and is dropped when the watermark passes its end. The watermark
    follows all requests, so an outage also ends while other requests go on."""
    # the condition names the event time, so it stays above the watermark
    bad = typed_stream(lines).withWatermark("event_time", delay).filter(F.when(F.col("status") == 401, F.col("event_time")).isNotNull())
    return (bad.groupBy(F.session_window("event_time", gap), "tier")
            .agg(F.count(F.lit(1)).alias("unauthorized"), F.min("event_time").alias("a"), F.max("event_time").alias("b"))
            .filter(F.col("unauthorized") >= least)
            .select("tier", F.unix_seconds("a").alias("opened"), F.unix_seconds("b").alias("last_seen"), "unauthorized"))


def unauthorized_alerts(windows: DataFrame, min_unauthorized: int) -> DataFrame:
    """401 alerts on closed activity windows (a row filter, works on the stream
    output or on a batch of windows): wrong or missing bearer tokens."""
    return windows.filter(F.col("unauthorized") >= min_unauthorized)


def dedup_stream(requests: DataFrame, store: DataFrame, key_cols: list[str],
                 event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """OP-48: check-first on the stream. Duplicates by (key, normalised-text
    hash) are dropped — within the watermark when an event-time column is
    given (bounded state), else over all keys seen — then anything already in
    the (static) store is removed with a stream-static anti join."""
    s = requests.withColumn("text_key", A.body_hash(normalized(F.col("episode_body"))))
    if event_time:
        s = s.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([*key_cols, "text_key"])
    else:
        s = s.dropDuplicates([*key_cols, "text_key"])
    st = store.select(*key_cols, A.body_hash(normalized(F.col("episode_body"))).alias("text_key")).distinct()
    return s.join(st, [*key_cols, "text_key"], "left_anti")
