"""Structured Streaming plumbing: file sources and run-to-completion sinks.

Sinks and checkpoints live under the shared folder (``spark.checkpoint.dir``),
so a restarted driver or a lost executor resumes from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from engram.session import scratch_path


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file source; ``maxFilesPerTrigger`` is the per-micro-batch rate limit."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def run_available_now(df: DataFrame, name: str, mode: str = "append",
                      partition_by: list[str] | None = None) -> str:
    """Run a streaming query over everything available, into a parquet table;
    returns the table path."""
    return run_resumed(df, name, None, None, mode, partition_by)[0]


def run_resumed(df: DataFrame, name: str, out: str | None, checkpoint: str | None, mode: str = "append",
                partition_by: list[str] | None = None) -> tuple[str, str]:
    """The same, going on from an earlier run's (table, checkpoint); returns both."""
    spark = df.sparkSession
    out = out or scratch_path(spark, "streams", name, "data")
    ckpt = checkpoint or scratch_path(spark, "streams", name, "checkpoint")
    w = (df.writeStream.format("parquet").outputMode(mode)
         .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return out, ckpt


def run_foreach_batch(df: DataFrame, name: str, fn, checkpoint: str | None = None) -> str:
    """Run with ``foreachBatch(fn(batch_df, epoch_id))`` (idempotent writes by epoch) over what
    is there; returns the checkpoint. With the checkpoint of an earlier run it goes on where
    that one ended."""
    spark = df.sparkSession
    ckpt = checkpoint or scratch_path(spark, "streams", name, "checkpoint")
    q = (df.writeStream.foreachBatch(fn).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return ckpt


def run_in_parts(df: DataFrame, name: str, parts: list, flow, fn, max_files_per_trigger: int = 1000) -> str:
    """Feed a table to a stream part by part (conditions), as files that arrive one after the
    other: each part is written to the source folder and the stream resumes from its
    checkpoint, so every part is at least one micro-batch of its own."""
    spark = df.sparkSession
    src, ckpt = scratch_path(spark, "streams", name, "source"), None
    for part in parts:
        df.filter(part).write.mode("append").parquet(src)
        ckpt = run_foreach_batch(flow(file_stream(spark, src, df.schema, max_files_per_trigger=max_files_per_trigger)), name, fn, ckpt)
    return ckpt
