"""Column helpers shared by operators (all JVM-side expressions)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from engram.config import SCORE_DIGITS


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal (data timestamps are NTZ; never mix with LTZ)."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f" if value.microsecond else "%Y-%m-%d %H:%M:%S")
    elif isinstance(value, _dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.expr(f"TIMESTAMP_NTZ '{value}'")


def truncate_seconds(value) -> str:
    """'now' is always an argument; it is truncated to whole seconds."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    return value.replace(microsecond=0).strftime("%Y-%m-%d %H:%M:%S")


def rounded_score(c: Column) -> Column:
    """Scores are rounded before ranking so float summation order cannot flip ties."""
    return F.round(c, SCORE_DIGITS)


def tier_of_parity(c: Column) -> Column:
    return F.when(c % 2 == 0, F.lit("personal")).otherwise(F.lit("client"))


def top_k_per_group(df: DataFrame, group_cols: list[str], order_cols: list[Column], k: int,
                    rank_col: str = "rank", salt_buckets: int = 32,
                    salt_col: Column | None = None) -> DataFrame:
    """Exact top-k per group that stays flat when one group holds most rows.

    For ``k`` up to the optimizer's window-group-limit threshold, a single
    ``row_number() <= k`` window is enough: Spark plans a *partial*
    WindowGroupLimit before the shuffle, so every map task ships at most k rows
    per group and a hot group receives at most k x (map tasks) rows. Above the
    threshold the limit is not inserted, so the work is split explicitly:
    top-k inside (group, salt), then a merge of at most ``salt_buckets * k``
    rows per group. The salt is a deterministic function of the row.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k <= threshold:
        return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
    if salt_col is None:
        salt_col = F.xxhash64(*[F.col(c) for c in df.columns])
    salted = df.withColumn("_salt", F.pmod(salt_col, F.lit(salt_buckets)))
    w1 = Window.partitionBy(*group_cols, "_salt").orderBy(*order_cols)
    phase1 = (salted.withColumn("_r1", F.row_number().over(w1))
              .filter(F.col("_r1") <= k).drop("_r1", "_salt"))
    return phase1.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def global_rank(df: DataFrame, order_cols: list[Column], rank_col: str = "ordinal",
                num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row in a total order, without a single-task window.

    Range-partition + sort within partitions gives a distributed total order;
    ``monotonically_increasing_id`` encodes (partition, offset); a table with one
    row per partition (bounded by the partition count) turns that into a rank.
    """
    n = num_partitions or df.sparkSession.sparkContext.defaultParallelism
    ordered = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
               .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = (ordered.withColumn("_pid", F.shiftright(F.col("_mid"), 33))
               .withColumn("_off", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))))
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.withColumn(
        "_start", F.coalesce(F.sum("_n").over(
            Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # one row per partition: bounded by the partition count, safe to broadcast
    out = ordered.join(F.broadcast(starts.select("_pid", "_start")), "_pid")
    return (out.withColumn(rank_col, F.col("_start") + F.col("_off") + 1)
            .drop("_mid", "_pid", "_off", "_start"))


def adaptive_bucket(df: DataFrame, keys: list[str], ts_col: str, coarse: str = "month",
                    fine: str = "hour", hot_rows: int = 5_000_000) -> DataFrame:
    """Add ``_bk``: a time bucket per row, coarse for ordinary keys and fine for
    hot keys (more than ``hot_rows`` rows), so one task never sorts more than
    about a fine bucket of a hot key.

    Hot keys come from a partial-aggregate count (combined map-side). There are
    at most total_rows / hot_rows of them (200,000 for 10^12 rows), so that list is
    broadcast and the data are not exchanged by the very key that is hot. Every row of a key gets the same granularity, which keeps the
    bucket order per key consistent for the stitching step.
    """
    k = F.struct(*keys)  # structs compare null fields as equal: a null key part loses no row
    counts = df.groupBy(k.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > hot_rows).select("_k", F.lit(True).alias("_hot"))
    t = F.col(ts_col)
    bk = F.when(F.col("_hot"), F.date_trunc(fine, t)).otherwise(F.date_trunc(coarse, t))
    return (df.withColumn("_k", k).join(F.broadcast(hot), "_k", "left")
            .withColumn("_bk", bk.cast("timestamp_ntz")).drop("_hot", "_k"))
