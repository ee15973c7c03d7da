"""Episode sink and point-in-time snapshots (OP-06, 07, 08).

Live tables of a restored store lie in a folder per version; a small pointer file names
the version that readers see (``live_path``). Restoring writes a new version beside the
old one and then adds one pointer, so readers see all tables of one version or of the
other, and a crash before that leaves the old one as it was.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from engram.operators.admission import effective_group
from engram.session import drop_path, scratch_path

GROUP_COLS = ["graph", "group_id"]


def append_episodes(episodes: DataFrame, path: str) -> None:
    """OP-06: append episodes partitioned by tier and effective group (a null or empty
    group is its tier's default). Rows are dealt by group and salted by row, so a
    group makes a few files and a hot group is not one task."""
    e = effective_group(episodes).withColumn("group_id", F.col("effective_group_id")).drop("effective_group_id")
    salt = F.pmod(F.xxhash64(*[c for c in e.columns if c not in GROUP_COLS]), F.lit(8))
    (e.select(*[c for c in e.columns if c not in GROUP_COLS], *GROUP_COLS)
     .repartition(*GROUP_COLS, salt).write.mode("append").partitionBy(*GROUP_COLS).parquet(path))


def read_episodes(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Stored episodes with the types they were written with: partition values are not
    guessed, so a group called "007" stays text."""
    return spark.read.schema(schema).parquet(path)


BUCKETS = 256


def upsert_episodes(episodes: DataFrame, path: str, order: list[str], key: str = "uuid", buckets: int = BUCKETS) -> None:
    """OP-06 with identities: an episode whose ``key`` is stored, or repeated in the batch,
    replaces the earlier one; inside the batch the last by ``order`` wins.

    The store is partitioned by a hash bucket of the key. A batch reads and rewrites the
    buckets that it touches and no others: survivors of those buckets and the batch are
    staged first, then the staged partitions replace theirs. Episodes with a null key have
    no identity: each of them is added."""
    spark = episodes.sparkSession
    bucket = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(buckets)).cast("int")
    same = F.when(F.col(key).isNull(), F.struct(F.lit(False), F.monotonically_increasing_id())).otherwise(F.struct(F.lit(True), F.lit(0).cast("long")))
    newest = (episodes.withColumn("_own", same).groupBy(key, "_own")
              .agg(F.max(F.struct(*order, F.struct(*[c for c in episodes.columns if c not in order]).alias("_rest"))).alias("_x")))
    batch = newest.select(*[(F.col(f"_x.{c}") if c in order else F.col(f"_x._rest.{c}")).alias(c) for c in episodes.columns]).withColumn("bucket", bucket)
    stage = scratch_path(spark, "upsert")
    batch.write.partitionBy("bucket").parquet(f"{stage}/batch")
    schema = StructType([*episodes.schema.fields, StructField("bucket", IntegerType())])
    batch = spark.read.schema(schema).parquet(f"{stage}/batch")
    touched = [r["bucket"] for r in batch.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    if not touched:
        return
    merged = batch
    if _exists(spark, path):
        old = spark.read.schema(schema).parquet(path).filter(F.col("bucket").isin(touched))
        merged = old.join(batch.filter(F.col(key).isNotNull()).select(key).distinct(), key, "left_anti").select(*schema.names).unionByName(batch)
    merged.repartition("bucket").write.partitionBy("bucket").parquet(f"{stage}/merged")
    (spark.read.schema(schema).parquet(f"{stage}/merged").repartition("bucket").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path))
    drop_path(spark, stage)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and content hash per (table, graph) — the snapshot's self-check. The
    hash is a sum over rows, so it does not depend on their order."""
    out = None
    for name, df in tables.items():
        row = F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")
        m = df.groupBy("graph").agg(F.count(F.lit(1)).alias("rows"), F.sum(row).alias("content")).select(
            F.lit(name).alias("table"), "graph", "rows", F.col("content").cast("string").alias("content"))
        out = m if out is None else out.unionByName(m)
    return out


def _same(a: DataFrame, b: DataFrame) -> bool:
    """Do two manifests name the same rows?"""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def export_snapshot(tables: dict[str, DataFrame], root: str, stamp: str) -> DataFrame:
    """OP-07: write every table under ``root/stamp/`` with its schema and a manifest
    computed from what was written; returns the manifest. Empty tables are kept."""
    base = f"{root.rstrip('/')}/{stamp}"
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{base}/{name}")
    schemas = [(name, df.schema.json()) for name, df in tables.items()]
    spark.createDataFrame(schemas, "table string, schema string").write.parquet(f"{base}/_schemas")
    manifest({name: spark.read.schema(df.schema).parquet(f"{base}/{name}") for name, df in tables.items()}
             ).write.mode("errorifexists").parquet(f"{base}/_manifest")
    return spark.read.parquet(f"{base}/_manifest")


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pointers(spark: SparkSession, target: str) -> list[tuple[int, str]]:
    """(number, version) of every pointer, oldest first. A pointer is the name of an empty
    file, so it is there whole or not at all."""
    at, fs = _files(spark, f"{target.rstrip('/')}/_pointers")
    if not fs.exists(at):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    return sorted((int(n.split("-", 1)[0]), n.split("-", 1)[1]) for n in names if n[0].isdigit())


def live_path(spark: SparkSession, target: str, table: str) -> str:
    """Where a table of the live store lies now."""
    found = _pointers(spark, target)
    if not found:
        raise FileNotFoundError(f"no live store at {target}")
    return f"{target.rstrip('/')}/{found[-1][1]}/{table}"


def _switch(spark: SparkSession, target: str, version: str) -> None:
    """Point readers to ``version``; of older versions the last one stays, for readers that
    are still at it."""
    before = _pointers(spark, target)
    number = before[-1][0] + 1 if before else 1
    at, fs = _files(spark, f"{target.rstrip('/')}/_pointers/{number:012d}-{version}")
    if not fs.createNewFile(at):
        raise RuntimeError("another restore has switched the store at the same time")
    for k, old in before[:-1]:
        drop_path(spark, f"{target.rstrip('/')}/{old}")
        drop_path(spark, f"{target.rstrip('/')}/_pointers/{k:012d}-{old}")


def restore_snapshot(spark: SparkSession, root: str, stamp: str, target: str,
                     confirm: bool = False) -> DataFrame:
    """OP-08: *replace* the live tables under ``target`` with the snapshot's.

    Refuses without ``confirm=True`` or when the snapshot is missing. The snapshot is checked
    against its manifest (counts and content), copied into a new version beside the live
    one and checked again, tables that are empty in the snapshot included; then one pointer
    switches all tables at once. A failure at any point before that leaves the live
    version in place."""
    if not confirm:
        raise PermissionError("restore replaces live data; pass confirm=True")
    base = f"{root.rstrip('/')}/{stamp}"
    try:
        man = spark.read.parquet(f"{base}/_manifest")
        schemas = {r["table"]: StructType.fromJson(json.loads(r["schema"]))
                   for r in spark.read.parquet(f"{base}/_schemas").collect()}  # a handful of names
    except Exception as e:  # noqa: BLE001
        raise FileNotFoundError(f"no such snapshot: {base}") from e
    snap = {n: spark.read.schema(s).parquet(f"{base}/{n}") for n, s in schemas.items()}
    if not _same(manifest(snap), man):
        raise RuntimeError("snapshot does not match its manifest; nothing restored")
    version = f"v{uuid.uuid4().hex}"
    new = f"{target.rstrip('/')}/{version}"
    try:
        for n, df in snap.items():
            df.write.parquet(f"{new}/{n}")
        if not _same(manifest({n: spark.read.schema(s).parquet(f"{new}/{n}") for n, s in schemas.items()}), man):
            raise RuntimeError("the restored copy does not match the manifest; the live store is unchanged")
    except Exception:
        drop_path(spark, new)
        raise
    _switch(spark, target, version)
    return man
