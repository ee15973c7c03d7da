"""Spark session helpers.

The library never creates a session implicitly; callers (tests, bench, CLI)
use :func:`build_session`. Shared folders for lineage cuts and snapshots come
from ``spark.checkpoint.dir``; a private one is only made when it is unset
(local runs and tests).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "engram", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("ENGRAM_DRIVER_MEMORY", "16g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir`` or from a checkpoint folder that is already
    set. Only a local master (tests, one machine) may go without: it gets a private
    folder that is removed when the process ends; a cluster must name one.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises
            d = None
    if not d and sc.getCheckpointDir() is not None:
        d = sc.getCheckpointDir()
        spark.conf.set("spark.checkpoint.dir", d)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="engram-shared-")
        atexit.register(shutil.rmtree, d, True)
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, once per application.

    Spark's file server hands the archive to every executor, so task functions
    can import the package wherever the driver was started and whether or not
    it is installed on the nodes.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="engram-package-"), "engram.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


_ROOTS: dict[str, str] = {}


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared folder (never a machine-local temp dir). All of them
    lie in one folder of the application, which Spark's file system removes when the
    application ends; ``drop_path`` removes one earlier."""
    import uuid

    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        root = f"{shared_dir(spark).rstrip('/')}/engram-{app}-{uuid.uuid4().hex[:8]}"
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _ROOTS[app] = root
    return "/".join([_ROOTS[app], *parts, uuid.uuid4().hex])


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a table or folder that the library wrote, wherever the shared folder is."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def reliable_checkpoint(df):
    """Cut lineage by writing to the shared checkpoint folder (never a local
    checkpoint: executors may be lost). Ensures the folder is registered."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
