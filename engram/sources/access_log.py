"""Access-log text files with their physical line order (OP-02's source)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns that order the lines as they stand in the files.
LINE_ORDER = ["file", "block", "seq"]


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line, file, block, seq`` of every line below ``path``. A file may be read in
    several blocks at once: the block's offset orders blocks, and the row number inside
    the task orders the lines of one block."""
    return (spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block")).withColumn("seq", F.monotonically_increasing_id()))


def log_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """The lines of log files as they arrive, with the file they stand in."""
    return (spark.readStream.option("maxFilesPerTrigger", str(max_files_per_trigger)).text(path)
            .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file")))
