"""Markdown -> episode chunks (OP-10, 11, 09, S3), all built-in array expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engram.config import MAX_CHARS
from engram.functions.text import py_strip

# split *before* every line that starts with "# " or "## " ("###", "#x" stay).
# (?d): only \n ends a line, as in Python's re.MULTILINE.
HEADING_SPLIT = r"(?dm)^(?=#{1,2} )"


def chunk_array(text):
    """OP-10 as one array expression: split on headings, strip, drop empties,
    slice parts longer than MAX_CHARS code points (slices are not re-stripped)."""
    parts = F.split(text, HEADING_SPLIT, -1)
    kept = F.filter(F.transform(parts, lambda p: py_strip(p)), lambda p: F.length(p) > 0)

    def slices(p):
        n = F.floor((F.length(p) - 1) / MAX_CHARS).cast("int")
        return F.transform(F.sequence(F.lit(0), n),
                           lambda i: F.substr(p, i * MAX_CHARS + 1, F.lit(MAX_CHARS)))
    return F.flatten(F.transform(kept, slices))


def chunk_markdown(files: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per chunk: (<other cols>, pos, episode_body). Whole texts, no UDF."""
    others = [c for c in files.columns if c != text_col]
    return files.select(*others, F.posexplode(chunk_array(F.col(text_col))).alias("pos", "episode_body"))


def episode_names(chunks: DataFrame, rel_col: str = "rel_path") -> DataFrame:
    """OP-11: first chunk named '<rel>', n-th '<rel> [n+1]'; description 'markdown ingest: <rel>'."""
    rel = F.col(rel_col)
    name = F.when(F.col("pos") == 0, rel).otherwise(
        F.concat(rel, F.lit(" ["), (F.col("pos") + 1).cast("string"), F.lit("]")))
    return chunks.withColumn("name", name).withColumn(
        "source_description", F.concat(F.lit("markdown ingest: "), rel)).withColumn(
        "source", F.lit("text"))


def ingest_dry_run(files: DataFrame, text_col: str = "text") -> DataFrame:
    """OP-09: files found and episodes a run would create (zero-chunk files count)."""
    return files.select(F.size(chunk_array(F.col(text_col))).alias("_n")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("_n").cast("long").alias("episodes"))


def path_order_key(rel_col: str = "rel_path"):
    """OP-S3: Python sorts paths by component, i.e. array order of the parts."""
    return F.split(F.col(rel_col), "/")
