"""WARC: write captures, read archives back, assemble transactions.

Writing: every page becomes a request, a response (or revisit) and a metadata
record; request and metadata name the response in WARC-Concurrent-To. Of pages
with equal payloads of at least ``min_bytes`` bytes the one with the largest id
is the response, the others are revisits that refer to it. The records are SQL
strings written by Spark's text writer whose line separator is the blank line
that ends a WARC record, gzip-compressed and bounded by bytes (``file_bytes``).

Reading: whole archive files go to tasks, which walk them record by record by
Content-Length (payloads may contain anything, blank lines and record headers
included). Assembly groups records by the response they are concurrent to and
emits one nested row per capture; the aggregate keeps one record of each kind
per capture, so no group is collected.

The group with a third of all pages: payload groups are counted with map-side
sums, and their table joins the pages on (digest, salt), ``SALTS`` ways.

Defined results: a null html is an empty payload, a null url an empty target; a
null page id sorts below all others and is written as an empty id; n identical
rows (id and payload) are one capture met n times and give n equal rows; extra
columns are ignored; an empty table gives an archive without records. A request
or metadata record without its response still gives a row (its response null).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from engram.llm.common import query, table
from engram.session import scratch_path

END = "\r\n\r\n"
SALTS = 64
RECORD = ("type string, id string, concurrent_to string, refers_to string, target string, date string, "
          "page string, fields string, payload binary, payload_bytes bigint, payload_digest string, digest_ok boolean")
#: Digits of Spark's conv() in base 32 and of RFC 4648 (fixed values).
_CONV32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(col):
    """Bare upper-case base32 SHA-1 of a string or binary column."""
    hexa = F.sha1(col)
    return F.concat(*[F.translate(F.lpad(F.conv(F.substring(hexa, 1 + 10 * k, 10), 16, 32), 8, "0"), _CONV32, _BASE32)
                      for k in range(4)])


def mark_revisits(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """``page, url, payload, digest, original`` — ``original``: id of the response
    that a revisit refers to, null for responses."""
    p = pages.select(F.col(id_col).alias("page"), F.col("url"),
                     F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    p = p.withColumn("digest", base32_sha1("payload")).withColumn("_salt", F.pmod(F.xxhash64("page"), F.lit(SALTS)))
    groups = (p.filter(F.octet_length("payload") >= min_bytes).groupBy("digest")
              .agg(F.max("page").alias("original"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select("digest", "original", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("_salt")))
    j = p.join(groups, ["digest", "_salt"], "left")
    return j.withColumn("original", F.when(~F.col("page").eqNullSafe(F.col("original")), F.col("original"))).drop("_salt")


def _record(kind: str, headers: list, block) -> F.Column:
    parts = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}")]
    for name, value in headers:
        parts.append(F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value), F.lit("")))
    return F.concat(*parts, F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html",
                  min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", file_bytes: int = 128 << 20) -> None:
    """Write one request, response or revisit, and metadata record per row below ``path``.

    Archives hold about ``file_bytes`` of payload at most (or one page): pages are written by
    size class, so many to a file that the largest of the class still fit."""
    p = mark_revisits(pages, id_col, payload_col, min_bytes)
    size = F.coalesce(F.octet_length("payload"), F.lit(0))
    classes = [(0, file_bytes >> 11), (file_bytes >> 11, file_bytes >> 5), (file_bytes >> 5, 1 << 62)]
    own = F.coalesce(F.octet_length(F.col(payload_col)), F.lit(0))
    there = pages.agg(*[F.count_if((own >= lo) & (own < hi)).alias(f"c{k}") for k, (lo, hi) in enumerate(classes)]).head()
    page = F.coalesce(F.col("page").cast("string"), F.lit(""))

    def urn(kind: str, of=page):
        h = F.md5(F.concat_ws("|", F.lit(kind), of, F.col("digest")))
        return F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
                                               for x in (F.lit("-") if a > 1 else F.lit(""), F.substring(h, a, n))], F.lit(">"))

    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20")
    host = F.regexp_extract(target, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    local = F.regexp_replace(target, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    common = [("WARC-Target-URI", target), ("WARC-Date", F.lit(date)), ("WARC-Page-Number", page)]
    answer = urn("response")
    request = _record("request", [("WARC-Record-ID", urn("request")), ("WARC-Concurrent-To", answer), *common,
                                  ("Content-Type", F.lit("application/http;msgtype=request"))],
                      F.concat(F.lit("GET "), local, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END)))
    about = [("WARC-Record-ID", answer), *common, ("Content-Type", F.lit("application/http;msgtype=response")),
             ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest"))]
    head = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END)
    original = F.col("original").cast("string")
    response = F.when(F.col("original").isNull(), _record("response", about, F.concat(head, "payload"))).otherwise(
        _record("revisit", [*about, ("WARC-Refers-To", urn("response", original)), ("WARC-Refers-To-Page", original),
                            ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                            ("WARC-Payload-Length", F.octet_length("payload").cast("string"))], head))
    metadata = _record("metadata", [("WARC-Record-ID", urn("metadata")), ("WARC-Concurrent-To", answer), *common,
                                    ("Content-Type", F.lit("application/warc-fields"))],
                       F.concat(F.lit("payload-bytes: "), F.octet_length("payload").cast("string"), F.lit("\r\n")))
    for k, (lo, hi) in enumerate(classes):
        if there[f"c{k}"] or k == 0:
            (p.filter((size >= lo) & (size < hi)).select(F.explode(F.array(request, response, metadata)).alias("value")).write.mode("append")
             .option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", 3 * max(1, file_bytes // hi)).text(path))


def records_of(stream):
    """(headers, block) of each record of an open, decompressed archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:60]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        n = int(headers["content-length"])
        block = stream.read(n)
        if len(block) < n:
            raise ValueError("archive ends inside a record")
        yield headers, block


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of all archives below ``path`` (plain or gzip).

    ``payload_bytes`` and ``payload_digest`` are taken from the bytes read (from
    the headers for revisits); ``digest_ok`` compares them with the header.
    ``payload=False`` leaves the bytes themselves out once they are measured.
    """
    schema = StructType.fromDDL(RECORD)
    arrow = to_arrow_schema(schema)

    def row(h: dict, block: bytes) -> dict:
        kind, body = h.get("warc-type"), None
        stated = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
        out = {"type": kind, "id": h.get("warc-record-id"), "concurrent_to": h.get("warc-concurrent-to"),
               "refers_to": h.get("warc-refers-to-page") or None, "target": h.get("warc-target-uri"), "date": h.get("warc-date"),
               "page": h.get("warc-page-number") or None, "payload_digest": stated}
        if kind == "response":
            body = block.partition(b"\r\n\r\n")[2] if h.get("content-type", "").startswith("application/http") else block
            digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
            out |= {"payload_bytes": len(body), "payload_digest": digest, "digest_ok": stated in (None, digest)}
        elif kind == "revisit" and h.get("warc-payload-length"):
            out["payload_bytes"] = int(h["warc-payload-length"])
        elif kind in ("request", "metadata"):
            out["fields"] = block.decode("utf-8", "replace")
        return out | {"payload": body if payload else None}

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                raw = pa.BufferReader(content.as_buffer())
                zipped = bytes(content.as_buffer()[:2]) == b"\x1f\x8b"
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if zipped else raw)
                rows, size = [], 0
                for h, block in records_of(stream):
                    rows.append(row(h, block))
                    size += len(block)
                    if size > 8 << 20 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture, times, request, response, metadata``.

    The capture is the response's record id; request and metadata records join it
    through ``concurrent_to``. Records that are neither are left out."""
    body = F.struct(*[c for c in records.columns if c != "concurrent_to"])
    kind = F.col("type")
    r = (records.filter(kind.isin("request", "response", "revisit", "metadata"))
         .withColumn("capture", F.when(kind.isin("response", "revisit"), F.col("id"))
                     .otherwise(F.coalesce("concurrent_to", "id"))))
    is_answer = kind.isin("response", "revisit")
    g = r.groupBy("capture").agg(
        F.greatest(F.sum(is_answer.cast("bigint")), F.lit(1)).alias("times"),
        F.first(F.when(kind == "request", body), ignorenulls=True).alias("request"),
        F.first(F.when(is_answer, body), ignorenulls=True).alias("response"),
        F.first(F.when(kind == "metadata", body), ignorenulls=True).alias("metadata"))
    return g.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("_copy", "times")


def digests(captures: DataFrame) -> DataFrame:
    """One row per page of :func:`assemble`'s captures."""
    r = F.col("response")
    return captures.select(
        r["page"].cast("bigint").alias("page_id"), r["payload_bytes"].alias("payload_bytes"),
        r["payload_digest"].alias("payload_digest"), r["type"].alias("record_type"),
        r["refers_to"].cast("bigint").alias("refers_to"), F.col("request.target").alias("target"),
        F.col("metadata.fields").isNotNull().alias("has_metadata"))


@query("op9_warc")
def op9_warc(spark: SparkSession, data_dir: str) -> DataFrame:
    """Write all pages as archives, read them back, assemble, one row per page."""
    path = scratch_path(spark, "llm", "warc")
    write_archive(table(spark, data_dir, "pages"), path)
    return digests(assemble(read_archive(spark, path, payload=False)))
