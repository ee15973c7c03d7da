import base64
import gzip
import hashlib
import io

import pytest

from engram.llm import warc
from engram.session import scratch_path

PAGES = "page_id bigint, url string, html string"
TRICK = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n"
ROWS = [(1, "http://a.example/x?y=1", "<p>one</p>"), (2, None, "<p>one</p>"), (7, "no url\r\nInjected: 1", "<p>one</p>"), (3, "http://b", None),
        (4, "http://c", ""), (5, "http://é/ü", TRICK), (6, "x", "é" * 70000), (None, "u", "nul"), (9, "u", "twice"), (9, "u", "twice")]


def expected(rows, min_bytes=0):
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        same = [j for j, _, g in rows if (g or "").encode() == b and j is not None]
        top = max(same) if same and len(b) >= min_bytes else i
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "response" if top == i else "revisit", None if top == i else top))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes,file_bytes", [(0, 128 << 20), (5, 4096)])
def test_round_trip(spark, min_bytes, file_bytes):
    path = scratch_path(spark, "warc-test")
    pages = spark.createDataFrame([(*r, "z") for r in ROWS], PAGES + ", digest string")
    warc.write_archive(pages, path, min_bytes=min_bytes, file_bytes=file_bytes)
    rows = warc.assemble(warc.read_archive(spark, path)).collect()
    got = sorted(((int(r.response.page) if r.response.page else None, r.response.payload_bytes, r.response.payload_digest, r.response.type,
                   int(r.response.refers_to) if r.response.refers_to else None) for r in rows), key=str)
    assert got == expected(ROWS, min_bytes)
    flat = warc.digests(warc.assemble(warc.read_archive(spark, path, payload=False))).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in flat), key=str) == got
    bodies = {r.response.page: bytes(r.response.payload) for r in rows if r.response.type == "response"}
    assert bodies["5"].decode() == TRICK and bodies["6"].decode() == "é" * 70000
    assert all(r.response.digest_ok is not False and r.request is not None and r.metadata is not None for r in rows)
    assert {r.request.target for r in rows if r.response.page == "7"} == {"no%20url%20%20Injected:%201"}


def test_empty_table(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archive(spark.createDataFrame([], PAGES), path)
    assert warc.assemble(warc.read_archive(spark, path)).collect() == []


def _plain(records):
    return b"".join(b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in h.items()).encode()
                    + f"Content-Length: {len(b)}\r\n\r\n".encode() + b + b"\r\n\r\n" for h, b in records)


def test_foreign_archives(spark, tmp_path):
    recs = [({"WARC-Type": "warcinfo", "WARC-Record-ID": "<i>"}, b"software: x"),
            ({"WARC-Type": "request", "WARC-Record-ID": "<q>", "WARC-Concurrent-To": "<r>"}, b"GET / HTTP/1.1\r\n\r\n"),
            ({"WARC-Type": "response", "WARC-Record-ID": "<r>", "Content-Type": "application/http; msgtype=response"}, b"HTTP/1.1 200 OK\r\n\r\nbody"),
            ({"WARC-Type": "metadata", "WARC-Record-ID": "<m>", "WARC-Concurrent-To": "<lost>"}, b"k: v")]
    (tmp_path / "a.warc").write_bytes(_plain(recs[:3]))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(_plain(recs[3:])))
    rows = {r.capture: r for r in warc.assemble(warc.read_archive(spark, f"file://{tmp_path}")).collect()}
    assert set(rows) == {"<r>", "<lost>"}
    assert bytes(rows["<r>"].response.payload) == b"body" and rows["<r>"].request.id == "<q>"
    assert rows["<lost>"].response is None and rows["<lost>"].metadata.fields == "k: v"


def test_cut_archive_raises():
    whole = _plain([({"WARC-Type": "metadata"}, b"0123456789")])
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(whole[:-9])))


def test_archives_are_bounded_by_bytes(spark):
    import random

    path, r = scratch_path(spark, "warc-test"), random.Random(2)
    rows = [(i, "http://a", "".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=60_000))) for i in range(20)] + [(100 + i, "u", f"small {i}") for i in range(50)]
    warc.write_archive(spark.createDataFrame(rows, PAGES).coalesce(1), path, file_bytes=200_000)
    sizes = [x.length for x in spark.read.format("binaryFile").load(path).select("length").collect()]
    assert max(sizes) < 200_000 and len(sizes) >= 7      # no file holds more than a few of the large pages
    assert warc.assemble(warc.read_archive(spark, path, payload=False)).count() == 70
