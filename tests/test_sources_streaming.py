"""Markdown scan, snapshots, eval-case files, ontology, streams (OP-01, 03, 04, 06..08, 15, 45..48)."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from engram.operators import ontology as O
from engram.operators.queue import queue_admission
from engram.sinks.snapshot import append_episodes, export_snapshot, live_path, restore_snapshot
from engram.sources.markdown import load_eval_cases, markdown_scan
from engram.streaming import pipelines as P
from engram.streaming.runner import file_stream, run_available_now, run_foreach_batch, run_in_parts


def test_markdown_scan(spark):
    root = tempfile.mkdtemp(prefix="md-")
    os.makedirs(f"{root}/a")
    with open(f"{root}/a/b.md", "wb") as f:
        f.write(b"# T\r\nline\rnext \xff end")
    with open(f"{root}/a-b.md", "wb") as f:
        f.write("# ü\n".encode())
    with open(f"{root}/skip.txt", "wb") as f:
        f.write(b"x")
    rows = {r["rel_path"]: r["text"] for r in markdown_scan(spark, root).collect()}
    assert rows == {"a/b.md": "# T\nline\nnext � end", "a-b.md": "# ü\n"}
    with pytest.raises(FileNotFoundError):
        markdown_scan(spark, tempfile.mkdtemp(prefix="empty-"))


def test_snapshot_round_trip(spark):
    from engram.session import scratch_path

    eps = spark.createDataFrame([("personal", "g", 1), ("client", None, 2)], "graph string, group_id string, uuid long")
    root = scratch_path(spark, "snaps")
    man = {(r["table"], r["graph"]): r["rows"] for r in export_snapshot({"episodes": eps}, root, "s1").collect()}
    assert man == {("episodes", "personal"): 1, ("episodes", "client"): 1}
    target = scratch_path(spark, "live")
    with pytest.raises(PermissionError):
        restore_snapshot(spark, root, "s1", target)
    with pytest.raises(FileNotFoundError):
        restore_snapshot(spark, root, "missing", target, confirm=True)
    restore_snapshot(spark, root, "s1", target, confirm=True)
    assert spark.read.parquet(live_path(spark, target, "episodes")).count() == 2
    sink = scratch_path(spark, "sink")
    append_episodes(eps, sink)
    append_episodes(eps, sink)
    assert spark.read.parquet(sink).count() == 4


def test_eval_case_file(spark):
    p = tempfile.mkdtemp(prefix="ev-") + "/q.jsonl"
    with open(p, "w") as f:
        f.write('{"query": "a", "expect": ["x"]}\n{"query": "b"}\n')
    rows = sorted((r["query"], r["expect"]) for r in load_eval_cases(spark, p).collect())
    assert rows == [("a", ["x"]), ("b", [])]
    e = tempfile.mkdtemp(prefix="ev-") + "/empty.jsonl"
    open(e, "w").close()
    with pytest.raises(ValueError):
        load_eval_cases(spark, e)


def test_typed_attributes_and_ontology(spark):
    df = spark.createDataFrame([('{"k": 5, "w": "x", "extra": 1}',), ('{"k": "bad"}',), ("not json",)], "p string")
    rows = O.typed_attributes(df, "p", [("k", "int"), ("w", "float"), ("z", "weird")]).collect()
    assert [(r["k"], r["w"], r["z"]) for r in rows] == [(5, None, None), (None, None, None), (None, None, None)]
    ont = O.ontology_frame(spark)
    assert ont.filter("graph = 'personal'").count() == 9 and ont.filter("graph = 'client'").count() == 9
    assert O.attribute_schema([("a", "int"), ("b", "date")]).simpleString() == "struct<a:bigint,b:string>"


def test_rule_extract_priority_and_fallback(spark):
    df = spark.createDataFrame([(1, "personal", "I prefer tea. We decided to ship."), (2, "personal", "nothing"),
                                (3, "client", "It must have logs.")], "doc_id long, graph string, episode_body string")
    got = sorted((r["doc_id"], r["entity_type"], r["value"]) for r in O.rule_extract(df).collect())
    assert got == [(1, "Preference", "tea"), (2, "Topic", None), (3, "Requirement", "logs")]


def test_stream_admission_equals_batch_over_many_files(spark):
    from engram.session import scratch_path

    base = dt.datetime(2024, 1, 1)
    rows = [("g%d" % (i % 3), base + dt.timedelta(minutes=i), i, "done" if i % 4 == 0 else "add")
            for i in range(120)]
    src = scratch_path(spark, "qsrc")
    schema = "group_id string, ts timestamp_ntz, event_id long, kind string"
    df = spark.createDataFrame(rows, schema)
    for k in range(4):  # files arrive in time order
        df.filter((F.col("event_id") >= k * 30) & (F.col("event_id") < (k + 1) * 30)).coalesce(1) \
          .write.mode("append").parquet(src)
    base = scratch_path(spark, "qtest")
    run_foreach_batch(file_stream(spark, src, df.schema, max_files_per_trigger=1), "qtest", P.admission_batches(base, 2))
    out = spark.read.parquet(f"{base}/decisions")
    assert out.select("epoch").distinct().count() == 4
    got = {r["event_id"]: (r["decision"], r["pending_before"]) for r in out.collect()}
    exp = {r["event_id"]: (r["decision"], r["pending_before"]) for r in queue_admission(df, 2).collect()}
    assert got == exp
    # a replayed epoch starts from the counts of the one before and writes the same again
    last = df.filter("event_id >= 90")
    P.admission_batches(base, 2)(last, 3)
    assert {r["event_id"]: (r["decision"], r["pending_before"]) for r in spark.read.parquet(f"{base}/decisions").collect()} == exp


def test_ingest_over_resumed_micro_batches_with_a_hot_group(spark):
    """Counts are carried over restarts; equal to one pass over the arrivals in order."""
    from engram.session import scratch_path

    schema = ("doc_id long, graph string, name string, episode_body string, source string, "
              "source_description string, group_id string, agent_id string")
    rows = [(i, "client" if i % 3 else "personal", str(i), "secret" if i % 11 == 0 else f"body {i}", "text", "d",
             [None, "hot", "hot", "p"][i % 4], None) for i in range(400)]
    df, base = spark.createDataFrame(rows, schema), scratch_path(spark, "hot")
    caps = {"client": 30, "personal": 7}
    run_in_parts(df, "hot", [F.col("doc_id") % 3 == k for k in (2, 0, 1)], lambda s: P.ingest_stream(s, {"client": "secret"}), P.ingest_batches(base, caps))
    want, count = {}, {}
    for r in sorted(rows, key=lambda r: ((r[0] % 3 - 2) % 3, r[0])):
        key = (r[1], r[6] or r[1])
        if r[1] == "client" and "secret" in r[3]:
            want[r[0]] = "tier guard: matches reject_pattern"
        elif count.get(key, 0) >= caps[r[1]]:
            want[r[0]] = f"queue full for group {key[1]} ({caps[r[1]]} pending)"
        else:
            want[r[0]], count[key] = None, count.get(key, 0) + 1
    got = {r["doc_id"]: None for r in spark.read.parquet(f"{base}/episodes").collect()}
    got |= {r["doc_id"]: r["reject_reason"] for r in spark.read.parquet(f"{base}/rejects").collect()}
    assert got == want and len([w for w in want.values() if w]) > 100
    left = {tuple(r["queue"].split("\u001f")): r["pending"] for r in spark.read.parquet(f"{base}/pending/epoch=2").collect()}
    assert left == count


def test_dedup_stream(spark):
    from engram.session import scratch_path

    src = scratch_path(spark, "dsrc")
    df = spark.createDataFrame([("g", 1, "Hello"), ("g", 2, "hello "), ("g", 3, "stored")],
                               "graph string, doc_id long, episode_body string")
    df.write.parquet(src)
    store = spark.createDataFrame([("g", "STORED")], "graph string, episode_body string")
    out = run_available_now(P.dedup_stream(file_stream(spark, src, df.schema), store, ["graph"])
                            .select("graph", "text_key"), "dtest")
    assert spark.read.parquet(out).count() == 1


def test_activity_stream_and_alerts(spark):
    from engram.session import scratch_path

    src = scratch_path(spark, "logsrc")
    base = 1704067200  # 2024-01-01 00:00:00 UTC
    lines = [f'{{"ts": {base + 60 * i}, "request": {{"host": "h:8000"}}, "status": {401 if i % 3 == 0 else 200}}}'
             for i in range(300)] + ["junk line"]
    spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1).write.text(src)
    stream = spark.readStream.text(src).withColumnRenamed("value", "line")
    out = run_available_now(P.activity_stream(stream, "1 hour", "10 minutes"), "acttest")
    w = spark.read.parquet(out)
    # 5 hours of traffic, the last hour is still open at the end (append mode)
    assert w.select("window_start").distinct().count() == 4
    r = w.filter("window_start = 1704067200 AND klass = '4xx'").first()
    assert (r["requests"], r["unauthorized"]) == (20, 20)
    assert P.unauthorized_alerts(w, 20).count() == 4


def test_one_alert_per_outage(spark):
    """An outage is reported once, when it is over; other requests move time on."""
    from engram.session import scratch_path
    from engram.sources.access_log import log_stream
    from engram.streaming.runner import run_resumed

    base, src = 1704067200, scratch_path(spark, "outages")

    def line(minute, status, port=8000):
        return f'{{"ts": {base + 60 * minute}, "request": {{"host": "h:{port}"}}, "status": {status}}}'
    first = [line(m, 401) for m in (0, 5, 9)] + [line(3, 401, 8001), line(20, 200), "junk"]
    second = [line(12, 401), line(100, 200), line(101, 401), line(102, 401, 8001)]
    third = [line(110, 401), line(118, 401), line(300, 200, 8001)]
    out = ckpt = None
    seen = []
    for part in (first, second, third):
        spark.createDataFrame([(x,) for x in part], "line string").coalesce(1).write.mode("append").text(src)
        out, ckpt = run_resumed(P.unauthorized_outages(log_stream(spark, src), "15 minutes", 3, "5 minutes"), "outages", out, ckpt)
        seen.append(sorted((r["tier"], (r["opened"] - base) // 60, (r["last_seen"] - base) // 60, r["unauthorized"]) for r in spark.read.parquet(out).collect()))
    assert seen[0] == [] and seen[1] == [("personal", 0, 12, 4)] and seen[2] == [("personal", 0, 12, 4), ("personal", 101, 118, 3)]


def test_ingest_stream_order_and_backpressure(spark):
    from engram.session import scratch_path

    src = scratch_path(spark, "wsrc")
    rows = [(i, "client" if i < 6 else "personal", str(i), "body %d" % i, "text", "desc", "g", "a" if i % 2 else None)
            for i in range(10)]
    rows.append((10, "client", "10", "secret stuff", "text", "desc", "g", None))  # refused by the guard
    schema = ("doc_id long, graph string, name string, episode_body string, source string, "
              "source_description string, group_id string, agent_id string")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(src)
    stream = file_stream(spark, src, spark.read.parquet(src).schema)
    base = scratch_path(spark, "ingtest")
    run_foreach_batch(P.ingest_stream(stream, {"client": "secret"}), "ingtest", P.ingest_batches(base, {"client": 2, "personal": 0}))
    got = {r["doc_id"]: (True, None, r["effective_source_description"]) for r in spark.read.parquet(f"{base}/episodes").collect()}
    got |= {r["doc_id"]: (False, r["reject_reason"], r["effective_source_description"]) for r in spark.read.parquet(f"{base}/rejects").collect()}
    assert [d for d in range(11) if got[d][0]] == [0, 1, 6, 7, 8, 9]
    assert got[2][1] == "queue full for group g (2 pending)"
    assert got[10][1].startswith("tier guard")
    assert got[1][2] == "[agent:a] desc" and got[0][2] == "desc"


def test_ontology_yaml_loader(spark):
    p = tempfile.mkdtemp(prefix="ont-") + "/tier.yaml"
    with open(p, "w") as f:
        f.write("server: {port: 1}\nmemory:\n  entity_types:\n    - name: Decision\n      description: d\n"
                "      fields:\n        - name: rationale\n        - name: score\n          type: float\n"
                "        - name: when\n          type: date\n    - name: Topic\n      description: t\n")
    rows = {r["entity_type"]: r["fields"] for r in O.load_ontology_yaml(spark, p, "personal").collect()}
    assert [(x["name"], x["type"]) for x in rows["Decision"]] == [("rationale", "str"), ("score", "float"), ("when", "str")]
    assert rows["Topic"] == []
