"""Queue admission (OP-46) and access-log typing (OP-02, 20, 21, S2)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from engram.operators import activity as AC
from engram.operators.queue import queue_admission

EV = "group_id string, ts timestamp_ntz, event_id long, kind string"


def loop(rows, cap):
    out, p = {}, {}
    for g, t, i, k in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        q = p.get(g, 0)
        if k == "add":
            out[i] = ("rejected" if cap and q >= cap else "accepted", q)
            if not (cap and q >= cap):
                q += 1
        else:
            out[i] = ("done", q)
            q = max(0, q - 1)
        p[g] = q
    return out


@pytest.mark.parametrize("cap", [0, 1, 3])
def test_admission_matches_loop_across_buckets(spark, cap):
    rnd = random.Random(cap)
    base = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice("ab"), base + dt.timedelta(hours=rnd.randint(0, 24 * 20)), i,
             rnd.choice(["add", "add", "done"])) for i in range(800)]
    rows += [("a", base, 10_000, "add"), ("a", base, 10_001, "add")]  # equal timestamps
    for hot_rows in (10**9, 300):  # 300: group "a" or "b" switches to minute buckets
        got = {r["event_id"]: (r["decision"], r["pending_before"])
               for r in queue_admission(spark.createDataFrame(rows, EV), cap, bucket="day",
                                        hot_rows=hot_rows).collect()}
        assert got == loop(rows, cap), hot_rows


def test_admission_edges(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("g", base, 1, "done"), ("g", base, 2, "add"), ("g", base, 3, "add"), ("g", base, 4, "done"),
            ("g", base, 5, "add")]
    got = {r["event_id"]: r["decision"] for r in queue_admission(spark.createDataFrame(rows, EV), 1).collect()}
    assert got == {1: "done", 2: "accepted", 3: "rejected", 4: "done", 5: "accepted"}


LINES = [
    "", "plain text line", "{broken", "{}", '{"request": {"host": "h:8000"}, "status": 200}',
    '{"request": {"host": "h:8001"}, "status": 0}', '{"request": {"host": "h:8001"}, "status": "200"}',
    '{"request": {"host": "h:8000"}, "status": 200.0}', '{"request": {"host": "h:8000"}, "status": null}',
    '{"request": {"host": "h:8000"}, "status": true}', '{"request": {"host": "nohost"}, "status": 401}',
    '{"request": {"host": "[::1]:8000"}, "status": 503}', '{"request": {"host": "h:9999"}, "status": 404}',
    '  {"request": "notanobject", "status": 200}',
]


def test_log_typing(spark):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(LINES)], "n long, line string")
    got = [(r["tier"], r["klass"]) for r in AC.typed_requests(df, ["n"], 100).orderBy("n").collect()]
    assert got == [("?", "?"), ("personal", "2xx"), ("client", "?"), ("client", "?"), ("personal", "?"),
                   ("personal", "?"), ("personal", "?"), ("?", "4xx"), ("personal", "5xx"), ("?", "4xx"),
                   ("?", "2xx")]


def test_tail_counts_junk(spark):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(LINES)], "n long, line string")
    assert AC.typed_requests(df, ["n"], 3).count() == 3 - 0  # last 3 lines are all JSON
    assert AC.typed_requests(df, ["n"], 14).count() == 11
    assert AC.typed_requests(df, ["n"], 10_000).count() == 11  # fewer lines than N
    rep = AC.activity_report(AC.typed_requests(df, ["n"], 100)).collect()
    assert sum(r["requests"] for r in rep) == 11 and all(r["total"] == 11 for r in rep)
    _ = F


def test_whole_log_tabs_and_repeated_keys(spark):
    lines = ['\t{"request": {"host": "h:8000"}, "status": 200}', '{"status": 401, "status": 200, "request": {"host": "h:8001"}}',
             '{"status": 200} trailing', '{"a": 1} {"b": 2}', "{'status': 200}", '{"status": 200, "status"', "\u00a0{}"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n long, line string")
    got = {r["n"]: (r["tier"], r["klass"]) for r in AC.typed_requests(df).collect()}
    assert got == {0: ("personal", "2xx"), 1: ("client", "2xx"), 6: ("?", "?")}


def test_log_text_source_keeps_line_order(spark, tmp_path):
    from engram.sources.access_log import LINE_ORDER, log_lines

    for name, a in (("a.log", 0), ("b.log", 500)):
        (tmp_path / name).write_text("".join(f"line {a + i}\n" for i in range(500)))
    lines = log_lines(spark, str(tmp_path))
    assert [r["line"] for r in lines.orderBy(*LINE_ORDER).collect()] == [f"line {i}" for i in range(1000)]
    assert {r["line"] for r in AC.tail_lines(lines, LINE_ORDER, 3).collect()} == {"line 997", "line 998", "line 999"}


def test_nothing_may_follow_the_object(spark):
    lines = ['{"status": 200}]', '{"status": 200}] {}', '{"status": 200} {}', '{"status": 200}, 0', '{"status": 200}}',
             '{"status": 200, "status": 401}]', '{"status": 200, "status": 401}', ' {"status": 5} ', "{'status': 3}"]
    got = AC.parse_access_log(spark.createDataFrame([(x,) for x in lines], "line string")).selectExpr("line", "to_json(rec) j")
    assert {r.line: r.j for r in got.collect()} == {lines[6]: '{"status":401}', lines[7]: '{"status":5}'}
