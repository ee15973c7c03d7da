"""Sinks and snapshots that survive replays, odd group names and empty tables (OP-06, 07, 08, 45)."""

import pytest

from engram.session import scratch_path
from engram.sinks import snapshot as S
from engram.streaming.pipelines import episodes_sink

EPS = "doc_id long, graph string, group_id string"


def test_group_names_stay_text(spark):
    rows = [(1, "personal", "007"), (2, "personal", ""), (3, "client", None), (4, "client", "2024-01-01")]
    eps, path = spark.createDataFrame(rows, EPS), scratch_path(spark, "episodes")
    S.append_episodes(eps, path)
    got = {r["doc_id"]: r["group_id"] for r in S.read_episodes(spark, path, eps.schema).collect()}
    assert got == {1: "007", 2: "personal", 3: "client", 4: "2024-01-01"}


def test_replayed_epoch_is_stored_once(spark):
    batch = spark.createDataFrame([(1, "personal", True, None), (2, "client", False, "no")], "doc_id long, graph string, accepted boolean, reject_reason string")
    base = scratch_path(spark, "ingest")
    write = episodes_sink(base)
    for epoch in (0, 0, 1):
        write(batch, epoch)
    assert spark.read.parquet(f"{base}/episodes").count() == 2 and spark.read.parquet(f"{base}/rejects").count() == 2


def test_snapshot_replaces_with_empty_tables_and_checks_content(spark):
    full = spark.createDataFrame([(1, "a"), (2, "b")], "uuid long, graph string")
    root, live = scratch_path(spark, "snapshots"), scratch_path(spark, "live")
    S.export_snapshot({"episodes": full, "facts": full.limit(0)}, root, "one")
    S.export_snapshot({"episodes": full, "facts": full}, root, "zero")
    with pytest.raises(FileNotFoundError):
        S.live_path(spark, live, "facts")
    S.restore_snapshot(spark, root, "zero", live, confirm=True)  # live rows that the snapshot does not have
    old = S.live_path(spark, live, "facts")
    S.restore_snapshot(spark, root, "one", live, confirm=True)
    assert spark.read.schema(full.schema).parquet(S.live_path(spark, live, "facts")).count() == 0
    assert spark.read.parquet(S.live_path(spark, live, "episodes")).count() == 2
    assert spark.read.parquet(old).count() == 2      # a reader that is still at the version before
    spark.createDataFrame([(1, "a"), (3, "b")], "uuid long, graph string").write.mode("overwrite").parquet(f"{root}/one/episodes")
    with pytest.raises(RuntimeError):  # same counts, other content
        S.restore_snapshot(spark, root, "one", live, confirm=True)
    assert {r["uuid"] for r in spark.read.parquet(S.live_path(spark, live, "episodes")).collect()} == {1, 2}


def test_failure_between_tables_leaves_the_old_state(spark, monkeypatch):
    old = spark.createDataFrame([(1, "a")], "uuid long, graph string")
    new = spark.createDataFrame([(2, "a"), (3, "b")], "uuid long, graph string")
    root, live = scratch_path(spark, "snapshots"), scratch_path(spark, "live")
    for name, df in (("old", old), ("new", new)):
        S.export_snapshot({"episodes": df, "facts": df}, root, name)
    S.restore_snapshot(spark, root, "old", live, confirm=True)
    whole, calls = S.manifest, []

    def broken(tables):
        calls.append(1)
        if len(calls) == 2:     # after the copy, before the switch
            raise OSError("disk")
        return whole(tables)
    monkeypatch.setattr(S, "manifest", broken)
    with pytest.raises(OSError):
        S.restore_snapshot(spark, root, "new", live, confirm=True)
    monkeypatch.setattr(S, "manifest", whole)
    for t in ("episodes", "facts"):
        assert [r["uuid"] for r in spark.read.parquet(S.live_path(spark, live, t)).collect()] == [1]
    for _ in range(3):          # repeated restores keep one earlier version
        S.restore_snapshot(spark, root, "new", live, confirm=True)
    assert {r["uuid"] for r in spark.read.parquet(S.live_path(spark, live, "facts")).collect()} == {2, 3}
    assert len(S._pointers(spark, live)) == 2


def test_upsert_rewrites_touched_buckets_only(spark):
    path = scratch_path(spark, "ups")
    schema = "uuid long, at int, body string"

    def put(rows):
        S.upsert_episodes(spark.createDataFrame(rows, schema), path, ["at"], buckets=8)

    def files():
        return set(spark.read.parquet(path).inputFiles())
    put([(i, 1, "a") for i in range(100)])
    before = files()
    put([(5, 2, "b"), (5, 3, "c"), (5, 1, "z"), (200, 1, "n")])
    rows = {r["uuid"]: r["body"] for r in spark.read.parquet(path).collect()}
    assert len(rows) == 101 and rows[5] == "c" and rows[200] == "n" and spark.read.parquet(path).count() == 101
    assert len(before - files()) <= 2       # two keys touch two buckets at most
    put([(None, 1, "x"), (None, 1, "x")])
    put([(None, 2, "y"), (5, 1, "late")])   # the last write wins, whatever its time
    out = spark.read.parquet(path).collect()
    assert sum(r["uuid"] is None for r in out) == 3 and {r["uuid"]: r["body"] for r in out}[5] == "late"
    S.upsert_episodes(spark.createDataFrame([], schema), path, ["at"], buckets=8)
    assert spark.read.parquet(path).count() == 104
