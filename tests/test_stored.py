"""Stored keyed tables, persisted watermarks and incremental syncs."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from stockwise.operators import stored as ST


def _files(path):
    return {f"{os.path.basename(d)}/{f}" for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def _rows(spark, rows):
    return spark.createDataFrame(rows, "id long, v string, write_date timestamp")


def day(i, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=i, hours=hour)


def test_only_touched_buckets_are_written(spark):
    path = tempfile.mkdtemp(prefix="sw-keyed-") + "/t"
    first = _rows(spark, [(i, f"v{i}", day(0)) for i in range(200)])
    table = ST.KeyedTable(spark, path, first.schema, ["id"], buckets=8).create(first)
    before = _files(path)
    batch = _rows(spark, [(5, "new", day(1)), (500, "added", day(1)), (None, "skipped", day(1))])
    touched = table.touched(batch.dropna())
    assert 1 <= len(touched) <= 2
    told = table.upsert(batch, order=["write_date"], counts=True).first()
    assert tuple(told) == (2, 1, 1)
    other = {f for f in before if int(f.split("/")[0].split("=")[1]) not in touched}
    assert other and other <= _files(path) and not (before - other) & _files(path)
    want = {i: f"v{i}" for i in range(200)} | {5: "new", 500: "added"}
    assert {r.id: r.v for r in table.read().collect()} == want
    table.upsert(batch, order=["write_date"])              # again: the same table
    table.upsert(_rows(spark, [(5, "late", day(0, -1))]), order=["write_date"])
    table.upsert(batch.limit(0))
    assert {r.id: r.v for r in table.read().collect()} == want and table.read().count() == 201


def test_watermark_moves_after_the_write_only(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="sw-sync-")
    rows = [(i % 40, f"v{i}", day(i // 10, i % 10)) for i in range(200)]
    source = _rows(spark, rows)
    table = ST.KeyedTable(spark, f"{base}/t", source.schema, ["id"], buckets=4).create()
    state = ST.SyncState(spark, f"{base}/state")
    assert state.get("m") is None
    assert ST.incremental_sync(source, table, state, "m", "write_date", day(7))
    first = state.get("m")
    assert first == max(r[2] for r in rows if r[2] <= day(7))

    def fails(*a):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ST.SyncState, "set", fails)
        with pytest.raises(RuntimeError):
            ST.incremental_sync(source, table, state, "m", "write_date", day(15))
    between = sorted(map(tuple, table.read().collect()))
    assert state.get("m") == first                            # written, not advanced
    assert ST.incremental_sync(source, table, state, "m", "write_date", day(15))
    assert sorted(map(tuple, table.read().collect())) == between and state.get("m") > first
    ST.incremental_sync(source, table, state, "m", "write_date", day(30))
    newest = {}
    for k, v, t in rows:
        newest[k] = max(newest.get(k, (t, v)), (t, v))
    assert {r.id: (r.write_date, r.v) for r in table.read().collect()} == newest
    state.set("other", day(3))
    assert state.get("m") == max(r[2] for r in rows) and state.get("other") == day(3)
    assert not ST.incremental_sync(source, table, state, "m", "write_date", day(0))      # the window ends before it starts


def test_the_window_is_pushed_to_the_scan(spark):
    path = tempfile.mkdtemp(prefix="sw-push-") + "/s"
    _rows(spark, [(1, "a", day(1))]).write.parquet(path)
    plan = ST.changed_rows(spark.read.parquet(path), "write_date", (day(0), day(2)))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(write_date" in plan.split("PushedFilters")[1]


def test_rows_in_the_overlap_are_read_again(spark):
    base = tempfile.mkdtemp(prefix="sw-over-")
    early = _rows(spark, [(1, "a", day(1, 12))])
    table = ST.KeyedTable(spark, f"{base}/t", early.schema, ["id"]).create()
    state = ST.SyncState(spark, f"{base}/state")
    ST.incremental_sync(early, table, state, "m", "write_date", day(2))
    late = early.unionByName(_rows(spark, [(2, "late", dt.datetime(2024, 1, 2, 11, 30)), (3, "too late", day(1, 10))]))
    ST.incremental_sync(late, table, state, "m", "write_date", day(2))
    assert {r.id for r in table.read().collect()} == {1, 2}
    assert table.read().where(F.col("id") == 2).first().v == "late"
