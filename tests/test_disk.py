"""What large jobs keep on disk: shuffle files go once their rows are written, and
steps that can do without a shuffle have none."""

import datetime as dt
import os
from functools import reduce

import pytest
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from stockwise.operators import ingest as I
from stockwise.operators import stored as ST
from stockwise.operators import upsert as U
from stockwise.session import shared_path
from stockwise.sources import files as S
from stockwise.sources import views as V


def _shuffles(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


def _rows(df):
    return sorted(map(str, df.collect()))


def _local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def _part_files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-") and f.endswith(".parquet")]


@pytest.fixture()
def sales(spark, tmp_path):
    """Lines of five years in three files, some keys repeated."""
    rows = [(f"F{i % 90}", f"SKU-{i % 7}", str(i % 4), dt.date(1996 + i % 5, 1 + i % 12, 1 + i % 28), float(i), 1.0 + i % 9, 2.0 * i, f"x{i % 5}")
            for i in range(600)]
    df = spark.createDataFrame(rows, "salesinvoiceid string, items_product_sku string, docnumber string, issueddate date, total_total double, "
                                     "items_quantity double, items_unitprice double, note string")
    df.coalesce(3).write.parquet(f"{tmp_path}/sales")
    return spark.read.parquet(f"{tmp_path}/sales")


KEYS = ["salesinvoiceid", "items_product_sku"]


def test_a_stored_view_leaves_no_shuffle_files(spark, sales, monkeypatch):
    key, seen, write = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (seen.append(spark.conf.get(key)), write(self, *a, **b))[1])
    before, set_before = _shuffles(spark), spark.conf.get(key)
    kept = V.materialise(sales.repartition(5, "items_product_sku"), (f"test-{id(sales)}", "sales_test"), sort_col="issueddate")
    assert _rows(kept) == _rows(sales)
    assert not _shuffles(spark) - before and seen == ["true"] and spark.conf.get(key) == set_before


def test_last_rows_are_dealt_by_number(spark, sales):
    whole = _rows(U.dedup_keep_last(sales, KEYS, ["docnumber"]))
    many = U.dedup_keep_last(sales, KEYS, ["docnumber"], (37,))
    assert len(whole) == len({(r.salesinvoiceid, r.items_product_sku) for r in sales.collect()}) and _rows(many) == whole
    assert "37" in many._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]


def test_years_are_written_without_a_shuffle(spark, sales, tmp_path, monkeypatch):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    conf = spark.conf.get(key)
    for most in (32, 2):
        before = _shuffles(spark)
        monkeypatch.setattr(S, "OPEN_YEARS", most, raising=False)
        out = f"{tmp_path}/years-{most}"
        S.write_by_year(sales, out)
        assert not _shuffles(spark) - before and spark.conf.get(key) == conf
        assert _rows(spark.read.parquet(out).drop("year").select(*sales.columns)) == _rows(sales)
        assert len([d for d in os.listdir(out) if d.startswith("year=")]) == 5
        span = dt.date(1997, 3, 1), dt.date(1998, 9, 30)
        got = S.read_years(spark, out, *span)
        assert _rows(got.drop("year").select(*sales.columns)) == _rows(sales.where(F.col("issueddate").between(*span))) and got.count() > 0
        assert "PartitionFilters: [isnotnull(year" in got._jdf.queryExecution().executedPlan().toString()


def test_an_upsert_merges_some_buckets_at_a_time(spark, sales, tmp_path, monkeypatch):
    batches = shared_path(spark, "stored")
    kept = lambda: {d for d in (os.listdir(_local(batches)) if os.path.isdir(_local(batches)) else []) if d.startswith("batch-")}
    monkeypatch.setattr(ST, "BUCKETS_AT_ONCE", 3, raising=False)
    old, new = sales.where("docnumber < '2'"), sales.where("docnumber >= '1' and total_total > 200")
    with_null = new.unionByName(new.limit(1).withColumn("salesinvoiceid", F.lit(None).cast("string")))
    want = _rows(U.upsert(U.dedup_keep_last(old, KEYS, ["docnumber"]), with_null, KEYS, order=["docnumber"]))
    writes = []
    write = ST.KeyedTable._write
    monkeypatch.setattr(ST.KeyedTable, "_write", lambda self, df: (writes.append(1), write(self, df)))
    parked = kept()
    for size in (8, 40):
        table = ST.KeyedTable(spark, f"{tmp_path}/t{size}", sales.schema, KEYS, buckets=size).create()
        table.upsert(old, order=["docnumber"])
        told = table.upsert(with_null, order=["docnumber"], counts=True).first()
        assert told.total == len({(r.salesinvoiceid, r.items_product_sku) for r in new.collect()}) and told.updated > 0
        table.upsert(with_null, order=["docnumber"])                # again: the same table
        assert _rows(table.read()) == want
        # columns that are left alone go another way
        table.upsert(sales.where("docnumber = '3'").withColumn("note", F.lit("new")), order=["docnumber"], preserve=["items_quantity"])
        assert table.read().count() == len({(r.salesinvoiceid, r.items_product_sku) for r in sales.where("docnumber < '2'").unionByName(new).unionByName(
            sales.where("docnumber = '3'")).collect()}) and table.read().where("note = 'new'").count() > 0
    assert len(writes) > 2 * 4
    assert kept() == parked


def test_written_tables_leave_no_shuffle_files(spark, sales, tmp_path):
    before = _shuffles(spark)
    table = ST.KeyedTable(spark, f"{tmp_path}/t", sales.schema, KEYS, buckets=8)
    assert table.touched(sales.limit(0)) == []
    table._write(table._dealt(table._bucketed(sales)))
    assert _rows(ST.parked(sales.repartition(3, "note"))) == _rows(sales)
    assert not _shuffles(spark) - before


def test_a_sync_keeps_no_batch(spark, sales, tmp_path):
    folder = _local(shared_path(spark, "stored"))
    kept = lambda: {d for d in (os.listdir(folder) if os.path.isdir(folder) else []) if d.startswith("batch-")}
    parked = kept()
    table = ST.KeyedTable(spark, f"{tmp_path}/t", sales.schema, KEYS, buckets=4).create()
    state = ST.SyncState(spark, f"{tmp_path}/state")
    state.set("sales", dt.datetime(1996, 1, 1))
    assert ST.incremental_sync(sales, table, state, "sales", "issueddate", dt.datetime(2002, 1, 1), order=["docnumber"])
    assert not ST.incremental_sync(sales, table, state, "sales", "issueddate", dt.datetime(1990, 1, 1))
    assert _rows(table.read()) == _rows(U.dedup_keep_last(sales, KEYS, ["docnumber"])) and kept() == parked


def test_legacy_lines_leave_the_whole_rows_shuffle_behind(spark, sales):
    product = spark.createDataFrame([(f"SKU-{i}", i) for i in range(6)], "sku string, product_id long")
    known = {r.salesinvoiceid for r in sales.collect()} - {r.salesinvoiceid for r in sales.where("items_product_sku = 'SKU-6'").collect()}
    for parts in ((), (5,)):
        before = _shuffles(spark)
        lines, orders = I.legacy_lines(sales, product, parts), I.legacy_orders(sales, product, parts)
        assert not _shuffles(spark) - before
        assert {r.salesinvoiceid for r in orders.collect()} == known
        want = U.dedup_keep_last(sales, KEYS, ["docnumber"]).where(F.col("salesinvoiceid").isin(list(known)))
        assert sorted((r.product_id, r.quantity, r.unit_price) for r in lines.collect()) == sorted(
            (int(r.items_product_sku[4:]), r.items_quantity, r.items_unitprice) for r in want.collect())


def test_a_feed_is_written_without_a_shuffle(spark, sales, tmp_path):
    from stockwise.plans import streams as P
    from stockwise.streaming import streams as R

    for parts in (1, 3, 60):
        given, feed = f"{tmp_path}/given-{parts}", f"{tmp_path}/feed-{parts}"
        sales.repartition(parts).write.parquet(given)
        frame = reduce(DataFrame.unionByName, [spark.read.parquet(f) for f in _part_files(given)])      # a task a file
        made = _shuffles(spark)
        P._write_feed(frame, feed)
        assert not _shuffles(spark) - made
        assert 2 * R.MAX_FILES < len(_part_files(feed)) <= 2 * P.FEED_FILES
        assert _rows(spark.read.parquet(feed)) == _rows(sales)
    got = R.incremental_upsert(spark, f"{tmp_path}/feed-3", sales.schema, KEYS, ["docnumber"], f"{tmp_path}/table", f"{tmp_path}/checkpoint")
    assert _rows(got) == _rows(U.dedup_keep_last(sales, KEYS, ["docnumber"]))
    assert len(os.listdir(f"{tmp_path}/checkpoint/commits")) >= 3
