"""Upsert, delete, snapshot and ingest cases (FIXTURES.md sections 1, 2, 3, 5, 11)."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from stockwise.operators import ingest as I
from stockwise.operators import inventory as INV
from stockwise.operators import upsert as U
from stockwise.sources.files import SALES_SCHEMA

ROW = ("HIST-001", "Factura", "1", 101, "Cust A", "VAT-A", None, "Term A", "WH-A", 100.0, 19.0, 119.0, "Prod A",
       "SKU-A", 2.0, 50.0, dt.date(2023, 1, 15), "Channel A")


def test_sales_upsert_updates_in_place(spark):
    target = spark.createDataFrame([ROW], SALES_SCHEMA)
    upd = list(ROW)
    upd[9], upd[10], upd[11], upd[12], upd[14] = 150.0, 28.5, 178.5, "Prod A Updated", 3.0
    source = spark.createDataFrame([tuple(upd)], SALES_SCHEMA)
    keys = ["salesinvoiceid", "items_product_sku"]
    counts = U.upsert_counts(target, source, keys).first()
    assert (counts.total, counts.new, counts.updated) == (1, 0, 1)
    merged = U.upsert(target, source, keys, order=["docnumber"])
    rows = merged.collect()
    assert len(rows) == 1 and rows[0].items_quantity == 3.0
    # idempotent: applying the same batch again gives the same table
    again = U.upsert(merged, source, keys, order=["docnumber"]).collect()
    assert again == rows


def test_catalogue_upsert_no_duplicate_skus(spark):
    t = spark.createDataFrame([("TEST-DUP-001", 100.0), ("TEST-DUP-002", 200.0)], "sku string, list_price double")
    s = spark.createDataFrame([("TEST-DUP-001", 175.0), ("TEST-DUP-003", 300.0), ("TEST-DUP-002", 275.0)],
                              "sku string, list_price double")
    out = {r.sku: r.list_price for r in U.upsert(t, s, ["sku"]).collect()}
    assert out == {"TEST-DUP-001": 175.0, "TEST-DUP-002": 275.0, "TEST-DUP-003": 300.0}


def test_null_keys_skipped_and_preserve(spark):
    t = spark.createDataFrame([("A", "keep", 1.0)], "sku string, embedding string, price double")
    s = spark.createDataFrame([("A", "new", 2.0), (None, "x", 9.0)], "sku string, embedding string, price double")
    rows = U.upsert(t, s, ["sku"], preserve=["embedding"]).collect()
    assert [(r.sku, r.embedding, r.price) for r in rows] == [("A", "keep", 2.0)]


def test_delete_policies(spark):
    local = spark.createDataFrame([(1, True), (2, True)], "id long, is_active boolean")
    remote = spark.createDataFrame([(1,)], "id long")
    marked = {r.id: r.is_active for r in U.apply_deletes(local, remote, "id", "mark_inactive").collect()}
    assert marked == {1: True, 2: False}
    assert [r.id for r in U.apply_deletes(local, remote, "id", "delete").collect()] == [1]
    # incremental sync never deletes
    assert U.apply_deletes(local, remote, "id", "delete", full_sync=False).count() == 2


def test_sync_window_rule():
    now = dt.datetime(2024, 5, 1, 12)
    assert U.sync_window(now, None) == (now - dt.timedelta(days=30), now)
    assert U.sync_window(now, dt.datetime(2024, 4, 30), full=True)[0] == now - dt.timedelta(days=90)
    assert U.sync_window(now, dt.datetime(2024, 5, 1, 10))[0] == dt.datetime(2024, 5, 1, 9)
    assert U.sync_window(now, dt.datetime(2024, 5, 2)) is None


def test_snapshot_same_day_rerun_overwrites(spark):
    path = tempfile.mkdtemp(prefix="sw-snap-")
    day = dt.date(2024, 1, 10)
    q1 = spark.createDataFrame([(100, 7, 11, 5.0), (101, 7, 22, 7.0)], "odoo_id long, product_id long, location_id long, quantity double")
    INV.write_snapshot(INV.daily_stock_snapshot(q1, day), path)
    q2 = spark.createDataFrame([(100, 7, 11, 5.0), (101, 7, 22, 3.0)], "odoo_id long, product_id long, location_id long, quantity double")
    INV.write_snapshot(INV.daily_stock_snapshot(q2, day), path)
    got = sorted(r.quantity for r in spark.read.parquet(path).collect())
    assert got == [3.0, 5.0]


def test_legacy_invoice_with_unknown_sku_dropped(spark):
    rows = [("F1", "1", "SKU-A", 1.0, 10.0, dt.date(2024, 1, 1), 10.0),
            ("F1", "2", "SKU-A", 2.0, 10.0, dt.date(2024, 1, 2), 20.0),
            ("F2", "1", "SKU-A", 1.0, 10.0, dt.date(2024, 1, 3), 10.0),
            ("F2", "1", "SKU-X", 1.0, 10.0, dt.date(2024, 1, 3), 10.0)]
    st = spark.createDataFrame(rows, "salesinvoiceid string, docnumber string, items_product_sku string, "
                                     "items_quantity double, items_unitprice double, issueddate date, total_total double")
    prod = spark.createDataFrame([("SKU-A", 1)], "sku string, product_id long")
    orders = I.legacy_orders(st, prod).collect()
    assert [o.salesinvoiceid for o in orders] == ["F1"]
    lines = I.legacy_lines(st, prod).collect()
    assert len(lines) == 1 and lines[0].quantity == 2.0   # highest docnumber kept


def test_canonical_partners(spark):
    p = spark.createDataFrame([(1, "V1", dt.datetime(2024, 1, 1)), (2, "V1", dt.datetime(2024, 2, 1)),
                               (3, None, dt.datetime(2024, 1, 1))], "partner_id long, vat string, write_date timestamp")
    _, remap = I.canonical_partners(p)
    assert {r.partner_id: r.canonical_id for r in remap.collect()} == {1: 2, 2: 2, 3: 3}


def test_uom_roots_pointer_jumping(spark):
    u = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, None), (6, 5)], "uom_id long, parent_id long")
    assert {r.uom_id: r.root_id for r in I.uom_roots(u).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5}


def test_uom_roots_with_cycles_and_tails(spark):
    """A walk ends in front of the unit that it would meet again."""
    u = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 6), (6, 5), (7, 1), (8, 8), (9, 8), (10, 99)], "uom_id long, parent_id long")
    assert {r.uom_id: r.root_id for r in I.uom_roots(u).collect()} == {1: 3, 2: 1, 3: 2, 5: 6, 6: 5, 7: 3, 8: 8, 9: 8, 10: 99}


def test_rejection_report(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(["", "None", "False", "A", "", "", ""])],
                               "product_id long, sku string")
    rep = {r.reason: (r.n, r.examples) for r in U.rejection_report(df, "sku", "product_id").collect()}
    assert rep["empty"] == (4, "0,4,5") and rep["none"] == (1, "1") and rep["false"] == (1, "2")
    assert F is not None


def test_upsert_keeps_newer_target_rows(spark):
    """A late, older source row does not replace the target's newer one."""
    target = spark.createDataFrame([(1, "new", 2), (2, "old", 1)], "id int, v string, write_date int")
    source = spark.createDataFrame([(1, "late", 1), (2, "next", 2), (3, "first", 1)], "id int, v string, write_date int")
    out = U.upsert(target, source, ["id"], order=["write_date"])
    assert sorted(map(tuple, out.collect())) == [(1, "new", 2), (2, "next", 2), (3, "first", 1)]
    again = U.upsert(out, source, ["id"], order=["write_date"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_whole_rows_are_replaced_in_one_shuffle(spark):
    rows = [(1, 5, "a"), (1, 3, "b"), (2, 1, "c"), (2, 1, "c"), (None, 9, "n"), (None, 9, "n"), (3, 7, "t")]
    new = [(1, 5, "0"), (1, 4, "z"), (3, 6, "old"), (4, None, "x"), (4, 1, "y"), (None, 1, "skipped")]
    target, source = (spark.createDataFrame(r, "k int, o int, v string") for r in (rows, new))
    want = [(1, 5, "0"), (2, 1, "c"), (2, 1, "c"), (3, 7, "t"), (4, 1, "y"), (None, 9, "n"), (None, 9, "n")]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or 0, r[2])
    out = U.upsert(target, source, ["k"], order=["o"])
    assert sorted(map(tuple, out.collect()), key=key) == want
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1
    plain = U.upsert(target, source, ["k"])
    assert {tuple(r) for r in plain.where("k IN (1, 3, 4)").collect()} == {(1, 5, "0"), (3, 6, "old"), (4, 1, "y")}


def test_large_tables_get_more_buckets_and_partitions(spark, monkeypatch):
    from stockwise.operators import stored
    from stockwise.sources import views as V

    assert stored.buckets_for(10) == stored.BUCKETS and stored.buckets_for(216_000_000) == 864
    assert V.spread_for(spark.range(1000)) == ()
    monkeypatch.setattr(V, "TASK_ROWS", 10)
    assert V.spread_for(spark.range(1000)) == (100,)
    few = V.Views(spark, "/root/testdata/sf0.001").sales_items_plan
    whole = few.collect()
    monkeypatch.setattr(V, "TASK_ROWS", 10 ** 9)
    assert sorted(map(str, whole)) == sorted(map(str, V.Views(spark, "/root/testdata/sf0.001").sales_items_plan.collect()))
