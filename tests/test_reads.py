"""Lookups, guards and syncs on small tables."""

from stockwise.operators import domain, ingest, nested
from stockwise.plans.registry import entries
from stockwise.sources import nested as NS
from stockwise.sources.views import Views

SF = "/root/testdata/sf0.001"


def test_partner_lookup_normalises_and_takes_the_smallest_id(spark):
    partner = spark.createDataFrame([
        (3, "Ana", "a@x.cl", "RUT-1", "+56 9 1234 5678", 1), (2, "ANA ", None, "rut-1", None, 1), (1, "Ana", "a@x.cl", "RUT-1", "912345678", 0), (9, "", "", "", "", 1)],
        "partner_id long, name string, email string, vat string, phone string, customer_rank int")
    asked = spark.createDataFrame([(1, "name", " ana"), (2, "vat", "Rut-1 "), (3, "email", "A@X.CL"), (4, "phone", "(9) 1234-5678"), (5, "id", "3"),
                                   (6, "id", "1"), (7, "name", ""), (8, "vat", None), (9, "city", "Ana")], "request_id int, field string, value string")
    got = {r.request_id: r.partner_id for r in ingest.lookup_partners(partner, asked).collect()}
    assert got == {1: 2, 2: 2, 3: 3, 4: 3, 5: 3, 6: None, 7: None, 8: None, 9: None}
    everyone = {r.request_id: r.partner_id for r in ingest.lookup_partners(partner, asked, customers_only=False).collect()}
    assert everyone[6] == 1 and everyone[1] == 1
    assert ingest.lookup_partners(partner, asked.limit(0)).collect() == []


def test_lines_follow_their_orders(spark):
    orders = spark.createDataFrame([(1,), (2,)], "order_id int")
    product = spark.createDataFrame([(10,), (10,)], "product_id int")
    lines = spark.createDataFrame([(1, 10, 2.0, 3.0), (2, 11, None, None), (3, 10, 1.0, 1.0), (2, None, 1.0, 1.0)], "order_id int, product_id int, qty double, unit_price double")
    got = sorted((r.order_id, r.product_id or 0, r.qty, r.unit_price) for r in ingest.sync_lines(lines, orders, product).collect())
    assert got == [(1, 10, 2.0, 3.0), (2, 0, 0.0, 0.0), (2, 0, 1.0, 1.0)]


def test_pos_orders_have_their_own_states(spark):
    rows = [(1, "paid", "Juan Sabaj/1"), (2, "sale", "x"), (3, "invoiced", "x"), (4, "draft", "x"), (5, None, "x")]
    orders = spark.createDataFrame(rows, "order_id int, state string, name string").selectExpr("*", "timestamp'2024-01-05 00:00:00' AS date_order")
    lo, hi = ingest.local_day_range_utc(*(__import__("datetime").date(2024, 1, d) for d in (1, 9)))
    assert {r.order_id: r.team_name for r in ingest.filter_pos_orders(orders, lo, hi).collect()} == {1: "Tienda Sabaj", 3: None}


def test_status_guard_and_sku_reads(spark):
    asked = [("", "status:active"), (None, "status:active"), (" shoes ", "shoes AND status:active"), ("tag:a AND STATUS:draft", "tag:a AND STATUS:draft")]
    frame = spark.createDataFrame([(q,) for q, _ in asked], "q string")
    assert [r[0] for r in frame.select(domain.status_guard(frame.q)).collect()] == [a for _, a in asked]
    product = spark.createDataFrame([("a-1", "n"), ("B-2", "m")], "sku string, name string")
    skus = spark.createDataFrame([("A-1",), ("a-1",), ("c",), (None,)], "sku string")
    assert {r.sku: r.found for r in domain.skus_exist(product, skus).collect()} == {"A-1": True, "a-1": True, "c": False, None: False}
    assert [r.sku for r in domain.products_by_skus(product, skus).collect()] == ["A-1"]


def test_merged_messages_are_sorted_and_whole(spark):
    conversations = NS.conversation_documents(Views(spark, SF))
    rows = nested.merged_messages(conversations).collect()
    keys = [(r.email, r.created_at, r.message_id) for r in rows]
    assert keys == sorted(keys) and len(keys) == len(set(keys)) > 0
    merged = {r.email: r.n_messages for r in nested.merge_by_email(conversations).collect()}
    assert {e: sum(k[0] == e for k in keys) for e in merged} == merged


def test_sql_functions_stay_callable(spark):
    for name, call in (("G1_max_monthly_sales_function", "calculate_max_monthly_sales"), ("G2_latest_unit_price_function", "get_latest_unit_price")):
        entries()[name].fn(spark, SF).count()
        assert spark.sql(f"SELECT {call}('SKU-none') AS x").first().x in (0, None)
