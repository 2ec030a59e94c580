"""Registered source queries (S1-S14): data derived from the given tables is
written to the shared folder and read back through each source."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from stockwise.plans.common import views
from stockwise.plans.nested import D1_SQL
from stockwise.plans.registry import register
from stockwise.session import shared_path
from stockwise.sources import files as S
from stockwise.sources import nested as NS
from stockwise.sources.views import spread_for

COLS = ", ".join(S.SALES_COLUMNS)


def _scratch(spark, name: str) -> str:
    return shared_path(spark, f"sources/{name}-{uuid.uuid4().hex[:10]}")


def _sales_csv(spark, sf_dir, header: bool) -> str:
    path = _scratch(spark, "sales-csv")
    views(spark, sf_dir).sales_items.select(*S.SALES_COLUMNS).write.option("header", header).csv(path)
    return path


@register("S1_read_sales_csv", oracle=f"SELECT {COLS} FROM sales_items")
def s1_csv(spark, sf_dir):
    return S.read_sales_csv(spark, _sales_csv(spark, sf_dir, header=False))


@register("S2_read_sales_csv_header_auto", oracle=f"SELECT {COLS} FROM sales_items")
def s2_csv_auto(spark, sf_dir):
    return S.read_sales_csv(spark, _sales_csv(spark, sf_dir, header=True), header="auto")


@register("S3_validate_csv", oracle="SELECT count(*) AS rows, 18 AS columns, 0 AS corrupt FROM sales_items")
def s3_validate(spark, sf_dir):
    return S.validate_csv(spark, _sales_csv(spark, sf_dir, header=False))


@register("S7_year_partitioned_scan", oracle="""
SELECT * , year(issueddate) AS year FROM sales_items
WHERE issueddate BETWEEN DATE '1999-11-15' AND DATE '2000-02-14'""")
def s7_years(spark, sf_dir):
    path = _scratch(spark, "sales-by-year")
    S.write_by_year(views(spark, sf_dir).sales_items, path)
    return S.read_years(spark, path, dt.date(1999, 11, 15), dt.date(2000, 2, 14))


@register("S8_date_bounds", oracle="""
SELECT min(issueddate) AS min_date, max(issueddate) AS max_date, count(*) AS rows FROM sales_items
WHERE items_quantity > 0""")
def s8_bounds(spark, sf_dir):
    return S.date_bounds(views(spark, sf_dir).sales_items)


@register("S9_read_since", oracle="""
SELECT partner_id, name, vat FROM partner WHERE supplier_rank > 0 AND write_date > TIMESTAMP '1994-12-31 00:30:00'""")
def s9_since(spark, sf_dir):
    p = views(spark, sf_dir).partner
    return S.read_since(p, ["partner_id", "name", "vat"], F.col("supplier_rank") > 0, "write_date",
                        dt.datetime(1994, 12, 31, 0, 30))


@register("S10_relay_pages_json", oracle=D1_SQL)
def s10_relay(spark, sf_dir):
    from stockwise.operators.nested import flatten_orders
    v = views(spark, sf_dir)
    orders = NS.order_documents(v)
    path = _scratch(spark, "relay-pages")
    S.write_relay_pages(orders, path, parts=spread_for(v.t.lineitem))
    node_schema = orders.schema["order"].dataType
    return flatten_orders(S.read_relay_pages(spark, path, node_schema))


@register("S11_conversation_envelopes", oracle="""
SELECT conversation_id AS id, count(*) AS n_messages FROM conversation_message GROUP BY 1""")
def s11_envelopes(spark, sf_dir):
    convs = NS.conversation_documents(views(spark, sf_dir))
    cid = F.col("conversation.id")
    raw = convs.select(F.when(cid % 3 == 0, F.to_json(F.struct(F.struct(F.array("conversation").alias("payload"))
                                                               .alias("data"))))
                       .when(cid % 3 == 1, F.to_json(F.struct(F.col("conversation").alias("payload"))))
                       .otherwise(F.to_json("conversation")).alias("value"))
    path = _scratch(spark, "envelopes")
    raw.write.text(path)
    parsed = S.normalise_envelopes(spark.read.text(path), convs.schema["conversation"].dataType)
    return parsed.select(F.col("conversation.id").alias("id"), F.size("conversation.messages").cast("long")
                         .alias("n_messages"))


@register("S13_table_profile", oracle="""
SELECT 'orders' AS table_name, 6 AS n_columns, count(*) AS n_rows, CAST(min(o_orderdate) AS DATE) AS min_date,
       CAST(max(o_orderdate) AS DATE) AS max_date FROM orders
UNION ALL SELECT 'lineitem', 11, count(*), CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE) FROM lineitem
UNION ALL SELECT 'customer', 5, count(*), NULL, NULL FROM customer
UNION ALL SELECT 'part', 6, count(*), NULL, NULL FROM part""")
def s13_profile(spark, sf_dir):
    t = views(spark, sf_dir).t
    return S.table_profile({"orders": t.orders, "lineitem": t.lineitem, "customer": t.customer, "part": t.part},
                           {"orders": "o_orderdate", "lineitem": "l_shipdate"})


@register("S14_volume_audit", oracle="""
SELECT count(*) AS orders, sum(coalesce(n, 0)) AS lines, round(avg(coalesce(n, 0)), 4) AS avg_lines_per_order
FROM (SELECT order_id FROM sale_order WHERE state IN ('sale', 'done')) o
LEFT JOIN (SELECT order_id, count(*) AS n FROM sale_order_line GROUP BY 1) l ON o.order_id = l.order_id""")
def s14_audit(spark, sf_dir):
    v = views(spark, sf_dir)
    return S.volume_audit(v.sale_order, v.sale_order_line)
