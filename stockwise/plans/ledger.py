"""Registered ledger, supplier-info, FK-lookup and export queries (A16, F15,
F16, J12, I4, I12, U18, U19) with oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stockwise.operators import upsert as U
from stockwise.plans.common import views
from stockwise.plans.registry import register
from stockwise.session import shared_path

# Ledger lines derived from orders: receivable on the order date, revenue on
# the same day; posted when the order is done.
LEDGER_SQL = """
SELECT order_id AS move_id, '1105' AS account_code, amount_total AS balance, state = 'done' AS posted,
       state = 'done' AND NOT invoiced AS is_reconciled, 'receivable' AS account_type FROM sale_order
UNION ALL SELECT order_id, '4101', -amount_total, state = 'done', FALSE, 'income' FROM sale_order"""


def _ledger(v):
    so = v.sale_order
    a = so.select(F.col("order_id").alias("move_id"), F.lit("1105").alias("account_code"),
                  F.col("amount_total").alias("balance"), (F.col("state") == "done").alias("posted"),
                  ((F.col("state") == "done") & ~F.col("invoiced")).alias("is_reconciled"),
                  F.lit("receivable").alias("account_type"))
    b = so.select("order_id", F.lit("4101"), -F.col("amount_total"), (F.col("state") == "done"), F.lit(False),
                  F.lit("income")).toDF(*a.columns)
    return a.unionByName(b)


@register("A16_account_balances", oracle=f"""
SELECT account_code, round(coalesce(sum(balance) FILTER (WHERE posted), 0.0), 2) AS balance
FROM ({LEDGER_SQL}) l GROUP BY 1""")
def a16_balances(spark, sf_dir):
    led = _ledger(views(spark, sf_dir))
    return led.groupBy("account_code").agg(
        F.round(F.coalesce(F.sum(F.when(F.col("posted"), F.col("balance"))), F.lit(0.0)), 2).alias("balance"))


@register("F15_unreconciled_entries", oracle=f"""
SELECT move_id, account_code, balance FROM ({LEDGER_SQL}) l
WHERE posted AND NOT is_reconciled AND account_type NOT IN ('receivable', 'payable')""")
def f15_unreconciled(spark, sf_dir):
    led = _ledger(views(spark, sf_dir))
    return led.where(F.col("posted") & ~F.col("is_reconciled") & ~F.col("account_type").isin("receivable", "payable")
                     ).select("move_id", "account_code", "balance")


@register("F16_active_opportunities", oracle="""
SELECT o.order_id AS opportunity_id, o.partner_id FROM sale_order o
WHERE o.partner_id IN (SELECT partner_id FROM partner WHERE customer_rank > 0)
  AND NOT EXISTS (SELECT 1 FROM (SELECT 'done' AS stage) w WHERE w.stage = o.state)""")
def f16_opportunities(spark, sf_dir):
    v = views(spark, sf_dir)
    won = spark.createDataFrame([("done",)], "stage string")   # the won stage list (configuration)
    opp = v.sale_order.join(v.partner.where(F.col("customer_rank") > 0).select("partner_id"), "partner_id", "left_semi")
    return opp.join(won, opp.state == won.stage, "left_anti").select(
        F.col("order_id").alias("opportunity_id"), "partner_id")


@register("J12_suppliers_per_sku", oracle="""
SELECT p.sku, s.partner_id AS supplier_id, s.name AS supplier_name, min(l.unit_price) AS min_price,
       min(l.date_order) AS first_purchase, max(l.date_order) AS last_purchase
FROM purchase_order_line l JOIN product p ON l.product_id = p.product_id
JOIN partner s ON s.partner_id = l.partner_id AND s.supplier_rank > 0
GROUP BY 1, 2, 3""")
def j12_suppliers(spark, sf_dir):
    v = views(spark, sf_dir)
    s = v.partner.where(F.col("supplier_rank") > 0).select("partner_id", F.col("name").alias("supplier_name"))
    df = v.purchase_order_line.join(v.product.select("product_id", "sku"), "product_id").join(s, "partner_id")
    return df.groupBy("sku", F.col("partner_id").alias("supplier_id"), "supplier_name").agg(
        F.min("unit_price").alias("min_price"), F.min("date_order").alias("first_purchase"),
        F.max("date_order").alias("last_purchase"))


@register("I4_bom_line_fk_lookup", oracle="""
SELECT b.product_id, b.component_id, p.sku AS product_sku, c.sku AS component_sku, b.product_qty
FROM (SELECT * FROM bom_line UNION ALL SELECT product_id, component_id + 1000000000, uom, product_qty FROM bom_line
      WHERE uom = 'g') b
LEFT JOIN product p ON p.product_id = b.product_id LEFT JOIN product c ON c.product_id = b.component_id""")
def i4_fk(spark, sf_dir):
    v = views(spark, sf_dir)
    bl = v.bom_line.unionByName(v.bom_line.where(F.col("uom") == "g").withColumn(
        "component_id", F.col("component_id") + 1000000000))   # unknown components -> NULL FK
    p = v.product.select("product_id", F.col("sku").alias("product_sku"))
    c = v.product.select(F.col("product_id").alias("component_id"), F.col("sku").alias("component_sku"))
    return bl.join(p, "product_id", "left").join(c, "component_id", "left").select(
        "product_id", "component_id", "product_sku", "component_sku", "product_qty")


@register("I12_order_line_transform", oracle="""
SELECT order_id, line_no, product_id, coalesce(nullif(qty, 0), 1.0) AS product_uom_qty, price_unit
FROM sale_order_line""")
def i12_transform(spark, sf_dir):
    sol = views(spark, sf_dir).sale_order_line
    return sol.select("order_id", "line_no", "product_id",
                      F.coalesce(F.nullif(F.col("qty"), F.lit(0.0)), F.lit(1.0)).alias("product_uom_qty"),
                      "price_unit")


@register("U18_csv_exports", oracle="""
SELECT items_product_sku AS sku, count(*) AS n, round(sum(items_quantity), 3) AS total_quantity
FROM sales_items GROUP BY 1""")
def u18_exports(spark, sf_dir):
    si = views(spark, sf_dir).sales_items
    base = shared_path(spark, f"exports/{uuid.uuid4().hex[:10]}")
    U.export_csv(si.select("issueddate", "items_product_sku", "items_quantity"), f"{base}/detail")
    summary = si.groupBy(F.col("items_product_sku").alias("sku")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("items_quantity"), 3).alias("total_quantity"))
    U.export_csv(summary, f"{base}/summary")
    return spark.read.schema("sku string, n long, total_quantity double").option("header", True).csv(f"{base}/summary")


@register("U19_json_export", oracle="SELECT sku, name, list_price FROM product WHERE is_active")
def u19_json(spark, sf_dir):
    p = views(spark, sf_dir).product.where("is_active").select("sku", "name", "list_price")
    path = shared_path(spark, f"exports/json-{uuid.uuid4().hex[:10]}")
    U.export_json(p, path)
    return spark.read.schema(p.schema).json(path)
