"""Registered sales-analytics queries (F1-F8, A1-A8, W5, W7) with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockwise.config import AS_OF
from stockwise.operators import sales as S
from stockwise.plans.common import AS_OF_SQL, avg_sql, views
from stockwise.plans.registry import register

NQ = "(sales_channel IS NULL OR sales_channel <> 'Cotizaciones')"
SI_ORDER = "issueddate DESC, salesinvoiceid DESC, items_product_sku DESC, docnumber DESC, total_total DESC"


@register("A1_sales_summary_channel", oracle=f"""
SELECT sales_channel AS channel, count(*) AS record_count,
       round(sum(items_quantity), 3) AS total_quantity, round(sum(totals_net), 2) AS total_net,
       round(sum(totals_vat), 2) AS total_vat, round(sum(total_total), 2) AS total_amount,
       {avg_sql("items_unitprice")} AS avg_unit_price
FROM sales_items GROUP BY sales_channel""")
def a1_channel(spark, sf_dir):
    return S.sales_summary(views(spark, sf_dir).sales_items, "channel")


@register("A1_sales_summary_warehouse", oracle=f"""
SELECT warehouse_name AS warehouse, count(*) AS record_count,
       round(sum(items_quantity), 3) AS total_quantity, round(sum(totals_net), 2) AS total_net,
       round(sum(totals_vat), 2) AS total_vat, round(sum(total_total), 2) AS total_amount,
       {avg_sql("items_unitprice")} AS avg_unit_price
FROM sales_items GROUP BY warehouse_name""")
def a1_warehouse(spark, sf_dir):
    return S.sales_summary(views(spark, sf_dir).sales_items, "warehouse")


@register("A1_sales_summary_product", oracle=f"""
SELECT items_product_sku AS product, count(*) AS record_count,
       round(sum(items_quantity), 3) AS total_quantity, round(sum(totals_net), 2) AS total_net,
       round(sum(totals_vat), 2) AS total_vat, round(sum(total_total), 2) AS total_amount,
       {avg_sql("items_unitprice")} AS avg_unit_price
FROM sales_items GROUP BY items_product_sku""")
def a1_product(spark, sf_dir):
    return S.sales_summary(views(spark, sf_dir).sales_items, "product")


@register("F1_sales_range_newest", oracle=f"""
SELECT * FROM sales_items
WHERE issueddate >= DATE '2000-01-01' AND issueddate <= DATE '2000-12-31'
ORDER BY {SI_ORDER} LIMIT 100""")
def f1_sales(spark, sf_dir):
    return S.sales(views(spark, sf_dir).sales_items, start="2000-01-01", end="2000-12-31", limit=100)


@register("F1_sales_customers_skus", oracle="""
SELECT * FROM sales_items
WHERE customer_name IN ('Customer#000000001', 'Customer#000000007', 'Customer#000000042')
  AND items_product_sku IN ('SKU-1', 'SKU-5', 'SKU-10', 'SKU-77', 'SKU-123', 'SKU-150')""")
def f1_filters(spark, sf_dir):
    df = S.sales(views(spark, sf_dir).sales_items,
                 customers=["Customer#000000001", "Customer#000000007", "Customer#000000042"],
                 skus=["SKU-1", "SKU-5", "SKU-10", "SKU-77", "SKU-123", "SKU-150"])
    return df


@register("F2_query_builder", oracle=f"""
SELECT items_product_sku, count(*) AS lines, round(sum(total_total), 2) AS total
FROM sales_items
WHERE warehouse_name = 'NATION_3' AND issueddate >= DATE '1999-01-01' AND issueddate <= DATE '2000-12-31'
  AND items_quantity >= 10 AND items_product_description ILIKE '%gear%'
GROUP BY items_product_sku""")
def f2_builder(spark, sf_dir):
    q = (S.SalesQuery(views(spark, sf_dir).sales_items)
         .where("warehouse_name", "=", "NATION_3")
         .where_date_range("1999-01-01", "2000-12-31")
         .where_in("sales_channel", [])            # empty IN list is ignored
         .where("items_quantity", ">=", 10)
         .where("items_product_description", "ILIKE", "%gear%")
         .group_by("items_product_sku", aggs=[F.count(F.lit(1)).alias("lines"),
                                              F.round(F.sum("total_total"), 2).alias("total")])
         .order_by("items_product_sku").order_by("total", desc=True))
    return q.build()


@register("F3_sales_by_product", oracle="""
SELECT * FROM sales_items WHERE items_product_sku = 'SKU-42'""")
def f3_by_product(spark, sf_dir):
    return S.sales_by_product(views(spark, sf_dir).sales_items, "SKU-42")


@register("F3_sales_by_customer", oracle="""
SELECT * FROM sales_items WHERE customer_name = 'Customer#000000100'""")
def f3_by_customer(spark, sf_dir):
    return S.sales_by_customer(views(spark, sf_dir).sales_items, "Customer#000000100")


@register("F3_sales_by_date_range", oracle="""
SELECT * FROM sales_items WHERE issueddate BETWEEN DATE '2001-01-01' AND DATE '2001-03-31'""")
def f3_by_range(spark, sf_dir):
    return S.sales_by_date_range(views(spark, sf_dir).sales_items, "2001-01-01", "2001-03-31")


@register("F4_custom_sql", oracle="""
SELECT warehouse_name, count(*) AS n, round(sum(total_total), 2) AS total
FROM sales_items WHERE issueddate >= DATE '2000-06-01' AND items_quantity > 25
GROUP BY warehouse_name""")
def f4_sql(spark, sf_dir):
    return S.run_sql(spark, views(spark, sf_dir).sales_items,
                     "SELECT warehouse_name, count(*) AS n, round(sum(total_total), 2) AS total "
                     "FROM sales_items WHERE issueddate >= :start AND items_quantity > :q "
                     "GROUP BY warehouse_name",
                     {"start": "2000-06-01", "q": 25})


@register("F5_not_quotation", oracle=f"""
SELECT salesinvoiceid, items_product_sku, docnumber, sales_channel FROM sales_items WHERE {NQ}""")
def f5_not_quotation(spark, sf_dir):
    from stockwise.functions.scalars import not_quotation
    return (views(spark, sf_dir).sales_items.where(not_quotation())
            .select("salesinvoiceid", "items_product_sku", "docnumber", "sales_channel"))


@register("F6_recent_skus", oracle=f"""
SELECT DISTINCT items_product_sku AS sku FROM sales_items
WHERE items_quantity > 0 AND issueddate >= {AS_OF_SQL} - INTERVAL 12 MONTH AND {NQ}""")
def f6_recent(spark, sf_dir):
    return S.recent_skus(views(spark, sf_dir).sales_items, AS_OF)


@register("F7_raw_material_skus", oracle="""
SELECT DISTINCT items_product_sku AS sku FROM sales_items
WHERE upper(items_product_description) LIKE '%MP%' OR upper(items_product_description) LIKE '%MATERIA PRIMA%'
   OR upper(items_product_description) LIKE '%RAW MATERIAL%'""")
def f7_raw(spark, sf_dir):
    return S.raw_material_skus(views(spark, sf_dir).sales_items)


@register("F8_valid_skus", oracle=f"""
SELECT DISTINCT items_product_sku AS sku FROM sales_items
WHERE items_quantity > 0 AND issueddate >= {AS_OF_SQL} - INTERVAL 12 MONTH AND {NQ}
  AND items_product_sku NOT IN (
    SELECT items_product_sku FROM sales_items
    WHERE upper(items_product_description) LIKE '%MP%' OR upper(items_product_description) LIKE '%MATERIA PRIMA%'
       OR upper(items_product_description) LIKE '%RAW MATERIAL%')""")
def f8_valid(spark, sf_dir):
    return S.valid_skus(views(spark, sf_dir).sales_items, AS_OF)


@register("A2_summary_by_date", oracle="""
SELECT issueddate, count(*) AS transactions, round(sum(total_total), 2) AS total_sales
FROM sales_items GROUP BY issueddate""")
def a2_by_date(spark, sf_dir):
    return S.summary_by_date(views(spark, sf_dir).sales_items)


@register("A2_top_customers", oracle="""
SELECT customer_name, count(DISTINCT salesinvoiceid) AS invoices, round(sum(total_total), 2) AS total_sales
FROM sales_items GROUP BY customer_name ORDER BY total_sales DESC, customer_name LIMIT 10""")
def a2_top_customers(spark, sf_dir):
    return S.top_customers(views(spark, sf_dir).sales_items, 10)


@register("A2_top_products", oracle="""
SELECT items_product_sku, round(sum(items_quantity), 3) AS total_quantity, round(sum(total_total), 2) AS total_sales
FROM sales_items GROUP BY items_product_sku ORDER BY total_sales DESC, items_product_sku LIMIT 10""")
def a2_top_products(spark, sf_dir):
    return S.top_products(views(spark, sf_dir).sales_items, 10)


@register("A3_monthly_summary", oracle=f"""
SELECT date_trunc('month', issueddate)::DATE AS month, count(*) AS transactions,
       round(sum(total_total), 2) AS total_sales, {avg_sql("total_total")} AS avg_sale
FROM sales_items GROUP BY 1 ORDER BY month DESC LIMIT 6""")
def a3_monthly(spark, sf_dir):
    return S.monthly_summary(views(spark, sf_dir).sales_items, 6)


@register("A4_month_overview", oracle="""
SELECT count(*) AS "rows", count(DISTINCT items_product_sku) AS distinct_skus,
       count(DISTINCT customer_name) AS distinct_customers, count(DISTINCT salesinvoiceid) AS distinct_invoices
FROM sales_items WHERE issueddate BETWEEN DATE '2000-03-01' AND DATE '2000-03-31'""")
def a4_overview(spark, sf_dir):
    return S.month_overview(views(spark, sf_dir).sales_items, 2000, 3)


@register("A5_sku_month_top", oracle="""
SELECT items_product_sku, round(sum(items_quantity), 3) AS total_quantity,
       count(DISTINCT salesinvoiceid) AS invoices
FROM sales_items WHERE issueddate BETWEEN DATE '2000-03-01' AND DATE '2000-03-31'
GROUP BY items_product_sku HAVING round(sum(items_quantity), 3) > 30
ORDER BY total_quantity DESC, items_product_sku LIMIT 10""")
def a5_sku_month(spark, sf_dir):
    return S.sku_month_sales(views(spark, sf_dir).sales_items, 2000, 3, min_qty=30, top=10)


@register("A6_seasonal_comparison", oracle="""
SELECT year(issueddate) AS year, month(issueddate) AS month,
       round(sum(items_quantity), 3) AS total_quantity, count(DISTINCT items_product_sku) AS distinct_skus
FROM sales_items
WHERE (year(issueddate) = 1999 AND month(issueddate) = 12) OR (year(issueddate) = 2000 AND month(issueddate) = 12)
   OR (year(issueddate) = 2000 AND month(issueddate) = 6)
GROUP BY 1, 2""")
def a6_seasonal(spark, sf_dir):
    return S.seasonal_comparison(views(spark, sf_dir).sales_items, [(1999, 12), (2000, 12), (2000, 6)])


A7_SQL = f"""
SELECT sku, CAST(max(monthly_total) AS BIGINT) AS max_monthly_sales FROM (
  SELECT items_product_sku AS sku, year(issueddate) AS y, month(issueddate) AS m, sum(items_quantity) AS monthly_total
  FROM sales_items
  WHERE items_quantity > 0 AND issueddate >= {AS_OF_SQL} - INTERVAL 24 MONTH AND {NQ}
  GROUP BY 1, 2, 3) t GROUP BY sku"""


@register("A7_max_monthly_sales", oracle=A7_SQL)
def a7_max_monthly(spark, sf_dir):
    return S.max_monthly_sales(views(spark, sf_dir).sales_items, AS_OF)


A8_SQL = f"""
WITH base AS (
  SELECT * FROM sales_items WHERE items_quantity > 0 AND items_unitprice > 0 AND {NQ}),
latest AS (
  SELECT items_product_sku AS sku,
         arg_max(items_unitprice, (issueddate, salesinvoiceid, docnumber, items_unitprice)) AS latest_price
  FROM base GROUP BY 1),
avgp AS (
  SELECT items_product_sku AS sku, {avg_sql("items_unitprice", 2)} AS avg_price FROM base
  WHERE issueddate >= {AS_OF_SQL} - INTERVAL 6 MONTH GROUP BY 1)
SELECT coalesce(l.sku, a.sku) AS sku, round(coalesce(l.latest_price, a.avg_price, 0.0), 2) AS unit_price
FROM latest l FULL OUTER JOIN avgp a ON l.sku = a.sku"""


@register("A8_latest_unit_price", oracle=A8_SQL)
def a8_latest_price(spark, sf_dir):
    return S.latest_unit_price(views(spark, sf_dir).sales_items, AS_OF)
