"""Registered syncs, batch reads and reports beside those of the other plan
modules (I6, I10, I16, F12, F17, F19, F20, A1, A12, C6, D13, N8, N13, G1, G2)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stockwise.config import AS_OF
from stockwise.functions import scalars as N
from stockwise.operators import checks as C
from stockwise.operators import domain as DOM
from stockwise.operators import ingest as I
from stockwise.operators import nested as D
from stockwise.operators import sales as S
from stockwise.plans.analytics import A7_SQL, A8_SQL
from stockwise.plans.common import avg_sql, views
from stockwise.plans.forecast import _capped, _sel
from stockwise.plans.integrity import C2_SQL, MASTER
from stockwise.plans.nested import PAIRS_SQL, _convs
from stockwise.plans.procurement import PROC, _components
from stockwise.plans.registry import register

# ---- syncs (I6) ---------------------------------------------------------------
REMAP_SQL = """
SELECT p.partner_id, coalesce(w.canonical_id, p.partner_id) AS canonical_id FROM partner p LEFT JOIN (
  SELECT vat, arg_max(partner_id, (write_date, -partner_id)) AS canonical_id FROM partner
  WHERE vat IS NOT NULL AND trim(vat) <> '' GROUP BY vat) w ON p.vat = w.vat"""


@register("I6_sync_sale_lines", oracle="""
SELECT l.order_id, l.line_no, p.product_id, l.qty, l.price_unit AS unit_price
FROM sale_order_line l JOIN sale_order o ON o.order_id = l.order_id AND o.state NOT IN ('draft', 'sent', 'cancel')
LEFT JOIN product p ON p.product_id = l.product_id AND p.is_active""")
def i6_sale_lines(spark, sf_dir):
    v = views(spark, sf_dir)
    _, remap = I.canonical_partners(v.partner)
    lines = v.sale_order_line.select("order_id", "line_no", "product_id", "qty", F.col("price_unit").alias("unit_price"))
    return I.sync_lines(lines, I.sync_orders(v.sale_order, remap), v.product.where("is_active"))


@register("I6_sync_purchase_orders", oracle=f"""
SELECT l.po_id, coalesce(r.canonical_id, l.partner_id) AS partner_id, l.date_order, l.cents / 100 AS amount_total, l.state
FROM (SELECT po_id, min(partner_id) AS partner_id, min(date_order) AS date_order,
             sum(CAST(round(qty * unit_price * 100) AS BIGINT)) AS cents,
             CASE WHEN count(*) FILTER (WHERE state = 'draft') > 0 THEN 'draft' ELSE 'purchase' END AS state
      FROM purchase_order_line GROUP BY 1) l LEFT JOIN ({REMAP_SQL}) r ON r.partner_id = l.partner_id""")
def i6_purchase_orders(spark, sf_dir):
    v = views(spark, sf_dir)
    _, remap = I.canonical_partners(v.partner)
    return I.sync_purchase_orders(v.purchase_order_line, remap)


@register("I6_sync_purchase_lines", oracle="""
SELECT l.po_id, p.product_id, l.qty, l.unit_price, l.date_order
FROM purchase_order_line l LEFT JOIN product p ON p.product_id = l.product_id AND p.is_active""")
def i6_purchase_lines(spark, sf_dir):
    v = views(spark, sf_dir)
    lines = v.purchase_order_line.select("po_id", "product_id", "qty", "unit_price", "date_order")
    return I.sync_lines(lines, lines.select("po_id").distinct(), v.product.where("is_active"), key="po_id")


@register("I6_sync_quants", oracle="""
SELECT p.product_id, l.location_id, q.quantity, q.reserved_quantity FROM inventory_quant q
LEFT JOIN product p ON p.product_id = q.product_id AND p.is_active
LEFT JOIN location l ON l.location_id = q.location_id AND l.usage = 'internal'""")
def i6_quants(spark, sf_dir):
    v = views(spark, sf_dir)
    return I.sync_quants(v.inventory_quant, v.product.where("is_active"), v.location.where("usage = 'internal'"))


# ---- sales feed with points of sale (I9, I10) -----------------------------------
POS = {"pos_order": """
SELECT event_id AS order_id, CASE WHEN event_id % 5 = 0 THEN 'Juan Sabaj/' ELSE 'POS/' END || CAST(event_id AS VARCHAR) AS name,
       user_id + 1 AS partner_id, ts AS date_order,
       CASE event_type WHEN 'purchase' THEN 'paid' WHEN 'signup' THEN 'done' WHEN 'click' THEN 'invoiced' ELSE 'draft' END AS state,
       event_id % 211 + 1 AS product_id, CAST(event_id % 3 + 1 AS DOUBLE) AS qty, value AS price_unit FROM events"""}


def _feed_sql(source: str, orders: str, lines: str, channel: str, where: str) -> str:
    return f"""
SELECT '{source}' AS source, o.order_id, 'S' || CAST(o.order_id AS VARCHAR) AS salesinvoiceid,
       o.partner_id AS customer_customerid, c.name AS customer_name, c.vat AS customer_vatid,
       round(l.qty * l.price_unit, 2) AS total_total, round(round(l.qty * l.price_unit, 2) / 1.19, 2) AS totals_net,
       round(round(l.qty * l.price_unit, 2) - round(round(l.qty * l.price_unit, 2) / 1.19, 2), 2) AS totals_vat,
       p.name AS items_product_description, p.sku AS items_product_sku, CAST(l.qty AS DOUBLE) AS items_quantity,
       l.price_unit AS items_unitprice, CAST(o.date_order AS DATE) AS issueddate, {channel} AS sales_channel
FROM {orders} o JOIN {lines} l ON l.order_id = o.order_id
LEFT JOIN product p ON p.product_id = l.product_id LEFT JOIN partner c ON c.partner_id = o.partner_id WHERE {where}"""


FEED_SQL = _feed_sql("sale", "sale_order", "sale_order_line", "coalesce(o.team_name, 'Otro')", "o.state IN ('sale', 'done') AND o.invoiced") + (
    " UNION ALL " + _feed_sql("pos", "pos_order", "pos_order", "CASE WHEN o.name LIKE '%Juan Sabaj%' THEN 'Tienda Sabaj' ELSE 'Otro' END",
                              "o.state IN ('paid', 'done', 'invoiced')"))


@register("I10_sales_feed_with_pos", oracle=FEED_SQL, extra_ctes=POS)
def i10_feed(spark, sf_dir):
    v = views(spark, sf_dir)
    e = v.t.events
    pos = e.select(F.col("event_id").alias("order_id"), F.concat(F.when(F.col("event_id") % 5 == 0, "Juan Sabaj/").otherwise("POS/"),
                                                                 F.col("event_id").cast("string")).alias("name"),
                   (F.col("user_id") + 1).alias("partner_id"), F.col("ts").cast("timestamp").alias("date_order"),
                   F.when(F.col("event_type") == "purchase", "paid").when(F.col("event_type") == "signup", "done")
                   .when(F.col("event_type") == "click", "invoiced").otherwise("draft").alias("state"))
    pos_lines = e.select(F.col("event_id").alias("order_id"), (F.col("event_id") % 211 + 1).alias("product_id"),
                         (F.col("event_id") % 3 + 1).cast("double").alias("qty"), F.col("value").alias("price_unit"))
    lo, hi = I.local_day_range_utc(dt.date(1990, 1, 1), dt.date(2030, 12, 31))
    lines = v.sale_order_line.withColumn("qty", F.col("qty").cast("double"))
    sale = I.orders_to_sales_items(I.filter_orders(v.sale_order, lo, hi), lines, v.product, v.partner)
    return sale.unionByName(I.orders_to_sales_items(I.filter_pos_orders(pos, lo, hi), pos_lines, v.product, v.partner, source="pos"))


# ---- partner and product reads (I16, F12, F17, F19, F20) ------------------------
REQUESTS = ["concat('id-', {k}) | id | {k}", "concat('vat-', {k}) | vat | concat(' rut-', CAST(c_custkey % 1200 AS {s}))",
            "concat('mail-', {k}) | email | concat(upper(replace(c_name, '#', '.')), '@EXAMPLE.com ')",
            "concat('name-', {k}) | name | upper(c_name)", "concat('phone-', {k}) | phone | concat('(9) ', lpad({k}, 8, '0'))"]


def _requests(string: str) -> list[list[str]]:
    return [[x.strip() for x in r.format(k=f"CAST(c_custkey AS {string})", s=string).split(" | ")] for r in REQUESTS]


REQUESTS_SQL = " UNION ALL ".join(f"SELECT {i} AS request_id, '{f}' AS field, {x} AS value FROM customer" for i, f, x in _requests("VARCHAR"))
KEY_SQL = "CASE WHEN {f} = 'phone' THEN right(regexp_replace({x}, '[^0-9]', '', 'g'), 9) ELSE lower(trim({x})) END"


@register("I16_partner_lookup", oracle=f"""
SELECT q.request_id, q.field, q.value, a.partner_id, a.name FROM ({REQUESTS_SQL}) q LEFT JOIN (
  SELECT field, {KEY_SQL.format(f="field", x="x")} AS key, min(partner_id) AS partner_id, arg_min(name, partner_id) AS name FROM (
    SELECT partner_id, name, unnest(['id', 'vat', 'email', 'name', 'phone']) AS field,
           unnest([CAST(partner_id AS VARCHAR), vat, email, name, phone]) AS x FROM partner WHERE customer_rank > 0) k
  WHERE x IS NOT NULL GROUP BY 1, 2) a ON a.field = q.field AND a.key = {KEY_SQL.format(f="q.field", x="q.value")}""")
def i16_lookup(spark, sf_dir):
    v = views(spark, sf_dir)
    rows = F.array(*[F.struct(F.expr(i).alias("request_id"), F.lit(f).alias("field"), F.expr(x).alias("value")) for i, f, x in _requests("STRING")])
    return I.lookup_partners(v.partner, v.t.customer.select(F.inline(rows)))


@register("F12_products_by_sku_list", oracle="""
SELECT upper(sku) AS sku, name, category FROM product WHERE upper(sku) IN (
  SELECT upper(items_product_sku) FROM sales_items WHERE items_quantity >= 49)""")
def f12_sku_list(spark, sf_dir):
    v = views(spark, sf_dir)
    asked = v.sales_items.where("items_quantity >= 49").select(F.lower("items_product_sku").alias("sku"))
    return DOM.products_by_skus(v.product, asked).select("sku", "name", "category")


@register("F12_purchase_ok", oracle="""
SELECT upper(sku) AS sku, name FROM product WHERE is_active AND purchase_ok ORDER BY name, sku""")
def f12_purchase_ok(spark, sf_dir):
    p = views(spark, sf_dir).product.where("is_active AND purchase_ok")
    return p.select(F.upper("sku").alias("sku"), "name").orderBy("name", "sku")


@register("F12_sku_exists", oracle="""
SELECT s.sku, p.sku IS NOT NULL AS found FROM (
  SELECT DISTINCT CASE WHEN event_id % 2 = 0 THEN 'sku-' ELSE 'old-' END || CAST(user_id AS VARCHAR) AS sku FROM events) s
LEFT JOIN (SELECT DISTINCT upper(sku) AS sku FROM product) p ON p.sku = upper(s.sku)""")
def f12_exists(spark, sf_dir):
    v = views(spark, sf_dir)
    asked = v.t.events.select(F.concat(F.when(F.col("event_id") % 2 == 0, "sku-").otherwise("old-"), F.col("user_id").cast("string")).alias("sku"))
    return DOM.skus_exist(v.product, asked)


@register("F12_product_counts", oracle="""
SELECT category, count(*) AS products, count(*) FILTER (WHERE is_active) AS active, count(*) FILTER (WHERE is_active AND purchase_ok) AS purchasable
FROM product GROUP BY 1""")
def f12_counts(spark, sf_dir):
    p = views(spark, sf_dir).product
    return p.groupBy("category").agg(F.count(F.lit(1)).alias("products"), F.count_if("is_active").alias("active"),
                                     F.count_if(F.col("is_active") & F.col("purchase_ok")).alias("purchasable"))


@register("F17_active_orders", oracle="""
SELECT mo_id, name, state, product_id FROM production_order WHERE state IN ('confirmed', 'progress', 'to_close')""")
def f17_active(spark, sf_dir):
    mo = views(spark, sf_dir).production_order
    return mo.where(F.col("state").isin("confirmed", "progress", "to_close")).select("mo_id", "name", "state", "product_id")


@register("F17_any_order_for_sku", oracle="""
SELECT p.sku, EXISTS (SELECT 1 FROM production_order m WHERE m.product_id = p.product_id AND m.state <> 'cancel') AS has_order FROM product p""")
def f17_any(spark, sf_dir):
    v = views(spark, sf_dir)
    made = v.production_order.where("state <> 'cancel'").select("product_id").distinct().withColumn("has_order", F.lit(True))
    return v.product.select("sku", "product_id").join(made, "product_id", "left").select("sku", F.coalesce("has_order", F.lit(False)).alias("has_order"))


@register("F19_status_guard_on_queries", oracle="""
SELECT sku, q, CASE WHEN lower(q) LIKE '%status:%' THEN trim(q) WHEN trim(q) = '' THEN 'status:active' ELSE trim(q) || ' AND status:active' END AS guarded
FROM (SELECT sku, CASE product_id % 3 WHEN 0 THEN '  ' WHEN 1 THEN ' title:' || name ELSE 'title:' || name || ' AND Status:draft' END AS q FROM product) t""")
def f19_guard(spark, sf_dir):
    q = F.when(F.col("product_id") % 3 == 0, "  ").when(F.col("product_id") % 3 == 1, F.concat(F.lit(" title:"), "name")).otherwise(
        F.concat(F.lit("title:"), "name", F.lit(" AND Status:draft")))
    return views(spark, sf_dir).product.select("sku", q.alias("q")).withColumn("guarded", DOM.status_guard(F.col("q")))


@register("F20_missing_components", oracle="SELECT * FROM comps WHERE required_to_order > 0", extra_ctes=PROC)
def f20_components(spark, sf_dir):
    return _components(spark, sf_dir).where(F.col("required_to_order").try_cast("double") > 0)


# ---- reports (A1, A12, C6, D13, G1, G2) ------------------------------------------
def _summary_sql(key: str, column: str) -> str:
    return f"""
SELECT {column} AS {key}, count(*) AS record_count, round(sum(items_quantity), 3) AS total_quantity, round(sum(totals_net), 2) AS total_net,
       round(sum(totals_vat), 2) AS total_vat, round(sum(total_total), 2) AS total_amount, {avg_sql("items_unitprice")} AS avg_unit_price
FROM sales_items GROUP BY 1"""


@register("A1_sales_summary_date", oracle=_summary_sql("date", "issueddate"))
def a1_date(spark, sf_dir):
    return S.sales_summary(views(spark, sf_dir).sales_items, "date")


@register("A1_sales_summary_customer", oracle=_summary_sql("customer", "customer_name"))
def a1_customer(spark, sf_dir):
    return S.sales_summary(views(spark, sf_dir).sales_items, "customer")


@register("A12_forecast_dates_per_sku", oracle="""
SELECT sku, string_agg(CAST(forecast_date AS VARCHAR) || '=' || CAST(CAST(forecast_qty AS BIGINT) AS VARCHAR), ',' ORDER BY forecast_date) AS by_date
FROM capped GROUP BY sku""", extra_ctes=_sel("capped"))
def a12_dates(spark, sf_dir):
    pair = F.concat_ws("=", F.col("forecast_date").cast("string"), F.col("forecast_qty").cast("long").cast("string"))
    return _capped(spark, sf_dir).groupBy("sku").agg(F.array_join(F.array_sort(F.collect_list(pair)), ",").alias("by_date"))


ALL_CHECKS_SQL = " UNION ALL ".join(
    f"SELECT 'empty_{t}' AS check_name, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS n, CASE WHEN count(*) = 0 THEN "
    f"'{'critical' if t in ('uom', 'product') else 'warning'}' END AS severity FROM {t}" for t in MASTER) + f"""
UNION ALL {C2_SQL}
UNION ALL SELECT 'order_amount_differs', count(*), 'warning' FROM sale_order o LEFT JOIN (
  SELECT order_id, sum(CAST(round(qty * price_unit * 100) AS BIGINT)) AS c FROM sale_order_line GROUP BY 1) l ON o.order_id = l.order_id
  WHERE l.c IS DISTINCT FROM CAST(round(o.amount_total * 100) AS BIGINT)
UNION ALL SELECT 'product_without_bom', count(*), 'warning' FROM product WHERE product_id NOT IN (SELECT product_id FROM bom_line)"""


@register("C6_checks_of_a_run", oracle=ALL_CHECKS_SQL)
def c6_checks(spark, sf_dir):
    v = views(spark, sf_dir)
    return C.all_checks(v, {t: getattr(v, t) for t in MASTER})


@register("C6_status_of_a_run", oracle=f"""
SELECT c AS critical, w AS warnings, CASE WHEN c > 0 THEN 'fail' WHEN w > 0 THEN 'warn' ELSE 'ok' END AS status FROM (
  SELECT count(*) FILTER (WHERE severity = 'critical' AND n > 0) AS c, count(*) FILTER (WHERE severity = 'warning' AND n > 0) AS w
  FROM ({ALL_CHECKS_SQL}) r) t""")
def c6_status_all(spark, sf_dir):
    v = views(spark, sf_dir)
    return C.run_status(C.all_checks(v, {t: getattr(v, t) for t in MASTER}))


@register("D13_merged_messages", oracle=f"""
SELECT p.email, m.created_at, m.message_id, p.conversation_id AS merged_from, m.content
FROM ({PAIRS_SQL}) p JOIN conversation_message m ON m.conversation_id = p.conversation_id""")
def d13_messages(spark, sf_dir):
    return D.merged_messages(_convs(spark, sf_dir))


@register("G1_max_monthly_sales_function", oracle=f"""
SELECT p.sku, coalesce(m.max_monthly_sales, 0) AS max_monthly_sales FROM product p LEFT JOIN ({A7_SQL}) m ON m.sku = p.sku""")
def g1_function(spark, sf_dir):
    v = views(spark, sf_dir)
    S.max_monthly_sales(v.sales_items, AS_OF).createOrReplaceTempView("max_monthly_sales_by_sku")
    v.product.createOrReplaceTempView("catalogue_products")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION calculate_max_monthly_sales(asked STRING) RETURNS BIGINT
        RETURN SELECT coalesce(max(max_monthly_sales), 0) FROM max_monthly_sales_by_sku WHERE sku = asked""")
    return spark.sql("SELECT sku, calculate_max_monthly_sales(sku) AS max_monthly_sales FROM catalogue_products")


@register("G2_latest_unit_price_function", oracle=f"""
SELECT p.sku, u.unit_price FROM product p LEFT JOIN ({A8_SQL}) u ON u.sku = p.sku""")
def g2_function(spark, sf_dir):
    v = views(spark, sf_dir)
    S.latest_unit_price(v.sales_items, AS_OF).createOrReplaceTempView("latest_unit_price_by_sku")
    v.product.createOrReplaceTempView("catalogue_products")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION get_latest_unit_price(asked STRING) RETURNS DOUBLE
        RETURN SELECT max(unit_price) FROM latest_unit_price_by_sku WHERE sku = asked""")
    return spark.sql("SELECT sku, get_latest_unit_price(sku) AS unit_price FROM catalogue_products")


# ---- scalars over whole tables (N8, N13) -------------------------------------------
@register("N8_coerce_fields", oracle="""
SELECT event_id, try_cast(x AS BIGINT) AS as_int, CASE WHEN try_cast(x AS BIGINT) IS NULL THEN 'Invalid int value for x: ' || x END AS int_error,
       CASE WHEN y IN ('true', '1') THEN TRUE WHEN y IN ('false', '0') THEN FALSE END AS as_flag,
       CASE WHEN y NOT IN ('true', '1', 'false', '0') THEN 'Invalid boolean value for y: ' || y END AS flag_error
FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_type ELSE CAST(user_id AS VARCHAR) END AS x,
             CASE event_type WHEN 'click' THEN 'true' WHEN 'view' THEN '0' WHEN 'error' THEN NULL ELSE event_type END AS y FROM events) t""")
def n8_coerce(spark, sf_dir):
    e = views(spark, sf_dir).t.events.select(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("user_id").cast("string")).alias("x"),
        F.when(F.col("event_type") == "click", "true").when(F.col("event_type") == "view", "0")
        .when(F.col("event_type") == "error", None).otherwise(F.col("event_type")).alias("y"))
    number, number_error = N.coerce(F.col("x"), "int", "x")
    flag, flag_error = N.coerce(F.col("y"), "boolean", "y")
    return e.select("event_id", number.alias("as_int"), number_error.alias("int_error"), flag.alias("as_flag"), flag_error.alias("flag_error"))


@register("N13_parse_id_lists", oracle="""
SELECT product_id, CASE product_id % 3 WHEN 0 THEN [product_id, product_id + 7] WHEN 1 THEN range(product_id, product_id + 5)
       ELSE [product_id] END AS ids FROM product""")
def n13_ids(spark, sf_dir):
    k = F.col("product_id")
    text = (F.when(k % 3 == 0, F.concat_ws(", ", k.cast("string"), (k + 7).cast("string")))
            .when(k % 3 == 1, F.concat_ws("-", k.cast("string"), (k + 4).cast("string"))).otherwise(k.cast("string")))
    return views(spark, sf_dir).product.select("product_id", N.parse_id_list(text).alias("ids"))
