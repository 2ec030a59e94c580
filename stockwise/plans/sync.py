"""Registered upsert / ingest queries (U1-U20, I1-I17) with oracles on the
resulting tables: the Spark side runs the upsert or transform, the SQL side
computes the same final table directly."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stockwise.config import AS_OF
from stockwise.operators import ingest as I
from stockwise.operators import upsert as U
from stockwise.plans.common import AS_OF_SQL, views
from stockwise.plans.registry import register
from stockwise.sources.views import spread_for

T_SPLIT = dt.datetime(2024, 1, 1, 12, 0)   # products written before noon are in the target
S_SPLIT = dt.datetime(2024, 1, 1, 6, 0)    # products written after 06:00 arrive in the batch
SALES_TARGET_END = dt.date(2001, 1, 1)
SALES_BATCH_START = dt.date(2000, 10, 1)

PROD_COLS = "product_id, sku, name, list_price, is_active, category"


def _prod_target_source(v):
    p = v.product.select("product_id", "sku", "name", "list_price", "is_active", "category", "write_date")
    target = p.where(F.col("write_date") < F.lit(T_SPLIT)).drop("write_date")
    source = (p.where(F.col("write_date") >= F.lit(S_SPLIT))
              .withColumn("list_price", F.col("list_price") * 2).withColumn("name", F.upper("name"))
              .drop("write_date"))
    return target, source


PROD_TS = {
    "tgt": f"SELECT {PROD_COLS} FROM product WHERE write_date < TIMESTAMP '2024-01-01 12:00:00'",
    "src": """SELECT product_id, sku, upper(name) AS name, list_price * 2 AS list_price, is_active, category
              FROM product WHERE write_date >= TIMESTAMP '2024-01-01 06:00:00'""",
}


@register("U1_upsert_products", oracle="""
SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE sku NOT IN (SELECT sku FROM src)""", extra_ctes=PROD_TS)
def u1_upsert(spark, sf_dir):
    target, source = _prod_target_source(views(spark, sf_dir))
    return U.upsert(target, source, ["sku"])


@register("U5_upsert_products_preserve_name", oracle="""
SELECT s.product_id, s.sku, coalesce(t.name, s.name) AS name, s.list_price, s.is_active, s.category
FROM src s LEFT JOIN tgt t ON s.sku = t.sku
UNION ALL SELECT * FROM tgt WHERE sku NOT IN (SELECT sku FROM src)""", extra_ctes=PROD_TS)
def u5_upsert_preserve(spark, sf_dir):
    target, source = _prod_target_source(views(spark, sf_dir))
    return U.upsert(target, source, ["sku"], preserve=["name"])


@register("U1_upsert_products_update_cols", oracle="""
SELECT s.product_id, s.sku, coalesce(t.name, s.name) AS name, s.list_price,
       CASE WHEN t.sku IS NULL THEN s.is_active ELSE t.is_active END AS is_active,
       CASE WHEN t.sku IS NULL THEN s.category ELSE t.category END AS category
FROM src s LEFT JOIN tgt t ON s.sku = t.sku
UNION ALL SELECT * FROM tgt WHERE sku NOT IN (SELECT sku FROM src)""", extra_ctes=PROD_TS)
def u1_update_cols(spark, sf_dir):
    target, source = _prod_target_source(views(spark, sf_dir))
    return U.upsert(target, source, ["sku"], update_cols=["list_price", "product_id"])


SALES_TS = {
    "st": f"SELECT * FROM sales_items WHERE issueddate < DATE '{SALES_TARGET_END}'",
    "ss": f"""SELECT * REPLACE (items_quantity + 1 AS items_quantity) FROM sales_items
              WHERE issueddate >= DATE '{SALES_BATCH_START}'""",
}


def _sales_target_source(v):
    si = v.sales_items
    target = si.where(F.col("issueddate") < F.lit(SALES_TARGET_END))
    source = si.where(F.col("issueddate") >= F.lit(SALES_BATCH_START)).withColumn(
        "items_quantity", F.col("items_quantity") + 1)
    return target, source


@register("U2_upsert_sales", oracle="""
SELECT count(*) AS total, count(*) FILTER (WHERE NOT in_t) AS new, count(*) FILTER (WHERE in_t) AS updated
FROM (SELECT DISTINCT salesinvoiceid, items_product_sku, (salesinvoiceid, items_product_sku) IN
        (SELECT (salesinvoiceid, items_product_sku) FROM st) AS in_t FROM ss) t""", extra_ctes=SALES_TS)
def u2_counts(spark, sf_dir):
    target, source = _sales_target_source(views(spark, sf_dir))
    return U.upsert_counts(target, source, ["salesinvoiceid", "items_product_sku"])


DEDUP_LAST = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY salesinvoiceid, items_product_sku
    ORDER BY docnumber DESC, {rest}) AS rn FROM {src}) d WHERE rn = 1"""
SI_REST = ", ".join(f"{c} DESC" for c in [
    "doctype_name", "customer_customerid", "customer_name", "customer_vatid", "salesman_name", "term_name",
    "warehouse_name", "totals_net", "totals_vat", "total_total", "items_product_description", "items_quantity",
    "items_unitprice", "issueddate", "sales_channel", "order_key", "product_id", "supplier_id"])


@register("U2_upserted_sales_table", oracle=f"""
SELECT * FROM ({DEDUP_LAST.format(rest=SI_REST, src='ss')}) n
UNION ALL SELECT * FROM st WHERE NOT EXISTS (SELECT 1 FROM ss WHERE ss.salesinvoiceid = st.salesinvoiceid
                                              AND ss.items_product_sku = st.items_product_sku)""",
          extra_ctes=SALES_TS)
def u2_table(spark, sf_dir):
    target, source = _sales_target_source(views(spark, sf_dir))
    return U.upsert(target, source, ["salesinvoiceid", "items_product_sku"], order=["docnumber"])


@register("U3_dedup_keep_last", oracle=DEDUP_LAST.format(rest=SI_REST, src="sales_items"))
def u3_dedup(spark, sf_dir):
    si = views(spark, sf_dir).sales_items
    return U.dedup_keep_last(si, ["salesinvoiceid", "items_product_sku"], ["docnumber"], spread_for(si))


RAW_SKU = """CASE WHEN product_type = 'service' THEN 'None' WHEN NOT is_active THEN ''
                  WHEN NOT purchase_ok AND category_id = 1 THEN 'False' ELSE sku END"""


def _raw_skus(v):
    p = v.product
    return p.select("product_id", F.when(F.col("product_type") == "service", "None")
                    .when(~F.col("is_active"), "").when(~F.col("purchase_ok") & (F.col("category_id") == 1), "False")
                    .otherwise(F.col("sku")).alias("sku"))


@register("U4_rejection_report", oracle=f"""
SELECT reason, count(*) AS n, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY product_id)
         FILTER (WHERE r <= 3) AS examples
FROM (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY product_id) AS r FROM (
  SELECT product_id, CASE WHEN sku IS NULL THEN 'null' WHEN trim(sku) = '' THEN 'empty' WHEN sku = 'None' THEN 'none'
                          WHEN sku = 'False' THEN 'false' END AS reason
  FROM (SELECT product_id, {RAW_SKU} AS sku FROM product) a) b WHERE reason IS NOT NULL) c
GROUP BY reason""")
def u4_report(spark, sf_dir):
    return U.rejection_report(_raw_skus(views(spark, sf_dir)), "sku", "product_id")


@register("U4_dedup_keep_first_valid", oracle=f"""
SELECT product_id, sku FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY product_id) AS r FROM (
  SELECT product_id, {RAW_SKU} AS sku FROM product) a
  WHERE sku IS NOT NULL AND trim(sku) <> '' AND sku NOT IN ('None', 'False')) b WHERE r = 1""")
def u4_first(spark, sf_dir):
    raw = _raw_skus(views(spark, sf_dir))
    valid = raw.where(U.invalid_key_reason("sku").isNull())
    return U.dedup_keep_first(valid, ["sku"], ["product_id"])


RECENT_SKUS = f"""SELECT items_product_sku FROM sales_items WHERE issueddate >= {AS_OF_SQL} - INTERVAL 3 MONTH"""


def _recent_skus(v):
    return v.sales_items.where(F.col("issueddate") >= F.add_months(F.lit(AS_OF), -3)).select(
        F.col("items_product_sku").alias("sku"))


@register("U11_deactivate_missing", oracle=f"""
SELECT {PROD_COLS.replace('is_active', 'is_active AND sku IN (' + RECENT_SKUS + ') AS is_active')} FROM product""")
def u11_deactivate(spark, sf_dir):
    v = views(spark, sf_dir)
    p = v.product.select("product_id", "sku", "name", "list_price", "is_active", "category")
    return U.deactivate_missing(p, _recent_skus(v), "sku")


@register("U12_apply_deletes_delete", oracle=f"""
SELECT {PROD_COLS} FROM product WHERE sku IN ({RECENT_SKUS})""")
def u12_delete(spark, sf_dir):
    v = views(spark, sf_dir)
    p = v.product.select("product_id", "sku", "name", "list_price", "is_active", "category")
    return U.apply_deletes(p, _recent_skus(v), "sku", policy="delete")


@register("U13_update_embeddings", oracle="""
SELECT p.sku, coalesce(len(e.embedding), len(p.embedding)) AS dim, e.vec_id IS NOT NULL AS embedding_updated
FROM product p LEFT JOIN embeddings e ON p.sku = 'SKU-' || CAST(e.vec_id + 250 AS VARCHAR)""")
def u13_embeddings(spark, sf_dir):
    v = views(spark, sf_dir)
    pairs = v.t.embeddings.select(F.concat(F.lit("SKU-"), (F.col("vec_id") + 250).cast("string")).alias("sku"),
                                  "embedding")
    out = U.update_embeddings(v.product.select("sku", "embedding"), pairs)
    return out.select("sku", F.size("embedding").alias("dim"), "embedding_updated").withColumn(
        "dim", F.when(F.col("dim") < 0, None).otherwise(F.col("dim")).cast("long"))


@register("U14_delete_by_key", oracle=f"""
SELECT {PROD_COLS} FROM product WHERE upper(sku) NOT IN (SELECT upper(trim(lower(items_product_sku)))
  FROM sales_items WHERE issueddate >= {AS_OF_SQL} - INTERVAL 3 MONTH)""")
def u14_delete(spark, sf_dir):
    v = views(spark, sf_dir)
    p = v.product.select("product_id", "sku", "name", "list_price", "is_active", "category")
    return U.delete_by_key(p, _recent_skus(v).select(F.lower("sku").alias("k")))


@register("U16_watermarks", oracle="""
SELECT 'product' AS table_name, max(write_date) AS watermark FROM product
UNION ALL SELECT 'partner', max(write_date) FROM partner
UNION ALL SELECT 'sales_items', CAST(max(issueddate) AS TIMESTAMP) FROM sales_items""")
def u16_watermarks(spark, sf_dir):
    v = views(spark, sf_dir)
    return (U.watermark(v.product, "write_date").select(F.lit("product").alias("table_name"), "watermark")
            .unionByName(U.watermark(v.partner, "write_date").select(F.lit("partner").alias("table_name"),
                                                                      "watermark"))
            .unionByName(U.watermark(v.sales_items.select(F.col("issueddate").cast("timestamp").alias("d")), "d")
                         .select(F.lit("sales_items").alias("table_name"), "watermark")))


@register("U20_surrogate_ids", oracle="SELECT sku, md5(sku) AS id FROM product")
def u20_ids(spark, sf_dir):
    return U.add_surrogate_id(views(spark, sf_dir).product.select("sku"), "sku")


# ---- ingest ------------------------------------------------------------------------
@register("I1_uom_roots", oracle="""
WITH RECURSIVE walk(uom_id, cur, depth) AS (
  SELECT uom_id, uom_id, 0 FROM uom
  UNION ALL SELECT w.uom_id, u.parent_id, w.depth + 1 FROM walk w JOIN uom u ON u.uom_id = w.cur
  WHERE u.parent_id IS NOT NULL)
SELECT uom_id, arg_max(cur, depth) AS root_id FROM walk GROUP BY uom_id""")
def i1_roots(spark, sf_dir):
    return I.uom_roots(views(spark, sf_dir).uom)


@register("I2_canonical_partner_remap", oracle="""
SELECT p.partner_id, coalesce(w.canonical_id, p.partner_id) AS canonical_id
FROM partner p LEFT JOIN (
  SELECT vat, arg_max(partner_id, (write_date, -partner_id)) AS canonical_id FROM partner
  WHERE vat IS NOT NULL AND trim(vat) <> '' GROUP BY vat) w ON p.vat = w.vat""")
def i2_remap(spark, sf_dir):
    _, remap = I.canonical_partners(views(spark, sf_dir).partner)
    return remap


@register("I3_sync_products", oracle="""
SELECT product_id, sku, CASE WHEN is_active THEN name || ' (' || category || ', ' || uom || ')' ELSE name END
         AS display_name, CASE WHEN uom = 'g' THEN 2 ELSE 1 END AS uom_id,
       CASE WHEN standard_price = 0 THEN NULL ELSE standard_price END AS standard_price
FROM product WHERE product_type <> 'service'""")
def i3_products(spark, sf_dir):
    p = views(spark, sf_dir).product
    attrs = p.select("product_id", F.when(F.col("is_active"), F.array("category", "uom"))
                     .otherwise(F.array().cast("array<string>")).alias("attrs"))
    uom = p.select(F.col("uom").alias("name")).distinct().withColumn(
        "uom_id", F.when(F.col("name") == "g", 2).otherwise(1))
    return I.sync_products(p, attrs, uom)


@register("I5_production_orders_origin", oracle="""
SELECT *, CASE WHEN ends_with(name, '_AUTO') THEN 'AUTO' WHEN ends_with(name, '_CHAT') THEN 'CHAT' END AS origin
FROM production_order""")
def i5_mo(spark, sf_dir):
    return I.sync_production_orders(views(spark, sf_dir).production_order)


@register("A18_origin_counts", oracle="""
SELECT count(*) FILTER (WHERE origin = 'AUTO') AS auto_orders, count(*) FILTER (WHERE origin = 'CHAT') AS chat_orders,
       round(CAST(count(*) FILTER (WHERE origin = 'AUTO') AS DOUBLE)
             / nullif(count(*) FILTER (WHERE origin IN ('AUTO', 'CHAT')), 0), 6) AS automation_ratio
FROM (SELECT CASE WHEN ends_with(name, '_AUTO') THEN 'AUTO' WHEN ends_with(name, '_CHAT') THEN 'CHAT' END AS origin
      FROM production_order WHERE state <> 'cancel') t""")
def a18_origin(spark, sf_dir):
    mo = I.sync_production_orders(views(spark, sf_dir).production_order).where(F.col("state") != "cancel")
    auto = F.count_if(F.col("origin") == "AUTO")
    chat = F.count_if(F.col("origin") == "CHAT")
    return mo.agg(auto.alias("auto_orders"), chat.alias("chat_orders"),
                  F.round(F.try_divide(auto, auto + chat), 6).alias("automation_ratio"))


@register("F18_dashboard_production", oracle="""
SELECT mo_id, name, product_id, state, CAST(date_planned_start AS DATE) AS planned_day FROM production_order
WHERE CAST(date_planned_start AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND state <> 'cancel'
  AND (ends_with(name, '_AUTO') OR ends_with(name, '_CHAT')) AND product_id IN (SELECT product_id FROM product
  WHERE is_active)""")
def f18_dashboard(spark, sf_dir):
    v = views(spark, sf_dir)
    mo = I.sync_production_orders(v.production_order)
    day = F.to_date("date_planned_start")
    df = mo.where(day.between(F.lit(dt.date(2024, 1, 5)), F.lit(dt.date(2024, 1, 20))) & (F.col("state") != "cancel")
                  & F.col("origin").isin("AUTO", "CHAT"))
    df = df.join(v.product.where("is_active").select("product_id"), "product_id", "left_semi")
    return df.select("mo_id", "name", "product_id", "state", day.alias("planned_day"))


@register("I6_sync_sale_orders", oracle="""
SELECT o.order_id, coalesce(r.canonical_id, o.partner_id) AS partner_id, o.date_order, o.state, o.amount_total,
       o.invoiced, o.team_name
FROM sale_order o LEFT JOIN (
  SELECT p.partner_id, coalesce(w.canonical_id, p.partner_id) AS canonical_id FROM partner p LEFT JOIN (
    SELECT vat, arg_max(partner_id, (write_date, -partner_id)) AS canonical_id FROM partner
    WHERE vat IS NOT NULL AND trim(vat) <> '' GROUP BY vat) w ON p.vat = w.vat) r ON o.partner_id = r.partner_id
WHERE o.state NOT IN ('draft', 'sent', 'cancel')""")
def i6_orders(spark, sf_dir):
    v = views(spark, sf_dir)
    _, remap = I.canonical_partners(v.partner)
    return I.sync_orders(v.sale_order, remap)


# Lines of invoices all of whose SKUs are known, by one flag over the invoice.
LEGACY = {"good": f"""
SELECT * FROM (
  SELECT n.*, k.product_id AS pid, bool_and(k.sku IS NOT NULL) OVER (PARTITION BY n.salesinvoiceid) AS all_known
  FROM ({DEDUP_LAST.format(rest=SI_REST, src='sales_items')}) n
  LEFT JOIN product k ON k.sku = n.items_product_sku AND k.product_type <> 'service') t
WHERE all_known"""}


def _legacy_inputs(v):
    known = v.product.where(F.col("product_type") != "service").select("sku", "product_id")
    return v.sales_items, known


@register("I7_legacy_orders", oracle="""
SELECT -CAST(('0x' || substr(md5(salesinvoiceid), 1, 15)) AS BIGINT) AS odoo_id, salesinvoiceid,
       max(issueddate) AS date_order, max(total_total) AS amount_total, 'done' AS state
FROM good GROUP BY salesinvoiceid""", extra_ctes=LEGACY)
def i7_legacy_orders(spark, sf_dir):
    si, known = _legacy_inputs(views(spark, sf_dir))
    return I.legacy_orders(si, known, spread_for(si))


@register("I8_legacy_lines", oracle="""
SELECT -CAST(('0x' || substr(md5(salesinvoiceid || items_product_sku), 1, 15)) AS BIGINT) AS odoo_id,
       -CAST(('0x' || substr(md5(salesinvoiceid), 1, 15)) AS BIGINT) AS order_odoo_id,
       pid AS product_id, items_quantity AS quantity, items_unitprice AS unit_price
FROM good""", extra_ctes=LEGACY)
def i8_legacy_lines(spark, sf_dir):
    si, known = _legacy_inputs(views(spark, sf_dir))
    return I.legacy_lines(si, known, spread_for(si))


@register("I9_I10_orders_to_sales_items", oracle="""
SELECT 'sale' AS source, o.order_id, 'S' || CAST(o.order_id AS VARCHAR) AS salesinvoiceid,
       o.partner_id AS customer_customerid, c.name AS customer_name, c.vat AS customer_vatid,
       round(l.qty * l.price_unit, 2) AS total_total, round(round(l.qty * l.price_unit, 2) / 1.19, 2) AS totals_net,
       round(round(l.qty * l.price_unit, 2) - round(round(l.qty * l.price_unit, 2) / 1.19, 2), 2) AS totals_vat,
       p.name AS items_product_description, p.sku AS items_product_sku, l.qty AS items_quantity,
       l.price_unit AS items_unitprice, CAST(o.date_order AS DATE) AS issueddate,
       CASE WHEN contains(o.team_name, 'Tienda Sabaj') THEN 'Tienda Sabaj' WHEN o.team_name IS NOT NULL THEN o.team_name
            ELSE 'Otro' END AS sales_channel
FROM sale_order o JOIN sale_order_line l ON l.order_id = o.order_id
LEFT JOIN product p ON p.product_id = l.product_id LEFT JOIN partner c ON c.partner_id = o.partner_id
WHERE o.state IN ('sale', 'done') AND o.invoiced
  AND o.date_order >= TIMESTAMP '2000-01-01 03:00:00' AND o.date_order <= TIMESTAMP '2000-04-01 02:59:59.999'""")
def i9_orders_to_items(spark, sf_dir):
    v = views(spark, sf_dir)
    lo, hi = I.local_day_range_utc(dt.date(2000, 1, 1), dt.date(2000, 3, 31))
    orders = I.filter_orders(v.sale_order, lo, hi)
    return I.orders_to_sales_items(orders, v.sale_order_line, v.product, v.partner)


@register("I13_map_product_columns", oracle="""
SELECT upper(trim(default_code)) AS sku, left(name, 255) AS name, coalesce(list_price, 0.0) AS list_price,
       coalesce(standard_price, 0.0) AS standard_price, coalesce(active, TRUE) AS is_active, TRUE AS sale_ok,
       coalesce(purchase_ok, FALSE) AS purchase_ok,
       CASE WHEN upper(trim(default_code)) IS NULL OR upper(trim(default_code)) IN ('', 'NONE', 'FALSE') THEN 'invalid_sku'
            WHEN name IS NULL OR trim(name) = '' THEN 'invalid_name' WHEN NOT coalesce(active, TRUE) THEN 'inactive'
       END AS reject_reason
FROM (SELECT CASE WHEN product_type = 'service' THEN 'False' ELSE lower(sku) END AS default_code,
             CASE WHEN category_id = 2 THEN '' ELSE name END AS name, list_price,
             CASE WHEN standard_price = 0 THEN NULL ELSE standard_price END AS standard_price,
             is_active AS active, purchase_ok FROM product) r""")
def i13_map(spark, sf_dir):
    p = views(spark, sf_dir).product
    raw = p.select(F.when(F.col("product_type") == "service", "False").otherwise(F.lower("sku")).alias("default_code"),
                   F.when(F.col("category_id") == 2, "").otherwise(F.col("name")).alias("name"), "list_price",
                   F.when(F.col("standard_price") == 0, None).otherwise(F.col("standard_price")).alias("standard_price"),
                   F.col("is_active").alias("active"), "purchase_ok")
    return I.map_product_columns(raw)


@register("I16_partners_by_email", oracle="""
SELECT * FROM partner WHERE customer_rank > 0 AND lower(email) IN (
  SELECT lower(trim(upper(contact_email))) FROM conversation_message)""")
def i16_by_email(spark, sf_dir):
    v = views(spark, sf_dir)
    emails = v.conversation_message.select(F.upper("contact_email").alias("email"))
    return I.partners_by_email(v.partner, emails)


@register("I17_new_statement_lines", oracle="""
SELECT * FROM (SELECT 'BANK' || CAST(order_id % 3 AS VARCHAR) AS journal, 'S' || CAST(order_id AS VARCHAR) AS ref,
                      amount_total FROM sale_order) l
WHERE (journal, ref) NOT IN (SELECT ('BANK' || CAST(order_id % 3 AS VARCHAR), 'S' || CAST(order_id AS VARCHAR))
                             FROM sale_order WHERE state = 'done')""")
def i17_statements(spark, sf_dir):
    so = views(spark, sf_dir).sale_order
    lines = so.select(F.concat(F.lit("BANK"), (F.col("order_id") % 3).cast("string")).alias("journal"),
                      F.concat(F.lit("S"), F.col("order_id").cast("string")).alias("ref"), "amount_total")
    existing = so.where(F.col("state") == "done").select(
        F.concat(F.lit("BANK"), (F.col("order_id") % 3).cast("string")).alias("journal"),
        F.concat(F.lit("S"), F.col("order_id").cast("string")).alias("ref"))
    return I.new_statement_lines(lines, existing)
