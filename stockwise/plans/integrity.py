"""Registered integrity checks, relational operators and scalar functions
(C1-C6, J10, J13, J14, W2, X1-X5, N1-N14, V1-V10) with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockwise.config import AS_OF
from stockwise.functions import scalars as N
from stockwise.operators import checks as C
from stockwise.operators import relational as REL
from stockwise.plans.common import AS_OF_SQL, views
from stockwise.plans.forecast import _plan, _plan_sql, _sel, PY_PRIORITY
from stockwise.plans.registry import register

MASTER = ["uom", "product", "partner", "sale_order", "sale_order_line", "purchase_order_line", "bom_line",
          "inventory_quant"]


@register("C1_master_counts", oracle=" UNION ALL ".join(
    f"SELECT '{t}' AS check_name, count(*) AS n, CASE WHEN count(*) = 0 THEN "
    f"'{'critical' if t in ('uom', 'product') else 'warning'}' END AS severity FROM {t}" for t in MASTER))
def c1_master(spark, sf_dir):
    v = views(spark, sf_dir)
    return C.master_counts({t: getattr(v, t) for t in MASTER})


ORPHANS = [
    ("sale_line_without_order", "sale_order_line", "order_id", "sale_order", "order_id", "critical"),
    ("sale_line_unknown_product", "sale_order_line", "product_id", "product", "product_id", "critical"),
    ("sale_order_unknown_partner", "sale_order", "partner_id", "partner", "partner_id", "warning"),
    ("purchase_line_unknown_product", "purchase_order_line", "product_id", "product", "product_id", "critical"),
    ("purchase_line_unknown_partner", "purchase_order_line", "partner_id", "partner", "partner_id", "warning"),
    ("quant_unknown_product", "inventory_quant", "product_id", "product", "product_id", "warning"),
    ("bom_line_unknown_component", "bom_line", "component_id", "product", "product_id", "critical"),
]
C2_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, count(*) AS n, CASE WHEN count(*) > 0 THEN '{sev}' ELSE 'ok' END AS severity "
    f"FROM {child} c WHERE c.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})"
    for n, child, fk, parent, pk, sev in ORPHANS) + (
    " UNION ALL SELECT 'sale_line_null_product', count(*), CASE WHEN count(*) > 0 THEN 'warning' ELSE 'ok' END "
    "FROM sale_order_line WHERE product_id IS NULL")


@register("C2_referential_integrity", oracle=C2_SQL)
def c2_integrity(spark, sf_dir):
    return C.referential_integrity(views(spark, sf_dir))


@register("C3_amount_consistency", oracle="""
SELECT count(*) AS orders,
       count(*) FILTER (WHERE l.lines_cents IS DISTINCT FROM CAST(round(o.amount_total * 100) AS BIGINT)) AS mismatched,
       count(*) FILTER (WHERE l.lines_cents IS NULL) AS without_lines
FROM sale_order o LEFT JOIN (
  SELECT order_id, sum(CAST(round(qty * price_unit * 100) AS BIGINT)) AS lines_cents FROM sale_order_line GROUP BY 1
) l ON o.order_id = l.order_id""")
def c3_amounts(spark, sf_dir):
    v = views(spark, sf_dir)
    return C.amount_consistency(v.sale_order, v.sale_order_line)


@register("C4_product_relations", oracle="""
SELECT p.product_id, p.sku, p.uom, CASE WHEN b.bom_lines IS NULL THEN 0 ELSE 1 END AS boms,
       coalesce(b.bom_lines, 0) AS bom_lines, coalesce(b.components, 0) AS components
FROM product p LEFT JOIN (SELECT product_id, count(*) AS bom_lines, count(DISTINCT component_id) AS components
                          FROM bom_line GROUP BY 1) b ON p.product_id = b.product_id""")
def c4_relations(spark, sf_dir):
    v = views(spark, sf_dir)
    return C.product_relations(v.product, v.bom_line)


@register("C5_constraint_report", oracle=f"""
SELECT 'year_range' AS rule, count(*) FILTER (WHERE NOT (year BETWEEN 2020 AND 2030)) AS violations FROM plan
UNION ALL SELECT 'month_range', count(*) FILTER (WHERE NOT (month BETWEEN 1 AND 12)) FROM plan
UNION ALL SELECT 'non_negative', count(*) FILTER (WHERE forecasted_qty < 0 OR required_production < 0
                                                  OR max_monthly_sales < 0) FROM plan
UNION ALL SELECT 'pk_not_null', count(*) FILTER (WHERE salesinvoiceid IS NULL OR items_product_sku IS NULL)
          FROM sales_items
UNION ALL SELECT 'pk_unique', count(*) FROM (SELECT salesinvoiceid, items_product_sku FROM sales_items
                                            GROUP BY 1, 2 HAVING count(*) > 1) d
UNION ALL SELECT 'net_vat_total', count(*) FILTER (WHERE abs(totals_net + totals_vat - total_total) >= 0.02)
          FROM sales_items""", extra_ctes={**_sel("plan_in"), "plan": _plan_sql(PY_PRIORITY)})
def c5_constraints(spark, sf_dir):
    return C.constraint_report(_plan(spark, sf_dir), views(spark, sf_dir).sales_items)


@register("C6_run_status", oracle=f"""
SELECT count(*) FILTER (WHERE severity = 'critical' AND n > 0) AS critical,
       count(*) FILTER (WHERE severity = 'warning' AND n > 0) AS warnings,
       CASE WHEN count(*) FILTER (WHERE severity = 'critical' AND n > 0) > 0 THEN 'fail'
            WHEN count(*) FILTER (WHERE severity = 'warning' AND n > 0) > 0 THEN 'warn' ELSE 'ok' END AS status
FROM ({C2_SQL}) r""")
def c6_status(spark, sf_dir):
    return C.run_status(C.referential_integrity(views(spark, sf_dir)))


# ---- joins, windows, sets ---------------------------------------------------------
@register("J10_statement_entry_match", oracle="""
SELECT statement_id, order_number, entry_id, amount FROM (
  SELECT s.statement_id, split_part(s.ref, ' - ', 1) AS order_number, e.entry_id, s.amount,
         row_number() OVER (PARTITION BY s.statement_id ORDER BY e.entry_id) AS rn
  FROM (SELECT order_id AS statement_id, 'S' || CAST(order_id AS VARCHAR) || ' - pago' AS ref,
               amount_total AS amount FROM sale_order WHERE state = 'done') s
  JOIN (SELECT order_id AS entry_id, 'INV/S' || CAST(order_id AS VARCHAR) AS name, amount_total AS debit,
               0.0 AS credit FROM sale_order WHERE NOT (team_name = '1-URGENT')) e
    ON CASE WHEN e.debit > 0 THEN 'debit' ELSE 'credit' END = CASE WHEN s.amount >= 0 THEN 'debit' ELSE 'credit' END
   AND CAST(round(greatest(e.debit, e.credit) * 100) AS BIGINT) = CAST(round(abs(s.amount) * 100) AS BIGINT)
   AND contains(e.name, split_part(s.ref, ' - ', 1))) t
WHERE rn = 1""")
def j10_match(spark, sf_dir):
    so = views(spark, sf_dir).sale_order
    st = so.where(F.col("state") == "done").select(
        F.col("order_id").alias("statement_id"),
        F.concat(F.lit("S"), F.col("order_id").cast("string"), F.lit(" - pago")).alias("ref"),
        F.col("amount_total").alias("amount"))
    en = so.select(F.col("order_id").alias("entry_id"),
                   F.concat(F.lit("INV/S"), F.col("order_id").cast("string")).alias("name"),
                   F.col("amount_total").alias("debit"), F.lit(0.0).alias("credit"),
                   (F.col("team_name") == "1-URGENT").alias("is_reconciled"))
    return REL.match_statements(st, en)


J13_KEYS = """
SELECT CAST(user_id AS VARCHAR) AS key FROM events UNION ALL SELECT 'sku-' || CAST(user_id AS VARCHAR) FROM events
UNION ALL SELECT CAST(user_id + 100000 AS VARCHAR) FROM events UNION ALL SELECT event_type FROM events"""


@register("J13_resolve_products", oracle=f"""
SELECT k.key, coalesce(p1.product_id, p2.product_id) AS product_id, coalesce(p1.sku, p2.sku) AS sku,
       CASE WHEN k._id IS NULL AND k._sku IS NULL THEN 'invalid_id'
            WHEN p1.product_id IS NOT NULL OR p2.sku IS NOT NULL THEN 'found' ELSE 'not_found' END AS status
FROM (SELECT key, CASE WHEN regexp_full_match(key, '\\d+') THEN CAST(key AS BIGINT) END AS _id,
             CASE WHEN NOT regexp_full_match(key, '\\d+') AND starts_with(upper(key), 'SKU-') THEN upper(key) END AS _sku
      FROM (SELECT DISTINCT trim(key) AS key FROM ({J13_KEYS}) a) b) k
LEFT JOIN product p1 ON k._id = p1.product_id LEFT JOIN product p2 ON k._sku = p2.sku""")
def j13_resolve(spark, sf_dir):
    v = views(spark, sf_dir)
    e = v.t.events
    keys = (e.select(F.col("user_id").cast("string").alias("key"))
            .unionByName(e.select(F.concat(F.lit("sku-"), F.col("user_id").cast("string")).alias("key")))
            .unionByName(e.select((F.col("user_id") + 100000).cast("string").alias("key")))
            .unionByName(e.select(F.col("event_type").alias("key"))))
    return REL.resolve_products(keys, v.product)


@register("J14_bom_per_product", oracle="""
SELECT p.sku, CASE WHEN b.n IS NOT NULL THEN p.product_id END AS bom_id, coalesce(b.n, 0) AS n_lines,
       CASE WHEN b.n IS NOT NULL THEN 'found' ELSE 'no_bom' END AS status
FROM product p LEFT JOIN (SELECT product_id, count(*) AS n FROM bom_line GROUP BY 1) b ON p.product_id = b.product_id""")
def j14_bom(spark, sf_dir):
    v = views(spark, sf_dir)
    return REL.bom_per_product(v.product, v.bom_line)


@register("W2_first_sale_per_customer", oracle="""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_customerid
      ORDER BY issueddate, salesinvoiceid, items_product_sku, docnumber, total_total) AS rn FROM sales_items) t
WHERE rn = 1""")
def w2_first(spark, sf_dir):
    si = views(spark, sf_dir).sales_items
    return REL.first_per_key(si, ["customer_customerid"],
                             ["issueddate", "salesinvoiceid", "items_product_sku", "docnumber", "total_total"])


@register("X1_inactive_catalogue_skus", oracle=f"""
SELECT DISTINCT sku FROM product WHERE sku NOT IN (
  SELECT items_product_sku FROM sales_items WHERE issueddate >= {AS_OF_SQL} - INTERVAL 12 MONTH)""")
def x1_difference(spark, sf_dir):
    v = views(spark, sf_dir)
    recent = v.sales_items.where(F.col("issueddate") >= F.add_months(F.lit(AS_OF), -12)).select(
        F.col("items_product_sku").alias("sku"))
    return REL.set_difference(v.product, recent, "sku")


@register("X2_components_with_supplier", oracle="""
SELECT DISTINCT component_id AS product_id FROM bom_line
INTERSECT SELECT DISTINCT product_id FROM purchase_order_line""")
def x2_intersection(spark, sf_dir):
    v = views(spark, sf_dir)
    return REL.set_intersection(v.bom_line.select(F.col("component_id").alias("product_id")),
                                v.purchase_order_line, "product_id")


@register("X3_skus_in_forecast_or_sales", oracle="""
SELECT sku FROM capped UNION SELECT items_product_sku FROM sales_items WHERE issueddate >= DATE '2001-07-01'""",
          extra_ctes=_sel("capped"))
def x3_union(spark, sf_dir):
    from stockwise.plans.forecast import _capped
    si = views(spark, sf_dir).sales_items.where(F.col("issueddate") >= F.lit("2001-07-01").cast("date"))
    return REL.set_union(_capped(spark, sf_dir), si.select(F.col("items_product_sku").alias("sku")), "sku")


@register("X4_concat_sources", oracle="""
SELECT 'sale' AS source, order_id, partner_id, amount_total FROM sale_order WHERE state IN ('sale', 'done')
UNION ALL SELECT 'pos', order_id, partner_id, amount_total FROM sale_order WHERE state = 'draft'""")
def x4_concat(spark, sf_dir):
    so = views(spark, sf_dir).sale_order
    cols = ["order_id", "partner_id", "amount_total"]
    return (so.where(F.col("state").isin("sale", "done")).select(F.lit("sale").alias("source"), *cols)
            .unionByName(so.where(F.col("state") == "draft").select(F.lit("pos").alias("source"), *cols)))


@register("X5_ordered_distinct_names", oracle="""
SELECT order_id, row_number() OVER (PARTITION BY order_id ORDER BY first_pos, name) AS rank, name FROM (
  SELECT l.order_id, p.name, min(l.line_no) AS first_pos FROM sale_order_line l JOIN product p
  ON l.product_id = p.product_id GROUP BY 1, 2) t""")
def x5_ordered(spark, sf_dir):
    v = views(spark, sf_dir)
    df = v.sale_order_line.join(v.product.select("product_id", "name"), "product_id")
    return REL.ordered_distinct(df, "order_id", "line_no", "name")


# ---- scalar functions over partner / product / sales rows --------------------------
def _phone_variants_spark(p):
    ph = F.col("phone")
    return p.select("partner_id", F.explode(F.array(
        ph, F.substring(ph, 5, 8), F.concat(F.lit("9"), F.substring(ph, -8, 8)),
        F.concat(F.lit("00"), ph), F.concat(F.lit("56 2 "), F.substring(ph, -8, 8)))).alias("raw"))


PHONE_SQL = """
SELECT partner_id, unnest([phone, substr(phone, 5, 8), '9' || right(phone, 8), '00' || phone,
                           '56 2 ' || right(phone, 8)]) AS raw FROM partner"""

_D = "regexp_replace(raw, '\\D', '', 'g')"


@register("N6_normalize_phone_cl", oracle=f"""
SELECT partner_id, raw,
  CASE WHEN regexp_full_match(d, '\\d{{1,8}}') THEN '569' || d WHEN regexp_full_match(d, '569\\d{{7,}}') THEN right(d, 11)
       WHEN regexp_full_match(d, '56\\d{{8,}}|\\d*9\\d{{8}}') THEN '56' || right(d, 9) ELSE nullif(d, '') END AS normalized,
  right(d, 9) AS last9
FROM (SELECT *, {_D} AS d FROM ({PHONE_SQL}) x) y""")
def n6_phone(spark, sf_dir):
    raw = _phone_variants_spark(views(spark, sf_dir).partner)
    return raw.select("partner_id", "raw", N.normalize_phone_cl("raw").alias("normalized"),
                      N.phone_last9("raw").alias("last9"))


@register("N1_N2_N3_N7_erp_value_cleaning", oracle="""
SELECT product_id, [CAST(product_id AS VARCHAR), name][1] AS m2o_id, [CAST(product_id AS VARCHAR), name][2] AS m2o_name,
       CASE WHEN txt IS NULL OR txt IN ('False', 'None') THEN '' ELSE txt END AS clean,
       coalesce(CASE WHEN isnan(TRY_CAST(num AS DOUBLE)) THEN NULL ELSE TRY_CAST(num AS DOUBLE) END, 0.0) AS number,
       coalesce(CAST(trunc(TRY_CAST(num AS DOUBLE)) AS BIGINT), 0) AS as_int
FROM (SELECT product_id, name,
             CASE WHEN NOT is_active THEN 'False' WHEN product_type = 'service' THEN 'None' ELSE description END AS txt,
             CASE WHEN purchase_ok THEN CAST(standard_price AS VARCHAR) ELSE uom END AS num
      FROM product) t""")
def n1_cleaning(spark, sf_dir):
    p = views(spark, sf_dir).product
    df = p.select("product_id", "name",
                  F.when(~F.col("is_active"), "False").when(F.col("product_type") == "service", "None")
                  .otherwise(F.col("description")).alias("txt"),
                  F.when(F.col("purchase_ok"), F.col("standard_price").cast("string")).otherwise(F.col("uom"))
                  .alias("num"))
    m2o = F.array(F.col("product_id").cast("string"), F.col("name"))
    return df.select("product_id", N.many2one_id(m2o).alias("m2o_id"), N.many2one_name(m2o).alias("m2o_name"),
                     N.clean_text("txt").alias("clean"), N.to_number_or_zero("num").alias("number"),
                     N.safe_convert("num", "int").alias("as_int"))


@register("N4_parse_write_date", oracle="""
SELECT partner_id, s, coalesce(try_strptime(s, '%Y-%m-%dT%H:%M:%S'), try_strptime(s, '%Y-%m-%d %H:%M:%S'),
                               try_strptime(s, '%Y-%m-%d')) AS parsed
FROM (SELECT partner_id, unnest([strftime(write_date, '%Y-%m-%d %H:%M:%S'), strftime(write_date, '%Y-%m-%d'),
                                 strftime(write_date, '%Y-%m-%dT%H:%M:%S'), 'False']) AS s FROM partner) t""")
def n4_dates(spark, sf_dir):
    p = views(spark, sf_dir).partner
    w = F.col("write_date")
    df = p.select("partner_id", F.explode(F.array(
        F.date_format(w, "yyyy-MM-dd HH:mm:ss"), F.date_format(w, "yyyy-MM-dd"),
        F.date_format(w, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("False"))).alias("s"))
    return df.select("partner_id", "s", N.parse_write_date("s").cast("timestamp_ntz").alias("parsed"))


@register("N5_neg_id", oracle="""
SELECT salesinvoiceid, items_product_sku,
       -CAST(('0x' || substr(md5(salesinvoiceid), 1, 15)) AS BIGINT) AS order_id,
       -CAST(('0x' || substr(md5(salesinvoiceid || '::' || items_product_sku), 1, 15)) AS BIGINT) AS line_id,
       -CAST(('0x' || substr(sha1(salesinvoiceid), 1, 15)) AS BIGINT) AS sha_id
FROM sales_items""")
def n5_neg_id(spark, sf_dir):
    si = views(spark, sf_dir).sales_items
    return si.select("salesinvoiceid", "items_product_sku", N.neg_id("salesinvoiceid").alias("order_id"),
                     N.neg_id("salesinvoiceid", "items_product_sku").alias("line_id"),
                     N.neg_id("salesinvoiceid", algo="sha1").alias("sha_id"))


@register("N9_N11_N12_N14_text_extractors", oracle="""
SELECT product_id, string_split(gid, '/')[-1] AS gid_id,
       nullif(regexp_extract(label, '\\[([^\\]]*)\\]', 1), '') AS sku_from_label,
       split_part(ref, ' - ', 1) AS order_number, left(description, 15) AS short_name
FROM (SELECT product_id, description, 'gid://shopify/Product/' || CAST(product_id AS VARCHAR) AS gid,
             '[' || sku || '] ' || name AS label, 'S' || CAST(product_id AS VARCHAR) || ' - ' || name AS ref
      FROM product) t""")
def n9_text(spark, sf_dir):
    p = views(spark, sf_dir).product.select(
        "product_id", "description",
        F.concat(F.lit("gid://shopify/Product/"), F.col("product_id").cast("string")).alias("gid"),
        F.concat(F.lit("["), F.col("sku"), F.lit("] "), F.col("name")).alias("label"),
        F.concat(F.lit("S"), F.col("product_id").cast("string"), F.lit(" - "), F.col("name")).alias("ref"))
    return p.select("product_id", N.gid_to_id("gid").alias("gid_id"), N.sku_from_label("label").alias("sku_from_label"),
                    N.order_number_from_ref("ref").alias("order_number"), N.truncate("description", 15).alias("short_name"))


@register("V1_V2_V8_V9_business_scalars", oracle="""
SELECT mo_id, CASE WHEN ends_with(name, '_AUTO') THEN 'AUTO' WHEN ends_with(name, '_CHAT') THEN 'CHAT' END AS origin,
       CASE WHEN len(attrs) = 0 THEN base ELSE base || ' (' || array_to_string(attrs, ', ') || ')' END AS display_name,
       CASE WHEN price IS NULL OR isnan(price) OR price <= 0 OR abs(price) < 1e-10 THEN '0.000'
            ELSE printf('%.3f', price) END AS price_text,
       CASE WHEN contains(team, 'Tienda Sabaj') THEN 'Tienda Sabaj' WHEN team IS NOT NULL AND team <> '' THEN team
            ELSE 'Otro' END AS channel
FROM (SELECT mo_id, name, 'MO ' || CAST(product_id AS VARCHAR) AS base,
             CASE state WHEN 'draft' THEN [] WHEN 'cancel' THEN ['x'] ELSE [state, 'v2'] END AS attrs,
             CASE WHEN state = 'cancel' THEN -1.0 ELSE CAST(mo_id % 1000 AS DOUBLE) / 8 END AS price,
             CASE state WHEN 'progress' THEN 'Tienda Sabaj Centro' WHEN 'draft' THEN '' ELSE state END AS team
      FROM production_order) t""")
def v_business(spark, sf_dir):
    po = views(spark, sf_dir).production_order
    df = po.select(
        "mo_id", "name", F.concat(F.lit("MO "), F.col("product_id").cast("string")).alias("base"),
        F.when(F.col("state") == "draft", F.array().cast("array<string>"))
        .when(F.col("state") == "cancel", F.array(F.lit("x"))).otherwise(F.array("state", F.lit("v2"))).alias("attrs"),
        F.when(F.col("state") == "cancel", F.lit(-1.0)).otherwise((F.col("mo_id") % 1000).cast("double") / 8)
        .alias("price"),
        F.when(F.col("state") == "progress", F.lit("Tienda Sabaj Centro")).when(F.col("state") == "draft", F.lit(""))
        .otherwise(F.col("state")).alias("team"))
    return df.select("mo_id", N.mo_origin("name").alias("origin"),
                     N.name_with_attributes("base", "attrs").alias("display_name"),
                     N.format_price("price").alias("price_text"), N.sales_channel("team").alias("channel"))


@register("V3_V4_month_bounds", oracle="""
SELECT DISTINCT issueddate, date_trunc('month', issueddate)::DATE AS month_start, last_day(issueddate) AS month_end,
       year(issueddate) AS year, month(issueddate) AS month FROM sales_items""")
def v3_bounds(spark, sf_dir):
    si = views(spark, sf_dir).sales_items
    return si.select("issueddate", N.month_start("issueddate").alias("month_start"),
                     N.month_end("issueddate").alias("month_end"), F.year("issueddate").alias("year"),
                     F.month("issueddate").alias("month")).distinct()


@register("V7_net_vat_split", oracle="""
SELECT salesinvoiceid, items_product_sku, docnumber, total_total,
       round(total_total / 1.19, 2) AS net, round(total_total - round(total_total / 1.19, 2), 2) AS vat
FROM sales_items""")
def v7_split(spark, sf_dir):
    si = views(spark, sf_dir).sales_items
    net = N.net_from_total("total_total")
    return si.select("salesinvoiceid", "items_product_sku", "docnumber", "total_total", net.alias("net"),
                     F.round(F.col("total_total") - net, 2).alias("vat"))


@register("V10_A24_embedding_summary", oracle="""
SELECT count(*) AS products_with_embedding, sum(len(embedding)) AS total_values,
       round(avg(len(embedding)), 4) AS avg_dimension
FROM product WHERE embedding IS NOT NULL""")
def v10_embeddings(spark, sf_dir):
    p = views(spark, sf_dir).product.where(F.col("embedding").isNotNull())
    return p.agg(F.count(F.lit(1)).alias("products_with_embedding"),
                 F.sum(F.size("embedding")).alias("total_values"),
                 F.round(F.avg(F.size("embedding")), 4).alias("avg_dimension"))
