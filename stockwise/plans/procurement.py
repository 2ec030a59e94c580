"""Registered procurement queries (O9, O10, O16-O24, F20, F21) with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockwise.config import AS_OF
from stockwise.operators import procure as P
from stockwise.plans.common import avg_sql, views
from stockwise.plans.forecast import PY_PRIORITY, _plan, _plan_sql, _sel, _stock
from stockwise.plans.registry import register
from stockwise.sources.views import spread_for

PRANK = "CASE {c} WHEN 'CRITICO' THEN 0 WHEN 'ALTA' THEN 1 WHEN 'MEDIA' THEN 2 WHEN 'BAJA' THEN 3 ELSE 4 END"

PROC = {
    **_sel("plan_in"),
    "plan": _plan_sql(PY_PRIORITY),
    "missing": "SELECT * FROM plan WHERE priority <> 'BAJA' AND required_production > 0",
    "need": f"""
SELECT b.component_id AS component_product_id,
       sum(m.required_production * CASE WHEN b.uom = 'g' THEN b.product_qty / 1000 ELSE b.product_qty END) AS rq,
       min({PRANK.format(c='m.priority')}) AS prank
FROM missing m JOIN product p ON m.sku = p.sku JOIN bom_line b ON b.product_id = p.product_id GROUP BY 1""",
    "comps": """
SELECT n.component_product_id, c.sku AS component_sku, round(n.rq, 4) AS required_component_qty,
       coalesce(s.qty_available, 0.0) AS on_hand_component_qty,
       round(greatest(0.0, n.rq - coalesce(s.qty_available, 0.0)), 4) AS required_to_order,
       CASE prank WHEN 0 THEN 'CRITICO' WHEN 1 THEN 'ALTA' WHEN 2 THEN 'MEDIA' ELSE 'BAJA' END AS priority
FROM need n JOIN product c ON c.product_id = n.component_product_id LEFT JOIN stock s ON s.sku = c.sku""",
    "sp": f"""
SELECT p.product_id, any_value(p.name) AS product_name, any_value(p.sku) AS product_default_code, s.partner_id AS supplier_id,
       any_value(s.name) AS supplier_name, any_value(s.vat) AS supplier_vat, min(l.unit_price) AS min_price, max(l.unit_price) AS max_price,
       {avg_sql('l.unit_price')} AS avg_price,
       arg_max(l.unit_price, (l.date_order IS NOT NULL, l.date_order, l.write_date IS NOT NULL, l.write_date, l.po_id, l.unit_price)) AS last_price
FROM purchase_order_line l JOIN partner s ON s.partner_id = l.partner_id AND s.supplier_rank > 0
JOIN product p ON p.product_id = l.product_id AND p.sku IS NOT NULL
GROUP BY p.product_id, s.partner_id""",
    "plist": """
SELECT CAST(c.component_product_id AS VARCHAR) AS id, CAST(c.component_product_id AS VARCHAR) AS product_id,
       left(p.name, 15) AS product_name, CAST(p.sku AS VARCHAR) AS default_code,
       CAST(c.on_hand_component_qty AS VARCHAR) AS on_hand_qty, CAST(c.required_to_order AS VARCHAR) AS required_qty,
       CAST(s.supplier_id AS VARCHAR) AS supplier_id, left(s.supplier_name, 15) AS supplier_name,
       CAST(s.supplier_vat AS VARCHAR) AS supplier_rut,
       CASE WHEN s.p3 IS NULL OR isnan(s.p3) OR s.p3 <= 0 OR abs(s.p3) < 1e-10 THEN '0.000'
            ELSE printf('%.3f', s.p3) END AS avg_price,
       CAST(c.priority AS VARCHAR) AS priority
FROM comps c LEFT JOIN product p ON p.product_id = c.component_product_id
JOIN (SELECT *, ((CAST(round(avg_price * 10000) AS BIGINT) + 5) // 10) / 1000.0::DOUBLE AS p3 FROM sp) s
  ON s.product_id = c.component_product_id""",
    "best": """
SELECT id, b.supplier_id, b.supplier_name, b.avg_price, b.required_qty, b.priority FROM (
  SELECT id, arg_min({'supplier_id': supplier_id, 'supplier_name': supplier_name, 'avg_price': avg_price,
                      'required_qty': required_qty, 'priority': priority},
                     (CASE WHEN priority = 'CRITICO' THEN 0 ELSE 1 END, CAST(avg_price AS DOUBLE),
                      CAST(supplier_id AS BIGINT))) AS b
  FROM plist GROUP BY id) t""",
}


def _components(spark, sf_dir):
    v = views(spark, sf_dir)
    return P.required_components(P.missing_products(_plan(spark, sf_dir)), v.product, v.bom_line,
                                 _stock(spark, sf_dir))


def _prices(spark, sf_dir):
    v = views(spark, sf_dir)
    lines, parts = v.purchase_order_line, spread_for(v.t.lineitem)
    lines = lines.repartition(*parts, "product_id") if parts else lines     # bounds the rows a task joins and sorts
    return P.supplier_prices(v.product, lines, v.partner)


def _plist(spark, sf_dir):
    return P.component_purchase_list(_components(spark, sf_dir), views(spark, sf_dir).product,
                                     _prices(spark, sf_dir))


@register("O16_supplier_prices", oracle="SELECT * FROM sp", extra_ctes=PROC)
def o16_supplier_prices(spark, sf_dir):
    return _prices(spark, sf_dir)


@register("O9_missing_products_current_month", oracle="SELECT * FROM missing", extra_ctes=PROC)
def o9_missing(spark, sf_dir):
    return P.missing_products(_plan(spark, sf_dir))


@register("O10_required_components", oracle="SELECT * FROM comps", extra_ctes=PROC)
def o10_components(spark, sf_dir):
    return _components(spark, sf_dir)


@register("O17_missing_components_report", oracle="""
SELECT c.*, p.name AS product_name, p.sku AS default_code
FROM comps c LEFT JOIN product p ON p.product_id = c.component_product_id""", extra_ctes=PROC)
def o17_report(spark, sf_dir):
    return P.enrich_missing(_components(spark, sf_dir), views(spark, sf_dir).product, "component_product_id")


@register("O18_component_purchase_list", oracle="SELECT * FROM plist", extra_ctes=PROC)
def o18_plist(spark, sf_dir):
    return _plist(spark, sf_dir)


@register("O19_supplier_coverage", oracle="""
SELECT count(*) AS components, count(*) FILTER (WHERE has_supplier) AS with_supplier,
       count(*) FILTER (WHERE NOT has_supplier) AS without_supplier,
       round(CAST(count(*) FILTER (WHERE has_supplier) AS DOUBLE) / nullif(count(*), 0), 4) AS coverage
FROM (SELECT n.component_product_id,
             n.component_product_id IN (SELECT product_id FROM sp) AS has_supplier
      FROM (SELECT DISTINCT component_product_id FROM comps WHERE required_to_order > 0) n) t""",
          extra_ctes=PROC)
def o19_coverage(spark, sf_dir):
    return P.supplier_coverage(_components(spark, sf_dir), _prices(spark, sf_dir))


@register("O20_cheapest_supplier", oracle="SELECT * FROM best", extra_ctes=PROC)
def o20_cheapest(spark, sf_dir):
    return P.cheapest_supplier(_plist(spark, sf_dir))


@register("O21_purchase_order_drafts", oracle="""
SELECT partner_id, count(*) AS n_lines,
       CAST(sum(CAST(round(product_qty * 10000) AS BIGINT)) AS DOUBLE) / 10000 AS total_qty,
       CAST(sum(CAST(round(product_qty * 10000) AS BIGINT) * CAST(round(price_unit * 1000) AS BIGINT)) AS DOUBLE)
         / 10000000 AS total_value
FROM (SELECT CAST(supplier_id AS BIGINT) AS partner_id, CAST(required_qty AS DOUBLE) AS product_qty,
             CAST(avg_price AS DOUBLE) AS price_unit FROM best
      WHERE priority = 'CRITICO' AND CAST(required_qty AS DOUBLE) > 0) l
GROUP BY partner_id""", extra_ctes=PROC)
def o21_drafts(spark, sf_dir):
    headers, _ = P.purchase_order_drafts(P.cheapest_supplier(_plist(spark, sf_dir)))
    return headers


@register("F21_rfq_list", oracle="""
SELECT po_id, partner_id, max(date_order) AS date_order, count(*) AS n_lines FROM purchase_order_line
WHERE state IN ('draft', 'sent') GROUP BY po_id, partner_id ORDER BY date_order DESC, po_id""")
def f21_rfq(spark, sf_dir):
    pol = views(spark, sf_dir).purchase_order_line
    return (pol.where(F.col("state").isin("draft", "sent")).groupBy("po_id", "partner_id")
            .agg(F.max("date_order").alias("date_order"), F.count(F.lit(1)).alias("n_lines"))
            .orderBy(F.col("date_order").desc(), "po_id"))


@register("O22_rfq_line_normalisation", oracle=f"""
SELECT l.partner_id, l.product_id, p.name AS name, p.uom AS uom, l.qty AS qty, l.unit_price AS price,
       DATE '{AS_OF.isoformat()}' AS date_planned,
       CASE WHEN coalesce(v.supplier_rank, 0) <= 0 THEN 'vendor is not a supplier'
            WHEN p.name IS NULL THEN 'unknown product' END AS reject_reason
FROM purchase_order_line l LEFT JOIN product p ON l.product_id = p.product_id
LEFT JOIN partner v ON l.partner_id = v.partner_id WHERE l.state = 'draft'""")
def o22_rfq(spark, sf_dir):
    v = views(spark, sf_dir)
    lines = v.purchase_order_line.where(F.col("state") == "draft").select(
        "partner_id", "product_id", F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("uom"), "qty", F.col("unit_price").alias("price"),
        F.lit(None).cast("date").alias("date_planned"))
    return P.normalise_rfq_lines(lines, v.partner, v.product, AS_OF)


@register("O23_quotation_pricing", oracle="""
SELECT l.order_id, l.line_no, l.product_id,
       coalesce(CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE l.price_unit END,
                p.list_price + coalesce(CASE WHEN l.l_linestatus = 'O' THEN 5.0 END, 0.0)) AS price
FROM sale_order_line l LEFT JOIN product p ON l.product_id = p.product_id""")
def o23_quotation(spark, sf_dir):
    v = views(spark, sf_dir)
    lines = v.sale_order_line.select(
        "order_id", "line_no", "product_id",
        F.when(F.col("l_returnflag") == "R", None).otherwise(F.col("price_unit")).alias("price"),
        F.when(F.col("l_linestatus") == "O", F.lit(5.0)).alias("price_extra"))
    return P.quotation_prices(lines, v.product).select("order_id", "line_no", "product_id", "price")


@register("O24_production_request_check", oracle="""
SELECT r.request_id, r.sku, r.qty, coalesce(hb.has_bom, FALSE) AS has_bom,
       CASE WHEN r.sku IS NULL OR r.qty IS NULL OR r.qty <= 0 THEN 'invalid_request'
            WHEN r.picking_type IS NULL THEN 'missing_picking'
            WHEN p.sku IS NULL THEN 'unknown_product'
            WHEN NOT p.sale_ok THEN 'not_sellable' ELSE 'ok' END AS status
FROM (SELECT event_id AS request_id, 'SKU-' || CAST(user_id AS VARCHAR) AS sku, value AS qty,
             CASE WHEN event_type = 'error' THEN NULL ELSE 'mrp_operation' END AS picking_type FROM events) r
LEFT JOIN product p ON r.sku = p.sku LEFT JOIN hb ON r.sku = hb.sku""", extra_ctes=_sel("hb"))
def o24_requests(spark, sf_dir):
    from stockwise.operators.inventory import has_bom
    v = views(spark, sf_dir)
    req = v.t.events.select(
        F.col("event_id").alias("request_id"), F.concat(F.lit("SKU-"), F.col("user_id").cast("string")).alias("sku"),
        F.col("value").alias("qty"),
        F.when(F.col("event_type") == "error", None).otherwise(F.lit("mrp_operation")).alias("picking_type"))
    return P.check_production_requests(req, v.product, has_bom(v.product, v.bom_line))


@register("O25_validate_inventory_rows", oracle="""
SELECT sku, found, qty_available, list_filter([CASE WHEN found IS NULL THEN 'found is not boolean' END,
       CASE WHEN qty_available IS NULL THEN 'qty_available is not numeric' END], lambda x: x IS NOT NULL) AS errors
FROM (SELECT sku, CASE WHEN lower(trim(CAST(product_type = 'product' AS VARCHAR))) IN ('true', '1') THEN TRUE
                       WHEN lower(trim(CAST(product_type = 'product' AS VARCHAR))) IN ('false', '0') THEN FALSE END
               AS found,
             TRY_CAST(CASE WHEN is_active THEN CAST(list_price AS VARCHAR) ELSE 'n/a' END AS DOUBLE) AS qty_available
      FROM product) t""")
def o25_validate(spark, sf_dir):
    p = views(spark, sf_dir).product
    rows = p.select("sku", (F.col("product_type") == "product").cast("string").alias("found"),
                    F.when(F.col("is_active"), F.col("list_price").cast("string")).otherwise(F.lit("n/a"))
                    .alias("qty_available"))
    return P.validate_inventory_rows(rows)
