"""Registered catalogue / partner reads and reports (F9-F19, A14-A27, N10,
G3, T13) with oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from stockwise.config import AS_OF
from stockwise.functions import scalars as N
from stockwise.operators import domain as DOM
from stockwise.operators import inventory as INV
from stockwise.operators import series as T
from stockwise.operators.quantiles import exact_quantiles
from stockwise.plans.common import AS_OF_SQL, views
from stockwise.plans.forecast import SQL_PRIORITY, _plan_sql, _sel
from stockwise.plans.registry import register
from stockwise.session import cut_lineage, shared_path


@register("F9_domain_filter", oracle="""
SELECT partner_id, name, email FROM partner
WHERE (customer_rank > 0 OR supplier_rank > 0) AND email ILIKE '%customer.00000001%' AND vat IS NOT NULL""")
def f9_domain(spark, sf_dir):
    dom = ["|", ("customer_rank", ">", 0), ("supplier_rank", ">", 0), ("email", "ilike", "customer.00000001"),
           ("vat", "!=", False)]
    return views(spark, sf_dir).partner.where(DOM.domain_to_column(dom)).select("partner_id", "name", "email")


@register("F10_search_partners_flexible", oracle="""
SELECT DISTINCT p.partner_id, p.name, p.email, p.vat FROM partner p
JOIN (SELECT unnest(['supplier#000000001', 'rut-5', 'customer#0000001']) AS w) q
  ON p.name ILIKE '%' || q.w || '%' OR p.email ILIKE '%' || q.w || '%' OR p.vat ILIKE '%' || q.w || '%'""")
def f10_partners(spark, sf_dir):
    words = [w for w in "supplier#000000001 rut-5 customer#0000001 ab".split() if len(w) >= 3]
    p = views(spark, sf_dir).partner
    cond = F.lit(False)
    for w in words:   # OR over words (reference behaviour); the word list is the user's query
        cond = cond | F.col("name").ilike(f"%{w}%") | F.col("email").ilike(f"%{w}%") | F.col("vat").ilike(f"%{w}%")
    return p.where(cond).select("partner_id", "name", "email", "vat")


@register("F11_skus_by_name", oracle="SELECT sku FROM product WHERE name ILIKE '%GEAR%'")
def f11_by_name(spark, sf_dir):
    return views(spark, sf_dir).product.where(F.col("name").ilike("%GEAR%")).select("sku")


@register("F12_active_products_by_category", oracle="""
SELECT sku, name, category FROM product WHERE is_active AND category = 'Brand#3' ORDER BY name, sku""")
def f12_catalogue(spark, sf_dir):
    p = views(spark, sf_dir).product
    return (p.where(F.col("is_active") & (F.col("category") == "Brand#3")).select(F.upper("sku").alias("sku"),
                                                                                   "name", "category")
            .orderBy("name", "sku"))


@register("F13_active_skus", oracle="SELECT DISTINCT sku FROM product WHERE is_active AND sku IS NOT NULL AND sku <> ''")
def f13_active(spark, sf_dir):
    p = views(spark, sf_dir).product
    return p.where(F.col("is_active") & F.col("sku").isNotNull() & (F.col("sku") != "")).select("sku").distinct()


@register("F14_customer_by_phone", oracle="""
SELECT q.raw, p.partner_id FROM (
  SELECT DISTINCT '(' || substr(phone, 1, 4) || ') ' || substr(phone, 5) AS raw FROM partner WHERE customer_rank > 0) q
JOIN partner p ON p.customer_rank > 0
 AND right(regexp_replace(p.phone, '\\D', '', 'g'), 9) = right(regexp_replace(q.raw, '\\D', '', 'g'), 9)""")
def f14_by_phone(spark, sf_dir):
    p = views(spark, sf_dir).partner.where(F.col("customer_rank") > 0)
    q = p.select(F.concat(F.lit("("), F.substring("phone", 1, 4), F.lit(") "), F.substring("phone", 5, 100))
                 .alias("raw")).distinct()
    qk = q.withColumn("k", N.phone_last9("raw"))
    pk = p.select("partner_id", N.phone_last9("phone").alias("k"))
    return qk.join(pk, "k").select("raw", "partner_id")


@register("F17_latest_draft_per_product", oracle="""
SELECT product_id, mo_id, name FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY mo_id DESC) AS r FROM production_order
  WHERE state = 'draft') t WHERE r = 1""")
def f17_latest_draft(spark, sf_dir):
    mo = views(spark, sf_dir).production_order.where(F.col("state") == "draft")
    w = Window.partitionBy("product_id").orderBy(F.col("mo_id").desc())
    return mo.withColumn("r", F.row_number().over(w)).where("r = 1").select("product_id", "mo_id", "name")


@register("F19_status_guard", oracle="""
SELECT sku, CASE WHEN is_active AND sale_ok THEN 'ACTIVE' ELSE 'DRAFT' END AS status FROM product
WHERE CASE WHEN is_active AND sale_ok THEN 'ACTIVE' ELSE 'DRAFT' END = 'ACTIVE'""")
def f19_status(spark, sf_dir):
    p = views(spark, sf_dir).product
    st = F.when(F.col("is_active") & F.col("sale_ok"), "ACTIVE").otherwise("DRAFT")
    return p.select("sku", st.alias("status")).where(F.col("status") == "ACTIVE")   # status:active added by default


@register("A14_categories_with_counts", oracle="""
SELECT category_id, category, count(*) AS products FROM product GROUP BY 1, 2""")
def a14_categories(spark, sf_dir):
    return views(spark, sf_dir).product.groupBy("category_id", "category").agg(F.count(F.lit(1)).alias("products"))


SKU_TOTALS = "SELECT items_product_sku AS sku, sum(items_quantity) AS qty FROM sales_items GROUP BY 1"


@register("A20_distribution_report", oracle=f"""
SELECT min(qty) AS min_qty, round(quantile_cont(qty, 0.25), 4) AS q25, round(quantile_cont(qty, 0.5), 4) AS median,
       round(quantile_cont(qty, 0.75), 4) AS q75, round(quantile_cont(qty, 0.9), 4) AS q90,
       round(quantile_cont(qty, 0.99), 4) AS q99, max(qty) AS max_qty, round(avg(qty), 4) AS mean,
       round(stddev_samp(qty), 4) AS std
FROM ({SKU_TOTALS}) t""")
def a20_distribution(spark, sf_dir):
    t = cut_lineage(views(spark, sf_dir).sales_items.groupBy(F.col("items_product_sku").alias("sku")).agg(
        F.sum("items_quantity").alias("qty")))
    names = {"q25": 0.25, "median": 0.5, "q75": 0.75, "q90": 0.9, "q99": 0.99}
    q = exact_quantiles(t, "qty", list(names.values())).get(None, [None] * len(names))
    return t.agg(F.min("qty").alias("min_qty"), *[F.lit(None if x is None else round(x, 4)).cast("double").alias(n) for n, x in zip(names, q)],
                 F.max("qty").alias("max_qty"), F.round(F.avg("qty"), 4).alias("mean"), F.round(F.stddev_samp("qty"), 4).alias("std"))


ANNUAL = f"""
SELECT items_product_sku AS sku, sum(items_quantity) AS annual FROM sales_items
WHERE issueddate >= {AS_OF_SQL} - INTERVAL 12 MONTH GROUP BY 1"""


@register("A21_rotation_classes", oracle=f"""
SELECT CASE WHEN annual >= 1000 THEN 'alta' WHEN annual >= 100 THEN 'media' ELSE 'baja' END AS rotation,
       count(*) AS skus, round(avg(annual), 4) AS mean, round(quantile_cont(annual, 0.25), 4) AS q25,
       round(quantile_cont(annual, 0.75), 4) AS q75
FROM ({ANNUAL}) a GROUP BY 1""")
def a21_rotation(spark, sf_dir):
    return _rotation(spark, sf_dir)[0]


def _rotation(spark, sf_dir):
    si = views(spark, sf_dir).sales_items.where(F.col("issueddate") >= F.add_months(F.lit(AS_OF), -12))
    a = si.groupBy(F.col("items_product_sku").alias("sku")).agg(F.sum("items_quantity").alias("annual"))
    cls = F.when(F.col("annual") >= 1000, "alta").when(F.col("annual") >= 100, "media").otherwise("baja")
    a = cut_lineage(a.withColumn("rotation", cls))
    quantiles = exact_quantiles(a, "annual", [0.25, 0.75], by="rotation")       # three classes

    def of(i):
        out = F.lit(None).cast("double")
        for name, q in quantiles.items():
            out = F.when(F.col("rotation") == name, F.lit(round(q[i], 4))).otherwise(out)
        return out

    classes = a.groupBy("rotation").agg(F.count(F.lit(1)).alias("skus"), F.round(F.avg("annual"), 4).alias("mean"))
    return classes.select("rotation", "skus", "mean", of(0).alias("q25"), of(1).alias("q75")), a


@register("A21_rotation_consistency", oracle=f"""
SELECT count(*) AS skus, count(*) FILTER (WHERE annual <= 0) AS not_positive, count(*) FILTER (WHERE sku IS NULL) AS without_sku,
       true AS classes_add_up
FROM ({ANNUAL}) a""")
def a21_consistency(spark, sf_dir):
    """Whether the classes partition the SKUs and no total is out of range."""
    classes, a = _rotation(spark, sf_dir)
    told = classes.agg(F.sum("skus").alias("n")).first().n
    return a.agg(F.count(F.lit(1)).alias("skus"), F.count_if(F.col("annual") <= 0).alias("not_positive"),
                 F.count_if(F.col("sku").isNull()).alias("without_sku"), (F.count(F.lit(1)) == F.lit(told)).alias("classes_add_up"))


@register("A22_overview_by_month_name", oracle="""
SELECT strftime(forecast_date, '%B') AS month_name, 'Q' || CAST(quarter(forecast_date) AS VARCHAR) AS quarter,
       CAST(sum(forecast_qty) AS BIGINT) AS total
FROM capped GROUP BY 1, 2""", extra_ctes=_sel("capped"))
def a22_overview(spark, sf_dir):
    from stockwise.plans.forecast import _capped
    cal = T.calendar_columns(_capped(spark, sf_dir))
    return cal.groupBy("month_name", "quarter").agg(F.sum("forecast_qty").cast("long").alias("total"))


@register("A22_best_and_worst_month", oracle="""
SELECT arg_max(month, (total, -month)) AS best_month, max(total) AS best_total, arg_min(month, (total, month)) AS worst_month,
       min(total) AS worst_total
FROM (SELECT month(forecast_date) AS month, CAST(sum(forecast_qty) AS BIGINT) AS total FROM capped GROUP BY 1) t""", extra_ctes=_sel("capped"))
def a22_best(spark, sf_dir):
    from stockwise.plans.forecast import _capped
    months = _capped(spark, sf_dir).groupBy(F.month("forecast_date").alias("month")).agg(F.sum("forecast_qty").cast("long").alias("total"))
    return months.agg(F.max_by("month", F.struct("total", -F.col("month"))).alias("best_month"), F.max("total").alias("best_total"),
                      F.min_by("month", F.struct("total", "month")).alias("worst_month"), F.min("total").alias("worst_total"))


@register("A23_inventory_summary", oracle="""
SELECT count(*) FILTER (WHERE s.sku IS NOT NULL) AS found, count(*) FILTER (WHERE s.sku IS NULL) AS not_found,
       coalesce(sum(s.qty_available), 0.0) AS total_stock,
       round(100.0 * count(*) FILTER (WHERE s.sku IS NOT NULL) / count(*), 4) AS success_rate
FROM (SELECT DISTINCT 'SKU-' || CAST(user_id AS VARCHAR) AS sku FROM events
      UNION SELECT DISTINCT 'SKU-' || CAST(user_id + 100000 AS VARCHAR) FROM events) k
LEFT JOIN stock s ON k.sku = s.sku""", extra_ctes=_sel("stock"))
def a23_inventory(spark, sf_dir):
    v = views(spark, sf_dir)
    e = v.t.events
    req = (e.select(F.concat(F.lit("SKU-"), F.col("user_id").cast("string")).alias("sku"))
           .unionByName(e.select(F.concat(F.lit("SKU-"), (F.col("user_id") + 100000).cast("string")).alias("sku"))))
    st = INV.stock_by_sku(v.product, v.inventory_quant, v.location, skus=req)
    return st.agg(F.count_if("found").alias("found"), F.count_if(~F.col("found")).alias("not_found"),
                  F.coalesce(F.sum(F.when(F.col("found"), F.col("qty_available"))), F.lit(0.0)).alias("total_stock"),
                  F.round(100.0 * F.count_if("found") / F.count(F.lit(1)), 4).alias("success_rate"))


@register("A26_counts_by_origin", oracle="""
SELECT count(*) AS orders, count(*) FILTER (WHERE id < 0) AS historical, count(*) FILTER (WHERE id >= 0) AS live
FROM (SELECT order_id AS id FROM sale_order
      UNION ALL SELECT DISTINCT -CAST(('0x' || substr(md5(salesinvoiceid), 1, 15)) AS BIGINT) FROM sales_items) t""")
def a26_origin(spark, sf_dir):
    v = views(spark, sf_dir)
    hist = v.sales_items.select(N.neg_id("salesinvoiceid").alias("id")).distinct()
    ids = v.sale_order.select(F.col("order_id").alias("id")).unionByName(hist)
    return ids.agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("id") < 0).alias("historical"),
                   F.count_if(F.col("id") >= 0).alias("live"))


@register("A27_sku_duplicate_check", oracle="""
SELECT upper(items_product_sku) AS sku, count(DISTINCT items_product_description) AS descriptions, count(*) AS line_count
FROM sales_items GROUP BY 1 HAVING count(*) > 1""")
def a27_duplicates(spark, sf_dir):
    si = views(spark, sf_dir).sales_items
    return (si.groupBy(F.upper("items_product_sku").alias("sku"))
            .agg(F.countDistinct("items_product_description").alias("descriptions"), F.count(F.lit(1)).alias("line_count"))
            .where("line_count > 1"))


def _html_sql(col: str) -> str:
    t = col
    t = f"regexp_replace({t}, '(?is)<script[^>]*>.*?</script\\s*>', ' ', 'g')"
    t = f"regexp_replace({t}, '(?is)<style[^>]*>.*?</style\\s*>', ' ', 'g')"
    t = f"regexp_replace({t}, '(?i)<br\\s*/?>|</p\\s*>|</div\\s*>|</li\\s*>|</h[1-6]\\s*>', '\n', 'g')"
    t = f"regexp_replace({t}, '<[^>]*>', ' ', 'g')"
    for ent, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        t = f"replace({t}, '{ent}', '{ch}')"
    t = f"regexp_replace({t}, '\\s+', ' ', 'g')"
    return f"trim({t})"


@register("N10_html_to_text", oracle=f"""
SELECT page_id, {_html_sql('html')} AS text, left({_html_sql('html')}, 300) AS snippet FROM pages""")
def n10_html(spark, sf_dir):
    p = views(spark, sf_dir).t.pages
    return p.select("page_id", N.html_to_text("html").alias("text"), N.html_to_text("html", limit=300).alias("snippet"))


@register("G3_priority_sql_udf", oracle=_plan_sql(SQL_PRIORITY), extra_ctes=_sel("plan_in"))
def g3_udf(spark, sf_dir):
    """The SQL priority rule as a function that any SQL text can call."""
    from stockwise.operators.replenish import priority_function
    from stockwise.plans.forecast import _plan
    spark.sql(priority_function())
    plan = _plan(spark, sf_dir, rule="sql")
    return plan.withColumn("priority", F.expr("calculate_priority(forecasted_qty, current_stock, max_monthly_sales)"))


@register("T13_monthly_sales_partitioned", oracle="""
SELECT sku, month, CAST(yu AS DOUBLE) / 1000 AS total_quantity, date_trunc('month', month)::DATE AS month_date
FROM (SELECT sku, last_day(make_date(CAST(mi // 12 AS INTEGER), CAST(mi % 12 + 1 AS INTEGER), 1)) AS month, yu
      FROM series) s""", extra_ctes=_sel("series"))
def t13_partitioned(spark, sf_dir):
    from stockwise.plans.forecast import _arrays
    path = shared_path(spark, f"tables/monthly-sales-{uuid.uuid4().hex[:10]}")
    T.write_monthly_sales(T.monthly_series(_arrays(spark, sf_dir)), path)
    return spark.read.parquet(path)
