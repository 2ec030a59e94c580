"""Registered forecasting, inventory and replenishment queries with oracles.

Oracles rebuild the same chain in DuckDB SQL: valid SKUs -> monthly grid ->
quality gate -> least-squares forecast (exact rational half-even rounding)
-> cap -> month pick -> plan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stockwise.config import AS_OF, PLAN_MONTH, PLAN_YEAR
from stockwise.operators import inventory as INV
from stockwise.operators import replenish as R
from stockwise.operators import sales as S
from stockwise.operators import sarima
from stockwise.operators import series as T
from stockwise.plans.common import AS_OF_SQL, avg_sql, views
from stockwise.plans.registry import register
from stockwise.sources.views import spread_for

NQ = "(sales_channel IS NULL OR sales_channel <> 'Cotizaciones')"
RAW = ("upper(items_product_description) LIKE '%MP%' OR upper(items_product_description) LIKE '%MATERIA PRIMA%' "
       "OR upper(items_product_description) LIKE '%RAW MATERIAL%'")


def _rhe(num: str, den: str) -> str:
    return T.round_half_even_ratio_sql(num, den, idiv="//")


def _month_end(mi: str) -> str:
    return f"last_day(make_date(CAST(({mi}) // 12 AS INTEGER), CAST(({mi}) % 12 + 1 AS INTEGER), 1))"


# ---- shared oracle CTEs (order matters: later ones reference earlier ones)
CHAIN = {
    "valid": f"""
SELECT DISTINCT items_product_sku AS sku FROM sales_items
WHERE items_quantity > 0 AND issueddate >= {AS_OF_SQL} - INTERVAL 12 MONTH AND {NQ}
  AND items_product_sku NOT IN (SELECT items_product_sku FROM sales_items WHERE {RAW})""",
    "fsales": f"""
SELECT * FROM sales_items WHERE items_quantity > 0 AND {NQ} AND items_product_sku IN (SELECT sku FROM valid)""",
    "monthly": """
SELECT items_product_sku AS sku, year(issueddate) * 12 + month(issueddate) - 1 AS mi, sum(items_quantity) AS q
FROM fsales GROUP BY 1, 2""",
    "bounds": "SELECT sku, min(mi) AS first_mi, max(mi) AS last_mi FROM monthly GROUP BY sku",
    "grid": "SELECT sku, first_mi, last_mi, unnest(generate_series(first_mi, last_mi)) AS mi FROM bounds",
    "series": """
SELECT g.sku, g.first_mi, g.last_mi, g.mi, CAST(g.mi - g.first_mi AS HUGEINT) AS x,
       CAST(round(coalesce(m.q, 0) * 1000) AS HUGEINT) AS yu
FROM grid g LEFT JOIN monthly m ON g.sku = m.sku AND g.mi = m.mi""",
    "stats": """
SELECT sku, first_mi, last_mi, CAST(count(*) AS HUGEINT) AS n, count(*) FILTER (WHERE yu = 0) AS nz,
       sum(yu) AS sy, sum(x) AS sx, sum(x * x) AS sxx, sum(x * yu) AS sxy
FROM series GROUP BY sku, first_mi, last_mi""",
    "judged": """
SELECT *, CASE WHEN n < 12 THEN 'insufficient_data' WHEN n < 24 THEN 'insufficient_data'
               WHEN CAST(nz AS DOUBLE) / n > CAST(0.7 AS DOUBLE) THEN 'poor_quality'
               WHEN sy < 10000 THEN 'poor_quality' END AS reject_reason
FROM stats""",
    "passed": "SELECT * FROM judged WHERE reject_reason IS NULL",
    "lin": f"""
SELECT sku, step, {_month_end('last_mi + step')} AS forecast_date,
       CAST({_rhe('(sy * D + NN * (n * (n - 1 + step) - sx))', '(n * D * 1000)')} AS BIGINT) AS forecast_qty,
       'linear' AS method
FROM (SELECT *, n * sxx - sx * sx AS D, n * sxy - sx * sy AS NN FROM passed) p, generate_series(1, 12) AS gs(step)""",
    "caps": f"""
SELECT sku, CAST(max(monthly_total) AS BIGINT) AS max_monthly_sales FROM (
  SELECT items_product_sku AS sku, year(issueddate) AS y, month(issueddate) AS m, sum(items_quantity) AS monthly_total
  FROM sales_items WHERE items_quantity > 0 AND issueddate >= {AS_OF_SQL} - INTERVAL 24 MONTH AND {NQ}
  GROUP BY 1, 2, 3) t GROUP BY sku""",
    "capped": """
SELECT l.sku, l.step, l.forecast_date,
       CASE WHEN coalesce(c.max_monthly_sales, 0) > 0 THEN least(l.forecast_qty, c.max_monthly_sales)
            ELSE l.forecast_qty END AS forecast_qty, l.method
FROM lin l LEFT JOIN caps c ON l.sku = c.sku""",
}

STOCK = {
    "locn": """
SELECT location_id, usage, warehouse,
       CASE WHEN name = 'Stock' THEN warehouse || '/' || name ELSE name END AS nm FROM location""",
    "locf": """
SELECT location_id, usage, warehouse,
       CASE WHEN starts_with(nm, warehouse) THEN nm ELSE warehouse || '/' || nm END AS full_name FROM locn""",
    "pp": """
SELECT q.product_id,
       sum(CASE WHEN l.usage = 'internal' AND q.quantity > 0 THEN q.quantity - q.reserved_quantity ELSE 0.0 END)
         AS qty_available,
       sum(q.quantity) AS virtual_available,
       count(*) FILTER (WHERE l.usage = 'internal' AND q.quantity > 0) AS n_locations
FROM inventory_quant q JOIN locf l ON q.location_id = l.location_id GROUP BY q.product_id""",
    "stock": """
SELECT p.sku, p.name AS product_name, TRUE AS found, coalesce(pp.qty_available, 0.0) AS qty_available,
       coalesce(pp.virtual_available, 0.0) AS virtual_available, coalesce(pp.n_locations, 0) AS n_locations
FROM product p LEFT JOIN pp ON p.product_id = pp.product_id""",
}

PLAN = {
    "mf": f"""
SELECT sku, greatest(forecast_qty, 0) AS forecast_qty, method FROM capped
WHERE date_trunc('month', forecast_date) = DATE '{PLAN_YEAR:04d}-{PLAN_MONTH:02d}-01'""",
    "base_sales": f"SELECT * FROM sales_items WHERE items_quantity > 0 AND items_unitprice > 0 AND {NQ}",
    "latest": """
SELECT items_product_sku AS sku,
       arg_max(items_unitprice, (issueddate, salesinvoiceid, docnumber, items_unitprice)) AS latest_price
FROM base_sales GROUP BY 1""",
    "avgp": f"""
SELECT items_product_sku AS sku, {avg_sql('items_unitprice', 2)} AS avg_price FROM base_sales
WHERE issueddate >= {AS_OF_SQL} - INTERVAL 6 MONTH GROUP BY 1""",
    "prices": """
SELECT coalesce(l.sku, a.sku) AS sku, round(coalesce(l.latest_price, a.avg_price, 0.0), 2) AS unit_price
FROM latest l FULL OUTER JOIN avgp a ON l.sku = a.sku""",
    "hb": """
SELECT p.sku, bl.product_id IS NOT NULL AS has_bom
FROM product p LEFT JOIN (SELECT DISTINCT product_id FROM bom_line) bl ON p.product_id = bl.product_id""",
    "plan_in": """
SELECT mf.sku, coalesce(c.max_monthly_sales, 0) AS cap, s.qty_available AS current_stock,
       CASE WHEN coalesce(c.max_monthly_sales, 0) > 0 THEN least(mf.forecast_qty, c.max_monthly_sales)
            ELSE mf.forecast_qty END AS fq,
       coalesce(pr.unit_price, 0.0) AS unit_price, coalesce(hb.has_bom, FALSE) AS has_bom
FROM mf JOIN stock s ON mf.sku = s.sku AND s.found
LEFT JOIN caps c ON mf.sku = c.sku LEFT JOIN prices pr ON mf.sku = pr.sku LEFT JOIN hb ON mf.sku = hb.sku""",
}

PY_PRIORITY = """
CASE WHEN cap >= 50 THEN
       CASE WHEN fq > 0 AND greatest(0, least(fq, cap) - CAST(trunc(current_stock) AS BIGINT)) <> 0 THEN
              CASE WHEN current_stock / fq >= CAST(0.5 AS DOUBLE) THEN 'CRITICO'
                   WHEN current_stock / fq >= CAST(0.35 AS DOUBLE) THEN 'ALTA'
                   WHEN current_stock / fq >= CAST(0.2 AS DOUBLE) THEN 'MEDIA' ELSE 'BAJA' END
            ELSE 'BAJA' END
     ELSE CASE WHEN greatest(0, least(fq, cap) - CAST(trunc(current_stock) AS BIGINT)) >= 40 THEN 'CRITICO'
               WHEN greatest(0, least(fq, cap) - CAST(trunc(current_stock) AS BIGINT)) >= 25 THEN 'ALTA'
               WHEN greatest(0, least(fq, cap) - CAST(trunc(current_stock) AS BIGINT)) >= 10 THEN 'MEDIA'
               ELSE 'BAJA' END END"""

SQL_PRIORITY = """
CASE WHEN cap >= 50 THEN
       CASE WHEN fq > 0 THEN
              CASE WHEN current_stock / fq >= CAST(0.5 AS DOUBLE) THEN 'CRITICO'
                   WHEN current_stock / fq >= CAST(0.35 AS DOUBLE) THEN 'ALTA'
                   WHEN current_stock / fq >= CAST(0.2 AS DOUBLE) THEN 'MEDIA' ELSE 'BAJA' END
            ELSE 'BAJA' END
     ELSE CASE WHEN least(fq, cap) - CAST(round(current_stock) AS BIGINT) >= 40 THEN 'CRITICO'
               WHEN least(fq, cap) - CAST(round(current_stock) AS BIGINT) >= 25 THEN 'ALTA'
               WHEN least(fq, cap) - CAST(round(current_stock) AS BIGINT) >= 10 THEN 'MEDIA'
               ELSE 'BAJA' END END"""


def _plan_sql(priority: str) -> str:
    return f"""
SELECT sku, {PLAN_YEAR} AS year, {PLAN_MONTH} AS month, cap AS max_monthly_sales, current_stock,
       fq AS forecasted_qty,
       greatest(0, CASE WHEN cap > 0 THEN least(fq, cap) ELSE fq END - CAST(trunc(current_stock) AS BIGINT))
         AS required_production,
       unit_price, {priority} AS priority, has_bom
FROM plan_in"""


ALL = {**CHAIN, **STOCK, **PLAN}

# The chain that starts at the seasonal model, with given parameters: SQL has no optimiser.
SEASONAL_PARAMS = (-0.4, -0.55)
SEASONAL = {
    **{k: v for k, v in CHAIN.items() if k != "capped"}, **sarima.forecast_sql(*SEASONAL_PARAMS),
    "chained": """
SELECT l.sku, l.step, l.forecast_date, coalesce(s.forecast_qty, l.forecast_qty) AS forecast_qty,
       CASE WHEN s.sku IS NULL THEN 'linear' ELSE 'sarima' END AS method
FROM lin l LEFT JOIN sar s ON s.sku = l.sku AND s.step = l.step""",
    "capped": CHAIN["capped"].replace("FROM lin l", "FROM chained l"), **STOCK, **PLAN}


def _sel(*names: str, of: dict[str, str] = ALL) -> dict[str, str]:
    """The named CTEs plus everything defined before them (dependency order)."""
    keys = list(of)
    last = max(keys.index(n) for n in names)
    return {k: of[k] for k in keys[: last + 1]}


# ---- Spark side helpers -----------------------------------------------------
def _arrays(spark, sf_dir):
    v = views(spark, sf_dir)
    return T.sku_month_arrays(T.forecast_sales(v.sales_series, AS_OF, spread_for(v.sales_series)))


def _profile_forecasts(spark, sf_dir, method="linear", params=None):
    """Single-pass path: one scan of sales_items feeds validity, series, cap
    and price (see operators/profile.py)."""
    from stockwise.operators.profile import sku_profile

    si = views(spark, sf_dir).sales_series
    return T.forecasts_from_profile(sku_profile(si, AS_OF, spread_for(si)), method=method, params=params)


def _capped(spark, sf_dir, method="linear", params=None):
    return _profile_forecasts(spark, sf_dir, method, params).drop("max_monthly_sales", "unit_price")


def _stock(spark, sf_dir):
    v = views(spark, sf_dir)
    return INV.stock_by_sku(v.product, v.inventory_quant, v.location)


def _plan(spark, sf_dir, rule="reference", year=PLAN_YEAR, month=PLAN_MONTH, method="linear", params=None, forecasts=None):
    v = views(spark, sf_dir)
    forecasts = _profile_forecasts(spark, sf_dir, method, params) if forecasts is None else forecasts
    mf = T.forecast_for(forecasts, year, month)   # carries cap and price
    return R.forecast_plan(mf, _stock(spark, sf_dir), None, None, INV.has_bom(v.product, v.bom_line),
                           year, month, rule=rule)


def _plan_joined(spark, sf_dir, rule="reference", year=PLAN_YEAR, month=PLAN_MONTH):
    """The same plan assembled from the standalone operators."""
    v = views(spark, sf_dir)
    fc = T.run_forecasts(v.sales_items, AS_OF, method="linear")
    mf = T.forecast_for(fc, year, month)
    return R.forecast_plan(mf, _stock(spark, sf_dir), S.max_monthly_sales(v.sales_items, AS_OF),
                           S.latest_unit_price(v.sales_items, AS_OF), INV.has_bom(v.product, v.bom_line),
                           year, month, rule=rule)


# ---- T family ---------------------------------------------------------------
@register("T1_monthly_series", oracle=f"""
SELECT sku, {_month_end('mi')} AS month, CAST(yu AS DOUBLE) / 1000 AS total_quantity FROM series""",
          extra_ctes=_sel("series"))
def t1_series(spark, sf_dir):
    return T.monthly_series(_arrays(spark, sf_dir))


@register("T2_quality_filter", oracle="""
SELECT sku, CAST(n AS INTEGER) AS n_months, round(CAST(nz AS DOUBLE) / n, 4) AS zero_share,
       CAST(sy AS DOUBLE) / 1000 AS total_quantity, reject_reason FROM judged""", extra_ctes=_sel("judged"))
def t2_quality(spark, sf_dir):
    return T.quality_report(_arrays(spark, sf_dir))


@register("T4_forecast_linear", oracle="SELECT * FROM lin", extra_ctes=_sel("lin"))
def t4_linear(spark, sf_dir):
    arrays = T.quality_filter(_arrays(spark, sf_dir)).where(F.col("reject_reason").isNull())
    return T.forecast_linear(arrays)


@register("T5_forecast_last_year", oracle=f"""
SELECT p.sku, gs.step, {_month_end('p.last_mi + gs.step')} AS forecast_date,
       CAST({_rhe('s.yu * 11', '10000')} AS BIGINT) AS forecast_qty, 'last_year' AS method
FROM passed p, generate_series(1, 12) AS gs(step)
JOIN series s ON s.sku = p.sku AND s.x = p.n - 12 + ((gs.step - 1) % 12)""", extra_ctes=_sel("passed", "series"))
def t5_last_year(spark, sf_dir):
    arrays = T.quality_filter(_arrays(spark, sf_dir)).where(F.col("reject_reason").isNull())
    return T.forecast_last_year(arrays)


@register("T6_forecast_chain_capped", oracle="SELECT * FROM capped", extra_ctes=_sel("capped"))
def t6_chain(spark, sf_dir):
    return _capped(spark, sf_dir)


@register("T7_run_forecasts_linear_operators", oracle="SELECT * FROM capped", extra_ctes=_sel("capped"))
def t7_linear(spark, sf_dir):
    return T.run_forecasts(views(spark, sf_dir).sales_items, AS_OF, method="linear")


@register("T8_sanitize_skus", oracle="""
SELECT trim(items_product_sku) AS sku FROM (SELECT DISTINCT items_product_sku FROM sales_items) t
WHERE trim(items_product_sku) <> '' AND lower(trim(items_product_sku)) NOT IN ('false', 'true', 'none', 'nan', 'null')""")
def t8_sanitize(spark, sf_dir):
    si = views(spark, sf_dir).sales_items
    return T.sanitize_skus(si.select(F.col("items_product_sku").alias("sku")).distinct())


@register("T9_forecast_for_month", oracle="SELECT * FROM mf", extra_ctes=_sel("mf"))
def t9_forecast_for(spark, sf_dir):
    return T.forecast_for(_capped(spark, sf_dir), PLAN_YEAR, PLAN_MONTH)


@register("T10_calendar_expansion", oracle="""
SELECT sku, step, forecast_date, forecast_qty, method, year(forecast_date) AS year, month(forecast_date) AS month,
       strftime(forecast_date, '%B') AS month_name, 'Q' || CAST(quarter(forecast_date) AS VARCHAR) AS quarter,
       weekofyear(forecast_date) AS week_of_year
FROM capped""", extra_ctes=_sel("capped"))
def t10_calendar(spark, sf_dir):
    return T.calendar_columns(_capped(spark, sf_dir))


T11_MONTH = (2001, 7)


def _month_sales_sql(y: int, m: int) -> str:
    return (f"SELECT items_product_sku AS sku, sum(items_quantity) AS real_sales FROM sales_items "
            f"WHERE year(issueddate) = {y} AND month(issueddate) = {m} GROUP BY 1")


def _month_sales(si, y, m):
    return (si.where((F.year("issueddate") == y) & (F.month("issueddate") == m))
            .groupBy(F.col("items_product_sku").alias("sku")).agg(F.sum("items_quantity").alias("real_sales")))


@register("T11_real_vs_forecast", oracle=f"""
SELECT coalesce(r.sku, f.sku) AS sku, coalesce(r.real_sales, 0.0) AS real_sales,
       coalesce(CAST(f.forecast_qty AS DOUBLE), 0.0) AS forecast,
       coalesce(CAST(f.forecast_qty AS DOUBLE), 0.0) - coalesce(r.real_sales, 0.0) AS difference,
       abs(coalesce(CAST(f.forecast_qty AS DOUBLE), 0.0) - coalesce(r.real_sales, 0.0)) AS abs_difference,
       CASE WHEN coalesce(r.real_sales, 0.0) > 0 THEN round((1 - abs(coalesce(CAST(f.forecast_qty AS DOUBLE), 0.0)
            - r.real_sales) / r.real_sales) * 100, 4) END AS accuracy
FROM ({_month_sales_sql(*T11_MONTH)}) r
FULL OUTER JOIN (SELECT sku, greatest(forecast_qty, 0) AS forecast_qty FROM capped
                 WHERE date_trunc('month', forecast_date) = DATE '2001-07-01') f ON r.sku = f.sku""",
          extra_ctes=_sel("capped"))
def t11_real_vs_forecast(spark, sf_dir):
    si = views(spark, sf_dir).sales_items
    f = T.forecast_for(_capped(spark, sf_dir), *T11_MONTH).select("sku", F.col("forecast_qty").alias("forecast"))
    return T.real_vs_forecast(_month_sales(si, *T11_MONTH), f)


@register("T12_clamp_to_history", oracle=f"""
SELECT mf.sku, mf.forecast_qty, mf.method, h.hist_min, h.hist_max,
       CASE WHEN h.hist_max IS NULL THEN CAST(mf.forecast_qty AS DOUBLE)
            ELSE least(greatest(CAST(mf.forecast_qty AS DOUBLE), h.hist_min), h.hist_max) END AS clamped_qty
FROM mf LEFT JOIN (
  SELECT sku, min(CAST(yu AS DOUBLE) / 1000) AS hist_min, max(CAST(yu AS DOUBLE) / 1000) AS hist_max
  FROM series WHERE {_month_end('mi')} < DATE '{PLAN_YEAR:04d}-{PLAN_MONTH:02d}-01' GROUP BY sku) h
ON mf.sku = h.sku""", extra_ctes=_sel("mf"))
def t12_clamp(spark, sf_dir):
    monthly = T.monthly_series(_arrays(spark, sf_dir))
    mf = T.forecast_for(_capped(spark, sf_dir), PLAN_YEAR, PLAN_MONTH)
    return T.clamp_to_history(mf, monthly, dt.date(PLAN_YEAR, PLAN_MONTH, 1))


# ---- A9-A13 over the forecast table ----------------------------------------------
@register("A9_forecast_stats", oracle="""
SELECT sku, CAST(sum(forecast_qty) AS BIGINT) AS total, round(avg(forecast_qty), 2) AS mean,
       round(stddev_samp(forecast_qty), 2) AS std, min(forecast_qty) AS min_qty, max(forecast_qty) AS max_qty,
       count(*) AS n
FROM capped GROUP BY sku""", extra_ctes=_sel("capped"))
def a9_stats(spark, sf_dir):
    fc = _capped(spark, sf_dir)
    return fc.groupBy("sku").agg(
        F.sum("forecast_qty").cast("long").alias("total"), F.round(F.avg("forecast_qty"), 2).alias("mean"),
        F.round(F.stddev_samp("forecast_qty"), 2).alias("std"), F.min("forecast_qty").alias("min_qty"),
        F.max("forecast_qty").alias("max_qty"), F.count(F.lit(1)).alias("n"))


@register("A10_forecasts_by_month", oracle="""
SELECT month(forecast_date) AS month, sku, CAST(sum(forecast_qty) AS BIGINT) AS total_qty
FROM capped GROUP BY 1, 2""", extra_ctes=_sel("capped"))
def a10_by_month(spark, sf_dir):
    return (_capped(spark, sf_dir).groupBy(F.month("forecast_date").alias("month"), "sku")
            .agg(F.sum("forecast_qty").cast("long").alias("total_qty")))


@register("A11_forecast_summary", oracle="""
SELECT count(*) AS n, count(DISTINCT sku) AS skus, count(DISTINCT date_trunc('month', forecast_date)) AS months,
       min(forecast_date) AS first_date, max(forecast_date) AS last_date, CAST(sum(forecast_qty) AS BIGINT) AS total,
       round(avg(forecast_qty), 4) AS mean, min(forecast_qty) AS min_qty, max(forecast_qty) AS max_qty
FROM capped""", extra_ctes=_sel("capped"))
def a11_summary(spark, sf_dir):
    return _capped(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("sku").alias("skus"),
        F.countDistinct(F.trunc("forecast_date", "month")).alias("months"),
        F.min("forecast_date").alias("first_date"), F.max("forecast_date").alias("last_date"),
        F.sum("forecast_qty").cast("long").alias("total"), F.round(F.avg("forecast_qty"), 4).alias("mean"),
        F.min("forecast_qty").alias("min_qty"), F.max("forecast_qty").alias("max_qty"))


@register("A12_forecast_per_sku", oracle="""
SELECT sku, count(*) AS n, CAST(sum(forecast_qty) AS BIGINT) AS total, round(avg(forecast_qty), 2) AS mean,
       min(forecast_date) AS first_date
FROM capped GROUP BY sku""", extra_ctes=_sel("capped"))
def a12_per_sku(spark, sf_dir):
    return _capped(spark, sf_dir).groupBy("sku").agg(
        F.count(F.lit(1)).alias("n"), F.sum("forecast_qty").cast("long").alias("total"),
        F.round(F.avg("forecast_qty"), 2).alias("mean"), F.min("forecast_date").alias("first_date"))


@register("A13_available_months", oracle="""
SELECT DISTINCT CAST(date_trunc('month', forecast_date) AS DATE) AS month FROM capped ORDER BY 1""",
          extra_ctes=_sel("capped"))
def a13_months(spark, sf_dir):
    return _capped(spark, sf_dir).select(F.trunc("forecast_date", "month").alias("month")).distinct().orderBy("month")


# ---- O family -----------------------------------------------------------------
@register("O4_forecast_plan", oracle=_plan_sql(PY_PRIORITY), extra_ctes=_sel("plan_in"))
def o4_plan(spark, sf_dir):
    return _plan(spark, sf_dir)


@register("O4_forecast_plan_joined_operators", oracle=_plan_sql(PY_PRIORITY), extra_ctes=_sel("plan_in"))
def o4_plan_joined(spark, sf_dir):
    return _plan_joined(spark, sf_dir)


@register("O3_forecast_plan_sql_rule", oracle=_plan_sql(SQL_PRIORITY), extra_ctes=_sel("plan_in"))
def o3_plan_sql(spark, sf_dir):
    return _plan(spark, sf_dir, rule="sql")


@register("A19_priority_stats", oracle=f"""
SELECT priority, count(*) AS n, sum(required_production) AS total_required
FROM ({_plan_sql(PY_PRIORITY)}) p GROUP BY priority""", extra_ctes=_sel("plan_in"))
def a19_priority_stats(spark, sf_dir):
    return R.priority_stats(_plan(spark, sf_dir))


@register("O5_production_need", oracle="""
SELECT k.sku, s.product_name, coalesce(CAST(f.forecast_qty AS DOUBLE), 0.0) AS forecast,
       coalesce(r.real_sales, 0.0) AS current_sales, s.qty_available AS inventory,
       coalesce(CAST(f.forecast_qty AS DOUBLE), 0.0) - coalesce(r.real_sales, 0.0) - s.qty_available
         AS production_needed,
       CASE WHEN coalesce(CAST(f.forecast_qty AS DOUBLE), 0.0) - coalesce(r.real_sales, 0.0) - s.qty_available > 100
            THEN 'ALTA'
            WHEN coalesce(CAST(f.forecast_qty AS DOUBLE), 0.0) - coalesce(r.real_sales, 0.0) - s.qty_available > 20
            THEN 'MEDIA' ELSE 'BAJA' END AS priority
FROM (SELECT sku FROM f7 UNION SELECT sku FROM r7) k
LEFT JOIN f7 f ON k.sku = f.sku LEFT JOIN r7 r ON k.sku = r.sku
JOIN stock s ON k.sku = s.sku AND s.found""",
          extra_ctes={**_sel("stock"),
                      "f7": "SELECT sku, greatest(forecast_qty, 0) AS forecast_qty FROM capped "
                            "WHERE date_trunc('month', forecast_date) = DATE '2001-07-01'",
                      "r7": _month_sales_sql(*T11_MONTH)})
def o5_need(spark, sf_dir):
    si = views(spark, sf_dir).sales_items
    f = T.forecast_for(_capped(spark, sf_dir), *T11_MONTH).select("sku", F.col("forecast_qty").alias("forecast"))
    ms = _month_sales(si, *T11_MONTH).withColumnRenamed("real_sales", "current_sales")
    return R.production_need(f, ms, _stock(spark, sf_dir))


@register("O6_stock_days_priority", oracle="""
SELECT sku, forecasted_qty, current_stock,
       CASE WHEN forecasted_qty = 0 THEN 'LOW'
            WHEN current_stock / (forecasted_qty / 30.0) < 7 THEN 'CRITICAL'
            WHEN current_stock / (forecasted_qty / 30.0) < 15 THEN 'HIGH'
            WHEN current_stock / (forecasted_qty / 30.0) < 30 THEN 'MEDIUM' ELSE 'LOW' END AS stock_days_priority
FROM (SELECT sku, fq AS forecasted_qty, current_stock FROM plan_in) t""", extra_ctes=_sel("plan_in"))
def o6_stock_days(spark, sf_dir):
    plan = _plan(spark, sf_dir)
    return plan.select("sku", "forecasted_qty", "current_stock",
                       R.stock_days_priority("forecasted_qty", "current_stock").alias("stock_days_priority"))


@register("O7_stock_by_sku", oracle="SELECT * FROM stock", extra_ctes=_sel("stock"))
def o7_stock(spark, sf_dir):
    return _stock(spark, sf_dir)


@register("O7_stock_requested_skus", oracle="""
SELECT k.sku, s.product_name, coalesce(s.found, FALSE) AS found, coalesce(s.qty_available, 0.0) AS qty_available,
       coalesce(s.virtual_available, 0.0) AS virtual_available, coalesce(s.n_locations, 0) AS n_locations
FROM (SELECT DISTINCT upper(trim(items_product_sku)) AS sku FROM sales_items WHERE issueddate >= DATE '2001-07-01'
      UNION SELECT 'SKU-99999999') k
LEFT JOIN stock s ON k.sku = s.sku""", extra_ctes=_sel("stock"))
def o7_requested(spark, sf_dir):
    v = views(spark, sf_dir)
    req = (v.sales_items.where(F.col("issueddate") >= F.lit(dt.date(2001, 7, 1)))
           .select(F.col("items_product_sku").alias("sku"))
           .unionByName(spark.range(1).select(F.lit("SKU-99999999").alias("sku"))))
    return INV.stock_by_sku(v.product, v.inventory_quant, v.location, skus=req)


@register("O8_stock_by_location", oracle="""
SELECT l.warehouse, l.full_name AS location, p.name AS product_name, p.sku, q.quantity
FROM inventory_quant q JOIN locf l ON q.location_id = l.location_id AND l.usage = 'internal'
JOIN product p ON q.product_id = p.product_id WHERE q.quantity > 0""", extra_ctes=_sel("locf"))
def o8_by_location(spark, sf_dir):
    v = views(spark, sf_dir)
    return INV.stock_by_location(v.product, v.inventory_quant, v.location)


BOMC = """
SELECT p.sku, c.sku AS component_sku,
       CASE WHEN b.uom = 'g' THEN b.product_qty / 1000 ELSE b.product_qty END AS quantity,
       CASE WHEN b.uom = 'g' THEN 'kg' ELSE b.uom END AS uom
FROM bom_line b JOIN product p ON b.product_id = p.product_id JOIN product c ON b.component_id = c.product_id"""


@register("O11_bom_components", oracle=BOMC)
def o11_components(spark, sf_dir):
    v = views(spark, sf_dir)
    return INV.bom_components(v.product, v.bom_line)


@register("O12_all_boms_kg", oracle=f"SELECT sku, component_sku, quantity FROM ({BOMC}) t WHERE uom = 'kg'")
def o12_all_boms(spark, sf_dir):
    v = views(spark, sf_dir)
    return INV.bom_components(v.product, v.bom_line).where(F.col("uom") == "kg").select(
        "sku", "component_sku", "quantity")


@register("O13_has_bom", oracle="SELECT * FROM hb", extra_ctes=_sel("hb"))
def o13_has_bom(spark, sf_dir):
    v = views(spark, sf_dir)
    return INV.has_bom(v.product, v.bom_line)


@register("O14_max_producible", oracle=f"""
SELECT p.sku, round(coalesce(m.max_quantity, 0.0), 4) AS max_quantity FROM product p LEFT JOIN (
  SELECT bc.sku, min(CASE WHEN bc.quantity <= 0 THEN 0.0 ELSE coalesce(s.qty_available, 0.0) / bc.quantity END)
    AS max_quantity
  FROM ({BOMC}) bc LEFT JOIN stock s ON bc.component_sku = s.sku GROUP BY bc.sku) m ON p.sku = m.sku""",
          extra_ctes=_sel("stock"))
def o14_max_producible(spark, sf_dir):
    v = views(spark, sf_dir)
    return INV.max_producible(v.product, v.bom_line, _stock(spark, sf_dir))


@register("A15_stock_product_location", oracle="""
SELECT product_id, location_id, sum(quantity) AS quantity FROM inventory_quant
WHERE product_id IS NOT NULL AND location_id IS NOT NULL GROUP BY 1, 2""")
def a15_stock(spark, sf_dir):
    return INV.stock_by_product_location(views(spark, sf_dir).inventory_quant)


@register("I18_negative_stock_clamp", oracle="""
SELECT product_id, location_id, greatest(sum(quantity), 0.0) AS quantity FROM inventory_quant GROUP BY 1, 2""")
def i18_clamp(spark, sf_dir):
    return INV.clamp_negative(INV.stock_by_product_location(views(spark, sf_dir).inventory_quant))


@register("O15_daily_stock_snapshot", oracle="""
SELECT product_id, location_id, sum(quantity) AS quantity, DATE '2001-08-15' AS snapshot_date
FROM inventory_quant GROUP BY 1, 2""")
def o15_snapshot(spark, sf_dir):
    return INV.daily_stock_snapshot(views(spark, sf_dir).inventory_quant, AS_OF)


# ---- the whole chain, seasonal model first ---------------------------------
# Fitted models have no SQL form (rows-only in the driver; numeric tests in tests/); with given
# parameters the same recursion is an oracle for every step of the chain.
def _passed(spark, sf_dir):
    return T.quality_filter(_arrays(spark, sf_dir)).where(F.col("reject_reason").isNull()).select("sku", "first_mi", "last_mi", "y_u")


@register("T3_forecast_sarima")
def t3_sarima(spark, sf_dir):
    return sarima.forecast_sarima(_passed(spark, sf_dir))


@register("T3_forecast_sarima_given", oracle=f"""
SELECT s.sku, s.step, {_month_end('p.last_mi + s.step')} AS forecast_date, s.forecast_qty, 'sarima' AS method
FROM sar s JOIN passed p ON p.sku = s.sku""", extra_ctes=_sel("sar", of=SEASONAL))
def t3_sarima_given(spark, sf_dir):
    return sarima.forecast_sarima(_passed(spark, sf_dir), params=SEASONAL_PARAMS)


@register("T7_run_forecasts_auto")
def t7_auto(spark, sf_dir):
    return T.run_forecasts(views(spark, sf_dir).sales_items, AS_OF, method="auto")


@register("T6_forecast_chain_seasonal")
def t6_seasonal(spark, sf_dir):
    return _capped(spark, sf_dir, method="auto")


@register("T6_forecast_chain_seasonal_given", oracle="SELECT * FROM capped", extra_ctes=_sel("capped", of=SEASONAL))
def t6_seasonal_given(spark, sf_dir):
    return _capped(spark, sf_dir, "auto", SEASONAL_PARAMS)


@register("O4_forecast_plan_seasonal")
def o4_plan_seasonal(spark, sf_dir):
    return _plan(spark, sf_dir, method="auto")


@register("O4_forecast_plan_seasonal_given", oracle=_plan_sql(PY_PRIORITY), extra_ctes=_sel("plan_in", of=SEASONAL))
def o4_plan_seasonal_given(spark, sf_dir):
    return _plan(spark, sf_dir, method="auto", params=SEASONAL_PARAMS)


@register("O3_forecast_plan_sql_rule_seasonal_given", oracle=_plan_sql(SQL_PRIORITY), extra_ctes=_sel("plan_in", of=SEASONAL))
def o3_plan_seasonal_given(spark, sf_dir):
    return _plan(spark, sf_dir, rule="sql", method="auto", params=SEASONAL_PARAMS)
