"""Registered queries of stored tables and incremental syncs (U1, U2, U7-U10, U15,
U17, R1, R2): the table is made in the shared folder, gets its batches, some of them
twice, and is read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from stockwise.config import AS_OF, PLAN_MONTH, PLAN_YEAR
from stockwise.operators import ingest as I
from stockwise.operators import replenish as R
from stockwise.operators import series as T
from stockwise.operators import stored as ST
from stockwise.plans.common import views
from stockwise.plans.forecast import PLAN, PY_PRIORITY, _capped, _plan, _plan_sql, _profile_forecasts, _sel
from stockwise.plans.registry import register
from stockwise.plans.sync import DEDUP_LAST, LEGACY, PROD_TS, SALES_TS, SI_REST, _legacy_inputs, _prod_target_source, _sales_target_source
from stockwise.session import cut_lineage, shared_path
from stockwise.sources.views import spread_for


def _path(spark, name):
    return shared_path(spark, f"stored/{name}-{uuid.uuid4().hex[:10]}")


def _table(name, rows, keys, create=True, size=0):
    """A table for about ``size`` rows."""
    table = ST.KeyedTable(rows.sparkSession, _path(rows.sparkSession, name), rows.schema, keys, ST.buckets_for(size))
    return table.create(rows if create else None)


# U1 / U2 ----------------------------------------------------------------------
@register("U1_upsert_products_stored", oracle="""
SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE sku NOT IN (SELECT sku FROM src)""", extra_ctes=PROD_TS)
def u1_stored(spark, sf_dir):
    target, source = _prod_target_source(views(spark, sf_dir))
    table = _table("products", target, ["sku"])
    table.upsert(source)
    table.upsert(source)
    return table.read()


@register("U2_upsert_sales_stored", oracle=f"""
SELECT * FROM ({DEDUP_LAST.format(rest=SI_REST, src='ss')}) n
UNION ALL SELECT * FROM ({DEDUP_LAST.format(rest=SI_REST, src='st')}) o WHERE NOT EXISTS (
  SELECT 1 FROM ss WHERE ss.salesinvoiceid = o.salesinvoiceid AND ss.items_product_sku = o.items_product_sku)""", extra_ctes=SALES_TS)
def u2_stored(spark, sf_dir):
    target, source = _sales_target_source(views(spark, sf_dir))
    keys = ["salesinvoiceid", "items_product_sku"]
    table = _table("sales", target, keys, create=False, size=views(spark, sf_dir).sales_items.count())
    for batch in (target, source):
        table.upsert(batch, order=["docnumber"], written=True)
    return table.read()


# U7 ---------------------------------------------------------------------------
def forecast_rows(forecasts):
    """The stored forecast table's columns: calendar and the SKU's totals."""
    of = Window.partitionBy("sku")
    q = F.col("forecast_qty")
    return T.calendar_columns(forecasts).select(
        "sku", "forecast_date", q.alias("forecasted_quantity"), "year", "month", "month_name", "quarter", "week_of_year",
        F.sum(q).over(of).cast("long").alias("total_forecast_12_months"), F.round(F.avg(q).over(of), 2).alias("avg_monthly_forecast"),
        F.round(F.stddev_samp(q).over(of), 2).alias("std_dev"), F.min(q).over(of).alias("min_monthly_forecast"),
        F.max(q).over(of).alias("max_monthly_forecast"), F.count(F.lit(1)).over(of).alias("months_forecasted"))


FORECAST_TABLE = """
SELECT sku, forecast_date, forecast_qty AS forecasted_quantity, year(forecast_date) AS year, month(forecast_date) AS month,
       strftime(forecast_date, '%B') AS month_name, 'Q' || CAST(quarter(forecast_date) AS VARCHAR) AS quarter,
       weekofyear(forecast_date) AS week_of_year, CAST(sum(forecast_qty) OVER s AS BIGINT) AS total_forecast_12_months,
       round(avg(forecast_qty) OVER s, 2) AS avg_monthly_forecast, round(stddev_samp(forecast_qty) OVER s, 2) AS std_dev,
       min(forecast_qty) OVER s AS min_monthly_forecast, max(forecast_qty) OVER s AS max_monthly_forecast,
       count(*) OVER s AS months_forecasted
FROM capped WINDOW s AS (PARTITION BY sku)"""


@register("U7_forecast_series_table", oracle=f"""
SELECT * EXCLUDE (step) REPLACE (CASE WHEN step <= 4 THEN forecasted_quantity + 1000 ELSE forecasted_quantity END AS forecasted_quantity)
FROM (SELECT f.*, c.step FROM ({FORECAST_TABLE}) f JOIN capped c ON c.sku = f.sku AND c.forecast_date = f.forecast_date) t""",
          extra_ctes=_sel("capped"))
def u7_forecast_table(spark, sf_dir):
    """An older run's rows (quantities off by 1000) up to the eighth month, then
    the new run's rows from the fifth on, twice."""
    capped = cut_lineage(_capped(spark, sf_dir))
    rows = forecast_rows(capped).join(capped.select("sku", "forecast_date", "step"), ["sku", "forecast_date"])
    older = rows.where("step <= 8").withColumn("forecasted_quantity", F.col("forecasted_quantity") + 1000).drop("step")
    newer = rows.where("step >= 5").drop("step")
    table = _table("forecast", older, ["sku", "forecast_date"])
    table.upsert(newer)
    table.upsert(newer)
    return table.read()


# U8 ---------------------------------------------------------------------------
NEXT = (PLAN_YEAR, PLAN_MONTH + 1)


def _next_month(sql):
    return sql.replace(f"DATE '{PLAN_YEAR:04d}-{PLAN_MONTH:02d}-01'", f"DATE '{NEXT[0]:04d}-{NEXT[1]:02d}-01'")


PLAN_TABLE = f"""
SELECT * FROM ({_plan_sql(PY_PRIORITY)}) a UNION ALL
SELECT * FROM ({_plan_sql(PY_PRIORITY).replace(f'{PLAN_MONTH} AS month', f'{NEXT[1]} AS month').replace('FROM plan_in', 'FROM plan_next')}) b"""
PLAN_CTES = {**_sel("plan_in"), "mf_next": _next_month(PLAN["mf"]), "plan_next": PLAN["plan_in"].replace("FROM mf JOIN", "FROM mf_next AS mf JOIN")}


def _plan_table(spark, sf_dir):
    forecasts = cut_lineage(_profile_forecasts(spark, sf_dir))      # once for both months
    first, second = (cut_lineage(_plan(spark, sf_dir, year=y, month=m, forecasts=forecasts)) for y, m in ((PLAN_YEAR, PLAN_MONTH), NEXT))
    table = _table("plan", first, ["sku", "year", "month"], create=False)
    for batch in (first.withColumn("priority", F.lit("BAJA")), second, first):
        table.upsert(batch)
    return table.read()


@register("U8_forecast_plan_table", oracle=PLAN_TABLE, extra_ctes=PLAN_CTES)
def u8_plan_table(spark, sf_dir):
    return _plan_table(spark, sf_dir)


@register("U8_plan_priority_totals", oracle=f"""
SELECT priority, count(*) AS n, sum(required_production) AS total_required FROM ({PLAN_TABLE}) t
WHERE month = {PLAN_MONTH} GROUP BY 1""", extra_ctes=PLAN_CTES)
def u8_totals(spark, sf_dir):
    return R.priority_stats(_plan_table(spark, sf_dir).where((F.col("year") == PLAN_YEAR) & (F.col("month") == PLAN_MONTH)))


# U9 / U10 ---------------------------------------------------------------------
@register("U9_legacy_orders_table", oracle="""
SELECT -CAST(('0x' || substr(md5(salesinvoiceid), 1, 15)) AS BIGINT) AS odoo_id, salesinvoiceid,
       max(issueddate) AS date_order, max(total_total) AS amount_total, 'done' AS state
FROM good GROUP BY salesinvoiceid""", extra_ctes=LEGACY)
def u9_orders(spark, sf_dir):
    si, known = _legacy_inputs(views(spark, sf_dir))
    parts, size = spread_for(si), si.count()
    whole = I.legacy_orders(si, known, parts)
    table = _table("legacy-orders", whole, ["odoo_id"], create=False, size=size // 4)
    table.upsert(I.legacy_orders(si.where(F.col("issueddate") < F.lit(dt.date(1998, 1, 1))), known, parts))
    table.upsert(whole)
    return table.read()


@register("U10_legacy_lines_table", oracle="""
SELECT l.*, o.date_order FROM (
  SELECT -CAST(('0x' || substr(md5(salesinvoiceid || items_product_sku), 1, 15)) AS BIGINT) AS odoo_id,
         -CAST(('0x' || substr(md5(salesinvoiceid), 1, 15)) AS BIGINT) AS order_odoo_id,
         pid AS product_id, items_quantity AS quantity, items_unitprice AS unit_price, salesinvoiceid FROM good) l
JOIN (SELECT salesinvoiceid, max(issueddate) AS date_order FROM good GROUP BY 1) o USING (salesinvoiceid)
""".replace("l.*", "l.odoo_id, l.order_odoo_id, l.product_id, l.quantity, l.unit_price"), extra_ctes=LEGACY)
def u10_lines(spark, sf_dir):
    """Lines take their order's stored surrogate, so orders are stored first."""
    si, known = _legacy_inputs(views(spark, sf_dir))
    good, size = ST.parked(I.good_lines(si, known, spread_for(si))), si.count()      # for orders and lines
    orders = _table("orders", I.orders_of(good), ["odoo_id"], size=size // 4)
    lines = I.lines_of(good).join(
        orders.read().select(F.col("odoo_id").alias("order_odoo_id"), "date_order"), "order_odoo_id").select(
        "odoo_id", "order_odoo_id", "product_id", "quantity", "unit_price", "date_order")
    lines = ST.parked(lines)
    table = _table("legacy-lines", lines, ["odoo_id"], create=False, size=size)
    table.upsert(lines.where(F.col("date_order") < F.lit(dt.date(1998, 1, 1))), written=True)
    table.upsert(lines, written=True)
    return table.read()


# U15 / U17 / R1 / R2 --------------------------------------------------------------
def _noon(day):
    return dt.datetime(day.year, day.month, day.day, 12)


def _synced_sales(spark, sf_dir):
    """History up to a watermark, then four syncs, one of them for nothing new."""
    si = views(spark, sf_dir).sales_items
    begun = dt.date(2000, 10, 1)
    keys = ["salesinvoiceid", "items_product_sku"]
    table = _table("sync-sales", si, keys, create=False, size=si.count())
    table.upsert(si.where(F.col("issueddate") <= F.lit(begun)), order=["docnumber"], written=True)
    state = ST.SyncState(spark, _path(spark, "state"))
    state.set("sales_items", dt.datetime(begun.year, begun.month, begun.day))
    for as_of in (dt.date(2001, 2, 1), dt.date(2001, 2, 1), dt.date(2001, 5, 1), AS_OF):
        ST.incremental_sync(si, table, state, "sales_items", "issueddate", _noon(as_of), order=["docnumber"])
    return table, state


def _synced_products(spark, sf_dir, state=None):
    p = views(spark, sf_dir).product.select("product_id", "sku", "name", "list_price", "is_active", "write_date")
    table = _table("sync-products", p, ["sku"], create=False)
    state = state or ST.SyncState(spark, _path(spark, "state"))
    for hour in (5, 13, 23):
        ST.incremental_sync(p, table, state, "product", "write_date", dt.datetime(2024, 1, 1, hour, 59, 59))
    ST.incremental_sync(p, table, state, "product", "write_date", dt.datetime(2024, 1, 10))
    return table, state


@register("R1_sync_sales_by_watermark", oracle=DEDUP_LAST.format(rest=SI_REST, src="sales_items"))
def r1_watermark(spark, sf_dir):
    return _synced_sales(spark, sf_dir)[0].read()


@register("R2_sync_products_by_watermark", oracle="SELECT product_id, sku, name, list_price, is_active FROM product")
def r2_watermark(spark, sf_dir):
    return _synced_products(spark, sf_dir)[0].read().drop("write_date")


@register("U15_stored_watermarks", oracle="""
SELECT 'product' AS model_name, max(write_date) AS last_synced FROM product
UNION ALL SELECT 'sales_items', CAST(max(issueddate) AS TIMESTAMP) FROM sales_items""")
def u15_watermarks(spark, sf_dir):
    _, state = _synced_sales(spark, sf_dir)
    return _synced_products(spark, sf_dir, state)[1].table.read()


@register("U17_sync_windows", oracle=f"""
SELECT partner_id, CASE WHEN partner_id % 5 = 0 THEN TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL 90 DAY
                        WHEN write_date IS NULL OR partner_id % 5 = 1 THEN TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL 30 DAY
                        ELSE write_date - INTERVAL 1 HOUR END AS start_at, TIMESTAMP '{AS_OF} 00:00:00' AS end_at
FROM partner WHERE partner_id % 5 IN (0, 1) OR write_date IS NULL OR write_date - INTERVAL 1 HOUR <= TIMESTAMP '{AS_OF} 00:00:00'""")
def u17_windows(spark, sf_dir):
    """Every partner's next window from its last write: every fifth a full sync,
    every fifth never synced; windows that start after their end drop out."""
    as_of = F.lit(dt.datetime(AS_OF.year, AS_OF.month, AS_OF.day))
    p = views(spark, sf_dir).partner
    last = F.when(F.col("partner_id") % 5 != 1, F.col("write_date"))
    return ST.sync_windows(p.select("partner_id", last.alias("last"), (F.col("partner_id") % 5 == 0).alias("full")), as_of).select(
        "partner_id", "start_at", "end_at")
