"""Replenishment plan.

The plan is one lazy join of SKU-level frames (forecast, stock, cap,
price, BOM flag); every input is already aggregated to one row per SKU, so
the joins are key-unique and the plan shuffles each input once by ``sku``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwise.config import PRIORITY_ORDER, ROTATION_THRESHOLD


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# O1 -------------------------------------------------------------------------
def limited_forecast(f, cap) -> Column:
    f, cap = _c(f), _c(cap)
    return F.when(cap > 0, F.least(f, cap)).otherwise(f)


def required_production(f, stock, cap) -> Column:
    """max(0, min(f, cap) - trunc(stock)); the cap is ignored when 0."""
    return F.greatest(F.lit(0), limited_forecast(f, cap) - _c(stock).cast("long"))


# Fixed business values: the least stock ratio, and the least missing units, of each priority but the last.
RATIO_CUTS = (0.5, 0.35, 0.2)
UNIT_CUTS = (40, 25, 10)


def graded(value: Column, cuts: tuple) -> Column:
    """The first priority whose cut ``value`` reaches, the last one below all."""
    out = F.lit(PRIORITY_ORDER[-1])
    for name, cut in reversed(list(zip(PRIORITY_ORDER, cuts))):
        out = F.when(value >= cut, name).otherwise(out)
    return out


def graded_sql(value: str, cuts: tuple) -> str:
    """``graded`` as SQL text."""
    arms = " ".join(f"WHEN {value} >= {cut}{'D' if isinstance(cut, float) else ''} THEN '{name}'" for name, cut in zip(PRIORITY_ORDER, cuts))
    return f"CASE {arms} ELSE '{PRIORITY_ORDER[-1]}' END"


# O2 -------------------------------------------------------------------------
def priority_python(f, stock, cap) -> Column:
    """Reference Python rule. Fast movers (cap >= 50): ratio stock/f, only
    when f > 0 and required > 0. Slow movers: required >= 40/25/10.
    Note required uses min(f, cap) even for cap = 0 (-> BAJA)."""
    f, stock, cap = _c(f), _c(stock), _c(cap)
    req = F.greatest(F.lit(0), F.least(f, cap) - stock.cast("long"))
    ratio = stock / f
    fast = F.when((f > 0) & (req != 0), graded(ratio, RATIO_CUTS)).otherwise(PRIORITY_ORDER[-1])
    return F.when(cap >= ROTATION_THRESHOLD, fast).otherwise(graded(req, UNIT_CUTS))


# O3 -------------------------------------------------------------------------
def priority_sql(f, stock, cap) -> Column:
    """Reference SQL-function rule: no required > 0 test, no clamp, and the
    stock is cast to integer by rounding."""
    f, stock, cap = _c(f), _c(stock), _c(cap)
    ratio = stock / f
    fast = F.when(f > 0, graded(ratio, RATIO_CUTS)).otherwise(PRIORITY_ORDER[-1])
    req = F.least(f, cap) - F.round(stock, 0).cast("long")
    return F.when(cap >= ROTATION_THRESHOLD, fast).otherwise(graded(req, UNIT_CUTS))


def priority_function() -> str:
    """``priority_sql`` as a temporary SQL function (G3), from the same cuts."""
    fast = f"IF(f > 0, {graded_sql('stock / f', RATIO_CUTS)}, '{PRIORITY_ORDER[-1]}')"
    slow = graded_sql("(least(f, cap) - CAST(round(stock) AS BIGINT))", UNIT_CUTS)
    return ("CREATE OR REPLACE TEMPORARY FUNCTION calculate_priority(f BIGINT, stock DOUBLE, cap BIGINT) RETURNS STRING "
            f"RETURN IF(cap >= {ROTATION_THRESHOLD}, {fast}, {slow})")


def priority_rank(p) -> Column:
    p = _c(p)
    expr = F.when(p == PRIORITY_ORDER[0], 0)
    for i, name in enumerate(PRIORITY_ORDER[1:], start=1):
        expr = expr.when(p == name, i)
    return expr.otherwise(len(PRIORITY_ORDER))


# O4 -------------------------------------------------------------------------
def forecast_plan(month_forecast: DataFrame, stock: DataFrame, caps: DataFrame | None, prices: DataFrame | None,
                  boms: DataFrame, year: int, month: int, rule: str = "reference") -> DataFrame:
    """Month forecast ⋈ stock (found only) ⋈ cap ⋈ price ⋈ has_bom.

    ``rule='reference'`` is the Python priority; ``'sql'`` the SQL function.
    Sorted by priority severity then required production (desc).
    """
    st = stock.where(F.col("found")).select("sku", F.col("qty_available").alias("current_stock"))
    # With caps / prices None the month forecast already carries
    # max_monthly_sales and unit_price (single-pass profile path).
    carried = [c for c in ("max_monthly_sales", "unit_price") if c in month_forecast.columns]
    df = month_forecast.select("sku", "forecast_qty", *carried).join(st, "sku")
    if caps is not None:
        df = df.join(caps, "sku", "left")
    if prices is not None:
        df = df.join(prices, "sku", "left")
    df = df.join(boms, "sku", "left")
    cap = F.coalesce("max_monthly_sales", F.lit(0)).cast("long")
    df = df.withColumn("max_monthly_sales", cap)
    df = df.withColumn("forecasted_qty", limited_forecast("forecast_qty", "max_monthly_sales"))
    prio = priority_python if rule == "reference" else priority_sql
    df = df.select(
        "sku", F.lit(year).alias("year"), F.lit(month).alias("month"),
        "max_monthly_sales", "current_stock", "forecasted_qty",
        required_production("forecasted_qty", "current_stock", "max_monthly_sales").alias("required_production"),
        F.coalesce("unit_price", F.lit(0.0)).alias("unit_price"),
        prio("forecasted_qty", "current_stock", "max_monthly_sales").alias("priority"),
        F.coalesce("has_bom", F.lit(False)).alias("has_bom"))
    return df.orderBy(priority_rank("priority"), F.col("required_production").desc(), "sku")


# A19 ------------------------------------------------------------------------
def priority_stats(plan: DataFrame) -> DataFrame:
    return (plan.groupBy("priority")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("required_production").alias("total_required"))
            .orderBy(priority_rank("priority")))


# O5 -------------------------------------------------------------------------
def production_need(forecast: DataFrame, month_sales: DataFrame, stock: DataFrame) -> DataFrame:
    """need = forecast - month sales - stock over the union of SKUs; rows not
    found in the catalogue are excluded. >100 ALTA, >20 MEDIA, else BAJA."""
    keys = forecast.select("sku").unionByName(month_sales.select("sku")).distinct()
    df = (keys.join(forecast, "sku", "left").join(month_sales, "sku", "left")
          .join(stock.select("sku", "found", "qty_available", "product_name"), "sku", "left")
          .where(F.coalesce("found", F.lit(False))))
    need = (F.coalesce(F.col("forecast").cast("double"), F.lit(0.0))
            - F.coalesce("current_sales", F.lit(0.0)) - F.col("qty_available"))
    return df.select(
        "sku", "product_name",
        F.coalesce(F.col("forecast").cast("double"), F.lit(0.0)).alias("forecast"),
        F.coalesce("current_sales", F.lit(0.0)).alias("current_sales"),
        F.col("qty_available").alias("inventory"),
        need.alias("production_needed"),
        F.when(need > 100, "ALTA").when(need > 20, "MEDIA").otherwise("BAJA").alias("priority"))


# O6 -------------------------------------------------------------------------
def stock_days_priority(f, stock, days_in_month: int = 30,
                        cutoffs: tuple[float, float, float] = (7.0, 15.0, 30.0)) -> Column:
    """Days of stock = stock / (f / days). Cut-offs are parameters (the
    reference does not define them): < c0 CRITICAL, < c1 HIGH, < c2 MEDIUM."""
    daily = _c(f) / F.lit(days_in_month)
    days = F.try_divide(_c(stock), daily)
    return (F.when(days.isNull(), "LOW").when(days < cutoffs[0], "CRITICAL").when(days < cutoffs[1], "HIGH")
            .when(days < cutoffs[2], "MEDIUM").otherwise("LOW"))
