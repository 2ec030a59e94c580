"""Monthly demand series and forecasts.

Layout for scale: sales are pre-aggregated to (sku, month) with map-side
partial aggregation, then grouped once by SKU into one row holding the
zero-filled month array (its length is the SKU's month span, so it is
bounded by calendar time, not by data volume). Quality statistics, the
least-squares fit and the last-year forecast are higher-order functions over
that array: no further shuffle. SARIMA (T3) consumes the same rows through
``mapInPandas``.

Quantities are kept in exact integer units (x1000) and forecasts are
rounded half-to-even from exact rationals, so results are engine-independent.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwise.config import INVALID_SKU_TOKENS
from stockwise.functions.scalars import not_quotation
from stockwise.operators.sales import max_monthly_sales, valid_skus

E = F.expr
QTY_SCALE = 1000


def month_index(d) -> Column:
    d = F.col(d) if isinstance(d, str) else d
    return F.year(d) * 12 + F.month(d) - 1


def month_end_of_index(mi) -> Column:
    mi = F.col(mi) if isinstance(mi, str) else mi
    return F.last_day(F.make_date((mi / 12).cast("int"), (mi % 12 + 1).cast("int"), F.lit(1)))


def forecast_sales(si: DataFrame, as_of, parts: tuple[int, ...] = ()) -> DataFrame:
    """Rows feeding the forecaster: valid SKUs, quantity > 0, not quotations. ``parts``
    (``views.spread_for``) is the number of partitions where the session's are too few."""
    ok = valid_skus(si, as_of)
    ok = ok.repartition(*parts, "sku") if parts else ok     # the sales follow in the join
    base = si.where((F.col("items_quantity") > 0) & not_quotation())
    return base.join(ok.withColumnRenamed("sku", "items_product_sku"), "items_product_sku", "left_semi")


# T1 ------------------------------------------------------------------------
def month_units(q) -> Column:
    return F.round(F.col(q) * QTY_SCALE).cast("long")


def month_array(entries: str = "m") -> Column:
    """Months in order with zeros between them, from (mi, u) entries in any order: one
    pass, where a look-up for each month would go through the entries again."""
    return E(f"flatten(transform(array(array_sort({entries})), s -> flatten(transform(s, (e, k) -> "
             "concat(array_repeat(0L, IF(k = 0, 0, e.mi - s[greatest(k - 1, 0)].mi - 1)), array(e.u))))))")


def sku_month_arrays(sales: DataFrame) -> DataFrame:
    """One row per SKU: first/last month index, the zero-filled array of monthly
    quantities in exact units (``y_u``) and its statistics."""
    monthly = (sales.groupBy(F.col("items_product_sku").alias("sku"),
                             month_index("issueddate").alias("mi"))
               .agg(F.sum("items_quantity").alias("q")))
    per_sku = (monthly.groupBy("sku")
               .agg(F.min("mi").alias("first_mi"), F.max("mi").alias("last_mi"), *month_measures(F.col("mi").isNotNull())))
    dated = per_sku.where(F.col("first_mi").isNotNull())        # sales without a date have no month
    return dated.select("sku", "first_mi", "last_mi", month_array().alias("y_u"), *month_stats())


def month_measures(counted: Column) -> list[Column]:
    """Aggregates over a SKU's months (mi, q): its entries, how many are not zero, their sum."""
    u = F.when(counted, F.coalesce(month_units("q"), F.lit(0).cast("long")))
    return [F.collect_list(F.when(counted, F.struct("mi", u.alias("u")))).alias("m"), F.count_if(u != 0).alias("n_some"), F.sum(u).alias("total_u")]


def month_stats() -> list[Column]:
    """``series_stats`` of the array, without it: a filter on them leaves the arrays of
    other SKUs unbuilt."""
    n = F.col("last_mi") - F.col("first_mi") + 1
    return [n.alias("n_months"), (n - F.col("n_some")).cast("int").alias("n_zero"), "total_u"]


def monthly_series(arrays: DataFrame) -> DataFrame:
    """T1 long form: (sku, month end, total_quantity), zero-filled per SKU."""
    return arrays.select("sku", "first_mi", F.posexplode("y_u").alias("pos", "yu")).select(
        "sku",
        month_end_of_index(F.col("first_mi") + F.col("pos")).alias("month"),
        (F.col("yu").cast("double") / QTY_SCALE).alias("total_quantity"))


# T2 ------------------------------------------------------------------------
def series_stats(arrays: DataFrame) -> DataFrame:
    if "total_u" in arrays.columns:      # counted with the months
        return arrays
    n = F.size("y_u")
    zeros = F.size(F.filter("y_u", lambda v: v == 0))
    total = F.aggregate("y_u", F.lit(0).cast("long"), lambda a, v: a + v)
    return arrays.select("*", n.alias("n_months"), zeros.alias("n_zero"), total.alias("total_u"))


def quality_filter(arrays: DataFrame, min_span: int = 24, max_zero_share: float = 0.7,
                   min_total: float = 10) -> DataFrame:
    """Adds ``reject_reason`` (NULL = passes): span < 12 or < 24 ->
    insufficient_data; zero share > 0.7 or total < 10 -> poor_quality."""
    st = series_stats(arrays)
    reason = (F.when(F.col("n_months") < 12, "insufficient_data")
              .when(F.col("n_months") < min_span, "insufficient_data")
              .when(F.col("n_zero") / F.col("n_months") > F.lit(max_zero_share), "poor_quality")
              .when(F.col("total_u") < F.lit(int(min_total * QTY_SCALE)), "poor_quality"))
    return st.withColumn("reject_reason", reason)


def quality_report(arrays: DataFrame) -> DataFrame:
    q = quality_filter(arrays)
    return q.select(
        "sku", "n_months",
        F.round(F.col("n_zero") / F.col("n_months"), 4).alias("zero_share"),
        (F.col("total_u").cast("double") / QTY_SCALE).alias("total_quantity"),
        "reject_reason")


# Rational rounding ----------------------------------------------------------
def round_half_even_ratio_sql(num: str, den: str, idiv: str = "div") -> str:
    """SQL for round-half-even(max(num, 0) / den) of exact integers (den > 0)."""
    q = f"(({num}) {idiv} ({den}))"
    r = f"(({num}) - {q} * ({den}))"
    return (f"(CASE WHEN ({num}) <= 0 THEN 0 ELSE {q} + CASE WHEN 2 * {r} > ({den}) THEN 1 "
            f"WHEN 2 * {r} = ({den}) THEN {q} % 2 ELSE 0 END END)")


# T4 / T5 --------------------------------------------------------------------
def _with_regression_sums(df: DataFrame) -> DataFrame:
    """n, Σx, Σx², Σy, Σxy over x = 0..n-1 as BIGINT (exact for any
    realistic span and volume); the products that could exceed 64 bits are
    formed in DECIMAL(38,0) below."""
    return df.withColumns({
        "_n": E("CAST(size(y_u) AS BIGINT)"),
        "_sx": E("CAST(size(y_u) AS BIGINT) * (size(y_u) - 1) div 2"),
        "_sxx": E("CAST(size(y_u) - 1 AS BIGINT) * size(y_u) * (2 * size(y_u) - 1) div 6"),
        "_sy": E("aggregate(y_u, CAST(0 AS BIGINT), (a, v) -> a + v)"),
        "_sxy": E("aggregate(zip_with(y_u, sequence(0, size(y_u) - 1), (v, i) -> v * i), "
                  "CAST(0 AS BIGINT), (a, v) -> a + v)"),
    })


def _steps_frame(arrays: DataFrame, steps: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """Regression sums per SKU, then one row per (SKU, step)."""
    d = "DECIMAL(38,0)"
    df = _with_regression_sums(arrays).withColumns({
        "_dd": E(f"CAST(_n AS {d}) * _sxx - CAST(_sx AS {d}) * _sx"),
        "_nn": E(f"CAST(_n AS {d}) * _sxy - CAST(_sx AS {d}) * _sy"),
    })
    return df.select("sku", "last_mi", "y_u", "_n", "_sx", "_sy", "_dd", "_nn", *extra,
                     F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))


def _linear_qty(min_points: int = 6) -> Column:
    num = "(_sy * _dd + _nn * (_n * (_n - 1 + step) - _sx))"
    den = f"(_n * _dd * {QTY_SCALE})"
    return F.when(F.size("y_u") >= min_points, E(round_half_even_ratio_sql(num, den)).cast("long"))


def _last_year_qty(min_points: int = 12) -> Column:
    num = f"(element_at(y_u, size(y_u) - 12 + ((step - 1) % 12) + 1) * 11)"
    return F.when(F.size("y_u") >= min_points,
                  E(round_half_even_ratio_sql(num, f"{QTY_SCALE * 10}")).cast("long"))


def _finish(df: DataFrame, qty: Column, method: Column, carry: tuple[str, ...] = ()) -> DataFrame:
    return df.select(
        "sku", "step", *carry,
        month_end_of_index(F.col("last_mi") + F.col("step")).alias("forecast_date"),
        qty.alias("forecast_qty"), method.alias("method")).where(F.col("forecast_qty").isNotNull())


def forecast_linear(arrays: DataFrame, steps: int = 12, min_points: int = 6) -> DataFrame:
    """Least squares on x = 0..n-1 (n >= 6), extrapolated ``steps`` months,
    clipped at 0 and rounded half-to-even (exact rational arithmetic)."""
    return _finish(_steps_frame(arrays, steps), _linear_qty(min_points), F.lit("linear"))


def forecast_last_year(arrays: DataFrame, steps: int = 12, min_points: int = 12) -> DataFrame:
    """Last 12 monthly values x 1.1, cycled to ``steps``; clip 0; half-even."""
    return _finish(_steps_frame(arrays, steps), _last_year_qty(min_points), F.lit("last_year"))


# T6 / T7 ------------------------------------------------------------------
def apply_cap(forecasts: DataFrame, caps: DataFrame) -> DataFrame:
    """min(f, max_monthly_sales) where the cap is > 0; no cap otherwise."""
    df = forecasts.join(caps, "sku", "left")
    cap = F.coalesce(F.col("max_monthly_sales"), F.lit(0))
    return df.withColumn(
        "forecast_qty", F.when(cap > 0, F.least("forecast_qty", cap)).otherwise(F.col("forecast_qty"))
    ).drop("max_monthly_sales")


def forecast_chain(arrays: DataFrame, method: str = "linear", steps: int = 12,
                   carry: tuple[str, ...] = (), params: tuple[float, float] | None = None) -> DataFrame:
    """Fallback chain SARIMA -> linear -> last year, recording the method.

    Evaluated per SKU row in one pass (no union, no anti join): each step
    takes the first method that produced a value. ``method='linear'`` (the
    deterministic chain the oracle checks) starts at the linear step;
    ``'auto'`` first tries SARIMA (``mapInPandas`` over the same rows), fitted
    or with given ``params``.
    """
    extra: tuple[str, ...] = ()
    if method == "auto":
        from stockwise.operators.sarima import with_sarima

        arrays = with_sarima(arrays, steps, params)
        extra = ("sarima",)
    elif method not in ("linear", "last_year"):
        raise ValueError(method)
    df = _steps_frame(arrays, steps, extra + tuple(carry))
    lin, ly = _linear_qty(), _last_year_qty()
    if method == "last_year":
        return _finish(df, ly, F.lit("last_year"), carry)
    sar = F.element_at("sarima", F.col("step")) if method == "auto" else F.lit(None).cast("long")
    qty = F.coalesce(sar, lin, ly)
    which = (F.when(sar.isNotNull(), "sarima").when(lin.isNotNull(), "linear")
             .when(ly.isNotNull(), "last_year"))
    return _finish(df, qty, which, carry)


def forecasts_from_profile(profile: DataFrame, method: str = "linear", steps: int = 12,
                           params: tuple[float, float] | None = None) -> DataFrame:
    """T7 over the single-pass SKU profile: valid SKUs -> quality gate ->
    chain -> cap, carrying the cap and price columns along (no joins)."""
    arrays = profile.where(F.col("valid")).select("sku", "first_mi", "last_mi", "y_u", "n_months", "n_zero", "total_u",
                                                  "max_monthly_sales", "unit_price")
    passed = quality_filter(arrays).where(F.col("reject_reason").isNull()).select(
        "sku", "first_mi", "last_mi", "y_u", "max_monthly_sales", "unit_price")
    fc = forecast_chain(passed, method, steps, carry=("max_monthly_sales", "unit_price"), params=params)
    cap = F.col("max_monthly_sales")
    return fc.withColumn("forecast_qty", F.when(cap > 0, F.least("forecast_qty", cap))
                         .otherwise(F.col("forecast_qty")))


def run_forecasts(si: DataFrame, as_of, method: str = "linear", steps: int = 12, parts: tuple[int, ...] = ()) -> DataFrame:
    """Valid SKUs -> monthly arrays -> quality gate -> chain -> cap."""
    arrays = sku_month_arrays(forecast_sales(si, as_of, parts))
    passed = quality_filter(arrays).where(F.col("reject_reason").isNull()).select(
        "sku", "first_mi", "last_mi", "y_u")
    caps = max_monthly_sales(si, as_of)
    return apply_cap(forecast_chain(passed, method, steps), caps)


# T8 / T9 / T10 -------------------------------------------------------------
def sanitize_skus(df: DataFrame, column: str = "sku") -> DataFrame:
    s = F.trim(F.col(column).cast("string"))
    return (df.withColumn(column, s)
            .where(s.isNotNull() & (s != "") & ~F.lower(s).isin(*INVALID_SKU_TOKENS)))


def forecast_for(forecasts: DataFrame, year: int, month: int) -> DataFrame:
    target = dt.date(year, month, 1)
    carried = [c for c in ("max_monthly_sales", "unit_price") if c in forecasts.columns]
    return (forecasts.where(F.trunc("forecast_date", "month") == F.lit(target))
            .select("sku", F.greatest(F.col("forecast_qty"), F.lit(0)).cast("long").alias("forecast_qty"),
                    "method", *carried))


def calendar_columns(df: DataFrame, date_col: str = "forecast_date") -> DataFrame:
    d = F.col(date_col)
    return df.withColumns({
        "year": F.year(d), "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
        "week_of_year": F.weekofyear(d),
    })


# T11 -----------------------------------------------------------------------
def real_vs_forecast(real: DataFrame, forecast: DataFrame) -> DataFrame:
    """Outer alignment (NULL -> 0), difference, accuracy where real > 0."""
    df = real.join(forecast, "sku", "full_outer").select(
        "sku", F.coalesce("real_sales", F.lit(0.0)).alias("real_sales"),
        F.coalesce(F.col("forecast").cast("double"), F.lit(0.0)).alias("forecast"))
    diff = F.col("forecast") - F.col("real_sales")
    return df.withColumns({
        "difference": diff,
        "abs_difference": F.abs(diff),
        "accuracy": F.when(F.col("real_sales") > 0,
                           F.round((1 - F.abs(diff) / F.col("real_sales")) * 100, 4)),
    })


# T12 -----------------------------------------------------------------------
def clamp_to_history(forecast: DataFrame, monthly: DataFrame, before_month: dt.date) -> DataFrame:
    """Current-month forecast clamped to each SKU's historical monthly min/max
    over months before ``before_month``."""
    hist = (monthly.where(F.col("month") < F.lit(before_month)).groupBy("sku")
            .agg(F.min("total_quantity").alias("hist_min"), F.max("total_quantity").alias("hist_max")))
    df = forecast.join(hist, "sku", "left")
    f = F.col("forecast_qty").cast("double")
    return df.withColumn("clamped_qty", F.when(F.col("hist_max").isNull(), f)
                         .otherwise(F.least(F.greatest(f, F.col("hist_min")), F.col("hist_max"))))


# T13 -----------------------------------------------------------------------
def write_monthly_sales(monthly: DataFrame, path: str) -> None:
    """Fact table partitioned by month for partition pruning."""
    (monthly.withColumn("month_date", F.trunc("month", "month"))
     .repartitionByRange("month_date", "sku").write.mode("overwrite").partitionBy("month_date").parquet(path))
