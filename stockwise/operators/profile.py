"""Single-pass SKU profile for the forecast / replenishment chain.

F8 (valid SKUs), T1 (monthly series), A7 (max monthly sales) and A8 (latest
price) all read the same fact table. Here one scan feeds one aggregation
per (sku, month) carrying every measure (map-side partial aggregation
absorbs hot SKUs), then one regrouping per SKU builds a row with the month
array, flags, cap and price. Everything after that is row-local, so the
forecast side of the plan costs one scan and two shuffles in total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwise.functions.scalars import not_quotation
from stockwise.operators.sales import _lit_date, raw_material_condition
from stockwise.operators.series import month_array, month_index, month_measures, month_stats

E = F.expr


def sku_month_facts(si: DataFrame, as_of) -> DataFrame:
    d, q, p = F.col("issueddate"), F.col("items_quantity"), F.col("items_unitprice")
    asof = _lit_date(as_of)
    fc = (q > 0) & not_quotation()
    priced = fc & (p > 0)
    recent6 = priced & (d >= F.add_months(asof, -6))
    key = F.struct("issueddate", "salesinvoiceid", "docnumber", "items_unitprice")
    return si.groupBy(F.col("items_product_sku").alias("sku"), month_index("issueddate").alias("mi")).agg(
        F.sum(F.when(fc, q)).alias("q"),
        F.bool_or(fc & (d >= F.add_months(asof, -12))).alias("recent"),
        F.bool_or(F.coalesce(raw_material_condition(), F.lit(False))).alias("raw"),
        F.sum(F.when(fc & (d >= F.add_months(asof, -24)), q)).alias("q_cap"),
        F.max(F.when(priced, key)).alias("price_key"),
        F.sum(F.when(recent6, F.round(p * 100).cast("long"))).alias("p6_sum"),
        F.count(F.when(recent6, F.lit(1))).alias("p6_n"))


def sku_profile(si: DataFrame, as_of, parts: tuple[int, ...] = ()) -> DataFrame:
    """One row per SKU: validity (recent, not raw material, NOT IN null rule),
    zero-filled month array ``y_u`` of forecastable sales, cap and price. ``parts``
    (``views.spread_for``) is the number of partitions where the session's are too few."""
    m = sku_month_facts(si, as_of)
    m = m.repartition(*parts, "sku") if parts else m        # a SKU has one row a month here
    has_q = F.col("q").isNotNull()
    per = m.groupBy("sku").agg(
        F.min(F.when(has_q, F.col("mi"))).alias("first_mi"),
        F.max(F.when(has_q, F.col("mi"))).alias("last_mi"),
        *month_measures(has_q & F.col("mi").isNotNull()),
        F.bool_or("recent").alias("recent"), F.bool_or("raw").alias("raw"),
        F.max("q_cap").alias("cap_q"), F.max("price_key").alias("price_key"),
        F.sum("p6_sum").alias("p6_sum"), F.sum("p6_n").alias("p6_n"))
    # NOT IN semantics of the reference: a raw-material row with a NULL SKU
    # empties the valid set. Evaluated as a scalar subquery on the fact table
    # (the IS NULL filter is pushed to Parquet, so row groups without NULL
    # SKUs are skipped) instead of recomputing the profile.
    null_raw = (si.where(F.col("items_product_sku").isNull() & raw_material_condition())
                .select(F.count(F.lit(1))).scalar())
    avg6 = F.when(F.col("p6_n") > 0, E("((2 * p6_sum + p6_n) div (2 * p6_n)) / 100D"))
    return per.select(
        "sku", "first_mi", "last_mi",
        (F.col("sku").isNotNull() & F.col("recent") & ~F.col("raw") & (null_raw == 0)).alias("valid"),
        F.when(F.col("first_mi").isNotNull(), month_array()).alias("y_u"), *month_stats(),
        F.coalesce(F.col("cap_q").cast("long"), F.lit(0).cast("long")).alias("max_monthly_sales"),
        F.round(F.coalesce(F.col("price_key.items_unitprice"), avg6, F.lit(0.0)), 2).alias("unit_price"),
        F.col("price_key").isNotNull().alias("has_price"))
