"""Sales reads, predicates and summaries over ``sales_items``.

All operators are lazy DataFrame transformations. Filters are plain column
predicates so Catalyst pushes them to the Parquet scan; long key lists are
joined (semi join) instead of being inlined as huge IN lists.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwise.config import RAW_MATERIAL_PATTERNS
from stockwise.functions.scalars import exact_avg, not_quotation

# Long IN lists become a broadcast semi join above this size.

SUMMARY_KEYS = {
    "date": "issueddate",
    "customer": "customer_name",
    "product": "items_product_sku",
    "warehouse": "warehouse_name",
    "channel": "sales_channel",
}


def _lit_date(d) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)))


def restrict_keys(df: DataFrame, column: str, keys) -> DataFrame:
    """Keep rows whose ``column`` is in ``keys`` (list or one-column DataFrame).

    Empty lists mean "no filter" (reference query-builder rule). Short lists
    are inlined (pushed to the scan); long lists or DataFrames are semi-joined.
    """
    if keys is None:
        return df
    if isinstance(keys, DataFrame):
        k = keys.select(F.col(keys.columns[0]).alias("__k")).distinct()
        return df.join(k, df[column] == k["__k"], "left_semi")
    keys = list(keys)
    if not keys:
        return df
    return df.where(F.col(column).isin(keys))


# F1 -----------------------------------------------------------------------
def sales(si: DataFrame, start=None, end=None, customers: Sequence | None = None,
          skus: Sequence | None = None, limit: int | None = None) -> DataFrame:
    """Optional date range / customer / SKU filters, newest first, optional limit."""
    df = si
    if start is not None:
        df = df.where(F.col("issueddate") >= _lit_date(start))
    if end is not None:
        df = df.where(F.col("issueddate") <= _lit_date(end))
    df = restrict_keys(df, "customer_name", customers)
    df = restrict_keys(df, "items_product_sku", skus)
    df = df.orderBy(F.col("issueddate").desc(), F.col("salesinvoiceid").desc(),
                    F.col("items_product_sku").desc(), F.col("docnumber").desc())
    return df.limit(limit) if limit else df


# F2 / F3 -------------------------------------------------------------------
_OPS = {"=": "__eq__", "!=": "__ne__", ">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__"}


class SalesQuery:
    """Fluent builder returning a DataFrame (conditions are ANDed).

    ``where`` accepts the operators of ``_OPS`` plus LIKE/ILIKE; an empty
    ``where_in`` list is ignored; the last ``order_by`` wins.
    """

    def __init__(self, sales_items: DataFrame):
        self._df = sales_items
        self._select: list[str] | None = None
        self._conds: list[Column] = []
        self._group: list[str] = []
        self._aggs: list[Column] = []
        self._order: list[Column] = []
        self._limit: int | None = None

    def select(self, *cols: str) -> "SalesQuery":
        self._select = list(cols)
        return self

    def where(self, column: str, op: str, value) -> "SalesQuery":
        c = F.col(column)
        op_u = op.upper()
        if op in _OPS:
            self._conds.append(getattr(c, _OPS[op])(value))
        elif op_u == "LIKE":
            self._conds.append(c.like(value))
        elif op_u == "ILIKE":
            self._conds.append(c.ilike(value))
        else:
            raise ValueError(f"operator not allowed: {op}")
        return self

    def where_date_range(self, start=None, end=None, column: str = "issueddate") -> "SalesQuery":
        if start is not None:
            self._conds.append(F.col(column) >= _lit_date(start))
        if end is not None:
            self._conds.append(F.col(column) <= _lit_date(end))
        return self

    def where_in(self, column: str, values: Iterable) -> "SalesQuery":
        values = list(values)
        if values:
            self._conds.append(F.col(column).isin(values))
        return self

    def group_by(self, *cols: str, aggs: Sequence[Column] | None = None) -> "SalesQuery":
        self._group = list(cols)
        self._aggs = list(aggs or [F.count(F.lit(1)).alias("count")])
        return self

    def order_by(self, column: str, desc: bool = False) -> "SalesQuery":
        self._order = [F.col(column).desc() if desc else F.col(column).asc()]
        return self

    def limit(self, n: int) -> "SalesQuery":
        self._limit = n
        return self

    def build(self) -> DataFrame:
        df = self._df
        for c in self._conds:
            df = df.where(c)
        if self._group:
            df = df.groupBy(*self._group).agg(*self._aggs)
        elif self._select:
            df = df.select(*self._select)
        if self._order:
            df = df.orderBy(*self._order)
        return df.limit(self._limit) if self._limit else df


def sales_by_date_range(si: DataFrame, start, end) -> DataFrame:
    return SalesQuery(si).where_date_range(start, end).order_by("issueddate", desc=True).build()


def sales_by_customer(si: DataFrame, customer: str) -> DataFrame:
    return SalesQuery(si).where("customer_name", "=", customer).order_by("issueddate", desc=True).build()


def sales_by_product(si: DataFrame, sku: str) -> DataFrame:
    return SalesQuery(si).where("items_product_sku", "=", sku).order_by("issueddate", desc=True).build()


# F4 -----------------------------------------------------------------------
def run_sql(spark: SparkSession, sales_items: DataFrame, query: str, params: dict | None = None) -> DataFrame:
    """Parameterised SQL over a ``sales_items`` temp view (named ``:params``)."""
    sales_items.createOrReplaceTempView("sales_items")
    return spark.sql(query, args=params or {})


# F6 / F7 / F8 ---------------------------------------------------------------
def recent_skus(si: DataFrame, as_of, months: int = 12) -> DataFrame:
    """Distinct SKUs with quantity > 0 in the last ``months``, quotations excluded."""
    since = F.add_months(_lit_date(as_of), -months)
    return (si.where((F.col("items_quantity") > 0) & (F.col("issueddate") >= since) & not_quotation())
            .select(F.col("items_product_sku").alias("sku")).distinct())


def raw_material_condition(patterns: Sequence[str] = RAW_MATERIAL_PATTERNS) -> Column:
    d = F.upper(F.col("items_product_description"))
    cond = F.lit(False)
    for p in patterns:
        cond = cond | d.like(p)
    return cond


def raw_material_skus(si: DataFrame, patterns: Sequence[str] = RAW_MATERIAL_PATTERNS) -> DataFrame:
    """SKUs whose description matches any raw-material pattern on any row."""
    return (si.where(raw_material_condition(patterns))
            .select(F.col("items_product_sku").alias("sku")).distinct())


def valid_skus(si: DataFrame, as_of, months: int = 12, null_aware: bool = True) -> DataFrame:
    """Recent SKUs that are not raw materials.

    ``null_aware=True`` keeps the reference's ``NOT IN`` semantics (one NULL
    raw-material SKU empties the result); ``False`` is a plain anti join.
    """
    recent = recent_skus(si, as_of, months)
    raw = raw_material_skus(si)
    return not_in(recent, raw, "sku") if null_aware else recent.join(raw, "sku", "left_anti")


def not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left.key NOT IN (SELECT key FROM right)`` with SQL NULL semantics.

    A hash anti join plus an uncorrelated scalar subquery that counts NULL
    keys on the right (one NULL empties the result). Unlike a null-aware
    anti join this never degrades to a nested-loop join when ``right`` is
    too large to broadcast.
    """
    null_keys = right.where(F.col(key).isNull()).select(F.count(F.lit(1))).scalar()
    return (left.where(F.col(key).isNotNull())
            .join(right.where(F.col(key).isNotNull()), key, "left_anti")
            .where(null_keys == 0))


# A1 / A2 / A3 -------------------------------------------------------------
def sales_summary(si: DataFrame, group_by: str = "date") -> DataFrame:
    """count, sums of qty/net/vat/total and mean unit price per key."""
    if group_by not in SUMMARY_KEYS:
        raise ValueError(f"group_by must be one of {sorted(SUMMARY_KEYS)}")
    key = SUMMARY_KEYS[group_by]
    return (si.groupBy(F.col(key).alias(group_by))
            .agg(F.count(F.lit(1)).alias("record_count"),
                 F.round(F.sum("items_quantity"), 3).alias("total_quantity"),
                 F.round(F.sum("totals_net"), 2).alias("total_net"),
                 F.round(F.sum("totals_vat"), 2).alias("total_vat"),
                 F.round(F.sum("total_total"), 2).alias("total_amount"),
                 exact_avg("items_unitprice", 4).alias("avg_unit_price"))
            .orderBy(F.col(group_by).desc_nulls_last()))


def summary_by_date(si: DataFrame) -> DataFrame:
    return (si.groupBy("issueddate")
            .agg(F.count(F.lit(1)).alias("transactions"), F.round(F.sum("total_total"), 2).alias("total_sales"))
            .orderBy(F.col("issueddate").desc()))


def top_customers(si: DataFrame, n: int = 10) -> DataFrame:
    return (si.groupBy("customer_name")
            .agg(F.countDistinct("salesinvoiceid").alias("invoices"),
                 F.round(F.sum("total_total"), 2).alias("total_sales"))
            .orderBy(F.col("total_sales").desc(), F.col("customer_name")).limit(n))


def top_products(si: DataFrame, n: int = 10) -> DataFrame:
    return (si.groupBy("items_product_sku")
            .agg(F.round(F.sum("items_quantity"), 3).alias("total_quantity"),
                 F.round(F.sum("total_total"), 2).alias("total_sales"))
            .orderBy(F.col("total_sales").desc(), F.col("items_product_sku")).limit(n))


def monthly_summary(si: DataFrame, last_n: int | None = 6) -> DataFrame:
    m = F.trunc("issueddate", "month").alias("month")
    df = (si.groupBy(m)
          .agg(F.count(F.lit(1)).alias("transactions"),
               F.round(F.sum("total_total"), 2).alias("total_sales"),
               exact_avg("total_total", 4).alias("avg_sale"))
          .orderBy(F.col("month").desc()))
    return df.limit(last_n) if last_n else df


# A4 / A5 / A6 -------------------------------------------------------------
def month_rows(si: DataFrame, year: int, month: int) -> DataFrame:
    start = dt.date(year, month, 1)
    return si.where((F.col("issueddate") >= F.lit(start)) & (F.col("issueddate") <= F.last_day(F.lit(start))))


def month_overview(si: DataFrame, year: int, month: int, approx: bool = False) -> DataFrame:
    cd = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.countDistinct(c))
    return month_rows(si, year, month).agg(
        F.count(F.lit(1)).alias("rows"),
        cd("items_product_sku").alias("distinct_skus"),
        cd("customer_name").alias("distinct_customers"),
        cd("salesinvoiceid").alias("distinct_invoices"))


def sku_month_sales(si: DataFrame, year: int, month: int, min_qty: float = 100, top: int | None = 10) -> DataFrame:
    df = (month_rows(si, year, month).groupBy("items_product_sku")
          .agg(F.round(F.sum("items_quantity"), 3).alias("total_quantity"),
               F.countDistinct("salesinvoiceid").alias("invoices"))
          .where(F.col("total_quantity") > min_qty)
          .orderBy(F.col("total_quantity").desc(), F.col("items_product_sku")))
    return df.limit(top) if top else df


def seasonal_comparison(si: DataFrame, months: Sequence[tuple[int, int]]) -> DataFrame:
    keys = F.lit(False)
    for y, m in months:
        keys = keys | ((F.year("issueddate") == y) & (F.month("issueddate") == m))
    return (si.where(keys)
            .groupBy(F.year("issueddate").alias("year"), F.month("issueddate").alias("month"))
            .agg(F.round(F.sum("items_quantity"), 3).alias("total_quantity"),
                 F.countDistinct("items_product_sku").alias("distinct_skus")))


# A7 / A8 ------------------------------------------------------------------
def max_monthly_sales(si: DataFrame, as_of, months: int = 24, skus: DataFrame | None = None) -> DataFrame:
    """Max over calendar months of the monthly quantity (last ``months``).

    With ``skus`` given, every requested SKU is returned (missing -> 0).
    Two aggregations on the same key: the second reuses the first's
    partitioning, so this costs one shuffle.
    """
    since = F.add_months(_lit_date(as_of), -months)
    monthly = (si.where((F.col("items_quantity") > 0) & (F.col("issueddate") >= since) & not_quotation())
               .groupBy(F.col("items_product_sku").alias("sku"),
                        F.year("issueddate").alias("y"), F.month("issueddate").alias("m"))
               .agg(F.sum("items_quantity").alias("monthly_total")))
    mx = monthly.groupBy("sku").agg(F.max("monthly_total").cast("long").alias("max_monthly_sales"))
    if skus is None:
        return mx
    return (skus.select("sku").join(mx, "sku", "left")
            .select("sku", F.coalesce("max_monthly_sales", F.lit(0).cast("long")).alias("max_monthly_sales")))


def latest_unit_price(si: DataFrame, as_of, months: int = 6) -> DataFrame:
    """Newest positive price per SKU (ties: highest invoice, doc, price),
    falling back to the recent average; full outer join + coalesce."""
    base = si.where((F.col("items_quantity") > 0) & (F.col("items_unitprice") > 0) & not_quotation())
    latest = (base.groupBy(F.col("items_product_sku").alias("sku"))
              .agg(F.max_by("items_unitprice",
                            F.struct("issueddate", "salesinvoiceid", "docnumber", "items_unitprice"))
                   .alias("latest_price")))
    since = F.add_months(_lit_date(as_of), -months)
    avg = (base.where(F.col("issueddate") >= since)
           .groupBy(F.col("items_product_sku").alias("sku"))
           .agg(exact_avg("items_unitprice", 2).alias("avg_price")))
    return (latest.join(avg, "sku", "full_outer")
            .select("sku", F.round(F.coalesce("latest_price", "avg_price", F.lit(0.0)), 2).alias("unit_price")))
