"""Integrity checks (C1-C6) as small report frames.

Each check is an aggregate or an anti join; the reports are unions of
one-row aggregates, so nothing but counts reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _count_row(df: DataFrame, name: str, severity_if_empty: str | None = None) -> DataFrame:
    n = F.count(F.lit(1))
    sev = F.when(n == 0, F.lit(severity_if_empty)) if severity_if_empty else F.lit(None).cast("string")
    return df.agg(F.lit(name).alias("check_name"), n.alias("n"), sev.alias("severity"))


# C1 ---------------------------------------------------------------------------
def master_counts(tables: dict[str, DataFrame], critical: tuple[str, ...] = ("uom", "product")) -> DataFrame:
    rows = [_count_row(df, name, "critical" if name in critical else "warning") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, rows)


# C2 ---------------------------------------------------------------------------
def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str, severity: str) -> DataFrame:
    """Rows whose non-NULL foreign key has no parent (left anti join)."""
    keys = parent.select(F.col(pk).alias("__pk")).distinct()
    bad = child.where(F.col(fk).isNotNull()).join(keys, child[fk] == keys["__pk"], "left_anti")
    return bad.agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("n"),
                   F.when(F.count(F.lit(1)) > 0, F.lit(severity)).otherwise(F.lit("ok")).alias("severity"))


def referential_integrity(v) -> DataFrame:
    checks = [
        orphans(v.sale_order_line, "order_id", v.sale_order, "order_id", "sale_line_without_order", "critical"),
        orphans(v.sale_order_line, "product_id", v.product, "product_id", "sale_line_unknown_product", "critical"),
        orphans(v.sale_order, "partner_id", v.partner, "partner_id", "sale_order_unknown_partner", "warning"),
        orphans(v.purchase_order_line, "product_id", v.product, "product_id", "purchase_line_unknown_product",
                "critical"),
        orphans(v.purchase_order_line, "partner_id", v.partner, "partner_id", "purchase_line_unknown_partner",
                "warning"),
        orphans(v.inventory_quant, "product_id", v.product, "product_id", "quant_unknown_product", "warning"),
        orphans(v.bom_line, "component_id", v.product, "product_id", "bom_line_unknown_component", "critical"),
    ]
    null_products = v.sale_order_line.where(F.col("product_id").isNull()).agg(
        F.lit("sale_line_null_product").alias("check_name"), F.count(F.lit(1)).alias("n"),
        F.when(F.count(F.lit(1)) > 0, F.lit("warning")).otherwise(F.lit("ok")).alias("severity"))
    return reduce(DataFrame.unionByName, checks + [null_products])


# C3 ---------------------------------------------------------------------------
def amount_consistency(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders whose Σ qty·price differs (null-safe, in cents) from the amount."""
    cents = F.round(F.col("qty") * F.col("price_unit") * 100).cast("long")
    sums = lines.groupBy("order_id").agg(F.sum(cents).alias("lines_cents"))
    df = orders.select("order_id", F.round(F.col("amount_total") * 100).cast("long").alias("amount_cents")).join(
        sums, "order_id", "left")
    differs = ~F.col("lines_cents").eqNullSafe(F.col("amount_cents"))
    return df.agg(F.count(F.lit(1)).alias("orders"), F.count_if(differs).alias("mismatched"),
                  F.count_if(F.col("lines_cents").isNull()).alias("without_lines"))


# C4 ---------------------------------------------------------------------------
def product_relations(product: DataFrame, bom_line: DataFrame) -> DataFrame:
    per = bom_line.groupBy("product_id").agg(F.count(F.lit(1)).alias("bom_lines"),
                                            F.countDistinct("component_id").alias("components"))
    return product.select("product_id", "sku", "uom").join(per, "product_id", "left").select(
        "product_id", "sku", "uom", F.when(F.col("bom_lines").isNull(), 0).otherwise(1).alias("boms"),
        F.coalesce("bom_lines", F.lit(0)).alias("bom_lines"), F.coalesce("components", F.lit(0)).alias("components"))


# C5 ---------------------------------------------------------------------------
def constraint_report(plan: DataFrame, sales_items: DataFrame) -> DataFrame:
    """Forecast-plan CHECKs, sales PK not-null/unique, net + vat ≈ total."""
    plan_rules = plan.agg(
        F.count_if(~F.col("year").between(2020, 2030)).alias("year_range"),
        F.count_if(~F.col("month").between(1, 12)).alias("month_range"),
        F.count_if((F.col("forecasted_qty") < 0) | (F.col("required_production") < 0)
                   | (F.col("max_monthly_sales") < 0)).alias("non_negative"))
    key = ["salesinvoiceid", "items_product_sku"]
    pk_null = sales_items.agg(F.count_if(F.col(key[0]).isNull() | F.col(key[1]).isNull()).alias("pk_not_null"))
    dup = (sales_items.groupBy(*key).agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1)
           .agg(F.count(F.lit(1)).alias("pk_unique")))
    vat = sales_items.agg(F.count_if(F.abs(F.col("totals_net") + F.col("totals_vat") - F.col("total_total")) >= 0.02)
                          .alias("net_vat_total"))
    rules = [("year_range", plan_rules, "year_range"), ("month_range", plan_rules, "month_range"),
             ("non_negative", plan_rules, "non_negative"), ("pk_not_null", pk_null, "pk_not_null"),
             ("pk_unique", dup, "pk_unique"), ("net_vat_total", vat, "net_vat_total")]
    return reduce(DataFrame.unionByName,
                  [df.select(F.lit(name).alias("rule"), F.col(col).alias("violations")) for name, df, col in rules])


# C6 ---------------------------------------------------------------------------
def run_status(report: DataFrame) -> DataFrame:
    """critical > 0 -> fail; warnings -> warn; else ok."""
    crit = F.count_if((F.col("severity") == "critical") & (F.col("n") > 0))
    warn = F.count_if((F.col("severity") == "warning") & (F.col("n") > 0))
    return report.agg(crit.alias("critical"), warn.alias("warnings"),
                      F.when(crit > 0, "fail").when(warn > 0, "warn").otherwise("ok").alias("status"))


def all_checks(v, tables: dict[str, DataFrame]) -> DataFrame:
    """C1 to C4 as (check_name, n, severity) rows, ``n`` the number of failures:
    an empty master table, an orphan, an order whose lines differ from its amount,
    a product without bill of materials (a warning each, unless critical)."""
    empty = master_counts(tables).select(F.concat(F.lit("empty_"), "check_name").alias("check_name"),
                                         F.when(F.col("n") == 0, 1).otherwise(0).cast("long").alias("n"), "severity")
    amounts = amount_consistency(v.sale_order, v.sale_order_line).select(
        F.lit("order_amount_differs").alias("check_name"), F.col("mismatched").alias("n"), F.lit("warning").alias("severity"))
    bare = product_relations(v.product, v.bom_line).agg(
        F.lit("product_without_bom").alias("check_name"), F.count_if(F.col("boms") == 0).alias("n"), F.lit("warning").alias("severity"))
    return reduce(DataFrame.unionByName, [empty, referential_integrity(v), amounts, bare])
