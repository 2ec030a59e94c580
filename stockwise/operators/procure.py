"""Procurement: supplier prices, shortages, purchase lines and drafts.

Everything is keyed by product or (product, supplier); supplier price history
is reduced with one aggregate per key, and drafts stay as rows
(header aggregates + line rows) instead of unbounded per-supplier arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwise.functions.scalars import exact_avg, format_price
from stockwise.operators.replenish import priority_rank


# O16 / W1 / A17 ----------------------------------------------------------------
def supplier_prices(product: DataFrame, po_line: DataFrame, partner: DataFrame) -> DataFrame:
    """min / max / avg / last purchase price per (product, supplier); suppliers
    only (supplier_rank > 0) and products with a SKU. Last price = newest
    order date, then newest write date (NULLs last)."""
    prt = partner.where(F.col("supplier_rank") > 0).select(
        F.col("partner_id").alias("supplier_id"), F.col("name").alias("supplier_name"),
        F.col("vat").alias("supplier_vat"))
    p = product.where(F.col("sku").isNotNull()).select(
        "product_id", F.col("name").alias("product_name"), F.col("sku").alias("product_default_code"))
    lines = (po_line.join(p, "product_id")
             .join(prt, po_line.partner_id == prt.supplier_id))
    newest = F.struct(*[F.coalesce(F.col(c), F.lit("0001-01-01").cast(po_line.schema[c].dataType)).alias(c)
                        for c in ("date_order", "write_date")], "po_id", "unit_price")
    return lines.groupBy("product_id", "product_name", "product_default_code",
                         "supplier_id", "supplier_name", "supplier_vat").agg(
        F.min("unit_price").alias("min_price"), F.max("unit_price").alias("max_price"),
        exact_avg("unit_price", 4).alias("avg_price"), F.max_by("unit_price", newest).alias("last_price"))


# O9 / F20 ----------------------------------------------------------------------
def missing_products(plan: DataFrame) -> DataFrame:
    """Plan rows that need production now: priority != BAJA and required > 0."""
    return plan.where((F.col("priority") != "BAJA") & (F.col("required_production") > 0))


# O10 --------------------------------------------------------------------------
def required_components(missing: DataFrame, product: DataFrame, bom_line: DataFrame,
                        stock: DataFrame) -> DataFrame:
    """BOM explosion of the missing products, summed per component, minus the
    component's stock. The component priority is the most severe parent's."""
    p = product.select("product_id", "sku")
    need = (missing.select("sku", "required_production", "priority").join(p, "sku")
            .join(bom_line, "product_id")
            .withColumn("qty", F.when(F.col("uom") == "g", F.col("product_qty") / 1000)
                        .otherwise(F.col("product_qty")))
            .groupBy(F.col("component_id").alias("component_product_id"))
            .agg(F.sum(F.col("required_production") * F.col("qty")).alias("required_component_qty"),
                 F.min(priority_rank("priority")).alias("_prank")))
    c = product.select(F.col("product_id").alias("component_product_id"), F.col("sku").alias("component_sku"))
    st = stock.select(F.col("sku").alias("component_sku"), F.col("qty_available").alias("on_hand_component_qty"))
    prio = (F.when(F.col("_prank") == 0, "CRITICO").when(F.col("_prank") == 1, "ALTA")
            .when(F.col("_prank") == 2, "MEDIA").otherwise("BAJA"))
    return (need.join(c, "component_product_id").join(st, "component_sku", "left")
            .select("component_product_id", "component_sku",
                    F.round("required_component_qty", 4).alias("required_component_qty"),
                    F.coalesce("on_hand_component_qty", F.lit(0.0)).alias("on_hand_component_qty"),
                    F.round(F.greatest(F.lit(0.0), F.col("required_component_qty")
                                       - F.coalesce("on_hand_component_qty", F.lit(0.0))), 4)
                    .alias("required_to_order"),
                    prio.alias("priority")))


# O17 ----------------------------------------------------------------------------
def enrich_missing(rows: DataFrame, product: DataFrame, id_col: str) -> DataFrame:
    p = product.select(F.col("product_id").alias(id_col), F.col("name").alias("product_name"),
                       F.col("sku").alias("default_code"))
    return rows.join(p, id_col, "left").orderBy(priority_rank("priority"), id_col)


# O18 ----------------------------------------------------------------------------
def component_purchase_list(components: DataFrame, product: DataFrame, prices: DataFrame) -> DataFrame:
    """Components x product x supplier prices (rows without supplier dropped);
    names cut to 15 characters, every column text, avg price formatted."""
    p = product.select(F.col("product_id").alias("component_product_id"), F.col("name").alias("product_name"),
                       F.col("sku").alias("default_code"))
    # avg_price carries 4 exact decimals: round half-up to 3 in integer units so
    # the text form does not depend on binary representation.
    price3 = ((F.round(F.col("avg_price") * 10000).cast("long") + 5) / 10).cast("long") / F.lit(1000.0)
    s = prices.select(F.col("product_id").alias("component_product_id"), "supplier_id", "supplier_name",
                      "supplier_vat", price3.alias("avg_price"))
    df = components.join(p, "component_product_id", "left").join(s, "component_product_id")
    return df.select(
        F.col("component_product_id").cast("string").alias("id"),
        F.col("component_product_id").cast("string").alias("product_id"),
        F.left("product_name", F.lit(15)).alias("product_name"),
        F.col("default_code").cast("string").alias("default_code"),
        F.col("on_hand_component_qty").cast("string").alias("on_hand_qty"),
        F.col("required_to_order").cast("string").alias("required_qty"),
        F.col("supplier_id").cast("string").alias("supplier_id"),
        F.left("supplier_name", F.lit(15)).alias("supplier_name"),
        F.col("supplier_vat").cast("string").alias("supplier_rut"),
        format_price("avg_price").alias("avg_price"),
        F.col("priority").cast("string").alias("priority"))


# O19 ----------------------------------------------------------------------------
def supplier_coverage(components: DataFrame, prices: DataFrame) -> DataFrame:
    """Components needing an order with / without any supplier, and the ratio."""
    need = components.where(F.col("required_to_order") > 0).select("component_product_id").distinct()
    sup = prices.select(F.col("product_id").alias("component_product_id")).distinct()
    flagged = need.join(sup.withColumn("has_supplier", F.lit(True)), "component_product_id", "left")
    return flagged.agg(
        F.count(F.lit(1)).alias("components"),
        F.count_if(F.col("has_supplier").isNotNull()).alias("with_supplier"),
        F.count_if(F.col("has_supplier").isNull()).alias("without_supplier")).withColumn(
        "coverage", F.round(F.try_divide(F.col("with_supplier"), F.col("components")), 4))


# O20 ----------------------------------------------------------------------------
def cheapest_supplier(purchase_list: DataFrame) -> DataFrame:
    """Per component: prefer CRITICO rows, then the lowest average price
    (ties: supplier id)."""
    df = purchase_list.withColumn("_crit", F.when(F.col("priority") == "CRITICO", 0).otherwise(1)).withColumn(
        "_price", F.col("avg_price").cast("double"))
    return df.groupBy("id").agg(F.min_by(
        F.struct("supplier_id", "supplier_name", "avg_price", "required_qty", "priority"),
        F.struct("_crit", "_price", F.col("supplier_id").cast("long"))).alias("best")).select(
        "id", "best.*")


# O21 ----------------------------------------------------------------------------
def purchase_order_drafts(best: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Critical rows with quantity > 0 grouped by supplier: (headers, lines).
    Lines stay rows, so a supplier with many components is not one task."""
    lines = (best.where((F.col("priority") == "CRITICO") & (F.col("required_qty").cast("double") > 0))
             .select(F.col("supplier_id").cast("long").alias("partner_id"), F.col("id").cast("long").alias("product_id"),
                     F.col("required_qty").cast("double").alias("product_qty"),
                     F.col("avg_price").cast("double").alias("price_unit")))
    qty_u = F.round(F.col("product_qty") * 10000).cast("long")
    price_u = F.round(F.col("price_unit") * 1000).cast("long")
    headers = lines.groupBy("partner_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        (F.sum(qty_u).cast("double") / 10000).alias("total_qty"),
        (F.sum(qty_u * price_u).cast("double") / 10000000).alias("total_value"))
    return headers, lines


# O22 ----------------------------------------------------------------------------
def normalise_rfq_lines(lines: DataFrame, partner: DataFrame, product: DataFrame, as_of) -> DataFrame:
    """Defaults: UoM from product, name from product, qty 1, price 0, planned
    date = as_of; vendor must be a supplier (else reject_reason)."""
    p = product.select("product_id", F.col("name").alias("_pname"), F.col("uom").alias("_puom"))
    v = partner.select(F.col("partner_id"), F.col("supplier_rank"))
    df = lines.join(p, "product_id", "left").join(v, "partner_id", "left")
    return df.select(
        "partner_id", "product_id",
        F.coalesce(F.nullif(F.col("name"), F.lit("")), "_pname").alias("name"),
        F.coalesce("uom", "_puom").alias("uom"),
        F.coalesce("qty", F.lit(1.0)).alias("qty"),
        F.coalesce("price", F.lit(0.0)).alias("price"),
        F.coalesce("date_planned", F.lit(as_of)).alias("date_planned"),
        F.when(F.coalesce("supplier_rank", F.lit(0)) <= 0, "vendor is not a supplier")
        .when(F.col("_pname").isNull(), "unknown product").alias("reject_reason"))


# O23 ----------------------------------------------------------------------------
def quotation_prices(lines: DataFrame, product: DataFrame) -> DataFrame:
    """price = given price, else list price + price_extra."""
    p = product.select("product_id", "list_price")
    return lines.join(p, "product_id", "left").withColumn(
        "price", F.coalesce("price", F.col("list_price") + F.coalesce("price_extra", F.lit(0.0))))


# O24 ----------------------------------------------------------------------------
def check_production_requests(requests: DataFrame, product: DataFrame, boms: DataFrame) -> DataFrame:
    """sku, qty and picking present; product known and sellable; BOM optional."""
    p = product.select("sku", "sale_ok", F.lit(True).alias("_known"))
    df = requests.join(p, "sku", "left").join(boms, "sku", "left")
    status = (F.when(F.col("sku").isNull() | (F.col("qty").isNull()) | (F.col("qty") <= 0), "invalid_request")
              .when(F.col("picking_type").isNull(), "missing_picking")
              .when(F.col("_known").isNull(), "unknown_product")
              .when(~F.col("sale_ok"), "not_sellable")
              .otherwise("ok"))
    return df.select("request_id", "sku", "qty", F.coalesce("has_bom", F.lit(False)).alias("has_bom"),
                     status.alias("status"))


# O25 ----------------------------------------------------------------------------
def validate_inventory_rows(rows: DataFrame) -> DataFrame:
    """found must be boolean-like, qty numeric: typed values plus an error list."""
    found_s = F.lower(F.trim(F.col("found").cast("string")))
    found = F.when(found_s.isin("true", "1"), True).when(found_s.isin("false", "0"), False)
    qty = F.col("qty_available").cast("string").try_cast("double")
    errors = F.array_compact(F.array(
        F.when(found.isNull(), F.lit("found is not boolean")),
        F.when(qty.isNull(), F.lit("qty_available is not numeric"))))
    return rows.select("sku", found.alias("found"), qty.alias("qty_available"), errors.alias("errors"))
