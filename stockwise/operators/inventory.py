"""Stock, BOM and capacity operators.

Stock is aggregated per product before any join with the catalogue, so the
catalogue join sees one row per product, not one per quant.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def location_names(location: DataFrame) -> DataFrame:
    """Full location name: 'Stock' locations get the warehouse prefix
    ('WH3/Stock'); other names are prefixed unless they already start with it."""
    name = F.when(F.col("name") == "Stock", F.concat_ws("/", "warehouse", "name")).otherwise(F.col("name"))
    full = F.when(name.startswith(F.col("warehouse")), name).otherwise(F.concat_ws("/", "warehouse", name))
    return location.withColumn("full_name", full)


# A15 / I18 -----------------------------------------------------------------
def stock_by_product_location(quants: DataFrame) -> DataFrame:
    """Σ quantity per (product, location); NULL keys dropped."""
    return (quants.where(F.col("product_id").isNotNull() & F.col("location_id").isNotNull())
            .groupBy("product_id", "location_id").agg(F.sum("quantity").alias("quantity")))


def clamp_negative(df: DataFrame, column: str = "quantity") -> DataFrame:
    return df.withColumn(column, F.greatest(F.col(column), F.lit(0.0)))


# O7 ------------------------------------------------------------------------
def stock_by_sku(product: DataFrame, quants: DataFrame, location: DataFrame,
                 skus: DataFrame | None = None, with_locations: bool = False) -> DataFrame:
    """Per SKU: available = Σ(qty - reserved) over internal locations with
    qty > 0; virtual = Σ qty over known locations; found flag.

    ``skus`` (one column ``sku``) keeps every requested key, found or not.
    """
    loc = location_names(location).select("location_id", "usage", "full_name", "warehouse")
    q = quants.join(loc, "location_id")  # unknown locations skipped
    internal = (F.col("usage") == "internal") & (F.col("quantity") > 0)
    aggs = [
        F.sum(F.when(internal, F.col("quantity") - F.col("reserved_quantity")).otherwise(0.0)).alias("qty_available"),
        F.sum("quantity").alias("virtual_available"),
        F.count_if(internal).alias("n_locations"),
    ]
    if with_locations:
        aggs.append(F.array_sort(F.collect_list(F.when(internal, F.struct(
            F.col("full_name").alias("location"), "warehouse", "quantity",
            F.col("reserved_quantity").alias("reserved"),
            (F.col("quantity") - F.col("reserved_quantity")).alias("available"))))).alias("locations"))
    per_product = q.groupBy("product_id").agg(*aggs)
    cat = product.select("product_id", "sku", F.col("name").alias("product_name"))
    stock = cat.join(per_product, "product_id", "left").select(
        "sku", "product_name", F.lit(True).alias("found"),
        F.coalesce("qty_available", F.lit(0.0)).alias("qty_available"),
        F.coalesce("virtual_available", F.lit(0.0)).alias("virtual_available"),
        F.coalesce("n_locations", F.lit(0)).alias("n_locations"),
        *(["locations"] if with_locations else []))
    if skus is None:
        return stock
    req = skus.select(F.upper(F.trim("sku")).alias("sku")).distinct()
    return req.join(stock, "sku", "left").withColumn("found", F.coalesce("found", F.lit(False))).fillna(
        {"qty_available": 0.0, "virtual_available": 0.0, "n_locations": 0})


# O8 ------------------------------------------------------------------------
def stock_by_location(product: DataFrame, quants: DataFrame, location: DataFrame) -> DataFrame:
    loc = location_names(location).where(F.col("usage") == "internal")
    return (quants.where(F.col("quantity") > 0).join(loc, "location_id")
            .join(product.select("product_id", "sku", F.col("name").alias("product_name")), "product_id")
            .select("warehouse", F.col("full_name").alias("location"), "product_name", "sku", "quantity"))


# O11 / O12 / O13 -------------------------------------------------------------
def bom_components(product: DataFrame, bom_line: DataFrame, skus: DataFrame | None = None) -> DataFrame:
    """SKU -> component SKU and quantity (grams converted to kg)."""
    p = product.select("product_id", "sku")
    c = product.select(F.col("product_id").alias("component_id"), F.col("sku").alias("component_sku"))
    df = (bom_line.join(p, "product_id").join(c, "component_id")
          .select("sku", "component_sku",
                  F.when(F.col("uom") == "g", F.col("product_qty") / 1000).otherwise(F.col("product_qty"))
                  .alias("quantity"),
                  F.when(F.col("uom") == "g", F.lit("kg")).otherwise(F.col("uom")).alias("uom")))
    if skus is not None:
        df = df.join(skus.select("sku").distinct(), "sku", "left_semi")
    return df


def has_bom(product: DataFrame, bom_line: DataFrame) -> DataFrame:
    boms = bom_line.select("product_id").distinct().withColumn("has_bom", F.lit(True))
    return (product.select("product_id", "sku").join(boms, "product_id", "left")
            .select("sku", F.coalesce("has_bom", F.lit(False)).alias("has_bom")))


# O14 -------------------------------------------------------------------------
def max_producible(product: DataFrame, bom_line: DataFrame, stock: DataFrame) -> DataFrame:
    """min over components of available / qty (qty <= 0 -> 0); no BOM -> 0."""
    comps = bom_components(product, bom_line)
    st = stock.select(F.col("sku").alias("component_sku"), "qty_available")
    per = comps.join(st, "component_sku", "left").withColumn(
        "cap", F.when(F.col("quantity") <= 0, F.lit(0.0))
        .otherwise(F.coalesce("qty_available", F.lit(0.0)) / F.col("quantity")))
    caps = per.groupBy("sku").agg(F.min("cap").alias("max_quantity"))
    return (product.select("sku").join(caps, "sku", "left")
            .select("sku", F.round(F.coalesce("max_quantity", F.lit(0.0)), 4).alias("max_quantity")))


# O15 -------------------------------------------------------------------------
def daily_stock_snapshot(quants: DataFrame, snapshot_date: dt.date) -> DataFrame:
    """A15 stamped with the snapshot day (written with dynamic partition
    overwrite, so a same-day rerun replaces that day only)."""
    return stock_by_product_location(quants).withColumn("snapshot_date", F.lit(snapshot_date))


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    spark = snapshot.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        snapshot.write.mode("overwrite").partitionBy("snapshot_date").parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)
