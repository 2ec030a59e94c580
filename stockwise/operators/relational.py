"""Join, window and set operators of the reference.

Everything is an equi join, a semi/anti join or a ``row_number`` window;
the one theta condition (J10's "name contains order number") is evaluated
after an equi join on (side, amount), never as a cross product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# J10 -----------------------------------------------------------------------
def match_statements(statements: DataFrame, entries: DataFrame) -> DataFrame:
    """Statement line -> first unreconciled ledger entry (lowest id) on the
    same side with the same amount whose name contains the order number
    (text before ' - ' in the statement reference)."""
    st = statements.withColumns({
        "order_number": F.substring_index("ref", " - ", 1),
        "side": F.when(F.col("amount") >= 0, "debit").otherwise("credit"),
        "amount_cents": F.round(F.abs(F.col("amount")) * 100).cast("long"),
    })
    en = entries.where(~F.col("is_reconciled")).withColumns({
        "e_side": F.when(F.col("debit") > 0, "debit").otherwise("credit"),
        "e_cents": F.round(F.greatest("debit", "credit") * 100).cast("long"),
    })
    cand = st.join(en, (st.side == en.e_side) & (st.amount_cents == en.e_cents)
                   & F.col("name").contains(F.col("order_number")))
    w = Window.partitionBy("statement_id").orderBy("entry_id")
    return (cand.withColumn("rn", F.row_number().over(w)).where("rn = 1")
            .select("statement_id", "order_number", "entry_id", "amount"))


# J13 -----------------------------------------------------------------------
def resolve_products(requested: DataFrame, product: DataFrame) -> DataFrame:
    """Requested identifiers (all-digit = product id, else SKU) with status
    found / not_found / invalid_id; every requested key is kept."""
    r = requested.select(F.trim(F.col("key").cast("string")).alias("key")).distinct()
    is_id = F.col("key").rlike(r"^\d+$")
    looks_sku = F.upper(F.col("key")).startswith("SKU-")
    r = r.withColumns({"_id": F.when(is_id, F.col("key").cast("long")),
                       "_sku": F.when(~is_id & looks_sku, F.upper("key"))})
    by_id = product.select(F.col("product_id").alias("_pid"), F.col("sku").alias("_psku1"))
    by_sku = product.select(F.col("sku").alias("_psku"), F.col("product_id").alias("_pid2"))
    df = r.join(by_id, r._id == by_id._pid, "left").join(by_sku, r._sku == by_sku._psku, "left")
    status = (F.when(F.col("_id").isNull() & F.col("_sku").isNull(), "invalid_id")
              .when(F.col("_pid").isNotNull() | F.col("_psku").isNotNull(), "found").otherwise("not_found"))
    return df.select("key", F.coalesce("_pid", "_pid2").alias("product_id"),
                     F.coalesce("_psku1", "_psku").alias("sku"), status.alias("status"))


# J14 -----------------------------------------------------------------------
def bom_per_product(product: DataFrame, bom_line: DataFrame) -> DataFrame:
    per = bom_line.groupBy("product_id").agg(F.count(F.lit(1)).alias("n_lines"))
    return product.select("product_id", "sku").join(per, "product_id", "left").select(
        "sku", F.when(F.col("n_lines").isNotNull(), F.col("product_id")).alias("bom_id"),
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.when(F.col("n_lines").isNotNull(), "found").otherwise("no_bom").alias("status"))


# W2 -------------------------------------------------------------------------
def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """DISTINCT ON (keys) ... ORDER BY order: row_number() = 1."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


# X1 / X2 / X3 / X5 -----------------------------------------------------------
def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def set_intersection(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).intersect(right.select(key))


def set_union(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).union(right.select(key)).distinct()


def ordered_distinct(df: DataFrame, group: str, pos: str, value: str) -> DataFrame:
    """Per group, values in first-occurrence order without repeats."""
    firsts = df.groupBy(group, value).agg(F.min(pos).alias("__first"))
    w = Window.partitionBy(group).orderBy("__first", value)
    return firsts.withColumn("rank", F.row_number().over(w)).select(group, "rank", value)
