"""ERP-style domain filters (F9) compiled to one Spark ``Column``.

A domain is a prefix-notation list: terms ``(field, op, value)`` and the
operators ``'&'`` / ``'|'`` (binary, prefix); consecutive terms without an
operator are ANDed. Operators: = != > >= < <= in, not in, like, ilike,
=ilike. The result is a plain predicate, so Catalyst pushes it to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _term(field: str, op: str, value) -> Column:
    c = F.col(field)
    op = op.lower()
    if op == "=":
        return c.isNull() if value is False or value is None else c == value
    if op == "!=":
        return c.isNotNull() if value is False or value is None else c != value
    if op in (">", ">=", "<", "<="):
        return {">": c > value, ">=": c >= value, "<": c < value, "<=": c <= value}[op]
    if op == "in":
        return c.isin(list(value))
    if op == "not in":
        return ~c.isin(list(value))
    if op == "like":
        return c.like(f"%{value}%")
    if op == "ilike":
        return c.ilike(f"%{value}%")
    if op == "=ilike":
        return c.ilike(str(value))
    raise ValueError(f"operator not supported: {op}")


def domain_to_column(domain: list) -> Column:
    stack: list[Column] = []
    for item in reversed(domain):
        if item in ("&", "|"):
            a, b = stack.pop(), stack.pop()
            stack.append(a & b if item == "&" else a | b)
        elif item == "!":
            stack.append(~stack.pop())
        else:
            stack.append(_term(*item))
    out = stack.pop() if stack else F.lit(True)
    while stack:
        out = out & stack.pop()
    return out


# F12 / F19 --------------------------------------------------------------------
def products_by_skus(product: DataFrame, skus: DataFrame) -> DataFrame:
    """Products whose SKU is asked for, in any case, ordered by name."""
    asked = skus.select(F.upper("sku").alias("asked")).distinct()
    return (product.withColumn("sku", F.upper("sku")).join(asked, F.col("sku") == F.col("asked"), "left_semi").orderBy("name", "sku"))


def skus_exist(product: DataFrame, skus: DataFrame) -> DataFrame:
    """Each distinct asked SKU and whether the catalogue has it."""
    known = product.select(F.upper("sku").alias("known")).distinct()
    return (skus.select("sku").distinct().join(known, F.upper("sku") == F.col("known"), "left")
            .select("sku", F.col("known").isNotNull().alias("found")))


def status_guard(query) -> Column:
    """``query`` asking for active products unless it names a status itself."""
    q = F.trim(F.coalesce(query, F.lit("")))
    return F.when(F.lower(q).contains("status:"), q).when(q == "", "status:active").otherwise(F.concat(q, F.lit(" AND status:active")))
