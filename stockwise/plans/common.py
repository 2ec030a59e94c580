"""Helpers shared by the plan modules."""

from __future__ import annotations

from pyspark.sql import SparkSession

from stockwise.config import AS_OF
from stockwise.sources.views import Views

AS_OF_SQL = f"DATE '{AS_OF.isoformat()}'"


def views(spark: SparkSession, sf_dir: str) -> Views:
    return Views(spark, sf_dir)


def avg_sql(col: str, decimals: int = 4, scale: int = 2) -> str:
    """SQL twin of ``scalars.exact_avg``."""
    factor = 10 ** (decimals - scale)
    units = f"CAST(round({col} * {10 ** scale}) AS BIGINT)"
    return (f"CAST((2 * sum({units}) * {factor} + count({units})) // (2 * count({units})) AS DOUBLE)"
            f" / {10 ** decimals}")
