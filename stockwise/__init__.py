"""stockwise: commerce-operations analytics on Spark DataFrames.

Sales analytics, demand series and forecasts, replenishment plans, BOM and
procurement, product search, nested order flattening and integrity checks,
all expressed as lazy DataFrame plans that Catalyst optimises.
"""

from stockwise.config import AS_OF, PLAN_MONTH, PLAN_YEAR

__all__ = ["AS_OF", "PLAN_YEAR", "PLAN_MONTH"]
