"""Exact quantiles by distributed selection.

Each wanted rank is bracketed by a value range. A round counts the rows of all open
brackets by bin (map-side combined, one row a bracket and bin reaches the driver)
and goes on with the bins that hold a wanted rank, until the bin is a single value
or holds at most two rows. No task sees more than its share of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024


def order_statistics(rows: DataFrame, wanted: dict, bounds: dict, bins: int = BINS) -> dict:
    """Values of the 0-based ranks ``wanted[g]`` of ``rows`` (g, v), whose groups
    lie within ``bounds[g]``; the groups are few."""
    found: dict = {}
    open_ = [(g, *bounds[g], 0, sorted(ranks)) for g, ranks in wanted.items()]
    while open_:
        at = bin_ = None
        for i, (g, lo, hi, _, _) in enumerate(open_):
            mine = F.col("g").eqNullSafe(F.lit(g)) & F.col("v").between(lo, hi)
            place = F.floor((F.col("v") - F.lit(lo)) / F.lit((hi - lo) or 1.0) * bins).cast("int")
            at = F.when(mine, i) if at is None else at.when(mine, i)
            bin_ = F.when(mine, place) if bin_ is None else bin_.when(mine, place)
        held = (rows.select(at.alias("at"), bin_.alias("bin"), "v").where("at IS NOT NULL").groupBy("at", "bin")
                .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
        by_bracket: dict = {}
        for r in held:
            by_bracket.setdefault(r["at"], []).append(r)
        onward = []
        for i, (g, _, _, below, ranks) in enumerate(open_):
            for r in sorted(by_bracket.get(i, []), key=lambda r: r.lo):
                inside = [k for k in ranks if below <= k < below + r.n]
                if r.lo == r.hi or r.n <= 2:
                    found.update({(g, k): r.lo if k == below else r.hi for k in inside})
                elif inside:
                    onward.append((g, r.lo, r.hi, below, inside))
                below += r.n
        open_ = onward
    return found


def exact_quantiles(df: DataFrame, value: str, fractions: Sequence[float], by: str | Column | None = None) -> dict:
    """By group (None without ``by``): the quantiles, linear between neighbours."""
    group = F.lit(None).cast("string") if by is None else (F.col(by) if isinstance(by, str) else by)
    rows = df.select(group.alias("g"), F.col(value).cast("double").alias("v")).where("v IS NOT NULL")
    sizes = {r.g: (r.n, r.lo, r.hi) for r in rows.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    place = {(g, f): f * (n - 1) for g, (n, _, _) in sizes.items() for f in fractions}
    wanted: dict = {}
    for (g, _), at in place.items():
        wanted.setdefault(g, set()).update({math.floor(at), math.ceil(at)})
    found = order_statistics(rows, wanted, {g: (lo, hi) for g, (_, lo, hi) in sizes.items()})
    out: dict = {g: [] for g in sizes}
    for (g, _), at in place.items():
        low, high = found[g, math.floor(at)], found[g, math.ceil(at)]
        out[g].append(low + (high - low) * (at - math.floor(at)))
    return out
