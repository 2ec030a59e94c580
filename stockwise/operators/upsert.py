"""Keyed, idempotent upserts and deletes on Parquet tables.

Parquet has no MERGE, so an upsert is computed as a DataFrame
    latest(source) per key  ∪  target rows whose key is not in source
(one shuffle on the key for each side). ``stored.KeyedTable`` writes it to the key
buckets that a batch touches. Re-running the same upsert yields the same table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INVALID_KEY_TOKENS = ("", "None", "False")


def _keys_not_null(df: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


# U3 / U4 -------------------------------------------------------------------
def dedup_keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: tuple[int, ...] = ()) -> DataFrame:
    """Keep the last row per key in ``order`` (ties broken by all columns). ``parts``
    (``views.spread_for``) is the number of partitions where the session's would give
    a task more rows than it can sort in memory."""
    df = df.repartition(*parts, *keys) if parts else df
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order], *[F.col(c).desc() for c in rest])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in order], *[F.col(c).asc() for c in rest])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def invalid_key_reason(key: str) -> Column:
    k = F.col(key)
    return (F.when(k.isNull(), "null").when(F.trim(k) == "", "empty").when(k == "None", "none")
            .when(k == "False", "false"))


def rejection_report(df: DataFrame, key: str, id_col: str, examples: int = 3) -> DataFrame:
    """Count of rejected rows per reason with the ``examples`` smallest example
    ids. The rank filter lets each task send on only its first rows of a reason."""
    bad = df.withColumn("reason", invalid_key_reason(key)).where(F.col("reason").isNotNull())
    counts = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    first = (bad.select("reason", id_col).withColumn("__r", F.row_number().over(Window.partitionBy("reason").orderBy(id_col)))
             .where(F.col("__r") <= examples).groupBy("reason")
             .agg(F.array_sort(F.collect_list(F.struct("__r", F.col(id_col).cast("string").alias("v")))).alias("e")))
    return counts.join(first, "reason").select(
        "reason", "n", F.array_join(F.transform("e", lambda s: s["v"]), ",").alias("examples"))


# U1 / U5 / U6 / U7 / U8 / U9 / U10 --------------------------------------------------------
def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
           update_cols: Sequence[str] | None = None, preserve: Sequence[str] = (),
           updated_at: str | None = None, now: dt.datetime | None = None, spread: tuple[int, str] | None = None) -> DataFrame:
    """Insert-or-update ``source`` into ``target`` on ``keys``.

    Rows with a NULL key are skipped; key columns are never updated; with
    ``update_cols`` only those columns change on existing rows;
    ``preserve`` columns keep the target's value when the row exists
    (e.g. the embedding of a product); ``updated_at`` is stamped on updated
    rows only. With ``order`` a source row that is older than the target's row
    of its key changes nothing. ``spread`` (number, column) deals the rows by a
    column that follows from the keys.
    """
    src = source.where(_keys_not_null(source, keys))
    if update_cols is None and not preserve and updated_at is None and src.columns == target.columns:
        return _replaced(target, src, keys, order, spread)
    src = dedup_keep_last(src, keys, order)      # without an order, the largest by all columns
    cols = target.columns
    keep_from_target = set(preserve)
    if update_cols is not None:
        keep_from_target |= {c for c in cols if c not in keys and c not in update_cols}
    dated = [c for c in order if c in cols and c in src.columns]
    tgt_keep = [c for c in cols if c not in keys] if dated else [c for c in cols if c in keep_from_target or c == updated_at]
    # One target row per key (a target with repeated keys must not multiply rows).
    t_one = dedup_keep_last(target, keys, order)
    t_side = t_one.select(*keys, *[F.col(c).alias(f"__t_{c}") for c in tgt_keep], F.lit(True).alias("__exists"),
                          *[F.col(c).alias(f"__o_{c}") for c in dated])
    joined = src.join(t_side, list(keys), "left")
    if dated:
        older = F.struct(*[F.col(c) for c in dated]) < F.struct(*[F.col(f"__o_{c}").alias(c) for c in dated])
        joined = joined.withColumn("__older", F.col("__exists").isNotNull() & older)
    out_cols = []
    for c in cols:
        if c in keys:
            out_cols.append(F.col(c))
        elif c == updated_at:
            stamp = F.lit(now) if now is not None else F.current_timestamp()
            out_cols.append(F.when(F.col("__exists"), stamp).otherwise(
                F.col(c) if c in src.columns else F.lit(None).cast(target.schema[c].dataType)).alias(c))
        elif c in keep_from_target:
            new = F.col(c) if c in src.columns else F.lit(None).cast(target.schema[c].dataType)
            out_cols.append(F.when(F.col("__exists"), F.col(f"__t_{c}")).otherwise(new).alias(c))
        else:
            out_cols.append(F.col(c) if c in src.columns else F.lit(None).cast(target.schema[c].dataType).alias(c))
    if dated:       # a row that is older leaves the target's row as it is
        out_cols = [c if name in keys else F.when(F.col("__older"), F.col(f"__t_{name}")).otherwise(c).alias(name)
                    for name, c in zip(cols, out_cols)]
    upserted = joined.select(*out_cols)
    untouched = target.join(src.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(upserted)


def _replaced(target: DataFrame, src: DataFrame, keys: Sequence[str], order: Sequence[str], spread: tuple[int, str] | None) -> DataFrame:
    """``upsert`` of whole rows: both sides meet in one shuffle. Of a key in the source
    the last row by ``order`` stays, one of the source before one of the target; rows of
    other keys stay as they are."""
    rest = [c for c in target.columns if c not in keys and c not in order]
    both = target.withColumn("__new", F.lit(0)).unionByName(src.withColumn("__new", F.lit(1)))
    both = both.repartition(*spread) if spread else both
    of = Window.partitionBy(*([spread[1]] if spread else []), *keys)
    last = of.orderBy(*[F.col(c).desc() for c in order], F.col("__new").desc(), *[F.col(c).desc() for c in rest])
    ranked = both.withColumns({"__rn": F.row_number().over(last), "__hit": F.max("__new").over(of)})
    return ranked.where("__hit = 0 OR __rn = 1").select(*target.columns)


def upsert_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(total, new, updated) for an upsert: distinct non-NULL source keys
    flagged by a left join with the target keys."""
    sk = source.where(_keys_not_null(source, keys)).select(*keys).distinct()
    tk = target.select(*keys).distinct().withColumn("__in_target", F.lit(True))
    flagged = sk.join(tk, list(keys), "left")
    return flagged.agg(F.count(F.lit(1)).alias("total"),
                       F.count_if(F.col("__in_target").isNull()).alias("new"),
                       F.count_if(F.col("__in_target").isNotNull()).alias("updated"))


# U11 / U12 / U13 / U14 --------------------------------------------------------------
def deactivate_missing(target: DataFrame, active_keys: DataFrame, key: str, flag: str = "is_active") -> DataFrame:
    """Active rows whose key is not in ``active_keys`` become inactive (an
    empty key set deactivates all)."""
    k = active_keys.select(F.col(key).alias("__k")).distinct().withColumn("__present", F.lit(True))
    df = target.join(k, target[key] == k["__k"], "left")
    return df.withColumn(flag, F.col(flag) & F.col("__present").isNotNull()).drop("__k", "__present")


def apply_deletes(target: DataFrame, source_keys: DataFrame, key: str, policy: str = "mark_inactive",
                  full_sync: bool = True, flag: str = "is_active") -> DataFrame:
    """Rows absent from the source on a full sync: mark inactive, delete or
    ignore. Incremental syncs (a watermark exists) never delete."""
    if not full_sync or policy == "ignore":
        return target
    k = source_keys.select(F.col(key).alias("__k")).distinct()
    if policy == "delete":
        return target.join(k, target[key] == k["__k"], "left_semi")
    if policy == "mark_inactive":
        return deactivate_missing(target, source_keys.select(key), key, flag)
    raise ValueError(policy)


def update_embeddings(target: DataFrame, pairs: DataFrame, key: str = "sku", col: str = "embedding") -> DataFrame:
    p = pairs.select(F.col(key).alias("__k"), F.col(col).alias("__new"))
    df = target.join(p, target[key] == p["__k"], "left")
    return df.withColumn(col, F.coalesce("__new", col)).withColumn(
        "embedding_updated", F.col("__new").isNotNull()).drop("__k", "__new")


def delete_by_key(target: DataFrame, keys: DataFrame, key: str = "sku") -> DataFrame:
    k = keys.select(F.upper(F.trim(F.col(keys.columns[0]))).alias("__k")).distinct()
    return target.join(k, F.upper(target[key]) == k["__k"], "left_anti")


# U15 / U16 / U17 ----------------------------------------------------------------------
def watermark(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.max(col).alias("watermark"))


def sync_window(as_of: dt.datetime, last: dt.datetime | None, full: bool = False,
                overlap: dt.timedelta = dt.timedelta(hours=1)) -> tuple[dt.datetime, dt.datetime] | None:
    """Full/override -> as_of - 90 d; else last - 1 h; none -> as_of - 30 d;
    None when start > end."""
    if full:
        start = as_of - dt.timedelta(days=90)
    elif last is not None:
        start = last - overlap
    else:
        start = as_of - dt.timedelta(days=30)
    return None if start > as_of else (start, as_of)


# U18 / U19 / U20 ------------------------------------------------------------------------
def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def add_surrogate_id(df: DataFrame, key: str, name: str = "id") -> DataFrame:
    """The key's MD5, 128 bits: 64 would merge rows at about 10^10 keys."""
    return df.withColumn(name, F.md5(F.col(key).cast("string")))
