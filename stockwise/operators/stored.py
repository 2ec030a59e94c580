"""Stored keyed tables and persisted watermarks.

A table is Parquet laid out by key bucket (``bucket=<n>``). An upsert reads and
writes only the buckets its batch touches: Spark prunes the others on reading and
leaves their files alone on writing (dynamic partition overwrite), so a batch costs
what its buckets hold. A repeated batch gives the same table.

A watermark is a row of a stored table. It moves only after the batch it stands for
is written; a run that ends in between reads the same rows again, with the same
result.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwise.operators.upsert import sync_window, upsert, upsert_counts
from stockwise.session import cut_lineage, drop_path, shared_path, shuffles_freed

BUCKETS = 32        # of a small table
BUCKET_ROWS = 250_000
BUCKETS_AT_ONCE = 256       # that an upsert merges in one job: bounds its shuffle files, whatever the table's size


def buckets_for(rows: int) -> int:
    """Buckets that a task can sort in memory, whatever the table's size."""
    return max(BUCKETS, -(-rows // BUCKET_ROWS))


def parked(df: DataFrame, path: str | None = None) -> DataFrame:
    """A batch written once as compact columns and read back."""
    path = path or _batch_path(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _batch_path(spark: SparkSession) -> str:
    return shared_path(spark, f"stored/batch-{uuid.uuid4().hex[:10]}")


class KeyedTable:
    """A stored table with unique ``keys``; ``schema`` without the bucket column."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets
        self.schema = schema
        self._stored = T.StructType(schema.fields + [T.StructField("bucket", T.IntegerType())])

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _dealt(self, df: DataFrame) -> DataFrame:
        return df.repartition("bucket") if self.buckets <= BUCKETS else df.repartition(self.buckets, "bucket")

    def _write(self, df: DataFrame) -> None:
        with shuffles_freed(self.spark):
            (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("bucket").parquet(self.path, compression="zstd"))

    def create(self, rows: DataFrame | None = None) -> "KeyedTable":
        """A new table of ``rows``, whose keys must be unique; empty without."""
        rows = self.spark.createDataFrame([], self.schema) if rows is None else rows.select(*self.schema.names)
        self._write(self._dealt(self._bucketed(rows)))
        return self

    def exists(self) -> bool:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place)

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(self._stored).parquet(self.path)

    def read(self) -> DataFrame:
        return self._rows().select(*self.schema.names)

    def touched(self, source: DataFrame) -> list[int]:
        """Buckets of a batch's keys: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in self._bucketed(source).select("bucket").distinct().collect())

    def upsert(self, source: DataFrame, order: Sequence[str] = (), counts: bool = False, written: bool = False, **options) -> DataFrame | None:
        """Insert or update the rows of ``source`` (see ``upsert.upsert``), which is
        kept until the table is written unless it is ``written`` already. Returns their
        numbers (total, new, updated) if asked. Keys of different buckets never meet, so
        the buckets are merged some at a time, and a job's shuffle files go after it."""
        source, batch = source.dropna(subset=self.keys), None
        if not written:
            batch = _batch_path(self.spark)
            source = parked(source, batch)
        touched = self.touched(source)
        told = cut_lineage(upsert_counts(self._of(touched), source, self.keys)) if counts else None
        for at in range(0, len(touched), BUCKETS_AT_ONCE):
            some = touched[at:at + BUCKETS_AT_ONCE]
            old, new = self._of(some), self._bucketed(source)
            new = new.where(F.col("bucket").between(some[0], some[-1])) if some != touched else new
            if not options and source.columns == old.columns:       # dealt by bucket once, then merged and written
                self._write(upsert(self._bucketed(old), new, self.keys, order=order, spread=(self.buckets, "bucket")))
            else:
                self._write(self._dealt(self._bucketed(upsert(old, new.drop("bucket"), self.keys, order=order, **options))))
        if batch:
            drop_path(self.spark, batch)
        return told

    def _of(self, buckets: Sequence[int]) -> DataFrame:
        return self._rows().where(F.col("bucket").isin(list(buckets))).select(*self.schema.names)


class SyncState:
    """Last synchronised time per model, stored."""

    SCHEMA = T.StructType([T.StructField("model_name", T.StringType()), T.StructField("last_synced", T.TimestampType())])

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.table = KeyedTable(spark, path, self.SCHEMA, ["model_name"], buckets=1)
        if not self.table.exists():
            self.table.create()

    def get(self, model: str) -> dt.datetime | None:
        row = self.table.read().where(F.col("model_name") == model).first()
        return row.last_synced if row else None

    def set(self, model: str, when: dt.datetime) -> None:
        self.table.upsert(self.table.spark.createDataFrame([(model, when)], self.SCHEMA))


def changed_rows(source: DataFrame, ts: str, window: tuple[dt.datetime, dt.datetime]) -> DataFrame:
    """Rows written after the window's start, up to its end: plain comparisons of
    the column, which reach the Parquet scan."""
    kind = source.schema[ts].dataType
    low, high = (F.lit(x).cast(kind) for x in window)
    after = F.col(ts) >= low if isinstance(kind, T.DateType) else F.col(ts) > low     # a date covers its whole day
    return source.where(after & (F.col(ts) <= high))


def sync_windows(states: DataFrame, as_of: Column) -> DataFrame:
    """The windows of many models at once, from (last, full): ``upsert.sync_window``
    as columns ``start_at`` and ``end_at``."""
    start = (F.when(F.col("full"), as_of - F.expr("INTERVAL 90 DAYS")).when(F.col("last").isNull(), as_of - F.expr("INTERVAL 30 DAYS"))
             .otherwise(F.col("last") - F.expr("INTERVAL 1 HOUR")))
    return states.withColumns({"start_at": start, "end_at": as_of}).where("start_at <= end_at")


def incremental_sync(source: DataFrame, table: KeyedTable, state: SyncState, model: str, ts: str, as_of: dt.datetime,
                     order: Sequence[str] = (), full: bool = False, overlap: dt.timedelta = dt.timedelta(hours=1), **options) -> bool:
    """Upsert what changed since ``model``'s watermark less ``overlap``, then move
    the watermark to the newest row read. Nothing is deleted. False when there was
    nothing to do."""
    window = sync_window(as_of, state.get(model), full, overlap)
    if window is None:
        return False
    path = _batch_path(table.spark)
    batch = parked(changed_rows(source, ts, window), path)
    newest = batch.agg(F.max(F.col(ts).cast("timestamp"))).first()[0]
    if newest is not None:
        table.upsert(batch, order=order or [ts], written=True, **options)
        state.set(model, newest)
    drop_path(table.spark, path)
    return newest is not None
