"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"     # state beyond the heap


def get_spark(cpus: int | str = "*", app: str = "stockwise", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster the builder's
    existing session and its configuration win (``getOrCreate``)."""
    builder = SparkSession.builder.appName(app)
    if not _submitted():
        # a local run; a submitted application keeps its master, memory and partitions
        parts = shuffle_partitions or (8 if cpus == "*" else max(4, int(cpus)))
        builder = (builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(parts))
                   .config("spark.driver.memory", os.environ.get("STOCKWISE_DRIVER_MEMORY", "16g")))
    spark = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _submitted() -> bool:
    """Whether spark-submit or a running session already chose a master."""
    return SparkSession.getActiveSession() is not None or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "") or "MASTER" in os.environ


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the setting is absent under a ``local[...]`` master (tests) a
    scratch folder is created and registered; on a cluster the configured shared
    folder is used as is, and its absence is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="stockwise-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never localCheckpoint): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written or collected inside go as soon as it is done;
    else they stay on disk until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes a written intermediate table, in whatever file system it lies."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
