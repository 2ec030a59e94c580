"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwise.session import shared_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
_KEPT: dict[str, dict] = {}     # by owner, what a Python worker keeps from task to task


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder (``spark.checkpoint.dir``)
    and read it back: cuts lineage, survives lost executors, computed once. The
    shuffle files that made the table go once it is written."""
    spark = df.sparkSession
    path = shared_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    conf, key = spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def kept(owner: str) -> dict:
    """What the tasks of ``owner`` keep in a Python worker from one to the next."""
    return _KEPT.setdefault(owner, {})


def let_go(*owners: str) -> None:
    """Frees what a Python worker keeps for others than ``owners``, and memory that
    Arrow holds unused. Spark gives a worker the tasks of any operator, so each
    task starts with this. Called by name: a task's copy of a module's dictionary
    is not the one that the worker's functions use."""
    for owner, held in _KEPT.items():
        if owner not in owners:
            held.clear()
    pa.default_memory_pool().release_unused()


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` evaluated once per row: a lambda variable
    holds it, so nested lambdas do not evaluate ``value`` again."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)
