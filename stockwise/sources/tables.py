"""Parquet table access for the driver's data set.

Tables are read lazily; Catalyst prunes columns and pushes filters into the
Parquet scan, so a view that needs two columns reads two columns.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy handle on the base tables of one scale factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def region(self) -> DataFrame: return self._read("region")
    @cached_property
    def nation(self) -> DataFrame: return self._read("nation")
    @cached_property
    def customer(self) -> DataFrame: return self._read("customer")
    @cached_property
    def supplier(self) -> DataFrame: return self._read("supplier")
    @cached_property
    def part(self) -> DataFrame: return self._read("part")
    @cached_property
    def orders(self) -> DataFrame: return self._read("orders")
    @cached_property
    def lineitem(self) -> DataFrame: return self._read("lineitem")
    @cached_property
    def events(self) -> DataFrame: return self._read("events")
    @cached_property
    def documents(self) -> DataFrame: return self._read("documents")
    @cached_property
    def embeddings(self) -> DataFrame: return self._read("embeddings")
    @cached_property
    def pages(self) -> DataFrame: return self._read("pages")
    @cached_property
    def benchmark(self) -> DataFrame: return self._read("benchmark")
    @cached_property
    def labels(self) -> DataFrame: return self._read("labels")
    @cached_property
    def conversations(self) -> DataFrame: return self._read("conversations")
