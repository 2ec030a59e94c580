"""Suffix dedup against prefix doubling over every byte position."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockwise.llm.common import stored
from stockwise.llm.suffix_dedup import Prints, batches_of, remove_repeats

FIRST = 25      # doubled four times: 400


def doubled(docs):
    """(doc_id, at): starts of the 400-byte strings that stand twice, by rank pairs
    at growing offsets; a position leaves once its rank is unique."""
    def first(batches):
        for batch in batches:
            for part, data, ends in batches_of(batch):
                n = np.maximum(np.diff(ends) - FIRST + 1, 0)
                of = np.repeat(np.arange(len(n)), n)
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                rank = Prints(data).wide(at + ends[of], at + ends[of] + FIRST).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(of)), pa.array(at.astype(np.int32)), pa.array(rank)], ["doc_id", "at", "r"])

    def twice(rows, *rank):
        return rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*rank))).where("n > 1")

    rows = stored(twice(docs.mapInArrow(first, "doc_id long, at int, r long"), "r").drop("n"), "doubling")
    length = FIRST
    while length < 400:
        onward = rows.select("doc_id", (F.col("at") - length).cast("int").alias("at"), F.col("r").alias("r2"))
        pairs = twice(rows.join(onward, ["doc_id", "at"]), "r", "r2")
        rows = stored(pairs.select("doc_id", "at", F.xxhash64("r", "r2").alias("r")), "doubling")
        length *= 2
    return rows.select("doc_id", "at")


def test_suffix_dedup_equals_prefix_doubling(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    onto = F.col("at") - F.lag("at").over(Window.partitionBy("doc_id").orderBy("at"))
    gone = doubled(docs).withColumn("x", F.least(F.coalesce(onto, F.lit(400)), F.lit(400))).groupBy("doc_id").agg(F.sum("x").alias("gone"))
    found = remove_repeats(docs, 400).join(gone, "doc_id", "left").select("n_removed", F.coalesce("gone", F.lit(0)).alias("gone"))
    total, same, removed = found.agg(F.count(F.lit(1)), F.sum((F.col("n_removed") == F.col("gone")).cast("int")), F.sum("gone")).first()
    assert total == same == docs.count() and removed > 0
