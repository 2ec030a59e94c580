"""Greedy request batches over a global order, whatever the partitioning.

Rows in order go into a batch until one more would exceed ``max_items`` or
``max_tokens``. Where a batch starts at a row, the next one starts at a row that
depends on the following ``max_items`` rows only: the row's pointer. The batches are
the chain of pointers from the first row.

1. Rows are sorted across partitions; counts and token sums of the partitions before
   (one row a partition at the driver) give each row its number and running sum.
2. Chunks of consecutive rows, each with the first rows of the next, give every row
   its pointer from the running sums.
3. Pointers are doubled: tables of 1, 2, 4, ... batches ahead. From the first row
   all batch starts follow, the largest step first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockwise.session import cut_lineage

CHUNK = 8_192


def numbered(df: DataFrame, order: list[str], value: str) -> DataFrame:
    """Rows with their 0-based number ``idx`` in ``order`` and the sum ``upto`` of
    ``value`` up to and with the row. Equal rows are numbered in any order."""
    parted = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("__part", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id()))
    totals = {r["__part"]: (r.n, r.s) for r in parted.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("s")).collect()}
    n = s = 0
    before = []
    for part in sorted(totals):
        before.append((part, n, s))
        n, s = n + totals[part][0], s + totals[part][1]
    # chunks of a partition, so that no task holds a partition's window alone when it is long
    spark = df.sparkSession
    offsets = spark.createDataFrame(before or [(0, 0, 0)], "__part int, __n long, __s long")
    local = F.col("__row").bitwiseAND((1 << 33) - 1)
    parted = parted.withColumn("__block", F.floor(local / CHUNK))
    in_block = Window.partitionBy("__part", "__block").orderBy("__row")
    blocks = parted.groupBy("__part", "__block").agg(F.sum(value).alias("__bs"))
    earlier = Window.partitionBy("__part").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__b", F.coalesce(F.sum("__bs").over(earlier), F.lit(0))).drop("__bs")
    out = parted.withColumn("__in", F.sum(value).over(in_block)).join(blocks, ["__part", "__block"]).join(F.broadcast(offsets), "__part")
    return out.select(*df.columns, (local + F.col("__n")).alias("idx"), (F.col("__in") + F.col("__b") + F.col("__s")).cast("long").alias("upto"))


def pointers(rows: DataFrame, max_items: int, max_tokens: int, chunk: int = CHUNK) -> DataFrame:
    """(idx, next): where the batch after one that starts at ``idx`` starts. ``rows``
    has (idx, tokens, upto), tokens at least 1."""
    own = F.floor(F.col("idx") / chunk).alias("chunk")
    begins = F.col("upto") - F.col("tokens")
    # the first rows of a chunk stand in the chunk before as well
    heads = rows.where((F.col("idx") % chunk < max_items) & (F.col("idx") >= chunk))
    both = (rows.select("idx", "tokens", "upto", own, F.lit(True).alias("mine"))
            .unionByName(heads.select("idx", "tokens", "upto", (F.floor(F.col("idx") / chunk) - 1).alias("chunk"), F.lit(False).alias("mine"))))
    ahead = Window.partitionBy("chunk").orderBy(begins).rangeBetween(0, max_tokens - 1)
    seen = both.withColumns({"n": F.count(F.lit(1)).over(ahead), "end": F.max("upto").over(ahead)}).where("mine")
    # only the last row that begins within the limit can go beyond it
    over = (F.col("end") > begins + max_tokens).cast("int")
    return seen.select("idx", (F.col("idx") + F.greatest(F.lit(1), F.least(F.lit(max_items), F.col("n") - over))).alias("next"))


def batch_starts(step: DataFrame, rows: int) -> DataFrame:
    """(idx, batch): the rows reached from row 0 by ``step`` (idx, next), in order."""
    tables, ahead = [], cut_lineage(step)
    while True:
        tables.append(ahead)
        first = ahead.where("idx = 0").first()
        if first is None or first["next"] >= rows:
            break
        onward = ahead.select(F.col("idx").alias("next"), F.col("next").alias("far"))
        ahead = cut_lineage(ahead.join(onward, "next", "left").select("idx", F.coalesce("far", F.lit(rows)).alias("next")))
    reached = step.sparkSession.range(1).select(F.col("id").alias("idx"), F.lit(0).cast("long").alias("batch"))
    for power in range(len(tables) - 1, -1, -1):
        on = tables[power].join(reached, "idx").where(F.col("next") < rows).select(
            F.col("next").alias("idx"), (F.col("batch") + (1 << power)).alias("batch"))
        reached = cut_lineage(reached.unionByName(on))
    return reached


def assign_batches(df: DataFrame, text_col: str, order: list[str], max_items: int = 100, max_tokens: int = 8000) -> DataFrame:
    """``df`` with ``est_tokens`` (a quarter of the characters, at least 1) and
    ``batch_id``, numbered from 0 in ``order``, which must be unique for ids that do
    not depend on the partitioning."""
    tokens = F.greatest(F.lit(1), F.floor(F.coalesce(F.length(text_col), F.lit(0)) / 4)).cast("long")
    rows = cut_lineage(numbered(df.withColumn("est_tokens", tokens), order, "est_tokens"))
    total = rows.count()
    step = pointers(rows.select("idx", F.col("est_tokens").alias("tokens"), "upto"), max_items, max_tokens)
    starts = batch_starts(step, total)
    members = starts.join(step, "idx").select("batch", F.explode(F.sequence(F.col("idx"), F.least("next", F.lit(total)) - 1)).alias("idx"))
    return rows.join(members, "idx").select(*df.columns, "est_tokens", F.col("batch").alias("batch_id"))
