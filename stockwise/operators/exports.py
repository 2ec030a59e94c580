"""Wide exports of long tables in column groups (U18), and table profiles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwise.session import cut_lineage

PER_GROUP = 1_000       # columns of a file


def export_wide(df: DataFrame, path: str, row: str, column: str, value: str, per_group: int = PER_GROUP) -> None:
    """``row`` x ``column`` as CSV files: the columns, sorted, are cut into ranges of
    about ``per_group``, each a file in ``path/cells/column_group=<n>`` with a header;
    ``path/manifest`` holds (column_group, name, place) of every column. Empty cells
    stay empty; of repeated cells the largest counts. A group's file is as long as
    there are rows, which are few (dates)."""
    cells = cut_lineage(df.where(F.col(column).isNotNull() & F.col(row).isNotNull()).groupBy(
        F.col(row).cast("string").alias("r"), F.col(column).cast("string").alias("c")).agg(F.max(value).cast("string").alias("v")))
    names = cells.select("c").distinct()
    groups = max(1, -(-names.count() // per_group))
    parted = names.repartitionByRange(groups, "c").select(F.spark_partition_id().alias("column_group"), F.col("c").alias("name"))

    def placed(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("name")
        return batch.assign(place=range(len(batch)))

    parted.groupBy("column_group").applyInPandas(placed, "column_group int, name string, place int").write.mode("overwrite").parquet(f"{path}/manifest")
    manifest = df.sparkSession.read.parquet(f"{path}/manifest")

    def lines(group: pd.DataFrame) -> pd.DataFrame:
        wide = group.pivot(index="r", columns="c", values="v").sort_index().sort_index(axis=1)
        quoted = lambda x: "" if pd.isna(x) else f'"{x}"' if any(s in x for s in ',"\n') else x
        text = [",".join([row, *map(quoted, wide.columns)])] + [",".join([r, *map(quoted, v)]) for r, v in zip(wide.index, wide.values)]
        return pd.DataFrame({"column_group": group["column_group"].iloc[0], "line": range(len(text)), "value": text})

    out = cells.join(manifest.select("column_group", F.col("name").alias("c")), "c").groupBy("column_group").applyInPandas(
        lines, "column_group int, line int, value string")
    (out.repartition("column_group").sortWithinPartitions("column_group", "line").select("column_group", "value")
     .write.mode("overwrite").partitionBy("column_group").text(f"{path}/cells"))


def read_wide(spark: SparkSession, path: str, row: str) -> DataFrame:
    """(row, column, value) of the cells of ``export_wide`` that are not empty, names
    taken from the files' own headers."""
    lines = spark.read.text(f"{path}/cells").select("column_group", F.split("value", ",").alias("f"))
    header = lines.where(F.col("f")[0] == row).select("column_group", F.col("f").alias("names"))
    cells = lines.where(F.col("f")[0] != row).join(header, "column_group")
    return cells.select(F.col("f")[0].alias(row), F.explode(F.slice(F.arrays_zip("f", "names"), 2, F.size("names"))).alias("x")).where(
        F.col("x.f") != "").select(row, F.col("x.names").alias("column"), F.col("x.f").alias("value"))


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """One row a column, from one pass: type, rows, nulls, bounds as doubles of
    numbers and dates (days since 1970), and of single values the number of distinct
    ones by a HyperLogLog sketch and the median of numbers by a KLL sketch."""
    stats = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        number = isinstance(f.dataType, T.NumericType)
        day = isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
        x = c.cast("double") if number else F.unix_date(c.cast("date")).cast("double") if day else F.lit(None).cast("double")
        single = not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
        median = F.when(F.count(x) > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(x), F.lit(0.5))) if number else F.lit(None).cast("double")
        stats.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.count(F.lit(1)).alias("n_rows"),
            F.count_if(c.isNull()).alias("n_nulls"), F.min(x).alias("low"), F.max(x).alias("high"),
            (F.hll_sketch_estimate(F.hll_sketch_agg(c.cast("string"))) if single else F.lit(None).cast("long")).alias("about_distinct"),
            median.alias("about_median")))
    return df.agg(F.array(*stats).alias("s")).select(F.lit(table).alias("table_name"), F.explode("s").alias("s")).select("table_name", "s.*")
