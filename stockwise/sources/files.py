"""File and JDBC sources (S1-S14): CSV with fixed schema, header detection,
validation, year-partitioned tables, Relay-page JSON, conversation
envelopes, profiles. Every reader declares its schema (no inference)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed column order of the headerless legacy sales CSV (18 columns).
SALES_COLUMNS = (
    "salesinvoiceid", "doctype_name", "docnumber", "customer_customerid", "customer_name", "customer_vatid",
    "salesman_name", "term_name", "warehouse_name", "totals_net", "totals_vat", "total_total",
    "items_product_description", "items_product_sku", "items_quantity", "items_unitprice", "issueddate",
    "sales_channel",
)
_TYPES = {"customer_customerid": T.LongType(), "totals_net": T.DoubleType(), "totals_vat": T.DoubleType(),
          "total_total": T.DoubleType(), "items_quantity": T.DoubleType(), "items_unitprice": T.DoubleType(),
          "issueddate": T.DateType()}
SALES_SCHEMA = T.StructType([T.StructField(c, _TYPES.get(c, T.StringType())) for c in SALES_COLUMNS])


# S1 / S2 / S4 / S5 ----------------------------------------------------------------
def read_sales_csv(spark: SparkSession, path: str, header: bool | str = False) -> DataFrame:
    """Headerless 18-column CSV (S1); ``header='auto'`` (S2) treats the first
    line as a header when at least max(1, 18 // 3) of its tokens are column
    names. One distributed read (S4: no 10 000-row chunks)."""
    if header == "auto":
        first = spark.read.text(path).limit(1).collect()  # one line
        tokens = [t.strip().strip('"').lower() for t in (first[0][0].split(",") if first else [])]
        matches = sum(1 for t in tokens if t in SALES_COLUMNS)
        header = matches >= max(1, len(SALES_COLUMNS) // 3)
    return (spark.read.schema(SALES_SCHEMA).option("header", bool(header)).option("mode", "PERMISSIVE")
            .option("dateFormat", "yyyy-MM-dd").csv(path))


def staging_view(df: DataFrame, name: str = "staging_legacy_sales") -> str:
    """The bulk-loaded rows as a temp view for set-based SQL."""
    df.createOrReplaceTempView(name)
    return name


# S3 ---------------------------------------------------------------------------
def validate_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows, expected columns and malformed rows (PERMISSIVE mode keeps the
    raw text of bad lines in ``_corrupt``)."""
    schema = SALES_SCHEMA.add("_corrupt", T.StringType())
    df = (spark.read.schema(schema).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt").csv(path))
    # Spark refuses plans that reference only the corrupt-record column, so
    # the (equivalent) predicate also mentions a parsed column.
    bad = F.col("_corrupt").isNotNull() & (F.col("salesinvoiceid").isNull() | F.col("salesinvoiceid").isNotNull())
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(SALES_COLUMNS)).alias("columns"),
                  F.count_if(bad).alias("corrupt"))


# S6 ---------------------------------------------------------------------------
def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
              num_partitions: int, properties: dict | None = None) -> DataFrame:
    """Parallel JDBC read split on a numeric column (requires a driver jar)."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=properties or {})


OPEN_YEARS = 32         # files that a task of ``write_by_year`` has open at once


# S7 / S8 / S9 -----------------------------------------------------------------
def write_by_year(df: DataFrame, path: str, date_col: str = "issueddate") -> None:
    """Each task writes its rows to a file per year as they come: nothing is dealt or
    sorted, so a year is not one task and no rows pass through the disk on their way.
    A task that meets more years than ``OPEN_YEARS`` sorts its other rows by year."""
    conf, key = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, OPEN_YEARS)
    try:
        (df.withColumn("year", F.year(date_col)).write.mode("overwrite").partitionBy("year").parquet(path, compression="zstd"))
    finally:
        conf.set(key, before)


def read_years(spark: SparkSession, path: str, start: dt.date, end: dt.date, date_col: str = "issueddate"):
    """Year partitions are pruned by the ``year`` predicate; the exact day
    range is then a pushed-down row filter."""
    df = spark.read.parquet(path)
    return df.where(F.col("year").between(start.year, end.year)
                    & F.col(date_col).between(F.lit(start), F.lit(end)))


def date_bounds(df: DataFrame, date_col: str = "issueddate", qty_col: str = "items_quantity") -> DataFrame:
    d = df.where(F.col(qty_col) > 0)
    return d.agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
                 F.count(F.lit(1)).alias("rows"))


def read_since(df: DataFrame, columns: list[str], condition, ts_col: str, since) -> DataFrame:
    """Projected, filtered, watermarked read (pruning and pushdown do the
    work the reference's offset paging did)."""
    return df.where(condition & (F.col(ts_col) > F.lit(since))).select(*columns)


# S10 ---------------------------------------------------------------------------
def write_relay_pages(orders: DataFrame, path: str, page_size: int = 250, parts: tuple[int, ...] = ()) -> None:
    """Orders as GraphQL-style pages {data:{orders:{edges:[{node}], pageInfo}}},
    ``page_size`` orders per page (bounded arrays), in compressed files. ``parts``
    (``views.spread_for``) is the number of partitions where the session's are too few."""
    oid = F.element_at(F.split("order.id", "/"), -1).cast("long")
    paged = orders.withColumn("page", (oid / page_size).cast("long"))
    paged = paged.repartition(*parts, "page") if parts else paged
    pages = (paged.groupBy("page").agg(F.collect_list(F.struct(F.col("order").alias("node"))).alias("edges")))
    doc = pages.select(F.struct(F.struct(F.struct(
        "edges", F.struct(F.lit(False).alias("hasNextPage"), F.col("page").cast("string").alias("endCursor"))
        .alias("pageInfo")).alias("orders")).alias("data")).alias("doc"))
    doc.select(F.to_json("doc").alias("value")).write.mode("overwrite").text(path, compression="gzip")


def read_relay_pages(spark: SparkSession, path: str, node_schema: T.StructType) -> DataFrame:
    schema = T.StructType([T.StructField("data", T.StructType([T.StructField("orders", T.StructType([
        T.StructField("edges", T.ArrayType(T.StructType([T.StructField("node", node_schema)]))),
        T.StructField("pageInfo", T.StructType([T.StructField("hasNextPage", T.BooleanType()),
                                                T.StructField("endCursor", T.StringType())]))]))]))])
    return spark.read.schema(schema).json(path).select(F.explode("data.orders.edges").alias("e")).select(
        F.col("e.node").alias("order"))


# S11 ---------------------------------------------------------------------------
def normalise_envelopes(raw: DataFrame, conv_schema: T.StructType, col: str = "value") -> DataFrame:
    """Payloads arrive as {data:{payload:[...]}}, {payload:{...}} or a bare
    conversation object: parse each shape, take the one present."""
    wrapped_list = T.StructType([T.StructField("data", T.StructType([
        T.StructField("payload", T.ArrayType(conv_schema))]))])
    wrapped_one = T.StructType([T.StructField("payload", conv_schema)])
    a = F.from_json(col, wrapped_list)["data"]["payload"]
    b = F.from_json(col, wrapped_one)["payload"]
    c = F.from_json(col, conv_schema)
    arr = F.when(a.isNotNull(), a).when(b.isNotNull(), F.array(b)).otherwise(F.array(c))
    return raw.select(F.explode(arr).alias("conversation")).where(F.col("conversation.id").isNotNull())


# S13 / S14 -----------------------------------------------------------------------
def table_profile(tables: dict[str, DataFrame], date_cols: dict[str, str] | None = None) -> DataFrame:
    """Columns, row count and (optional) min/max date per table, one pass each."""
    from functools import reduce

    rows = []
    for name, df in tables.items():
        dc = (date_cols or {}).get(name)
        rows.append(df.agg(
            F.lit(name).alias("table_name"), F.lit(len(df.columns)).alias("n_columns"),
            F.count(F.lit(1)).alias("n_rows"),
            (F.min(F.col(dc).cast("date")) if dc else F.lit(None).cast("date")).alias("min_date"),
            (F.max(F.col(dc).cast("date")) if dc else F.lit(None).cast("date")).alias("max_date")))
    return reduce(DataFrame.unionByName, rows)


def volume_audit(orders: DataFrame, lines: DataFrame, states=("sale", "done")) -> DataFrame:
    o = orders.where(F.col("state").isin(*states)).select("order_id")
    per = lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    j = o.join(per, "order_id", "left")
    return j.agg(F.count(F.lit(1)).alias("orders"), F.sum(F.coalesce("n", F.lit(0))).alias("lines"),
                 F.round(F.avg(F.coalesce("n", F.lit(0))), 4).alias("avg_lines_per_order"))
