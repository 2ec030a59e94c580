"""Registered table profiles, wide exports and nested updates."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwise.operators import exports as X
from stockwise.operators import upsert as U
from stockwise.operators.patch import partial_update
from stockwise.plans.common import views
from stockwise.plans.forecast import _capped, _sel
from stockwise.plans.registry import register
from stockwise.session import shared_path
from stockwise.sources.tables import TABLE_NAMES, read_table

# Columns and types of the given tables, for the SQL twin of the profile.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _profile_sql() -> str:
    parts = []
    for table, columns in COLUMNS.items():
        for column in columns.split(", "):
            name, kind = column.split(" ")
            value = (f"CAST({name} AS DOUBLE)" if kind in ("int", "bigint", "double")
                     else f"CAST(date_diff('day', DATE '1970-01-01', CAST({name} AS DATE)) AS DOUBLE)" if kind.startswith("timestamp")
                     else "CAST(NULL AS DOUBLE)")
            parts.append(f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{kind}' AS data_type, count(*) AS n_rows, "
                         f"count(*) - count({name}) AS n_nulls, min({value}) AS low, max({value}) AS high FROM {table}")
    return "\nUNION ALL ".join(parts)


def column_profiles(spark, sf_dir) -> DataFrame:
    return reduce(DataFrame.unionByName, [X.column_profile(read_table(spark, sf_dir, t), t) for t in TABLE_NAMES])


@register("S13_column_profile", oracle=_profile_sql())
def s13_columns(spark, sf_dir):
    """Every column of every table: the exact part of the profile."""
    return column_profiles(spark, sf_dir).drop("about_distinct", "about_median")


@register("S13_column_sketches")
def s13_sketches(spark, sf_dir):
    """The same with the sketches' estimates."""
    return column_profiles(spark, sf_dir)


# U18 --------------------------------------------------------------------------
@register("U18_forecast_wide", oracle="""
SELECT CAST(forecast_date AS VARCHAR) AS forecast_date, sku, CAST(max(forecast_qty) AS BIGINT) AS forecast_qty FROM capped GROUP BY 1, 2""",
          extra_ctes=_sel("capped"))
def u18_wide(spark, sf_dir):
    """The forecast table as date x SKU files in column groups, read back."""
    path = shared_path(spark, f"exports/wide-{uuid.uuid4().hex[:10]}")
    X.export_wide(_capped(spark, sf_dir), path, "forecast_date", "sku", "forecast_qty", per_group=200)
    return X.read_wide(spark, path, "forecast_date").select(
        "forecast_date", F.col("column").alias("sku"), F.col("value").cast("long").alias("forecast_qty"))


@register("U18_forecast_exports", oracle="""
SELECT sku, count(*) AS n, CAST(sum(forecast_qty) AS BIGINT) AS total_quantity, min(forecast_date) AS first_date, max(forecast_date) AS last_date
FROM capped GROUP BY 1""", extra_ctes=_sel("capped"))
def u18_forecast(spark, sf_dir):
    """Detail file of the forecast table, and a summary per SKU of what it holds."""
    base = shared_path(spark, f"exports/{uuid.uuid4().hex[:10]}")
    U.export_csv(_capped(spark, sf_dir).select("sku", "forecast_date", "forecast_qty", "method"), f"{base}/detail")
    detail = spark.read.schema("sku string, forecast_date date, forecast_qty long, method string").option("header", True).csv(f"{base}/detail")
    U.export_csv(detail.groupBy("sku").agg(
        F.count(F.lit(1)).alias("n"), F.sum("forecast_qty").alias("total_quantity"), F.min("forecast_date").alias("first_date"),
        F.max("forecast_date").alias("last_date")), f"{base}/summary")
    return spark.read.schema("sku string, n long, total_quantity long, first_date date, last_date date").option("header", True).csv(f"{base}/summary")


# V11 --------------------------------------------------------------------------
PATCHES = {
    1: """{"name": null}""",
    2: """{"info": {"price": {"list": 1.5}}}""",
    3: """{"info": null, "unknown": {"name": "x"}}""",
    4: """{"info": {"tags": [{"k": "a", "v": "b"}, {"k": "c", "v": null}], "category": "X"}, "unknown": 1}""",
    5: """{"info": {"price": null, "tags": []}}""",
    6: """{"name": "new", "info": {"price": {"cost": 2.0, "list": null}}}""",
}
PATCH_SQL = "CASE product_id % 7 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in PATCHES.items()) + " END"


@register("V11_partial_update", oracle=f"""
SELECT product_id, CASE WHEN json_exists(j, '$.name') THEN j ->> '$.name' ELSE name END AS name,
       CASE WHEN json_type(j, '$.info') = 'NULL' THEN NULL WHEN json_exists(j, '$.info.category') THEN j ->> '$.info.category'
            ELSE category END AS category,
       CASE WHEN json_type(j, '$.info') = 'NULL' OR json_type(j, '$.info.price') = 'NULL' THEN NULL
            WHEN json_exists(j, '$.info.price.list') THEN CAST(j ->> '$.info.price.list' AS DOUBLE) ELSE list_price END AS list,
       CASE WHEN json_type(j, '$.info') = 'NULL' OR json_type(j, '$.info.price') = 'NULL' THEN NULL
            WHEN json_exists(j, '$.info.price.cost') THEN CAST(j ->> '$.info.price.cost' AS DOUBLE) ELSE standard_price END AS cost,
       CASE WHEN json_type(j, '$.info') = 'NULL' THEN NULL WHEN json_exists(j, '$.info.tags') THEN coalesce((
              SELECT string_agg((t ->> '$.k') || '=' || coalesce(t ->> '$.v', '-'), ';') FROM (SELECT unnest(CAST(j -> '$.info.tags' AS JSON[])) AS t)), '')
            ELSE tags END AS tags
FROM (SELECT product_id, name, CASE WHEN product_id % 11 <> 0 THEN category END AS category,
             CASE WHEN product_id % 11 <> 0 THEN list_price END AS list_price,
             CASE WHEN product_id % 11 <> 0 THEN standard_price END AS standard_price,
             CASE WHEN product_id % 11 <> 0 THEN 'type=' || product_type END AS tags, CAST({PATCH_SQL} AS JSON) AS j FROM product) p""")
def v11_patch(spark, sf_dir):
    """Three levels; no patch, nulls at each level, fields that were null, arrays of
    structs replaced whole, unknown fields."""
    p = views(spark, sf_dir).product
    info = F.struct("category", F.struct(F.col("list_price").alias("list"), F.col("standard_price").alias("cost")).alias("price"),
                    F.array(F.struct(F.lit("type").alias("k"), F.col("product_type").alias("v"))).alias("tags"))
    rows = p.select("product_id", F.struct("name", F.when(F.col("product_id") % 11 != 0, info).alias("info")).alias("doc"))
    done = partial_update(rows, p.select("product_id", F.expr(PATCH_SQL).alias("patch")), "product_id", "doc")
    tags = F.array_join(F.transform("doc.info.tags", lambda t: F.concat(t["k"], F.lit("="), F.coalesce(t["v"], F.lit("-")))), ";")
    return done.select("product_id", "doc.name", "doc.info.category", "doc.info.price.list", "doc.info.price.cost", tags.alias("tags"))
