"""Steps that deal a large table's rows over more partitions than the session has."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockwise.sources import files as S
from stockwise.sources import nested as NS
from stockwise.sources import views as V

DAY = dt.datetime(2001, 3, 5)


@pytest.fixture()
def tables(spark, tmp_path):
    """Twelve orders of up to three lines; order 12 has none, one line's part is unknown."""
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    lines = [(o, 9 if (o, n) == (5, 1) else 1 + (o + n) % 4, 1 + o % 2, n, 2.0 + n, 100.0 * o, 0.05, 0.02, "ANR"[n % 3], "FO"[o % 2], DAY)
             for o in range(1, 12) for n in range(1, 2 + o % 3)]
    lines += lines[-1:]
    write("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    write("orders", [(o, 1 + o % 3, "FOP"[o % 3], 10.0 * o, DAY, "1-URGENT") for o in range(1, 13)],
          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    write("customer", [(c, f"Customer#{c}", 1, 0.0, "BUILDING") for c in (1, 2)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    write("supplier", [(s, f"Supplier#{s}", 1, 0.0) for s in (1, 2)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    write("nation", [(1, "CHILE")], "n_nationkey int, n_name string")
    write("part", [(p, f"part {p}", "Brand#1", "PROMO", p, 10.0 * p) for p in (1, 2, 3, 4)],
          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    write("embeddings", [(1, [0.5, 1.0])], "vec_id long, embedding array<float>")
    return str(tmp_path)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_relay_pages_are_compressed_and_dealt_by_rows(spark, tables, tmp_path, monkeypatch):
    from stockwise.operators.nested import flatten_orders

    few = NS.order_documents(V.Views(spark, tables))
    plain = _rows(few)
    monkeypatch.setattr(V, "TASK_ROWS", 1)
    v = V.Views(spark, tables)
    orders, parts = NS.order_documents(v), V.spread_for(v.t.lineitem)
    assert len(plain) == 12 and _rows(orders) == plain
    out = str(tmp_path / "pages")
    S.write_relay_pages(orders, out, page_size=2, parts=parts)
    names = [f.name for f in (tmp_path / "pages").iterdir() if f.name.startswith("part-")]
    assert len(names) > 1 and all(n.endswith(".gz") for n in names)
    back = flatten_orders(S.read_relay_pages(spark, out, orders.schema["order"].dataType))
    assert _rows(back) == _rows(flatten_orders(few)) and back.count() == 25
    dealt = orders._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [order_id" in dealt and f", {parts[0]}" in dealt
    # customers meet the orders before the lines do: a nested order is not dealt by customer
    assert dealt.index("RepartitionByExpression") > dealt.index("c_custkey")


def test_purchase_lines_are_dealt_by_rows(spark, tables, monkeypatch):
    from stockwise.plans.procurement import _prices

    plain = _rows(_prices(spark, tables))
    monkeypatch.setattr(V, "TASK_ROWS", 1)
    many = _prices(spark, tables)
    lines = V.Views(spark, tables).t.lineitem.count()
    assert f", {lines}" in many._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    assert plain and _rows(many) == plain


def test_forecast_steps_deal_skus_by_rows_of_a_narrow_table(spark, tables):
    from stockwise.operators import series as T
    from stockwise.operators.profile import sku_profile

    v = V.Views(spark, tables)
    si = v.sales_series
    assert tuple(si.columns) == V.SERIES_COLUMNS
    assert _rows(si) == _rows(v.sales_items_plan.select(*V.SERIES_COLUMNS))
    as_of = dt.date(2001, 6, 30)
    si = si.withColumn("sales_channel", F.lit("Online"))
    series = T.sku_month_arrays(T.forecast_sales(si, as_of))
    wide = T.sku_month_arrays(T.forecast_sales(si, as_of, (31,)))
    assert series.count() > 0 and _rows(wide) == _rows(series)
    assert "RepartitionByExpression [sku" in wide._jdf.queryExecution().optimizedPlan().toString()
    profile = sku_profile(si, as_of, (31,))
    assert _rows(profile) == _rows(sku_profile(si, as_of))
    assert "RepartitionByExpression [sku" in profile._jdf.queryExecution().optimizedPlan().toString()
    # where the whole table is stored, it is not stored again
    assert v.sales_items.count() == si.count()
    again = V.Views(spark, tables).sales_series
    assert again.inputFiles() and set(again.inputFiles()) == set(v.sales_items.inputFiles())


def test_stored_quants_are_dealt_by_rows(spark, tables, monkeypatch):
    plan = V.Views(spark, tables).inventory_quant_plan
    monkeypatch.setattr(V, "TASK_ROWS", 1)
    stored = V.Views(spark, tables).inventory_quant
    assert plan.count() > 4 and _rows(stored) == _rows(plan)
    assert len(stored.inputFiles()) > 1
    dealt = stored.select("product_id", F.input_file_name().alias("f")).distinct()
    assert dealt.count() == dealt.select("product_id").distinct().count()      # a product is in one file
