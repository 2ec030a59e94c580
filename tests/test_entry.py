"""Driver contract: entry() runs, every query has a callable, oracle keys
are a subset of the queries, and a sample of queries runs on sf0.001."""

import importlib.util
import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    df = _entry_module().entry(spark)
    assert df.count() > 0
    assert {"sku", "priority", "required_production"} <= set(df.columns)


def test_registry_consistent():
    m = _entry_module()
    q, o = m.queries(), m.oracle_sql()
    assert len(q) >= 150
    assert set(o) <= set(q)


@pytest.mark.parametrize("name", ["A1_sales_summary_channel", "T6_forecast_chain_capped", "O7_stock_by_sku",
                                  "D1_flatten_orders", "C2_referential_integrity", "E3_hybrid_search"])
def test_sample_queries_run(spark, name):
    df = _entry_module().queries()[name](spark, "/root/testdata/sf0.001")
    assert df.count() > 0
