"""What vector search holds at the driver."""

import tracemalloc

import numpy as np
import pytest

from stockwise.operators import vector_index as VI
from stockwise.plans import search as P
from stockwise.sources import views as V


@pytest.fixture()
def tables(spark, tmp_path):
    """Parts with and without vectors, one vector's part unknown, one part with two."""
    spark.createDataFrame([(p, f"part {p}", "Brand#11", "PROMO", p, 10.0 * p) for p in range(1, 40)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(p, [float(p % 5), 1.0 + p]) for p in [*range(1, 30), 3, 99]], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parts_do_not_pass_through_the_driver(spark, tables):
    v = V.Views(spark, tables)
    assert sorted(map(str, v.product_to_search.collect())) == sorted(map(str, v.product.collect()))
    queries = P.product_queries(spark, tables)
    assert "Broadcast" not in _plan(queries) and queries.count() == 30
    catalogue = VI.vectors(v.product_to_search.where("is_active"), "embedding", "sku")
    assert "SortMergeJoin" in _plan(catalogue) and "Broadcast" not in _plan(catalogue)
    found = P.E.similar(queries, v.product_to_search, threshold=0.3)
    assert sorted(map(str, found.collect())) == sorted(map(str, P.E.similar(queries, v.product, threshold=0.3).collect())) and found.count() > 0


def test_centroids_are_compared_some_rows_at_a_time(monkeypatch):
    rng = np.random.default_rng(3)
    unit, centres = rng.normal(size=(8_000, 16)), rng.normal(size=(1_000, 16))
    whole = (unit @ centres.T).argmax(axis=1)
    tracemalloc.start()
    got = VI._nearest(unit, centres)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got == whole).all() and peak < 16e6       # the whole is 64 MB
