"""Quantile selection, batching, substring search, wide exports, profiles, patches."""

import json
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwise.operators import batching, exports, quantiles, text_search
from stockwise.operators.patch import partial_update


@pytest.mark.parametrize("bins", [2, 1024])
def test_quantiles_equal_sorting(spark, monkeypatch, bins):
    rng = np.random.default_rng(8)
    groups = {"a": rng.lognormal(3, 2, 700).round(2), "b": np.repeat([1.0, 1.0, 5.0], 40), "c": np.array([7.0]), "d": np.array([1e300, -1e300, 0.0])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("a", None), ("e", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    fractions = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
    monkeypatch.setattr(quantiles.order_statistics, "__defaults__", (bins,))
    got = quantiles.exact_quantiles(df, "x", fractions, by="k")
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert np.allclose(got[g], np.quantile(vs, fractions), rtol=1e-12), g
    whole = np.concatenate(list(groups.values()))
    assert np.allclose(quantiles.exact_quantiles(df, "x", [0.5])[None], np.quantile(whole, [0.5]))
    assert quantiles.exact_quantiles(df.limit(0), "x", [0.5]) == {}


def _greedy(texts, items, tokens):
    out, batch, n, t = [], 0, 0, 0
    for x in texts:
        k = max(1, len(x or "") // 4)
        if n and (n + 1 > items or t + k > tokens):
            batch, n, t = batch + 1, 0, 0
        n, t = n + 1, t + k
        out.append(batch)
    return out


@pytest.mark.parametrize("parts", [1, 64])
def test_batches_do_not_depend_on_partitions(spark, monkeypatch, parts):
    monkeypatch.setattr(batching, "CHUNK", 64)
    monkeypatch.setattr(batching.pointers, "__defaults__", (64,))
    rng = np.random.default_rng(2)
    rows = [(i, None if i % 31 == 0 else "x" * int(n)) for i, n in enumerate(rng.choice([0, 3, 40, 200, 900, 5000], 700))]
    df = spark.createDataFrame(rows, "id long, text string").repartition(parts)
    got = {r.id: r.batch_id for r in batching.assign_batches(df, "text", ["id"], 20, 300).collect()}
    assert [got[i] for i, _ in rows] == _greedy([t for _, t in rows], 20, 300)
    assert batching.assign_batches(df.limit(0), "text", ["id"]).collect() == []


def test_substring_search(spark):
    products = spark.createDataFrame([
        (1, "Organic Coconut Oil", "ACTIVE", [("v1", "C-1", 2.0), ("v2", "C-2", 3.0)]), (2, "coconut milk", "ACTIVE", []),
        (3, "Coco nut", "DRAFT", None), (4, "Aloe", "ACTIVE", None), (5, None, "ACTIVE", None), (6, "nuts nuts nuts", "ACTIVE", [("v6", "N-6", 1.0)])],
        "id long, title string, status string, variants array<struct<id:string,sku:string,price:double>>")
    terms = spark.createDataFrame([("coconut", 1), (" NUT ", 2), ("al", 3), ("o", 4), ("", 5), (None, 6), ("utco", 7)], "term string, term_order long")
    hits = {(r.term, r.id) for r in text_search.substring_hits(terms, products.select("id", F.col("title").alias("text"))).collect()}
    names = {1: "organic coconut oil", 2: "coconut milk", 3: "coco nut", 4: "aloe", 6: "nuts nuts nuts"}
    assert hits == {(t, i) for t in ("coconut", " NUT ", "al", "o", "utco") for i, n in names.items() if t.strip().lower() in n}
    rows = text_search.consolidated_search(terms, products, per_term=3).collect()
    assert sorted((r.id, r.term, r.variant_id, r.variant_sku) for r in rows) == [
        (1, "coconut", "v1", "C-1"), (1, "coconut", "v2", "C-2"), (2, "coconut", "2", None), (4, "al", "4", None)]
    assert text_search.consolidated_search(terms, products, per_term=9).where("id = 6").first().term == " NUT "


def test_wide_export_holds_every_cell_once(spark):
    rows = [(f"2024-{m:02d}-01", f"SKU-{s:03d}", m * s) for m in range(1, 7) for s in range(137) if (m + s) % 4]
    df = spark.createDataFrame(rows, "d string, sku string, q long")
    path = tempfile.mkdtemp(prefix="sw-wide-")
    exports.export_wide(df, path, "d", "sku", "q", per_group=20)
    manifest = spark.read.parquet(f"{path}/manifest").collect()
    assert sorted(r.name for r in manifest) == sorted({s for _, s, _ in rows}) and len({r.column_group for r in manifest}) > 3
    bounds = {}
    for r in manifest:
        low, high = bounds.get(r.column_group, (r.name, r.name))
        bounds[r.column_group] = (min(low, r.name), max(high, r.name))
    spans = sorted(bounds.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))        # ranges of SKUs
    got = [(r.d, r.column, int(r.value)) for r in exports.read_wide(spark, path, "d").collect()]
    assert sorted(got) == sorted(rows)


def test_profile_sketches_are_close(spark):
    df = spark.range(20_000).select((F.col("id") % 5000).alias("k"), F.when(F.col("id") % 10 != 0, F.col("id")).alias("x"), F.array("id").alias("a"),
                                    F.expr("date_add(DATE '2024-01-01', int(id % 30))").alias("d"))
    got = {r.column_name: r for r in exports.column_profile(df, "t").collect()}
    assert abs(got["k"].about_distinct - 5000) <= 250 and abs(got["x"].about_distinct - 18_000) <= 900
    assert abs(got["x"].about_median - 10_000) <= 400 and got["x"].n_nulls == 2000 and (got["x"].low, got["x"].high) == (1.0, 19_999.0)
    assert got["a"].about_distinct is None and got["d"].high - got["d"].low == 29 and got["d"].data_type == "date"
    empty = {r.column_name: r for r in exports.column_profile(df.limit(0), "t").collect()}
    assert empty["k"].n_rows == 0 and empty["k"].low is None


def _patched(model, patch, kind):
    out = dict(model or {f.name: None for f in kind.fields})
    for f in kind.fields:
        if f.name in patch:
            new = patch[f.name]
            if isinstance(f.dataType, T.StructType) and new is not None:
                out[f.name] = _patched(out[f.name], new, f.dataType)
            elif isinstance(f.dataType, T.StructType):
                out[f.name] = None
            else:
                out[f.name] = new
    return out


def test_nested_patches(spark):
    schema = T._parse_datatype_string("id long, doc struct<a:string,n:struct<x:int,m:struct<p:double,q:string>,tags:array<struct<k:string>>>>")
    base = {"a": "A", "n": {"x": 1, "m": {"p": 0.5, "q": "Q"}, "tags": [{"k": "t"}]}}
    patches = [{}, {"a": None}, {"n": None}, {"n": {"x": 2}}, {"n": {"m": {"p": 2.5}}}, {"n": {"m": None, "tags": []}}, {"zzz": 1, "a": "B"},
               {"n": {"m": {"q": None, "p": 1.0}, "tags": [{"k": "u"}, {"k": None}]}, "a": "C"}]
    docs = [base] * len(patches) + [{"a": "A", "n": None}] * len(patches)
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(docs)] + [(99, base), (98, None)], schema)
    given = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(patches * 2)], "id long, patch string")
    got = {r.id: r.doc.asDict(recursive=True) if r.doc else None for r in partial_update(rows, given, "id", "doc").collect()}
    assert got[99] == base and got[98] is None
    for i, (d, p) in enumerate(zip(docs, patches * 2)):
        assert got[i] == _patched(d, p, schema["doc"].dataType), (d, p)
