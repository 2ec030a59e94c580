"""Forecast kernels, search and nested cases (FIXTURES.md sections 6, 9, 12, 13)."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from stockwise.operators import nested as D
from stockwise.operators import sarima as SA
from stockwise.operators import search as E
from stockwise.operators import series as T


def _arrays(spark, series: dict[str, list[float]]):
    rows = [(sku, 24000, 24000 + len(v) - 1, [int(round(x * 1000)) for x in v]) for sku, v in series.items()]
    return spark.createDataFrame(rows, "sku string, first_mi int, last_mi int, y_u array<long>")


def test_quality_gate_reasons(spark):
    rng = np.random.default_rng(1)
    seasonal = list(20 + 10 * np.sin(np.arange(36) * 2 * np.pi / 12) + rng.integers(0, 3, 36))
    series = {"S36": seasonal, "S24": list(range(1, 25)), "S23": [5.0] * 23,
              "Z30": [0.0] * 23 + [5.0] * 7, "T30": [0.0] * 21 + [1.0] * 9}
    got = {r.sku: r.reject_reason for r in T.quality_filter(_arrays(spark, series)).collect()}
    assert got == {"S36": None, "S24": None, "S23": "insufficient_data", "Z30": "poor_quality",
                   "T30": "poor_quality"}


def test_linear_forecast_matches_polyfit(spark):
    y = [3, 5, 4, 8, 9, 12, 11, 15]
    out = T.forecast_linear(_arrays(spark, {"A": y})).orderBy("step").collect()
    slope, icpt = np.polyfit(np.arange(8), y, 1)
    expect = [int(np.rint(max(0.0, icpt + slope * (8 + h)))) for h in range(12)]
    assert [r.forecast_qty for r in out] == expect


def test_last_year_forecast(spark):
    y = list(range(1, 15))
    out = T.forecast_last_year(_arrays(spark, {"A": y})).orderBy("step").collect()
    base = [v * 1.1 for v in y[-12:]]
    assert [r.forecast_qty for r in out] == [int(np.rint(b)) for b in base]


def test_sarima_likelihood_matches_dense_normal():
    rng = np.random.default_rng(7)
    w = rng.normal(size=40)
    params = np.array([0.3, -0.4])
    theta, ttheta = np.tanh(params)
    m = len(w)
    lag = np.abs(np.subtract.outer(np.arange(m), np.arange(m)))
    sigma = np.where(lag <= SA.LAGS, SA._autocov(theta, ttheta)[np.minimum(lag, SA.LAGS)], 0.0)
    # dense concentrated Gaussian likelihood
    inv = np.linalg.inv(sigma)
    ss = w @ inv @ w
    dense = 0.5 * (m * np.log(ss / m) + np.linalg.slogdet(sigma)[1])
    assert abs(SA.neg_loglik(params, w) - dense) < 1e-8


def test_sarima_forecast_shape_and_seasonality():
    t = np.arange(48)
    clean = 50 + 20 * np.sin(2 * np.pi * t / 12) + 0.5 * t
    # degenerate input: the doubly differenced series is all zeros -> no fit
    assert SA.sarima_forecast(clean, 12) is None
    # a series generated by the model itself: theta=-0.4, Theta=-0.5
    rng = np.random.default_rng(2)
    e = rng.normal(0, 3, 61)
    w = e[13:] + -0.4 * e[12:-1] + -0.5 * e[1:-12] + 0.2 * e[:-13]
    y = np.zeros(48)
    y[:13] = clean[:13]
    for i in range(13, 48):
        y[i] = y[i - 1] + y[i - 12] - y[i - 13] + w[i]
    f = SA.sarima_forecast(y, 12)
    assert f is not None and len(f) == 12 and (f >= 0).all()
    # forecasts stay near the seasonal-naive-with-drift path
    naive = y[36:48] + (y[47] - y[35])
    assert np.max(np.abs(f - naive)) < 15
    assert SA.sarima_forecast(y[:20], 12) is None


def test_batched_fits_equal_single_ones_and_reach_the_maximum():
    """Series of different lengths side by side; each fit is the best of a grid."""
    rng = np.random.default_rng(4)
    series = [np.round(np.abs(60 + 25 * np.sin(np.arange(n) * np.pi / 6) + rng.normal(0, 9, n))) for n in (24, 25, 40, 61, 30, 72)]
    series += [np.zeros(30), np.arange(20.0)]
    together = SA.sarima_forecasts(series)
    assert together[6] is None and together[7] is None
    for y, f in zip(series[:6], together):
        alone = SA.sarima_forecast(y)
        assert f is not None and (alone == f).all()
        w = (y[13:] - y[12:-1]) - (y[1:-12] - y[:-13])
        x, ok = SA.nelder_mead(lambda p, rows: SA.neg_logliks(p, np.repeat(w[:, None], len(rows), 1), np.full(len(rows), len(w))), np.full((1, 2), -0.3))
        grid = min(SA.neg_loglik(np.array([a, b]), w) for a in np.linspace(-3, 3, 25) for b in np.linspace(-3, 3, 25))
        assert ok[0] and SA.neg_loglik(x[0], w) <= grid + 0.05


def test_recorded_seasonal_forecasts():
    """A recorded series and its forecasts at given parameters, computed by a dense
    best linear predictor."""
    y = np.array([31, 28, 40, 52, 61, 70, 74, 69, 55, 47, 38, 33, 35, 30, 41, 55, 66, 72, 79, 70, 60, 49, 37, 36, 39, 33, 47, 58, 63, 77, 80, 75, 61, 52, 44, 37], float)
    theta, ttheta = -0.4, -0.55
    w = (y[13:] - y[12:-1]) - (y[1:-12] - y[:-13])
    n = len(w) + 12
    lag = np.abs(np.subtract.outer(np.arange(n), np.arange(n)))
    full = np.where(lag <= SA.LAGS, SA._autocov(theta, ttheta)[np.minimum(lag, SA.LAGS)], 0.0)
    ahead = full[len(w):, :len(w)] @ np.linalg.solve(full[:len(w), :len(w)], w)
    path = list(y)
    for x in ahead:
        path.append(path[-1] + path[-12] - path[-13] + x)
    want = np.rint(np.clip(path[-12:], 0, None)).astype(int).tolist()
    assert SA.sarima_forecast(y, 12, (theta, ttheta)).tolist() == want


def test_search_exact_and_threshold(spark):
    prod = spark.createDataFrame(
        [("SKU-1", "one", True, [1.0, 0.0]), ("SKU-2", "two", True, [0.9, 0.1]), ("SKU-3", "three", True, [0.0, 1.0]),
         ("SKU-4", "four", False, [1.0, 0.0])], "sku string, name string, is_active boolean, embedding array<float>")
    q = spark.createDataFrame([(1, " sku-1 ", None), (2, "anything", [1.0, 0.0]), (3, "   ", None)],
                              "qid long, text string, vec array<double>")
    rows = E.hybrid_search(q, prod, k=20, threshold=0.8).collect()
    by_q = {}
    for r in rows:
        by_q.setdefault(r.qid, []).append((r.sku, r.search_type))
    assert by_q[1] == [("SKU-1", "exact_sku")]                       # exact hit returns alone
    assert sorted(by_q[2]) == [("SKU-1", "semantic"), ("SKU-2", "semantic")]   # > 0.8, inactive excluded
    assert 3 not in by_q                                               # blank query -> nothing


def _vector_tables(spark, n, m):
    rng = np.random.default_rng(11)
    spots = rng.normal(size=(6, 8))
    cat = [(f"SKU-{i:05d}", bool(i % 9), None if i % 50 == 7 else [float(x) for x in spots[i % 6] + rng.normal(size=8) * 0.3]) for i in range(n)]
    cat += [(f"SKU-T{i}", True, [1.0] + [0.0] * 7) for i in range(30)] + [("SKU-0", True, [0.0] * 8)]      # ties, and no direction
    ask = [(i, [float(x) for x in spots[i % 6] + rng.normal(size=8) * 0.3]) for i in range(m)] + [(m, [2.0] + [0.0] * 7), (m + 1, None), (0, [1.0] * 8)]
    return (spark.createDataFrame(cat, "sku string, is_active boolean, embedding array<double>"),
            spark.createDataFrame(ask, "qid long, vec array<double>"), cat, ask)


def _nearest(cat, ask, k, threshold):
    live = sorted((s, np.array(v)) for s, a, v in cat if a and v is not None and any(v))
    names, mat = [s for s, _ in live], np.vstack([v / np.linalg.norm(v) for _, v in live])
    out = set()
    for q, v in ask:
        if v is not None:
            sims = mat @ (np.array(v) / np.linalg.norm(v))
            order = sorted((i for i in np.flatnonzero(sims > threshold)), key=lambda i: (-round(sims[i], 9), names[i]))[:k]
            out |= {(q, names[i], r + 1) for r, i in enumerate(order)}
    return out


def test_block_search_equals_brute_force(spark, monkeypatch):
    from stockwise.operators import vector_index as V

    prod, queries, cat, ask = _vector_tables(spark, 400, 60)
    for rows, asked in ((4096, 4096), (16, 7)):
        monkeypatch.setattr(V, "BLOCK_ROWS", rows)
        monkeypatch.setattr(V, "BLOCK_QUERIES", asked)
        for threshold in (0.8, -0.5):
            got = {(r.qid, r.sku, r["rank"]) for r in E.similar(queries, prod, 5, threshold).collect()}
            assert got == _nearest(cat, ask, 5, threshold)
    assert E.similar(queries, prod.limit(0)).collect() == [] and E.similar(queries.limit(0), prod).collect() == []
    one = {(r.qid, r.sku, r["rank"]) for r in E.similar(queries.where("qid = 3"), prod, 5, 0.8).collect()}
    assert one == {x for x in _nearest(cat, ask, 5, 0.8) if x[0] == 3}


def test_many_queries_and_approximate_recall(spark):
    prod, queries, cat, ask = _vector_tables(spark, 300, 20_000)
    got = {(r.qid, r.sku, r["rank"]) for r in E.similar(queries, prod, 3, 0.8).collect()}
    assert got == _nearest(cat, ask, 3, 0.8)
    few = {(r.qid, r.sku) for r in E.ivf_similar(queries, prod, 3, 0.8, probes=3).collect()}
    exact = {x[:2] for x in got}
    assert len(few & exact) >= 0.9 * len(exact)


def test_new_vectors_join_the_cells(spark):
    from stockwise.operators import vector_index as V

    prod, queries, cat, ask = _vector_tables(spark, 400, 30)
    live = prod.where("is_active")
    centres = V.fit_centres(V.vectors(live.where("sku < 'SKU-00200'"), "embedding", "sku"), 10)
    placed = V.place(V.vectors(live.where("sku < 'SKU-00200'"), "embedding", "sku"), centres)
    grown = placed.unionByName(V.place(V.vectors(live.where("sku >= 'SKU-00200'"), "embedding", "sku"), centres))
    got = {(r.qid, r.sku, r["rank"]) for r in V.exact_top_k(queries, grown, V.summarise(grown, centres), 5, 0.5).collect()}
    assert got == _nearest(cat, ask, 5, 0.5)


def test_sent_queries_stay_small(spark, monkeypatch):
    """Neighbouring cells share a shelf: a query that needs every cell is sent once for
    many of them, in slices, and vectors that are all alike do not add up."""
    import pyarrow as pa
    from stockwise.operators import vector_index as V

    prod, queries, cat, ask = _vector_tables(spark, 400, 60)
    monkeypatch.setattr(V, "BLOCK_ROWS", 128)
    placed, cells = V.build(prod.where("is_active"), 20)
    shelves = V.shared(cells)
    assert len(shelves.sizes) < len(cells.sizes) and shelves.sizes.sum() == cells.sizes.sum()
    assert all(shelves.sizes[s] <= 128 or (shelves.shelf == s).sum() == 1 for s in range(len(shelves.sizes)))
    routes = V._routes(V._keyed(queries, "vec"), shelves, -1.0, lambda unit, floor: np.ones((len(unit), len(shelves.sizes)), bool))
    sent = routes.groupBy("q").count().agg({"count": "max"}).first()[0]
    assert sent == shelves.blocks.sum() < len(cells.sizes)
    same = pa.table({"q": [1, 2], "qid": [1, 2], "vec": [[1.0, 0.0]] * 2, "norm": [1.0] * 2, "floor": [0.5, 1.5]})
    many = pa.table({"sku": [f"S{i:04d}" for i in range(3000, 0, -1)], "vec": [[2.0, 0.0]] * 3000, "norm": [2.0] * 3000})
    monkeypatch.setattr(V, "PAIRS", 4000)
    got = V._block_hits(3, 0.5)(same, many).to_pydict()
    assert got["sku"] == ["S0001", "S0002", "S0003"] and got["q"] == [1, 1, 1]      # the second asks for more than there is


def test_month_arrays_from_entries(spark):
    rows = [("a", dt.date(2020, 1, 5), 2.0), ("a", dt.date(2020, 4, 1), 1.5), ("a", dt.date(2020, 4, 9), 1.0), ("b", dt.date(2021, 12, 1), 0.0001), ("b", dt.date(2022, 1, 1), 3.0),
            ("b", None, 9.0), ("c", None, 9.0)]
    sales = spark.createDataFrame(rows, "items_product_sku string, issueddate date, items_quantity double")
    got = {r.sku: (r.y_u, r.n_months, r.n_zero, r.total_u) for r in T.sku_month_arrays(sales).collect()}
    assert got == {"a": ([2000, 0, 0, 2500], 4, 2, 4500), "b": ([0, 3000], 2, 1, 3000)}
    again = {r.sku: (r.n_months, r.n_zero, r.total_u) for r in T.series_stats(T.sku_month_arrays(sales).select("sku", "y_u")).collect()}
    assert again == {k: v[1:] for k, v in got.items()}


def test_message_direction_and_merge(spark):
    conv = spark.createDataFrame([(99, "user@example.com", 0, 1, 10), (99, "user@example.com", 1, 2, 20)],
                                 "cid long, email string, mtype int, mid long, t long")
    out = conv.select(D.direction("mtype")).collect()
    assert [r[0] for r in out] == ["inbound", "outbound"]


def test_router(spark):
    ev = spark.createDataFrame([
        (1, "u", "B1", None, [("a.mp3", "mp3")]), (2, "u", None, "channel_join", None),
        (3, "u", None, None, [("a.m4a", "m4a")]), (4, "u", None, None, [("a.m4a", "m4a"), ("d.pdf", "pdf")]),
        (5, "u", None, None, None)],
        "event_id long, user string, bot_id string, subtype string, files array<struct<name:string,filetype:string>>")
    assert [r.route for r in D.route_events(ev).orderBy("event_id").collect()] == [
        "dropped_bot", "dropped_subtype", "audio_only", "mixed", "text"]
