"""Seasonal ARIMA (0,1,1)(0,1,1)_12 forecasts (T3) without statsmodels.

The differenced series w = (1-B)(1-B^12) y is an MA(13) process
    w_t = e_t + θ e_{t-1} + Θ e_{t-12} + θΘ e_{t-13}
whose only non-zero autocovariances are at lags 0, 1, 11, 12 and 13. Its
exact Gaussian likelihood comes from the innovations recursion, which for an
MA(13) has 13 terms a step. The recursion runs for all series of an Arrow
batch at once, one numpy operation for each term; Nelder-Mead searches
(θ, Θ) in the invertible region for all series side by side, at most 50
iterations. Where it does not converge the forecast is NULL, so the chain
falls back to the linear one. Forecasts go on with the recursion, future
innovations being zero, and are integrated back.

Runs per SKU row inside ``mapInPandas``: every row already holds the SKU's
whole zero-filled month array (bounded by the calendar span), so Spark
partitions the work and nothing is gathered on the driver. Parameters may be
given instead of fitted (``params``), which has an SQL twin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwise.operators.series import QTY_SCALE, month_end_of_index

MIN_POINTS = 24
MAX_ITER = 50
LAGS = 13
FLAT = 1e-9                # differences smaller than this share of the series are rounding noise
SERIES_AT_ONCE = 2000      # series of one recursion: bounds its memory


def _autocov(theta, ttheta) -> np.ndarray:
    """Autocovariances at lags 0..13 over the innovation variance, one row a lag."""
    theta, ttheta = np.asarray(theta, float), np.asarray(ttheta, float)
    g = np.zeros((LAGS + 1, *theta.shape))
    g[0] = (1 + theta ** 2) * (1 + ttheta ** 2)
    g[1] = theta * (1 + ttheta ** 2)
    g[11] = g[13] = theta * ttheta
    g[12] = ttheta * (1 + theta ** 2)
    return g


def innovations(theta: np.ndarray, ttheta: np.ndarray, w: np.ndarray, m: np.ndarray, ahead: int = 0):
    """For series in the columns of ``w`` (padded below ``m`` values): the
    innovations, their variances, and ``ahead`` predictions after each
    series' end. A step's coefficients solve
    ``c[l] v[n-l] = γ(l) - Σ_a c_{n-l}[a] c[l+a] v[n-l-a]`` for l = 13..1."""
    steps, many = w.shape[0] + ahead, w.shape[1]
    g = _autocov(theta, ttheta)
    coef = np.zeros((steps, LAGS + 1, many))
    var = np.zeros((steps, many))
    inn = np.zeros((steps, many))
    out = np.zeros((ahead, many))
    last = np.arange(many)
    for n in range(steps):
        scaled = np.zeros((LAGS + 1, many))
        reach = min(n, LAGS)
        for lag in range(reach, 0, -1):
            far = reach - lag
            scaled[lag] = g[lag]
            if far:
                scaled[lag] -= (coef[n - lag, 1:far + 1] * scaled[lag + 1:lag + far + 1]).sum(axis=0)
            coef[n, lag] = scaled[lag] / var[n - lag]
        var[n] = g[0] - (coef[n, 1:] * scaled[1:]).sum(axis=0)
        predicted = (coef[n, 1:reach + 1] * inn[n - reach:n][::-1]).sum(axis=0)
        if n < w.shape[0]:
            inn[n] = np.where(n < m, w[n] - predicted, 0.0)
        step = n - m
        future = (step >= 0) & (step < ahead)
        out[step[future], last[future]] = predicted[future]
    return inn, var, out


def neg_logliks(params: np.ndarray, w: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Concentrated negative log likelihood of each column of ``w`` at
    ``tanh(params)`` (rows of two)."""
    theta, ttheta = np.tanh(params).T
    with np.errstate(all="ignore"):
        inn, var, _ = innovations(theta, ttheta, w, m)
        here = np.arange(w.shape[0])[:, None] < m
        ss = np.where(here, inn ** 2 / var, 0.0).sum(axis=0)
        logdet = np.where(here, np.log(var), 0.0).sum(axis=0)
        value = 0.5 * (m * np.log(ss / m) + logdet)
    good = np.isfinite(value) & (ss > 0) & ((var > 0) | ~here).all(axis=0)
    return np.where(good, value, np.inf)


def neg_loglik(params: np.ndarray, w: np.ndarray) -> float:
    return float(neg_logliks(np.asarray(params, float)[None], np.asarray(w, float)[:, None], np.array([len(w)]))[0])


def nelder_mead(fun, starts: np.ndarray, max_iter: int = MAX_ITER, ftol: float = 1e-7):
    """Nelder-Mead for all rows of ``starts`` side by side; ``fun(x, rows)``
    gives the values at ``x`` for those rows. Converged means that the values
    agree: at the edge of the region ``x`` itself may run on. Returns (x, converged)."""
    many, n = starts.shape
    simplex = np.repeat(starts[:, None, :], n + 1, axis=1)
    for i in range(n):
        simplex[:, i + 1, i] += 0.25
    every = np.arange(many)
    values = np.stack([fun(simplex[:, i], every) for i in range(n + 1)], axis=1)
    best, done = starts.copy(), np.zeros(many, bool)
    rows = every
    for _ in range(max_iter):
        order = np.argsort(values[rows], axis=1, kind="stable")
        simplex[rows] = np.take_along_axis(simplex[rows], order[:, :, None], axis=1)
        values[rows] = np.take_along_axis(values[rows], order, axis=1)
        s, v = simplex[rows], values[rows]
        with np.errstate(invalid="ignore"):
            close = np.abs(v[:, -1] - v[:, 0]) <= ftol * (1 + np.abs(v[:, 0]))
        close &= np.isfinite(v[:, -1])
        done[rows[close]] = True
        best[rows[close]] = s[close, 0]
        rows = rows[~close]
        if not len(rows):
            break
        s, v = simplex[rows], values[rows]
        centre, worst = s[:, :-1].mean(axis=1), s[:, -1]
        mirrored = 2.0 * centre - worst
        at_mirror = fun(mirrored, rows)
        grow = at_mirror < v[:, 0]
        keep = ~grow & (at_mirror < v[:, -2])
        # one more point for all others: twice as far, or half way to the worst
        second = np.where(grow[:, None], 3.0 * centre - 2.0 * worst, 0.5 * (centre + worst))
        at_second = np.full(len(rows), np.inf)
        at_second[~keep] = fun(second[~keep], rows[~keep])
        take_second = np.where(grow, at_second < at_mirror, ~keep & (at_second < v[:, -1]))
        take_mirror = (grow & ~take_second) | keep
        for take, point, value in ((take_second, second, at_second), (take_mirror, mirrored, at_mirror)):
            simplex[rows[take], -1] = point[take]
            values[rows[take], -1] = value[take]
        shrink = rows[~(take_second | take_mirror)]
        for i in range(1, n + 1):
            if len(shrink):
                simplex[shrink, i] = 0.5 * (simplex[shrink, 0] + simplex[shrink, i])
                values[shrink, i] = fun(simplex[shrink, i], shrink)
    left = ~done
    best[left] = simplex[left, values[left].argmin(axis=1)]
    return best, done


def sarima_forecasts(series: list[np.ndarray], steps: int = 12, params: tuple[float, float] | None = None) -> list[np.ndarray | None]:
    """Integer forecasts (clip 0, half-even) of each series, or None where it is
    too short, flat after differencing, or not fitted."""
    out: list[np.ndarray | None] = [None] * len(series)
    ready = []
    for i, y in enumerate(series):
        if len(y) >= MIN_POINTS:
            w = (y[13:] - y[12:-1]) - (y[1:-12] - y[:-13])
            if np.abs(w).max() > FLAT * max(1.0, np.abs(y).max()):
                ready.append((i, w))
    for lo in range(0, len(ready), SERIES_AT_ONCE):
        part = ready[lo:lo + SERIES_AT_ONCE]
        m = np.array([len(w) for _, w in part])
        padded = np.zeros((m.max(), len(part)))
        for c, (_, w) in enumerate(part):
            padded[:len(w), c] = w
        if params is None:
            x, fitted = nelder_mead(lambda p, rows: neg_logliks(p, padded[:, rows], m[rows]), np.full((len(part), 2), -0.3))
            theta, ttheta = np.tanh(x).T
        else:
            theta, ttheta = (np.full(len(part), p) for p in params)
            fitted = np.ones(len(part), bool)
        with np.errstate(all="ignore"):
            _, _, ahead = innovations(theta, ttheta, padded, m, steps)
        for c, (i, _) in enumerate(part):
            if fitted[c]:
                path = list(series[i].astype(float))
                for w_hat in ahead[:, c]:
                    path.append(path[-1] + path[-12] - path[-13] + w_hat)
                future = np.rint(np.clip(np.array(path[-steps:]), 0, None))
                if np.all(np.isfinite(future)):
                    out[i] = future.astype(np.int64)
    return out


def sarima_forecast(y: np.ndarray, steps: int = 12, params: tuple[float, float] | None = None) -> np.ndarray | None:
    return sarima_forecasts([np.asarray(y, float)], steps, params)[0]


def _sarima_batches(steps: int, params: tuple[float, float] | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = sarima_forecasts([np.asarray(y, dtype=float) / QTY_SCALE for y in pdf["y_u"]], steps, params)
            yield pdf.assign(sarima=pd.Series([None if f is None else f.tolist() for f in found], index=pdf.index, dtype=object))
    return run


def with_sarima(arrays: DataFrame, steps: int = 12, params: tuple[float, float] | None = None) -> DataFrame:
    """Adds ``sarima`` (array<bigint> of ``steps`` forecasts, or NULL)."""
    schema = T.StructType(arrays.schema.fields + [T.StructField("sarima", T.ArrayType(T.LongType()))])
    return arrays.mapInPandas(_sarima_batches(steps, params), schema)


def forecast_sarima(arrays: DataFrame, steps: int = 12, params: tuple[float, float] | None = None) -> DataFrame:
    """Long form (sku, step, forecast_date, forecast_qty, method) for fitted SKUs."""
    df = with_sarima(arrays, steps, params).where(F.col("sarima").isNotNull())
    return df.select("sku", "last_mi", F.posexplode("sarima").alias("pos", "forecast_qty")).select(
        "sku", (F.col("pos") + 1).alias("step"),
        month_end_of_index(F.col("last_mi") + F.col("pos") + 1).alias("forecast_date"),
        "forecast_qty", F.lit("sarima").alias("method"))


def forecast_sql(theta: float, ttheta: float, steps: int = 12, skus: str = "SELECT sku FROM passed") -> dict[str, str]:
    """The same recursion as DuckDB CTEs for given parameters, from ``series``
    (sku, x, yu) of ``skus``: ``sar`` holds (sku, step, forecast_qty)."""
    g = _autocov(theta, ttheta).tolist()
    return {
        "sar_coef": f"""
SELECT * FROM (WITH RECURSIVE r(n, c, v) AS (
  SELECT 0, [list_transform(range({LAGS}), lambda i: 0.0::DOUBLE)], [{g[0]!r}::DOUBLE]
  UNION ALL
  SELECT n + 1, list_append(c, row), list_append(v, {g[0]!r}::DOUBLE - list_sum(list_transform(range(1, {LAGS} + 1), lambda l: row[l] * s[{LAGS + 1} - l])))
  FROM (SELECT n, c, v, s, list_transform(range(1, {LAGS} + 1), lambda l: CASE WHEN n + 1 >= l THEN s[{LAGS + 1} - l] / v[n + 2 - l] ELSE 0.0 END) AS row
    FROM (SELECT n, c, v, list_reduce(list_transform(range({LAGS}, 0, -1), lambda l: [l::DOUBLE]), lambda acc, l: list_append(acc,
            CASE WHEN n + 1 >= l[1] THEN ({g!r})[l[1]::INTEGER + 1]::DOUBLE - coalesce(list_sum(list_transform(
              range(1, {LAGS + 1} - l[1]::INTEGER), lambda a: coalesce(c[n + 2 - l[1]::INTEGER][a], 0.0) * acc[{LAGS + 1} - l[1]::INTEGER - a])), 0.0)
            ELSE 0.0 END), []::DOUBLE[]) AS s
          FROM r WHERE n < (SELECT max(x) FROM series) + {steps})))
  SELECT n, c[n + 1] AS c FROM r)""",
        "sar_y": f"""
SELECT sku, list(CAST(yu AS DOUBLE) / {QTY_SCALE} ORDER BY x) AS y FROM series WHERE sku IN ({skus}) GROUP BY sku HAVING count(*) >= {MIN_POINTS}""",
        "sar_w": f"""
SELECT sku, y, w FROM (SELECT sku, y, list_transform(range(14, len(y) + 1), lambda t: (y[t] - y[t - 1]) - (y[t - 12] - y[t - 13])) AS w FROM sar_y)
WHERE list_max(list_transform(w, lambda z: abs(z))) > {FLAT} * greatest(1.0, list_max(list_transform(y, lambda z: abs(z))))""",
        "sar_path": f"""
SELECT * FROM (WITH RECURSIVE p(sku, w, n, e, path) AS (
  SELECT sku, w, 0, []::DOUBLE[], y FROM sar_w
  UNION ALL
  SELECT sku, w, p.n + 1, list_append(e, CASE WHEN p.n < len(w) THEN w[p.n + 1] - f ELSE 0.0 END),
         CASE WHEN p.n < len(w) THEN path ELSE list_append(path, path[-1] + path[-12] - path[-13] + f) END
  FROM (SELECT p.*, coalesce(list_sum(list_transform(range(1, least(p.n, {LAGS}) + 1), lambda j: k.c[j] * e[p.n + 1 - j])), 0.0) AS f
        FROM p JOIN sar_coef k ON k.n = p.n WHERE p.n < len(w) + {steps}) p)
  SELECT sku, path FROM p WHERE n = len(w) + {steps})""",
        "sar": f"""
SELECT sku, step, CAST(round_even(greatest(path[len(path) - {steps} + step], 0.0), 0) AS BIGINT) AS forecast_qty
FROM sar_path, generate_series(1, {steps}) AS gs(step)""",
    }
