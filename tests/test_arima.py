"""Damped Gauss-Newton against a fine brute-force search, bounds, short and constant series."""

import math

import numpy as np
import pytest

from conftest import SF_SMALL
from shelfwise.operators import arima, forecast
from shelfwise.plans.registry import QUERIES


def sse_of(y, phi, theta):
    e = before = total = 0.0
    for x in np.diff(y):
        e, before = x - phi * before - theta * e, x
        total += e * e
    return total


def brute(y):
    """Least SSE by zooming grids: every basin of a grid of 0.02 is followed down to steps of 1e-6."""
    axis = np.linspace(-arima.BOUND, arima.BOUND, 101)
    p, t = np.meshgrid(axis, axis, indexing="ij")
    d = np.diff(y)[None, :]
    live = np.ones(d.shape, bool)
    grid = arima.residuals(d, live, p.reshape(1, -1), t.reshape(1, -1))[0].reshape(p.shape)
    padded = np.pad(grid, 1, constant_values=np.inf)
    low = [(i, j) for i in range(101) for j in range(101) if grid[i, j] <= padded[i:i + 3, j:j + 3].min()]
    best = (math.inf, 0, 0)
    for i, j in low:
        at, width = (axis[i], axis[j]), 0.04
        while width > 1e-6:
            steps = np.linspace(-width, width, 41)
            for _ in range(60):                                 # follow the basin before zooming in
                a, b = np.meshgrid(np.clip(at[0] + steps, -arima.BOUND, arima.BOUND), np.clip(at[1] + steps, -arima.BOUND, arima.BOUND), indexing="ij")
                s = arima.residuals(d, live, a.reshape(1, -1), b.reshape(1, -1))[0][0]
                k = int(s.argmin())
                new = (a.ravel()[k], b.ravel()[k])
                if new == at:
                    break
                at = new
            width /= 8
        best = min(best, (sse_of(y, *at), *at))
    return best


def some_series():
    rng = np.random.default_rng(4)
    out = []
    for phi, theta in [(0.6, -0.3), (-0.4, 0.5), (0.0, 0.9), (0.9, 0.1), (0.3, 0.3), (-0.8, -0.2)]:
        for n in (12, 60, 150):
            e = rng.normal(0, 5, n)
            d = np.zeros(n)
            for k in range(1, n):
                d[k] = phi * d[k - 1] + e[k] + theta * e[k - 1]
            out.append(np.round(100 + np.cumsum(d)))
    return out


@pytest.mark.parametrize("k", range(18))
def test_agrees_with_brute_force(k):
    y = some_series()[k]
    phi, theta, last_d, last_e, last_y, sse, grid_sse = arima.fit([y])[0]
    want, p, t = brute(y)
    assert sse <= want * (1 + 1e-9) and sse <= grid_sse
    if abs(sse - want) <= 1e-9 * want:                          # the same basin
        assert abs(phi - p) < 1e-4 and abs(theta - t) < 1e-4
    assert abs(phi) <= arima.BOUND and abs(theta) <= arima.BOUND
    assert math.isclose(sse, sse_of(y, phi, theta), rel_tol=1e-9) and last_y == y[-1] and last_d == y[-1] - y[-2]


def test_grid_column_is_that_of_the_grid_search():
    for y in some_series()[:6]:
        phi, theta, *_ = forecast.arima_fit(y)
        assert math.isclose(arima.fit([y])[0][-1], sse_of(y, phi, theta), rel_tol=1e-9)


def test_slopes_are_the_derivatives():
    rng = np.random.default_rng(1)
    d = rng.normal(0, 1, (3, 20))
    live = np.ones(d.shape, bool)
    live[1, 12:] = False
    phi, theta = rng.uniform(-0.8, 0.8, (3, 4)), rng.uniform(-0.8, 0.8, (3, 4))
    _, _, (_, _, _, pe, te) = arima.residuals(d, live, phi, theta, True)
    h = 1e-6
    for at, move in ((pe, (h, 0)), (te, (0, h))):
        up, _ = arima.residuals(d, live, phi + move[0], theta + move[1])
        down, _ = arima.residuals(d, live, phi - move[0], theta - move[1])
        assert np.allclose(2 * at, (up - down) / (2 * h), rtol=1e-5, atol=1e-5)


def test_many_series_at_once_are_each_fitted_alone():
    ys = some_series() + [np.array([1.0, 2.0]), np.array([5.0] * 20), np.array([1.0, 5.0, 2.0, 8.0])]
    together = arima.fit(ys)
    for y, row in zip(ys, together):
        alone = arima.fit([y])[0]
        assert np.allclose(row, alone, rtol=1e-7, atol=1e-7, equal_nan=True)


def test_short_and_constant_series():
    assert np.isnan(arima.fit([np.array([]), np.array([1.0, 2.0, 3.0])])).all()
    assert arima.fit([np.array([5.0] * 10)])[0].tolist() == [0, 0, 0, 0, 5, 0, 0]
    line = arima.fit([np.arange(30.0)])[0]                       # constant differences: phi runs to its bound
    assert abs(line[0]) <= arima.BOUND and line[5] <= line[6]


def test_groups_and_nulls(spark):
    rows = [("a", w, 10 * (w % 3) + w) for w in range(30)] + [("b", w, 5) for w in range(12)] + [(None, w, w * w % 7) for w in range(20)] + [("short", w, w) for w in range(9)]
    df = spark.createDataFrame(rows, "k string, w int, demand long").selectExpr("k", "w AS t", "demand", "w >= 8 AND k = 'short' AS is_test")
    got = {r["k"]: r for r in arima.refined_params(df.na.fill(False, ["is_test"]), ["k"]).collect()}
    assert set(got) == {"a", "b", None, "short"}
    assert (got["b"]["phi"], got["b"]["theta"], got["b"]["sse"]) == (0, 0, 0)
    assert all(r["sse"] <= r["grid_sse"] for r in got.values())


def test_queries_never_lie_above_the_grid(spark):
    total = QUERIES["f06_refined"](spark, SF_SMALL).collect()
    rows = QUERIES["f06_refined_by_category"](spark, SF_SMALL).collect()
    assert len(total) == 1 and len(rows) > 3
    assert all(r["sse"] <= r["grid_sse"] * (1 + 1e-9) for r in [*total, *rows])
