"""F06 beyond the grid: conditional least squares of ARIMA(1,1,1) by damped Gauss-Newton steps.

The residuals e_t = d_t - phi d_{t-1} - theta e_{t-1} and their derivatives
follow one recursion over the weeks; numpy runs it for all series of a batch
and all starts of a series at once.  Starts are the best point of the grid
search of ``forecast`` (so the sum of squares is never above the grid's) and
the local minima of its coarse grid (so a basin that the grid ranks lower by a
little is tried too).  Steps stay within the bounds of stationarity and
invertibility, |phi| and |theta| <= ``BOUND``; a parameter at its bound whose
slope points outwards rests while the other one moves.

Series shorter than four weeks have no fit (NULLs).  A constant series says
nothing about the parameters: they are 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.forecast import COARSE, FINE, fit_partitions

BOUND = 0.999
STARTS = 6                       # local minima of the coarse grid that are followed
STEPS = 200
BATCH = 256                      # series fitted at once
FIELDS = ["phi", "theta", "last_d", "last_e", "last_y", "sse", "grid_sse"]


def residuals(d: np.ndarray, live: np.ndarray, phi: np.ndarray, theta: np.ndarray, slopes: bool = False):
    """SSE, last residual and, with ``slopes``, J'J and J'e for series ``d`` (series x weeks, ``live`` marks their weeks)
    and parameters (series x points)."""
    shape = phi.shape
    e, sse, before = np.zeros(shape), np.zeros(shape), np.zeros((len(d), 1))
    ep, et = np.zeros(shape), np.zeros(shape)
    acc = np.zeros((5, *shape))                     # pp, pt, tt, pe, te
    for k in range(d.shape[1]):
        now, on = d[:, k:k + 1], live[:, k:k + 1]
        if slopes:
            ep, et = np.where(on, -before - theta * ep, ep), np.where(on, -e - theta * et, et)
        e = np.where(on, now - phi * before - theta * e, e)
        before = np.where(on, now, before)
        sse += np.where(on, e * e, 0.0)
        if slopes:
            acc += np.where(on, np.stack([ep * ep, ep * et, et * et, ep * e, et * e]), 0.0)
    return (sse, e, acc) if slopes else (sse, e)


def _grid_best(d, live, phi, theta):
    """The first point of least SSE, by phi, then theta, as in the grid search."""
    sse, _ = residuals(d, live, phi, theta)
    best = np.lexsort((theta, phi, sse), axis=1)[:, 0]
    rows = np.arange(len(d))
    return phi[rows, best], theta[rows, best], sse[rows, best], sse


def starts(d: np.ndarray, live: np.ndarray):
    """(phi, theta, grid_sse): the grid search's point first, then local minima of the coarse grid."""
    n, m = len(d), len(COARSE)
    cp, ct = (np.broadcast_to(x.ravel(), (n, m * m)) for x in np.meshgrid(COARSE, COARSE, indexing="ij"))
    bp, bt, _, coarse = _grid_best(d, live, cp, ct)
    fp, ft = (x.ravel()[None, :] for x in np.meshgrid(FINE, FINE, indexing="ij"))
    fp, ft = bp[:, None] + fp, bt[:, None] + ft
    out = (np.abs(fp) >= 1) | (np.abs(ft) >= 1)
    fp, ft = np.where(out, bp[:, None], fp), np.where(out, bt[:, None], ft)       # outside: the coarse point again
    gp, gt, grid_sse, _ = _grid_best(d, live, fp, ft)
    cube = np.pad(coarse.reshape(n, m, m), ((0, 0), (1, 1), (1, 1)), constant_values=np.inf)
    middle = cube[:, 1:-1, 1:-1]
    low = np.ones(middle.shape, bool)
    for i in range(3):
        for j in range(3):
            low &= middle <= cube[:, i:i + m, j:j + m]
    ranked = np.where(low, middle, np.inf).reshape(n, -1)
    order = np.argsort(ranked, axis=1, kind="stable")[:, :STARTS]
    rows = np.arange(n)[:, None]
    return np.hstack([gp[:, None], cp[rows, order]]), np.hstack([gt[:, None], ct[rows, order]]), grid_sse


def refine(d: np.ndarray, live: np.ndarray, phi: np.ndarray, theta: np.ndarray):
    """Damped Gauss-Newton from all points at once; returns (phi, theta, sse) of where each has come to rest."""
    damping = np.full(phi.shape, 1e-3)
    sse, _, acc = residuals(d, live, phi, theta, True)
    moving = np.ones(phi.shape, bool)
    for _ in range(STEPS):
        pp, pt, tt, pe, te = acc
        rest_p = (np.abs(phi) >= BOUND) & (np.sign(-pe) == np.sign(phi))
        rest_t = (np.abs(theta) >= BOUND) & (np.sign(-te) == np.sign(theta))
        a, c = pp * (1 + damping) + 1e-300, tt * (1 + damping) + 1e-300
        b = np.where(rest_p | rest_t, 0.0, pt)
        det = a * c - b * b
        ok = det > 1e-290
        det = np.where(ok, det, 1.0)
        gp, gt = np.where(rest_p, 0.0, pe), np.where(rest_t, 0.0, te)
        sp, st = np.where(ok, -(c * gp - b * gt) / det, 0.0), np.where(ok, -(a * gt - b * gp) / det, 0.0)
        to_p, to_t = np.clip(phi + sp, -BOUND, BOUND), np.clip(theta + st, -BOUND, BOUND)
        far = np.abs(to_p - phi) + np.abs(to_t - theta)
        new, _, new_acc = residuals(d, live, to_p, to_t, True)
        better = moving & (new < sse)
        phi, theta, sse = np.where(better, to_p, phi), np.where(better, to_t, theta), np.where(better, new, sse)
        acc = np.where(better, new_acc, acc)
        damping = np.clip(np.where(better, damping / 5, damping * 4), 1e-12, 1e14)
        moving &= ~((far < 1e-13) | (damping >= 1e13))
        if not moving.any():
            break
    return phi, theta, sse


def fit(series: list[np.ndarray]) -> np.ndarray:
    """One row of ``FIELDS`` per series; NaN for series that are too short."""
    out = np.full((len(series), len(FIELDS)), np.nan)
    long = [i for i, y in enumerate(series) if len(y) >= 4]
    long.sort(key=lambda i: len(series[i]))                     # alike in length, so little is padded
    for at in range(0, len(long), BATCH):
        own = long[at: at + BATCH]
        weeks = max(len(series[i]) for i in own) - 1
        d, live = np.zeros((len(own), weeks)), np.zeros((len(own), weeks), bool)
        for k, i in enumerate(own):
            d[k, :len(series[i]) - 1], live[k, :len(series[i]) - 1] = np.diff(series[i]), True
        phi, theta, grid_sse = starts(d, live)
        # The grid's own point stays among the candidates, wherever the steps lead.
        p, t, sse = refine(d, live, np.clip(phi, -BOUND, BOUND), np.clip(theta, -BOUND, BOUND))
        p, t, sse = np.hstack([p, phi[:, :1]]), np.hstack([t, theta[:, :1]]), np.hstack([sse, grid_sse[:, None]])
        rows, best = np.arange(len(own)), np.argmin(sse, axis=1)
        flat = ~(np.abs(d) > 0).any(1)
        p, t = np.where(flat, 0.0, p[rows, best])[:, None], np.where(flat, 0.0, t[rows, best])[:, None]
        sse, last = residuals(d, live, p, t)
        for k, i in enumerate(own):
            y = series[i]
            out[i] = p[k, 0], t[k, 0], y[-1] - y[-2], last[k, 0], y[-1], sse[k, 0], grid_sse[k]
    return out


def refined_params(s: DataFrame, group_cols=()) -> DataFrame:
    """F06 per group: ``FIELDS`` of the training weeks of ``forecast.split``.

    A series (a number per week) is collected into one row; batches of rows
    are fitted together."""
    g = list(group_cols)
    train = s.where(~F.col("is_test"))
    if g:
        train = train.repartition(fit_partitions(s.sparkSession), *g)
    rows = train.groupBy(*g).agg(F.sort_array(F.collect_list(F.struct("t", F.col("demand").cast("double").alias("y")))).alias("_ys"))
    rows = rows.where(F.size("_ys") > 0).select(*g, F.col("_ys.y").alias("_ys"))
    schema = T.StructType([rows.schema[c] for c in g] + [T.StructField(c, T.DoubleType()) for c in FIELDS])

    def run(frames):
        for pdf in frames:
            fits = pd.DataFrame(fit([np.asarray(y, float) for y in pdf["_ys"]]), columns=FIELDS)
            yield pd.concat([pdf[g].reset_index(drop=True), fits.astype(object).where(fits.notna(), None)], axis=1)

    return rows.mapInPandas(run, schema)
