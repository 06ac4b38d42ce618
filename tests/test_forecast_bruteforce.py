"""Forecast models against direct computations on the weekly total series."""

import numpy as np
import pytest

from conftest import SF_SMALL
from shelfwise.operators import forecast as FC
from shelfwise.plans.catalog import load


@pytest.fixture(scope="module")
def series(spark):
    s = FC.split(FC.fill_weeks(FC.weekly_demand(load(spark, SF_SMALL).sales)))
    rows = s.orderBy("t").collect()
    y = np.array([r["demand"] for r in rows], dtype=float)
    return s, y


def test_weeks_are_contiguous_sundays(series):
    s, y = series
    weeks = [r["week"] for r in s.orderBy("t").collect()]
    assert all(w.weekday() == 6 for w in weeks)
    assert all((b - a).days == 7 for a, b in zip(weeks, weeks[1:]))


def test_moving_average_and_trend(series):
    s, y = series
    train = y[:-FC.TEST_WEEKS]
    assert FC.ma_params(s).first()["ma"] == pytest.approx(train[-4:].mean(), rel=1e-12)
    slope, intercept = np.polyfit(np.arange(len(train)), train, 1)
    r = FC.lr_params(s).first()
    assert r["slope"] == pytest.approx(slope, rel=1e-9)
    assert r["intercept"] == pytest.approx(intercept, rel=1e-9)


def _css_python(y, phi, theta):
    pd_ = pe = sse = 0.0
    for i in range(1, len(y)):
        d = y[i] - y[i - 1]
        e = d - phi * pd_ - theta * pe
        sse += e * e
        pd_, pe = d, e
    return sse, pd_, pe


def test_arima_grid_fit_matches_plain_loop(series):
    s, y = series
    train = y[:-FC.TEST_WEEKS]
    coarse = [(p, t) for p in FC.COARSE for t in FC.COARSE]
    best = min(coarse, key=lambda pt: (_css_python(train, *pt)[0], pt[0], pt[1]))
    fine = [(best[0] + a, best[1] + b) for a in FC.FINE for b in FC.FINE if abs(best[0] + a) < 1 and abs(best[1] + b) < 1]
    phi, theta = min(fine, key=lambda pt: (_css_python(train, *pt)[0], pt[0], pt[1]))
    r = FC.arima_params(s).first()
    assert (r["phi"], r["theta"]) == (phi, theta)
    _, last_d, last_e = _css_python(train, phi, theta)
    assert r["last_d"] == last_d and r["last_e"] == pytest.approx(last_e, rel=1e-12)
    # forecast path: y_T + cumulative phi-damped differences
    fc = FC.forecasts(load(s.sparkSession, SF_SMALL).sales).orderBy("t").collect()
    d1 = phi * last_d + theta * last_e
    exp = train[-1] + np.cumsum([d1 * phi ** k for k in range(FC.TEST_WEEKS)])
    assert np.allclose([r["forecast_arima"] for r in fc], exp, rtol=1e-9)
    assert [r["actual"] for r in fc] == list(y[-FC.TEST_WEEKS:])


def test_short_series_falls_back_to_damped_trend(spark):
    import datetime as dt
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=7 * i) for i in range(10)]      # 10 weeks: 2 train
    sales = spark.createDataFrame([(d, i + 1) for i, d in enumerate(days)], "sale_date date, quantity_sold int")
    fc = FC.forecasts(sales).orderBy("t").collect()
    assert all(r["forecast_arima"] == pytest.approx(0.95 * r["forecast_lr"]) for r in fc)
    assert all(r["forecast_ma"] is None for r in fc)
    ev = {r["model"]: r for r in FC.report(sales).collect()}
    assert set(ev) == {"MA", "LR", "ARIMA"} and ev["MA"]["mae"] is None


def test_custom_test_length(spark, series):
    _, y = series
    sales = load(spark, SF_SMALL).sales
    s12 = FC.split(FC.fill_weeks(FC.weekly_demand(sales)), 12)
    train = y[:-12]
    assert FC.ma_params(s12).first()["ma"] == pytest.approx(train[-4:].mean(), rel=1e-12)
    fc = FC.forecasts(sales, test_weeks=12).orderBy("t").collect()
    assert len(fc) == 12 and [r["actual"] for r in fc] == list(y[-12:])
    assert all(r["forecast_ma"] == pytest.approx(train[-4:].mean()) for r in fc)
