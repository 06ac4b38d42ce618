"""EDA statistics against direct numpy/pandas computations on the reference's product table."""

import math
import os

import numpy as np
import pandas as pd
import pytest

from conftest import FIXTURES
from shelfwise.operators import cleaning, eda
from shelfwise.sources.schema import products_schema


@pytest.fixture(scope="module")
def products(spark):
    raw = spark.read.schema(products_schema()).option("header", True).csv(os.path.join(FIXTURES, "golden_products_raw.csv"))
    return cleaning.clean_products(raw)


@pytest.fixture(scope="module")
def pdf(products):
    p = products.toPandas()
    for c in ["unit_price", "unit_cost"]:
        p[c] = p[c].astype(float)
    return p


def test_histogram_matches_numpy(products, pdf):
    got = [r["count"] for r in eda.histogram(products, "unit_price").orderBy("bin").collect()]
    exp, _ = np.histogram(pdf["unit_price"].to_numpy(), bins=30)
    assert got == list(exp)


def test_correlations_match_pandas(products, pdf):
    got = {(r["var1"], r["var2"]): r["corr"] for r in eda.correlation_matrix(products).collect()}
    exp = pdf[eda.CORR_COLUMNS].astype(float).corr()
    for (a, b), v in got.items():
        assert abs(v - exp.loc[a, b]) < 1e-6


def test_box_stats_match_numpy(spark, pdf):
    df = spark.createDataFrame(pd.DataFrame({"q": pdf["min_order_qty"].astype(int)}))
    r = eda.box_stats(df, "q").first()
    x = pdf["min_order_qty"].to_numpy(dtype=float)
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    assert (r["q1"], r["median"], r["q3"]) == (q1, med, q3)
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert r["n_outliers"] == int(((x < lo) | (x > hi)).sum())
    assert r["upper_whisker"] == x[x <= hi].max() and r["lower_whisker"] == x[x >= lo].min()


def test_kde_matches_direct_sum(products, pdf):
    x = pdf["unit_price"].to_numpy()
    n, s = len(x), x.std(ddof=1)
    h = s * n ** -0.2
    grid = np.linspace(x.min(), x.max(), eda.KDE_GRID)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(axis=1) / (n * h * math.sqrt(2 * math.pi))
    got = [r["density"] for r in eda.kde(products, "unit_price").orderBy("grid_index").collect()]
    assert np.allclose(got, dens, rtol=1e-7, atol=1e-12)        # output is rounded to 12 places
    area = np.trapezoid(dens, grid)
    assert 0.8 < area <= 1.0
