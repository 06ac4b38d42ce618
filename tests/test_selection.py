"""Exact quantiles by selection against sorting, outlier rows, and the binned density against the exact one."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.functions import selection
from shelfwise.operators import eda
from shelfwise.plans.registry import QUERIES

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]


def plain(xs, p):
    xs = sorted(xs)
    if not xs:
        return None
    at = p * (len(xs) - 1)
    lo, hi = xs[math.floor(at)], xs[math.ceil(at)]
    return lo if lo == hi else lo + (hi - lo) * (at - math.floor(at))


def columns():
    rng = random.Random(1)
    return {
        "small numbers": [float(rng.randint(1, 50)) for _ in range(500)],
        "continuous": [rng.gauss(0, 1) for _ in range(700)],
        "skewed": [math.exp(rng.gauss(0, 8)) for _ in range(400)],
        "one value": [7.5] * 30,
        "one row": [-3.0],
        "two far values": [1.0, 1e300],
        "close values": [1.0 + k * 2 ** -52 for k in range(20)] * 3,
        "tiny and negative": [-1e-320, -1e-310, 0.0, 5e-324, 1e-300, -2.0, -2.0, -7e250],
        "infinite": [float("-inf"), 1.0, 2.0, float("inf"), float("inf")],
        "a third is one value": [5.0] * 200 + [rng.random() * 10 for _ in range(400)],
    }


@pytest.mark.parametrize("name", sorted(columns()))
def test_quantiles_equal_sorting(spark, name):
    xs = columns()[name]
    df = spark.createDataFrame([(x,) for x in map(float, xs)] + [(None,), (float("nan"),)], "x double").repartition(5)
    n, got = selection.quantiles(df, "x", PROBS)
    assert n == len(xs) and str(got) == str([plain(xs, p) for p in PROBS])              # an infinite step gives nan in both


def test_groups_equal_sorting(spark):
    cols = columns()
    rows = [(name, float(x)) for name, xs in cols.items() for x in xs] + [(None, 1.0), (None, 3.0), ("no value", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(6)
    got = {r["k"]: (r["n"], [r[f"q{i}"] for i in range(len(PROBS))])
           for r in selection.grouped_quantiles(df, ["k"], "x", PROBS, [f"q{i}" for i in range(len(PROBS))]).collect()}
    cols[None] = [1.0, 3.0]
    assert {k: str(v) for k, v in got.items()} == {k: str((len(xs), [plain(xs, p) for p in PROBS])) for k, xs in cols.items()}


def test_two_group_columns_with_names_of_their_own(spark):
    rows = [(i % 3, "n" if i % 2 else None, i * 0.37) for i in range(200)]
    df = spark.createDataFrame(rows, "n int, _x string, value double").withColumnRenamed("_x", "kind")
    want = defaultdict(list)
    for a, b, x in rows:
        want[a, b].append(x)
    got = selection.grouped_quantiles(df.withColumnRenamed("n", "a"), ["a", "kind"], "value", [0.5], ["median"]).collect()
    assert {(r["a"], r["kind"]): r["median"] for r in got} == {k: plain(xs, 0.5) for k, xs in want.items()}


def test_empty_columns(spark):
    df = spark.createDataFrame([(1, None)], "k int, x double")
    assert selection.quantiles(df, "x", [0.5]) == (0, [None])
    assert selection.grouped_quantiles(df, ["k"], "x", [0.5], ["m"]).collect() == []


def test_whole_numbers_take_one_pass(spark):
    df = spark.range(5000).select((F.col("id") % 50 + 1).cast("int").alias("q"))
    spark.sparkContext.setJobGroup("selection", "")
    try:
        eda.box_stats(df, "q").collect()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("selection")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert len(jobs) < 6


def test_box_stats_and_outliers_of_groups(spark):
    rng = random.Random(3)
    rows = [(g, rng.gauss(g, 1) * (30 if rng.random() < 0.03 else 1)) for g in range(4) for _ in range(300)]
    df = spark.createDataFrame(rows, "g int, x double").repartition(5)
    out = defaultdict(list)
    for r in eda.outliers(df, "x", ["g"]).collect():
        out[r["g"]].append((r["x"], r["side"]))
    stats = {r["g"]: r for r in eda.box_stats_by(df, ["g"], "x").collect()}
    for g in range(4):
        xs = [x for k, x in rows if k == g]
        q1, q3 = plain(xs, 0.25), plain(xs, 0.75)
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        want = [(x, "low" if x < lo else "high") for x in xs if x < lo or x > hi]
        assert sorted(out[g]) == sorted(want) and want
        s = stats[g]
        assert (s["q1"], s["median"], s["q3"], s["n_outliers"]) == (q1, plain(xs, 0.5), q3, len(want))
        assert s["lower_whisker"] == min(x for x in xs if x >= lo) and s["upper_whisker"] == max(x for x in xs if x <= hi)


def test_outliers_of_a_whole_column(spark):
    df = spark.createDataFrame([(i, float(i % 10)) for i in range(100)] + [(100, 99.0), (101, -99.0), (102, None)], "i int, x double")
    assert sorted((r["i"], r["side"]) for r in eda.outliers(df, "x").collect()) == [(100, "high"), (101, "low")]


def exact(xs, grid):
    n = len(xs)
    m = sum(xs) / n
    h = math.sqrt(sum((x - m) ** 2 for x in xs) / (n - 1)) * n ** -0.2
    return h, [sum(math.exp(-0.5 * ((g - x) / h) ** 2) for x in xs) / (n * h * math.sqrt(2 * math.pi)) for g in grid]


@pytest.mark.parametrize("fine", [16, 64, 1024])
def test_binned_density_keeps_its_error_bound(spark, fine):
    rng = random.Random(fine)
    xs = [rng.gauss(0, 1) for _ in range(300)] + [rng.gauss(6, 0.3) for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double").repartition(4)
    got = eda.kde_binned(df, "x", 50, fine=fine).orderBy("grid_index").collect()
    lo, hi = min(xs), max(xs)
    h, want = exact(xs, [lo + i * (hi - lo) / 49 for i in range(50)])
    bound = eda.binning_error(h, (hi - lo) / fine) + 1e-11
    assert max(abs(r["density"] - w) for r, w in zip(got, want)) <= bound
    assert bound < 0.4 / h / fine ** 0.5


def test_binned_density_of_one_value(spark):
    rows = eda.kde_binned(spark.createDataFrame([(2.0,)] * 3, "x double"), "x", 5).collect()
    assert all(r["density"] is None for r in rows)


def test_binned_and_exact_density_agree_on_the_catalog(spark):
    from shelfwise.plans.catalog import load
    products = load(spark, SF_SMALL).products
    a = eda.kde(products, "unit_price").orderBy("grid_index").collect()
    b = eda.kde_binned(products, "unit_price").orderBy("grid_index").collect()
    assert [r["x"] for r in a] == [r["x"] for r in b]
    n, sd, lo, hi = products.agg(F.count("unit_price"), F.stddev_samp(F.col("unit_price").cast("double")), F.min("unit_price"), F.max("unit_price")).first()
    bound = eda.binning_error(sd * n ** -0.2, float(hi - lo) / eda.FINE_BINS) + 1e-11
    assert max(abs(x["density"] - y["density"]) for x, y in zip(a, b)) <= bound < 1e-6


def test_selected_medians_are_those_of_c04(spark):
    medians = {r["category"]: r["median"] for r in QUERIES["c04_selected"](spark, SF_SMALL).collect()}
    imputed = {(r["category"], r["lead_time_days"]) for r in QUERIES["c04"](spark, SF_SMALL).collect()}
    assert all((c, m) in imputed or m == int(m) for c, m in medians.items()) and medians
