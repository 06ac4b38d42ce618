"""Helpers: prefix sums against plain windows, rounding rules, bands."""

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.functions import avg_money, band, half_even, prefix_sum, round_half_up, top_k


@pytest.mark.parametrize("frame", ["range", "rows"])
def test_prefix_sum_equals_global_window(spark, frame):
    rng = np.random.default_rng(7)
    vals = rng.integers(0, 50, 3000)            # many ties
    df = spark.createDataFrame([(int(i), int(v)) for i, v in enumerate(vals)], "id long, v long")
    order = ["-v"] + (["id"] if frame == "rows" else [])
    got = prefix_sum(df, order, {"cum": "v"}, frame=frame, num_partitions=6)
    w = Window.orderBy(*([F.col("v").desc()] + ([F.col("id")] if frame == "rows" else [])))
    w = (w.rangeBetween(Window.unboundedPreceding, 0) if frame == "range"
         else w.rowsBetween(Window.unboundedPreceding, 0))
    exp = df.withColumn("cum", F.sum("v").over(w))
    a = {r["id"]: r["cum"] for r in got.collect()}
    b = {r["id"]: r["cum"] for r in exp.collect()}
    assert a == b


def test_prefix_sum_ties_share_value(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 3)], "id long, v long")
    got = {r["id"]: r["c"] for r in prefix_sum(df, ["-v"], {"c": "v"}).collect()}
    assert got == {1: 10, 2: 10, 3: 13}


def test_half_even_is_numpy_round(spark):
    xs = [0.5, 1.5, 2.5, -0.5, 2.675, 0.125, 84.95, 69.95, 12.345]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(half_even("x", 1)).collect()]
    assert got == [float(np.round(x, 1)) for x in xs]
    got0 = [r[0] for r in df.select(half_even("x", 0)).collect()]
    assert got0 == [float(np.round(x)) for x in xs]


def test_round_half_up_is_decimal_half_up(spark):
    df = spark.createDataFrame([(5.005,), (2.675,), (-1.005,), (1.0049,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got == [5.01, 2.68, -1.01, 1.0]


def test_avg_money_exact(spark):
    df = spark.createDataFrame([(Decimal("10.01"), 2), (Decimal("0.05"), 10), (Decimal("100.00"), 3), (Decimal("1.00"), 0)],
                               "t decimal(18,2), n long")
    got = [r[0] for r in df.select(avg_money("t", "n")).collect()]
    assert got == [5.01, 0.01, 33.33, None]


def test_band_null_falls_through(spark):
    df = spark.createDataFrame([(None,), (1.0,), (5.0,)], "x double")
    x = F.col("x")
    got = [r[0] for r in df.select(band(x, [(x < 2, "low"), (x < 10, "mid"), (None, "else")])).collect()]
    assert got == ["else", "low", "mid"]


def test_top_k_deterministic_ties(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "id long, v long")
    got = [r["id"] for r in top_k(df, [F.desc("v"), "id"], 4).collect()]
    assert got == [2, 5, 8, 11]


def test_batch_writes_every_stage(spark, tmp_path):
    from conftest import SF_SMALL
    from shelfwise.plans import batch
    from shelfwise.sources import testdata
    paths = batch.run(spark, testdata.raw_tables(spark, SF_SMALL), str(tmp_path / "out"), "csv",
                         testdata.TEST_CATEGORY_MAP)
    assert set(paths) == {"suppliers", "warehouses", "products", "sales", "inventory", "quality_report", "inventory_optimization",
                          "inventory_recommendations", "forecast_evaluation"}
    recs = spark.read.option("header", True).csv(paths["inventory_recommendations"])
    assert len(recs.columns) == 17 and recs.count() > 0
    ev = spark.read.option("header", True).csv(paths["forecast_evaluation"])
    assert sorted(r["model"] for r in ev.collect()) == ["ARIMA", "LR", "MA"]


def test_round_half_up_keeps_requested_places(spark):
    df = spark.createDataFrame([(0.000686912712345678,)], "x double")
    assert df.select(round_half_up("x", 12)).first()[0] == 0.000686912712
    assert df.select(round_half_up("x", 6)).first()[0] == 0.000687


def test_prefix_sum_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 3), (4, None)], "id long, v long")
    df = df.withColumn("w", F.lit(1))
    got = {r["id"]: r["c"] for r in prefix_sum(df, ["v"], {"c": "w"}).collect()}
    exp = {r["id"]: r["c"] for r in df.withColumn(
        "c", F.sum("w").over(Window.orderBy("v").rangeBetween(Window.unboundedPreceding, 0))).collect()}
    assert got == exp and len(got) == 4


def test_batch_parquet_layout(spark, tmp_path):
    import os
    from conftest import SF_SMALL
    from shelfwise.plans import batch
    from shelfwise.sources import testdata
    paths = batch.run(spark, testdata.raw_tables(spark, SF_SMALL), str(tmp_path / "pq"), "parquet",
                      testdata.TEST_CATEGORY_MAP)
    assert any(d.startswith("sale_month=") for d in os.listdir(paths["sales"]))
    assert any(d.startswith("date=") for d in os.listdir(paths["inventory"]))
    assert spark.read.parquet(paths["inventory_recommendations"]).count() == 1000


def test_exact_std_matches_numpy_and_is_order_free(spark):
    from shelfwise.functions import exact_std
    rng = np.random.default_rng(3)
    vals = [int(v) for v in rng.integers(0, 5000, 999)]
    df = spark.createDataFrame([(i % 7, v) for i, v in enumerate(vals)], "g long, x long")
    a = df.repartition(1).agg(exact_std("x")).first()[0]
    b = df.repartition(13, "g").agg(exact_std("x")).first()[0]
    assert a == b                                   # bit-identical regardless of partitioning
    assert a == pytest.approx(np.std(vals, ddof=1), rel=1e-13)
    one = spark.createDataFrame([(5,)], "x long").agg(exact_std("x")).first()[0]
    assert one is None
