"""Behaviour notes and band edges on small literal frames."""

from decimal import Decimal

from pyspark.sql import functions as F

from shelfwise.operators import classify, recommend, stock, suppliers


def col_values(df, c):
    return [r[c] for r in df.collect()]


def test_supplier_band_gap_falls_to_high_risk(spark):
    # reliability*60 + rating*8 = 84.5 is neither >= 85 nor BETWEEN 70 AND 84
    df = spark.createDataFrame([("a", "A", 4.0, 0.875), ("b", "B", 5.0, 0.75), ("c", "C", 3.0, 0.5)],
                               "supplier_id string, supplier_name string, rating double, reliability_score double")
    got = {r["supplier_id"]: r["supplier_risk_status"] for r in suppliers.q42_supplier_scorecard(df).collect()}
    assert got == {"a": "High Risk / Under Review", "b": "Preferred Partner", "c": "High Risk / Under Review"}


def test_xyz_band_edges(spark):
    df = spark.createDataFrame([(0.2499,), (0.25,), (0.6,), (0.6001,), (None,)], "cv double")
    got = col_values(df.select(classify.xyz_of(F.col("cv")).alias("x")), "x")
    assert got == ["X", "Y", "Y", "Z", "Z"]
    wide = col_values(df.select(classify.xyz_of(F.col("cv"), classify.XYZ_BANDS_MATRIX).alias("x")), "x")
    assert wide == ["X", "X", "Y", "Y", "Z"]


def test_abc_band_edges(spark):
    df = spark.createDataFrame([(0.70,), (0.7000001,), (0.90,), (0.95,)], "s double")
    assert col_values(df.select(classify.abc_of(F.col("s")).alias("a")), "a") == ["A", "B", "B", "C"]


def test_turnover_and_cost_scores_with_null_parameters(spark):
    df = spark.createDataFrame([(0, 10, 5), (5, 10, 5), (15, 10, 5), (35, 10, 0), (50, 10, 5), (7, None, None)],
                               "s long, rop long, ss long")
    s, rop, ss = F.col("s"), F.col("rop"), F.col("ss")
    t = col_values(df.select(recommend.turnover_score(s, rop).alias("t")), "t")
    c = col_values(df.select(recommend.cost_score(s, ss).alias("c")), "c")
    assert t == [20.0, 60.0, 100.0, 70.0, 40.0, 40.0]
    assert c == [100.0, 100.0, 80.0, 100.0, 20.0, 20.0]


def test_recommendation_rules_in_order(spark):
    df = spark.createDataFrame([(0, 10, 0, 2, 50), (0, None, 0, None, None), (5, 10, 0, 2, 50), (5, 10, 30, 2, 50),
                                (9, 1, 0, 2, 50), (12, 10, 0, 5, 50)],
                               "s long, rop long, oo long, ss long, eoq long")
    r = df.select(recommend.recommendation(F.col("s"), F.col("rop"), F.col("oo"), F.col("ss"), F.col("eoq")).alias("r"))
    got = col_values(r, "r")
    assert got[0] == "CRITICAL: Out of stock! Place emergency order of size 50 units immediately."
    assert got[1] == "CRITICAL: Out of stock! Place emergency order of size 0 units immediately."
    assert got[2] == "Reorder Alert: Stock is below Reorder Point (10). Order 50 units."
    assert got[3] == "Pending Replenishment: Stock is below ROP, but order of 30 units is in transit."
    assert got[4].startswith("Overstocked: Current stock (9) is far above Safety Stock (2).")
    assert got[5] == "Optimal: Inventory levels are healthy. No action required."


def test_supplier_risk_truncates_percentage(spark):
    df = spark.createDataFrame([(0.57, 4.0), (0.9, 3.5), (0.9, 4.2), (None, None)], "rel double, rating double")
    got = col_values(df.select(recommend.supplier_risk(F.col("rel"), F.col("rating")).alias("x")), "x")
    assert got[0] == "High Risk (Supplier reliability is 56%). Evaluate alternative vendors."
    assert got[1] == "Medium Risk (Supplier rating: 3.5). Review service-level agreement."
    assert got[2] == "Low Risk" and got[3] == "Low Risk"


def test_health_label_on_rounded_score(spark):
    df = spark.createDataFrame([(84.95,), (85.0,), (69.99,), (50.0,), (49.9,)], "h double")
    from shelfwise.functions import half_even
    got = col_values(df.select(recommend.health_label(half_even("h", 1)).alias("l")), "l")
    assert got == ["Excellent", "Excellent", "Good", "Needs Attention", "Critical"]


def test_stock_status_bands(spark):
    df = spark.createDataFrame([(0,), (19,), (20,), (300,), (301,)], "s long")
    got = col_values(df.select(stock.stock_status(F.col("s")).alias("b")), "b")
    assert got == ["1. Out of Stock", "2. Understocked", "3. Healthy", "3. Healthy", "4. Overstocked"]


def test_zero_stock_turnover_ratio_sorts_first(spark):
    ci = spark.createDataFrame([(1, 0), (2, 10), (3, 5)], "product_id long, stock_on_hand long")
    sales = spark.createDataFrame([(1, 3), (2, 4), (3, 10)], "product_id long, quantity_sold int")
    products = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")],
                                     "product_id long, product_name string, category string")
    got = [r["product_id"] for r in stock.q24_lowest_sku_turnover(ci, sales, products).collect()]
    assert got == [1, 2, 3]


def test_abc_range_frame_ties(spark):
    sales = spark.createDataFrame([(1, Decimal("50.00")), (2, Decimal("30.00")), (3, Decimal("30.00")), (4, Decimal("10.00"))],
                                  "product_id long, revenue decimal(18,2)")
    got = {r["product_id"]: r["cumulative_share_pct"] for r in classify.q39_abc(sales).collect()}
    assert got == {1: 41.67, 2: 91.67, 3: 91.67, 4: 100.0}


def test_by_warehouse_demand_changes_grain(spark):
    import datetime as dt
    from shelfwise.operators import replenish
    d = dt.date(2024, 1, 1)
    rows = [(1, "WH01", d, 5), (1, "WH01", d + dt.timedelta(1), 7),
            (2, "WH01", d, 4), (2, "WH02", d, 6), (2, "WH02", d + dt.timedelta(2), 2)]
    sales = spark.createDataFrame(rows, "product_id long, warehouse_id string, sale_date date, quantity_sold int") \
        .withColumn("revenue", (F.col("quantity_sold") * F.lit(Decimal("10.00"))).cast("decimal(18,2)"))
    products = spark.createDataFrame(
        [(1, "a", "x", Decimal("10.00"), Decimal("6.00"), 1, 4, 10), (2, "b", "x", Decimal("10.00"), Decimal("6.00"), 1, 9, 50)],
        "product_id long, product_name string, category string, unit_price decimal(12,2), unit_cost decimal(12,2), "
        "supplier_id long, lead_time_days int, min_order_qty int")
    pooled = {r["product_id"]: r for r in replenish.optimization_table(sales, products).collect()}
    per_wh = {(r["product_id"], r["warehouse_id"]): r
              for r in replenish.optimization_table(sales, products, by_warehouse=True).collect()}
    assert set(per_wh) == {(1, "WH01"), (2, "WH01"), (2, "WH02")}
    for c in ["daily_mean", "daily_std", "eoq", "safety_stock", "rop"]:      # one warehouse: same numbers
        assert per_wh[(1, "WH01")][c] == pooled[1][c]
    assert pooled[2]["daily_mean"] == 6.0 and per_wh[(2, "WH02")]["daily_mean"] == 4.0
    assert per_wh[(2, "WH01")]["abc_class"] == pooled[2]["abc_class"]       # classes stay per SKU


def test_drop_partial_weeks(spark):
    from shelfwise.operators import forecast
    import datetime as dt
    # Wed 2024-01-03 .. Fri 2024-01-19: first and last weeks are partial
    days = [dt.date(2024, 1, 3) + dt.timedelta(days=i) for i in range(17)]
    sales = spark.createDataFrame([(d, 1) for d in days], "sale_date date, quantity_sold int")
    full = {r["week"]: r["demand"] for r in forecast.weekly_demand(sales).collect()}
    trimmed = {r["week"]: r["demand"] for r in forecast.weekly_demand(sales, drop_partial=True).collect()}
    assert sorted(full) == [dt.date(2024, 1, 7), dt.date(2024, 1, 14), dt.date(2024, 1, 21)]
    assert trimmed == {dt.date(2024, 1, 14): 7}
