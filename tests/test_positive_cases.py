"""Literal frames in which the checks and rare-row queries have something to find, and NULLs to leave alone."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import cleaning, eda, forecast, metrics, quality, sales, stock

D = dt.date(2024, 1, 1)
SALES = "sale_id string, sale_date date, product_id int, warehouse_id string, quantity_sold int, selling_price_per_unit decimal(12,2), channel string, revenue decimal(18,2)"


def row(i, product=1, wh="W1", q=1, price="10.00", channel="Online", revenue=None, day=D):
    price = None if price is None else Decimal(price)
    return (i, day, product, wh, q, price, channel, Decimal(revenue) if revenue else (price * q if price is not None and q is not None else None))


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([(1, "a", "x", 10.0, 5.0, 1), (2, "b", "x", 10.0, 5.0, 9), (3, "c", "y", 10.0, 5.0, None)],
                                 "product_id int, product_name string, category string, unit_price double, unit_cost double, supplier_id int")


def test_q15_low_revenue(spark, products):
    s = spark.createDataFrame([row("a", 1, q=200), row("b", 2, q=3), row("c", 3, q=199, price="10.05"), row("d", 3, q=0)], SALES)
    fn = next(getattr(sales, n) for n in dir(sales) if n.startswith("q15_"))
    got = {r["product_id"]: r["total_revenue"] for r in fn(s, products).collect()}
    assert got == {2: 30.0, 3: 1999.95}


def test_q33_unusual_quantities(spark):
    s = spark.createDataFrame([row(str(i), q=2) for i in range(9)] + [row("big", q=30), row("edge", q=12), row("none", q=None)], SALES)
    fn = next(getattr(sales, n) for n in dir(sales) if n.startswith("q33_"))
    got = [(r["sale_id"], r["variance_from_average"]) for r in fn(s).collect()]
    assert got == [("big", pytest.approx(30 - 60 / 11, abs=0.01))]


def frames(spark, products):
    inv = [("I1", D, 1, "W1", 5, 0, 0), ("I1", D, 2, "W1", -1, None, 0), ("I2", D, 7, "W9", None, 0, -3), ("I3", D, 1, "W1", 5, 0, 0), ("I4", D, None, None, 1, 1, 1)]
    return {
        "suppliers": spark.createDataFrame([(1, "s", 5.5, 0.9), (1, None, None, -0.1)], "supplier_id int, supplier_name string, rating double, reliability_score double"),
        "warehouses": spark.createDataFrame([("W1", "w", None, 0, -1.0)], "warehouse_id string, warehouse_name string, location string, capacity_sqft int, operational_cost_monthly double"),
        "products": products.withColumn("lead_time_days", F.lit(-1)).withColumn("min_order_qty", F.lit(None).cast("int")),
        "sales": spark.createDataFrame([row("a"), row("a", 8), row("b", None, None), row("c", 8, "W2", q=-4, channel="Fax"), row("d", channel=None)], SALES),
        "inventory": spark.createDataFrame(inv, "inventory_id string, date date, product_id int, warehouse_id string, stock_on_hand long, stock_allocated long, stock_on_order long"),
    }


def test_k01_keys(spark, products):
    got = {(r["table_name"], r["key_columns"]): (r["duplicate_keys"], r["surplus_rows"]) for r in quality.primary_key_violations(frames(spark, products)).collect()}
    assert got == {("suppliers", "supplier_id"): (1, 1), ("warehouses", "warehouse_id"): (0, 0), ("products", "product_id"): (0, 0), ("sales", "sale_id"): (1, 1),
                   ("inventory", "date,product_id,warehouse_id"): (1, 1), ("inventory", "inventory_id"): (1, 1)}


def test_k02_not_null(spark, products):
    got = {(r["table_name"], r["column_name"]): r["violations"] for r in quality.not_null_violations(frames(spark, products)).collect()}
    assert {k: v for k, v in got.items() if v} == {("suppliers", "supplier_name"): 1, ("warehouses", "location"): 1, ("sales", "product_id"): 1, ("sales", "warehouse_id"): 1,
                                                   ("inventory", "product_id"): 1, ("inventory", "warehouse_id"): 1, ("inventory", "stock_on_hand"): 1}


def test_k03_k04_checks(spark, products):
    f = frames(spark, products)
    got = {(r["table_name"], r["rule_name"]): r["violations"] for r in quality.check_violations(f).collect()}
    assert {k: v for k, v in got.items() if v} == {
        ("suppliers", "rating_1_to_5"): 1, ("suppliers", "reliability_0_to_1"): 1, ("warehouses", "capacity_positive"): 1, ("warehouses", "cost_non_negative"): 1,
        ("products", "lead_time_non_negative"): 3, ("sales", "quantity_positive"): 1, ("sales", "channel_domain"): 1, ("inventory", "on_hand_non_negative"): 1,
        ("inventory", "on_order_non_negative"): 1}
    assert quality.channel_violations(f["sales"]).first()["violations"] == 1


def test_k05_k06_references(spark, products):
    f = frames(spark, products)
    got = {r["foreign_key"]: r["violations"] for r in quality.foreign_key_violations(f).collect()}
    assert got == {"products.supplier_id -> suppliers.supplier_id": 1, "sales.product_id -> products.product_id": 2, "sales.warehouse_id -> warehouses.warehouse_id": 1,
                   "inventory.product_id -> products.product_id": 1, "inventory.warehouse_id -> warehouses.warehouse_id": 1}
    one = f["suppliers"].dropDuplicates(["supplier_id"])
    fixed = cleaning.set_null_dangling_supplier(products, one).orderBy("product_id").collect()
    assert [r["supplier_id"] for r in fixed] == [1, None, None]


def test_k07_finds_a_wrong_row(spark):
    s = spark.createDataFrame([row("a"), row("b", revenue="10.01"), row("c", price=None), row("d", q=3)], SALES)
    assert tuple(quality.generated_revenue(s).first()) == (4, 1)


def test_k08_defaults(spark, products):
    got = {r["column_name"]: r["filled"] for r in quality.default_fills(frames(spark, products)["inventory"]).collect()}
    assert got == {"stock_allocated": 1, "stock_on_order": 0}


def test_c12_counts_copies(spark, products):
    f = frames(spark, products)
    raw = spark.createDataFrame([row("a")] * 3 + [row("b", q=-2), row("c", price="999.00"), row("n", None, None), row("n", None, None)], SALES).drop("revenue")
    rep = {(r["table_name"], r["check_name"]): r["value"] for r in quality.cleaning_report(
        f["suppliers"], f["warehouses"], f["products"], f["products"], raw, f["inventory"]).collect()}
    assert [rep["sales", k] for k in ("rows_in", "duplicates_removed", "negative_quantity", "price_outliers", "rows_out")] == [7, 3, 1, 1, 4]


def weeks(spark, n):
    start = dt.date(2023, 1, 2)
    return spark.createDataFrame([(start + dt.timedelta(days=7 * i), 3 * i + i % 3) for i in range(n)], "sale_date date, quantity_sold int")


@pytest.mark.parametrize("n", [5, 10, 30])
def test_f09_short_series(spark, n):
    rep = {r["model"]: r for r in forecast.report(weeks(spark, n)).collect()}
    best = {m: [k for k, r in rep.items() if r[f"best_{m}"]] for m in ("mae", "rmse", "mape")}
    if n == 5:                       # no training weeks at all
        assert all(r["mae"] is None for r in rep.values()) and best == {"mae": [], "rmse": [], "mape": []}
        return
    assert (rep["MA"]["mae"] is None) == (n == 10)
    for m, winners in best.items():
        errors = {k: r[m] for k, r in rep.items() if r[m] is not None}
        assert winners == [min(errors, key=lambda k: (errors[k], k))]


def test_f09_groups_of_all_lengths(spark):
    s = weeks(spark, 5).withColumn("g", F.lit("a")).unionAll(weeks(spark, 10).withColumn("g", F.lit("b"))).unionAll(weeks(spark, 30).withColumn("g", F.lit("c")))
    rep = forecast.report(s, ["g"]).collect()
    flags = {g: sum(r["best_mae"] for r in rep if r["g"] == g) for g in "abc"}
    assert flags == {"a": 0, "b": 1, "c": 1}
    assert [r["mae"] for r in rep if r["g"] == "b" and r["model"] == "MA"] == [None]


def test_params_in_one_pass_equal_separate_ones(spark):
    s = forecast.split(forecast.fill_weeks(forecast.weekly_demand(weeks(spark, 40))))
    one = forecast.series_params(s).first()
    assert one["ma"] == forecast.ma_params(s).first()["ma"]
    assert (one["slope"], one["intercept"]) == tuple(forecast.lr_params(s).first())
    assert tuple(one[c] for c in ("phi", "theta", "last_d", "last_e", "last_y")) == tuple(forecast.arima_params(s).first())


def test_all_skus_are_listed(spark, products):
    s = spark.createDataFrame([row(str(i), i, q=i % 7 + 1) for i in range(60)], SALES)
    assert sales.q31_first_last_sale(s).count() == 60 and sales.q31_first_last_sale(s, k=10).count() == 10
    ci = spark.createDataFrame([(i, f"p{i}", "WH01" if i % 2 else "WH77", i) for i in range(60)], "product_id int, product_name string, warehouse_id string, stock_on_hand long")
    got = stock.q20_stock_by_warehouse(ci).collect()
    assert len(got) == 60 and sum(r["total_stock"] for r in got) == sum(range(60)) and sum(r["wh01_stock"] for r in got) == sum(range(1, 60, 2))


def test_box_stats_of_odd_columns(spark):
    for xs in ([1, 2, 3, 4, 100], [7], [5, 5, 5, 5], [1, 2], [3, None, 9, 4, 4, 4, 8, None, 60]):
        ys = sorted(x for x in xs if x is not None)
        r = eda.box_stats(spark.createDataFrame([(x,) for x in xs], "quantity_sold int")).first()
        q = [ys[int(p * (len(ys) - 1))] + (p * (len(ys) - 1) % 1) * (ys[min(int(p * (len(ys) - 1)) + 1, len(ys) - 1)] - ys[int(p * (len(ys) - 1))]) for p in (.25, .5, .75)]
        assert [r["q1"], r["median"], r["q3"]] == pytest.approx(q)
        lo, hi = q[0] - 1.5 * (q[2] - q[0]), q[2] + 1.5 * (q[2] - q[0])
        assert r["n_outliers"] == sum(y < lo or y > hi for y in ys)


def test_p09_shares(spark, products):
    got = {(r["supplier_id"], r["category"]): (r["skus"], r["category_skus"], r["share_pct"]) for r in metrics.p09_single_source_share(products).collect()}
    assert got == {(1, "x"): (1, 2, 50.0), (9, "x"): (1, 2, 50.0), (None, "y"): (1, 1, 100.0)}
