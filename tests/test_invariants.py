"""Invariants on the smallest test data, and the adapter figures of FIXTURES.md."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import classify, sales as S
from shelfwise.plans.catalog import load


@pytest.fixture(scope="module")
def t(spark):
    return load(spark, SF_SMALL)


def test_adapter_figures(t):
    rs = t.raw_sales
    assert rs.count() == 6051
    assert rs.select("sale_id").distinct().count() == 5999
    assert rs.where("quantity_sold < 0").count() == 9
    out = (rs.join(t.raw_products.select("product_id", "unit_price"), "product_id")
           .where(F.col("selling_price_per_unit") > F.col("unit_price") * 5).count())
    assert out == 19
    rp = t.raw_products
    assert rp.count() == 200
    assert rp.where(F.col("lead_time_days").isNull()).count() == 16
    assert rp.select("category").distinct().count() == 9
    ri = t.raw_inventory
    assert ri.count() == 55000
    assert ri.select("date").distinct().count() == 55
    assert ri.where("stock_on_hand = 0").count() == 914
    assert ri.where("stock_on_hand < 0").count() == 165
    sums = t.suppliers.agg(F.sum("rating"), F.sum("reliability_score")).first()
    assert round(sums[0], 6) == 25.2 and round(sums[1], 6) == 8.61


def test_abc_xyz_split_on_uncleaned_prices(spark, t):
    from shelfwise.operators import cleaning
    # the figure's recipe: raw rows with absolute quantities, prices not repaired
    raw = cleaning.add_revenue(cleaning.fix_quantity(t.raw_sales))
    abc = {r["abc_class"]: r["count"] for r in classify.abc_classes(raw).groupBy("abc_class").count().collect()}
    assert abc == {"A": 124, "B": 46, "C": 30}
    st = classify.monthly_demand_stats(raw)
    cv = F.try_divide(F.col("std"), F.col("mean"))
    xyz = {r["x"]: r["count"] for r in st.select(classify.xyz_of(cv).alias("x")).groupBy("x").count().collect()}
    assert xyz == {"Y": 75, "Z": 125}


def test_revenue_shares_sum_to_one_and_are_monotone(t):
    rows = classify.o01_revenue_share(t.sales).orderBy(F.desc("revenue"), "product_id").collect()
    assert abs(sum(r["rev_share"] for r in rows) - 1.0) < 1e-9
    cum = [r["cum_share"] for r in rows]
    assert all(a <= b for a, b in zip(cum, cum[1:]))
    assert abs(cum[-1] - 1.0) < 1e-12


def test_basket_counts_cover_all_sales(t):
    assert S.q32_basket_bands(t.sales).agg(F.sum("order_count")).first()[0] == t.sales.count()


def test_running_total_ends_at_grand_total(t):
    last = S.q27_running_monthly_revenue(t.sales).orderBy(F.desc("sales_month")).first()
    total = t.sales.agg(F.sum("revenue")).first()[0]
    assert Decimal(str(last["running_total_revenue"])) == total


def test_cleaned_tables_satisfy_constraints(t):
    from shelfwise.operators import quality
    loaded = {"suppliers": t.suppliers, "warehouses": t.warehouses, "products": t.products, "sales": t.sales,
              "inventory": t.inventory}
    assert quality.check_violations(loaded).agg(F.sum("violations")).first()[0] == 0
    assert quality.not_null_violations(loaded).agg(F.sum("violations")).first()[0] == 0
    assert quality.foreign_key_violations(loaded).agg(F.sum("violations")).first()[0] == 0
    # the repeated sale_id of two distinct lines survives cleaning (K01's positive case)
    pk = {r["table_name"]: r["duplicate_keys"] for r in quality.primary_key_violations(loaded).collect()}
    assert pk["sales"] == 1 and pk["products"] == 0 and pk["inventory"] == 0


def test_lazy_catalog_equals_written_catalog(spark, t):
    from shelfwise.plans.catalog import load_lazy
    lazy = load_lazy(spark, SF_SMALL)
    for name in ["products", "sales", "inventory", "raw_sales"]:
        a, b = getattr(lazy, name), getattr(t, name)
        cols = sorted(b.columns)
        assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
        assert a.count() == b.count()
