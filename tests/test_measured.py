"""C12 counted by the cleaning writes: the same rows as the separate report, and no further scan."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import cleaning, measured, quality
from shelfwise.plans import catalog
from shelfwise.plans.registry import QUERIES
from shelfwise.sources import testdata


def rows(df):
    return sorted((r["table_name"], r["check_name"], r["value"]) for r in df.collect())


def test_same_report_as_counting_again(spark):
    t = catalog.load(spark, SF_SMALL)
    want = rows(quality.cleaning_report(t.suppliers, t.warehouses, t.raw_products, t.products, t.raw_sales, t.raw_inventory))
    got = rows(QUERIES["c12"](spark, SF_SMALL))
    assert got == want and ("sales", "duplicates_removed", 51) in got


def test_the_report_scans_nothing(spark):
    catalog.load(spark, SF_SMALL).all()
    plan = QUERIES["c12"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


def test_measured_plans_clean_like_the_plain_ones(spark, tmp_path):
    raw = testdata.raw_tables(spark, SF_SMALL)
    products = cleaning.clean_products(raw["raw_products"], testdata.TEST_CATEGORY_MAP)
    pairs = {"products": (measured.products(raw["raw_products"], testdata.TEST_CATEGORY_MAP), products),
             "sales": (measured.sales(raw["raw_sales"], products), cleaning.clean_sales(raw["raw_sales"], products)),
             "inventory": (measured.inventory(raw["raw_inventory"]), cleaning.clean_inventory(raw["raw_inventory"]))}
    for name, (m, plain) in pairs.items():
        df, seen = measured.observe(m)
        assert df.columns == plain.columns
        df.write.parquet(str(tmp_path / name))
        got = spark.read.parquet(str(tmp_path / name))
        assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
        assert set(seen.get) == set(m.counts)


@pytest.fixture
def faulty(spark):
    sales = spark.createDataFrame(
        [("a", 1, -5, 10.0), ("a", 1, -5, 10.0), ("a", 1, -5, 10.0), ("b", 1, 5, 100.0), ("c", 2, 5, 1000.0), ("d", None, None, None), ("d", None, None, None)],
        "sale_id string, product_id long, quantity_sold int, selling_price_per_unit double").withColumn(
        "selling_price_per_unit", F.col("selling_price_per_unit").cast("decimal(12,2)"))
    return sales, spark.createDataFrame([(1, 10.0)], "product_id long, unit_price double").withColumn("unit_price", F.col("unit_price").cast("decimal(12,2)"))


def test_counts_of_faulty_rows_survive_a_shuffle_before_the_write(spark, faulty, tmp_path):
    m = measured.sales(*faulty)
    df, seen = measured.observe(m._replace(df=m.df.repartition(7, "sale_id")))
    df.write.parquet(str(tmp_path / "sales"))
    assert seen.get == {"rows_in": 7, "duplicates_removed": 3, "negative_quantity": 1, "price_outliers": 1, "rows_out": 4}
    got = {r["sale_id"]: (r["quantity_sold"], r["selling_price_per_unit"]) for r in spark.read.parquet(str(tmp_path / "sales")).collect()}
    assert {k: (q, None if p is None else float(p)) for k, (q, p) in got.items()} == {"a": (5, 10.0), "b": (5, 10.0), "c": (5, 1000.0), "d": (None, None)}


def test_empty_tables_count_zero(spark, faulty, tmp_path):
    sales, products = faulty
    df, seen = measured.observe(measured.sales(sales.limit(0), products))
    df.write.parquet(str(tmp_path / "sales"))
    assert {v for _, _, v in rows(measured.report(spark, {"sales": seen.get}))} == {0}
