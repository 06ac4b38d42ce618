"""Tables bucketed by SKU: the same results, no exchange by SKU above the scans, and where a hot SKU's rows lie."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import replenish, stock
from shelfwise.plans import catalog
from shelfwise.plans.registry import QUERIES
from shelfwise.sources import files


@pytest.fixture
def no_broadcast(spark):
    """As if the tables were too large to be sent out."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def by_sku(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Exchange hashpartitioning(product_id" in line]      # an ORDER BY still sorts


@pytest.mark.parametrize("name", ["q22", "q24", "q38", "o11"])
def test_no_exchange_by_sku(spark, no_broadcast, name):
    assert by_sku(QUERIES[f"{name}_by_sku"](spark, SF_SMALL)) == []
    assert by_sku(QUERIES[name](spark, SF_SMALL))                 # the plain tables need one


@pytest.mark.parametrize("name", ["q22", "q24", "q38", "o11"])
def test_same_rows_as_the_plain_tables(spark, no_broadcast, name):
    a, b = QUERIES[f"{name}_by_sku"](spark, SF_SMALL), QUERIES[name](spark, SF_SMALL)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.columns == b.columns


def test_a_hot_sku_is_a_row_per_warehouse_and_day(spark):
    """A third of all sales are of one SKU; its bucket of the daily table is no larger for that."""
    sales = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("long").alias("product_id"),
                                      F.concat(F.lit("W"), F.col("id") % 5).alias("warehouse_id"), F.expr("date_add(DATE'2025-01-01', cast(id % 60 AS int))").alias("sale_date"),
                                      F.lit(1).alias("quantity_sold"), F.lit(2).cast("decimal(18,2)").alias("revenue"))
    daily = files.write_bucketed(spark, catalog.daily_sales(sales), f"{files.create_database(spark, 'hot')}.daily", "product_id", 8)
    assert daily.where("product_id = 7").count() <= 5 * 60
    assert daily.agg(F.sum("n_sales")).first()[0] == 30000
    sizes = [r["n"] for r in daily.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) <= 8 and max(sizes) < 3 * sum(sizes) / len(sizes)


def test_plans_group_where_the_rows_lie(spark, no_broadcast):
    t = catalog.co_located(spark, SF_SMALL)
    assert by_sku(t["daily"].groupBy("product_id").agg(F.sum("revenue"))) == []
    assert by_sku(replenish.annual_demand(t["daily"], t["products"])) == []
    assert by_sku(stock.category_cogs(t["daily"], t["products"])) == []
