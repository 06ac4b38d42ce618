"""KPIs the reference describes in its report without code.

They reuse the same building blocks (current inventory, recommendations,
ABC classes, per-SKU pre-aggregates); none needs a global ordering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import avg_money, money, pct, ratio, round_half_up
from shelfwise.operators.sales import latest_sale_date, per_product, since

HOLDING_RATE = 0.15
DEAD_DAYS = 90
LOW_MARGIN_PCT = 12.0


def p01_stockout_rate(inventory: DataFrame) -> DataFrame:
    """Zero-stock snapshot rows / all snapshot rows, per warehouse."""
    g = inventory.groupBy("warehouse_id").agg(F.count(F.lit(1)).alias("snapshot_rows"),
                                              F.count_if(F.col("stock_on_hand") == 0).alias("zero_stock_rows"))
    return g.withColumn("stockout_rate_pct", pct("zero_stock_rows", "snapshot_rows"))


def p02_overstock_capital(recs: DataFrame, products: DataFrame) -> DataFrame:
    """Capital in overstocked (SKU, warehouse) rows, and each warehouse's share."""
    over = (recs.where(F.col("recommendation").startswith("Overstocked"))
            .join(products.select("product_id", "unit_cost"), "product_id")
            .groupBy("warehouse_name").agg(F.count(F.lit(1)).alias("overstocked_rows"),
                                           F.sum(F.col("stock_on_hand") * F.col("unit_cost")).alias("_cap")))
    total = over.agg(F.sum("_cap")).scalar()
    return over.select("warehouse_name", "overstocked_rows", money("_cap").alias("overstocked_capital"),
                       pct("_cap", total).alias("share_pct"))


def p03_dead_stock(ci: DataFrame, sales: DataFrame, products: DataFrame, days: int = DEAD_DAYS,
                   holding_rate: float = HOLDING_RATE) -> DataFrame:
    """SKUs in stock with no sale in the last ``days`` days (never sold
    included): count, capital and annual holding cost."""
    max_d = latest_sale_date(sales)
    recent = since(sales, F.date_add(F.date_sub(max_d, days), 1)).select("product_id").distinct()
    ever = sales.select("product_id").distinct().withColumn("_sold", F.lit(True))
    stock = (ci.join(products.select("product_id", "unit_cost"), "product_id")
             .groupBy("product_id").agg(F.sum(F.col("stock_on_hand") * F.col("unit_cost")).alias("_cap")))
    dead = stock.join(recent, "product_id", "left_anti").join(ever, "product_id", "left")
    return dead.agg(F.count(F.lit(1)).alias("dead_skus"), F.count_if(F.col("_sold").isNull()).alias("never_sold_skus"),
                    money(F.coalesce(F.sum("_cap"), F.lit(0))).alias("tied_up_capital"),
                    money(F.coalesce(F.sum("_cap"), F.lit(0)) * F.lit(holding_rate).cast("decimal(4,2)"))
                    .alias("annual_holding_cost"))


def p04_revenue_vs_space(sales: DataFrame, warehouses: DataFrame) -> DataFrame:
    rev = sales.groupBy("warehouse_id").agg(F.sum("revenue").alias("_r"))
    total_r = sales.agg(F.sum("revenue")).scalar()
    total_s = warehouses.agg(F.sum("capacity_sqft")).scalar()
    j = warehouses.join(rev, "warehouse_id", "left")
    return j.select("warehouse_id", "warehouse_name", pct(F.coalesce("_r", F.lit(0)), total_r).alias("revenue_share_pct"),
                    pct("capacity_sqft", total_s).alias("space_share_pct"),
                    round_half_up(ratio(ratio(F.coalesce("_r", F.lit(0)), total_r), ratio("capacity_sqft", total_s)), 4)
                    .alias("revenue_to_space"))


def p05_avg_stockout_days(status: DataFrame) -> DataFrame:
    """Average zero-stock days per SKU, by warehouse (status = R03 rows)."""
    return status.groupBy("warehouse_id").agg(round_half_up(F.avg("stockout_days"), 2).alias("avg_stockout_days"))


def p06_transfer_candidates(recs_full: DataFrame, overstock: int = 4) -> DataFrame:
    """Per SKU: warehouses above ``overstock`` x SS (donors) and below ROP
    (receivers); the movable quantity is min(total excess, total shortage).
    One aggregate per SKU -- no donor x receiver pairs are formed."""
    excess = F.col("stock_on_hand") - F.col("safety_stock") * overstock
    short = F.col("rop") - F.col("stock_on_hand")
    g = recs_full.groupBy("product_id").agg(
        F.count_if(excess > 0).alias("donor_warehouses"), F.count_if(short > 0).alias("receiver_warehouses"),
        F.sum(F.when(excess > 0, excess).otherwise(0)).alias("total_excess"),
        F.sum(F.when(short > 0, short).otherwise(0)).alias("total_shortage"))
    return (g.where((F.col("donor_warehouses") > 0) & (F.col("receiver_warehouses") > 0))
            .withColumn("transfer_qty", F.least("total_excess", "total_shortage")))


def p07_cost_per_sqft(sales: DataFrame, warehouses: DataFrame) -> DataFrame:
    rev = sales.groupBy("warehouse_id").agg(F.sum("revenue").alias("_r"))
    j = warehouses.join(rev, "warehouse_id", "left")
    w_cost = Window.orderBy(F.desc("cost_per_sqft"), "warehouse_id")      # one row per warehouse
    w_rev = Window.orderBy(F.desc("revenue"), "warehouse_id")
    out = j.select("warehouse_id", "warehouse_name",
                   round_half_up(ratio("operational_cost_monthly", "capacity_sqft"), 4).alias("cost_per_sqft"),
                   money(F.coalesce("_r", F.lit(0))).alias("revenue"))
    return (out.withColumn("cost_rank", F.rank().over(w_cost).cast("long"))
               .withColumn("revenue_rank", F.rank().over(w_rev).cast("long")))


def p08_lead_time_range(products: DataFrame) -> DataFrame:
    return products.groupBy("supplier_id").agg(F.min("lead_time_days").alias("min_lead_time_days"),
                                               F.max("lead_time_days").alias("max_lead_time_days"))


def p09_single_source_share(products: DataFrame) -> DataFrame:
    """Supplier's share of each category's SKUs (a second aggregate joined
    back, so no task holds all suppliers of a category)."""
    g = products.groupBy("supplier_id", "category").agg(F.count(F.lit(1)).alias("skus"))
    tot = products.groupBy(F.col("category").alias("_c")).agg(F.count(F.lit(1)).alias("category_skus"))
    return (g.join(tot, F.col("category").eqNullSafe(F.col("_c"))).drop("_c")
            .withColumn("share_pct", pct("skus", "category_skus")))


def p10_a_class_share(abc: DataFrame) -> DataFrame:
    """Share of SKUs against share of revenue per ABC class (abc = O02 rows)."""
    n = abc.agg(F.count(F.lit(1))).scalar()
    r = abc.agg(F.sum("revenue")).scalar()
    return (abc.groupBy("abc_class").agg(F.count(F.lit(1)).alias("skus"), F.sum("revenue").alias("_r"))
            .select("abc_class", "skus", pct("skus", n).alias("sku_share_pct"), pct("_r", r).alias("revenue_share_pct")))


def p11_category_markup_profit(sales: DataFrame, products: DataFrame) -> DataFrame:
    markup = ratio(F.col("unit_price") - F.col("unit_cost"), "unit_cost") * 100
    mk = products.groupBy("category").agg(round_half_up(F.avg(markup), 2).alias("avg_markup_pct"))
    pr = (per_product(sales).join(products.select("product_id", "category", "unit_cost"), "product_id")
          .groupBy("category").agg((F.sum("rev") - F.sum(F.col("qty") * F.col("unit_cost"))).alias("_p")))
    return mk.join(pr, "category", "left").select("category", "avg_markup_pct", money("_p").alias("total_profit"))


def p12_channel_share(sales: DataFrame) -> DataFrame:
    n = sales.agg(F.count(F.lit(1))).scalar()
    tot = sales.agg(F.sum("revenue")).scalar()
    g = sales.groupBy("channel").agg(F.count(F.lit(1)).alias("txn_count"), F.sum("revenue").alias("_r"))
    overall = avg_money(tot, n)
    aov = avg_money("_r", "txn_count")
    return g.select("channel", "txn_count", pct("txn_count", n).alias("txn_share_pct"), aov.alias("avg_order_value"),
                    round_half_up((ratio(aov, overall) - 1) * 100, 2).alias("aov_gap_pct"))


def p13_weekend_uplift(sales: DataFrame) -> DataFrame:
    daily = sales.groupBy("sale_date").agg(F.sum("quantity_sold").alias("_u"))
    weekend = F.dayofweek("sale_date").isin(1, 7)
    g = daily.agg(F.avg(F.when(weekend, F.col("_u"))).alias("_we"), F.avg(F.when(~weekend, F.col("_u"))).alias("_wd"))
    return g.select(round_half_up("_we", 2).alias("weekend_mean_daily_units"),
                    round_half_up("_wd", 2).alias("weekday_mean_daily_units"),
                    round_half_up((ratio("_we", "_wd") - 1) * 100, 2).alias("weekend_uplift_pct"))


def p14_low_margin_skus(products: DataFrame, threshold: float = LOW_MARGIN_PCT) -> DataFrame:
    margin = ratio(F.col("unit_price") - F.col("unit_cost"), "unit_price") * 100
    return products.groupBy("category").agg(F.count_if(margin < threshold).alias("low_margin_skus"),
                                            F.count(F.lit(1)).alias("total_skus"))
