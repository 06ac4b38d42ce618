"""Sales analytics: profile, revenue and window queries (Q01-Q15, Q26-Q35).

Pattern used throughout: aggregate the sales fact to the grain of the
dimension key first (partial + final hash aggregate, so a hot SKU is
collapsed map-side), then join the dimension.  Joins are left to the
planner; AQE broadcasts a side only when its measured size is small.
Scalars over the whole fact (grand totals, averages) are scalar
subqueries (``DataFrame.scalar()``), computed once, never joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import avg_money, band, money, pct, prefix_sum, round_half_up, top_k
from shelfwise.sources.files import row_counts

MONTH = "yyyy-MM"

# Labels of the day types and basket-size bands.
WEEKEND, WEEKDAY = "Weekend", "Weekday"
BASKETS = ["Single Unit (1)", "Small Basket (2-5)", "Medium Basket (6-10)", "Bulk Order (>10)"]


def month_of(col: str = "sale_date"):
    return F.date_format(F.col(col), MONTH)


def latest_sale_date(sales: DataFrame):
    """MAX(sale_date) as a scalar.  When the table carries its month
    partition column, only the latest month's partition is read for it."""
    if "sale_month" in sales.columns:
        last_month = sales.agg(F.max("sale_month")).scalar()
        return sales.where(F.col("sale_month") == last_month).agg(F.max("sale_date")).scalar()
    return sales.agg(F.max("sale_date")).scalar()


def since(sales: DataFrame, start) -> DataFrame:
    """Rows with sale_date >= ``start`` (a date column or scalar); prunes
    month partitions when the table has them."""
    out = sales.where(F.col("sale_date") >= start)
    if "sale_month" in sales.columns:
        out = out.where(F.col("sale_month") >= F.trunc(start, "month"))
    return out


def per_product(sales: DataFrame, *extra_keys) -> DataFrame:
    """Sales pre-aggregated to (product_id, *extra_keys)."""
    return (sales.groupBy("product_id", *extra_keys)
            .agg(F.sum("quantity_sold").alias("qty"), F.sum("revenue").alias("rev"),
                 F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- group 1

def q01_row_counts(suppliers, warehouses, products, sales, inventory) -> DataFrame:
    return row_counts({"suppliers": suppliers, "warehouses": warehouses, "products": products,
                       "sales": sales, "inventory": inventory})


def q02_top_unit_price(products: DataFrame, k: int = 10) -> DataFrame:
    out = products.select("product_id", "product_name", "category",
                          F.col("unit_price").cast("double").alias("unit_price"),
                          F.col("unit_cost").cast("double").alias("unit_cost"))
    return top_k(out, [F.col("unit_price").desc(), "product_id"], k)


def q03_skus_per_category(products: DataFrame) -> DataFrame:
    return (products.groupBy("category").agg(F.count("product_id").alias("total_skus"))
            .orderBy(F.desc("total_skus"), "category"))


def q04_channel_mix(sales: DataFrame) -> DataFrame:
    return (sales.groupBy("channel")
            .agg(F.count(F.lit(1)).alias("txn_count"), F.sum("quantity_sold").alias("total_qty"),
                 money(F.sum("revenue")).alias("total_revenue"))
            .orderBy(F.desc("total_revenue")))


def q05_supplier_averages(suppliers: DataFrame) -> DataFrame:
    return suppliers.agg(round_half_up(F.avg("rating"), 2).alias("avg_rating"),
                         round_half_up(F.avg("reliability_score") * 100, 2).alias("avg_reliability_pct"))


# ---------------------------------------------------------------- group 2

def q06_top_products_by_revenue(sales: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    agg = per_product(sales)
    out = (agg.join(products.select("product_id", "product_name", "category"), "product_id")
           .select("product_id", "product_name", "category",
                   F.col("qty").alias("total_qty_sold"), money("rev").alias("total_revenue")))
    return top_k(out, [F.col("total_revenue").desc(), "product_id"], k)


def q07_monthly_trend(sales: DataFrame) -> DataFrame:
    return (sales.groupBy(month_of().alias("sales_month"))
            .agg(F.count("sale_id").alias("order_count"), F.sum("quantity_sold").alias("units_sold"),
                 money(F.sum("revenue")).alias("gross_revenue"))
            .orderBy("sales_month"))


def q08_aov_by_channel(sales: DataFrame) -> DataFrame:
    g = sales.groupBy("channel").agg(F.countDistinct("sale_id").alias("total_orders"),
                                     F.sum("revenue").alias("_rev"))
    return g.select("channel", "total_orders", money("_rev").alias("total_revenue"),
                    avg_money("_rev", "total_orders").alias("average_order_value"))


def q09_category_margin(sales: DataFrame, products: DataFrame) -> DataFrame:
    agg = per_product(sales).join(products.select("product_id", "category", "unit_cost"), "product_id")
    g = agg.groupBy("category").agg(F.sum("rev").alias("_rev"),
                                    F.sum(F.col("qty") * F.col("unit_cost")).alias("_cost"))
    profit = F.col("_rev") - F.col("_cost")
    return (g.select("category", money("_rev").alias("total_revenue"), money("_cost").alias("total_cost"),
                     money(profit).alias("total_profit"),
                     pct(profit, "_rev").alias("profit_margin_percentage"))
            .orderBy(F.desc("total_profit")))


def q10_weekday_weekend(sales: DataFrame) -> DataFrame:
    day_type = F.when(F.dayofweek("sale_date").isin(1, 7), WEEKEND).otherwise(WEEKDAY)
    g = sales.groupBy(day_type.alias("day_type")).agg(
        F.count("sale_id").alias("total_orders"), F.sum("quantity_sold").alias("units_sold"),
        F.sum("revenue").alias("_rev"), F.count("revenue").alias("_n"))
    return g.select("day_type", "total_orders", "units_sold", money("_rev").alias("total_revenue"),
                    avg_money("_rev", "_n").alias("avg_txn_value"))


def q11_warehouse_contribution(sales: DataFrame, warehouses: DataFrame) -> DataFrame:
    grand = sales.agg(F.sum("revenue")).scalar()          # over all sales, before the join
    g = sales.groupBy("warehouse_id").agg(F.sum("revenue").alias("_rev"))
    return (g.join(warehouses.select("warehouse_id", "warehouse_name", "location"), "warehouse_id")
            .select("warehouse_id", "warehouse_name", "location", money("_rev").alias("total_revenue"),
                    pct("_rev", grand).alias("revenue_pct_contribution"))
            .orderBy(F.desc("total_revenue")))


def q12_warehouse_category(sales: DataFrame, warehouses: DataFrame, products: DataFrame) -> DataFrame:
    agg = per_product(sales, "warehouse_id").join(products.select("product_id", "category"), "product_id")
    g = agg.groupBy("warehouse_id", "category").agg(F.sum("qty").alias("total_units_sold"),
                                                    F.sum("rev").alias("_rev"))
    return (g.join(warehouses.select("warehouse_id", "warehouse_name"), "warehouse_id")
            .select("warehouse_id", "warehouse_name", "category", "total_units_sold",
                    money("_rev").alias("total_revenue"))
            .orderBy("warehouse_id", F.desc("total_revenue")))


def q13_markup(products: DataFrame, k: int = 15) -> DataFrame:
    out = products.select(
        "product_id", "product_name", F.col("unit_cost").cast("double").alias("unit_cost"),
        F.col("unit_price").cast("double").alias("unit_price"),
        money(F.col("unit_price") - F.col("unit_cost")).alias("markup_abs"),
        pct(F.col("unit_price") - F.col("unit_cost"), "unit_cost").alias("markup_pct"))
    return top_k(out, [F.col("markup_pct").desc_nulls_last(), "product_id"], k)


def q14_daily_avg_by_month(sales: DataFrame) -> DataFrame:
    g = sales.groupBy(month_of().alias("sales_month")).agg(
        F.countDistinct("sale_date").alias("active_days"), F.sum("revenue").alias("_rev"))
    return (g.select("sales_month", "active_days", money("_rev").alias("monthly_revenue"),
                     avg_money("_rev", "active_days").alias("daily_avg_revenue"))
            .orderBy("sales_month"))


def q15_low_revenue_skus(sales: DataFrame, products: DataFrame, threshold: float = 2000.0) -> DataFrame:
    agg = per_product(sales).select("product_id", money("rev").alias("total_revenue"))
    return (agg.where(F.col("total_revenue") < threshold)       # HAVING on the rounded alias
            .join(products.select("product_id", "product_name", "category"), "product_id")
            .select("product_id", "product_name", "category", "total_revenue")
            .orderBy("total_revenue", "product_id"))


# ---------------------------------------------------------------- group 4 (windows)

def q26_top_per_category(sales: DataFrame, products: DataFrame, k: int = 3) -> DataFrame:
    """Rank <= k inside each category.  Spark plans the rank filter as a
    WindowGroupLimit, so each task keeps only its local top-k per category
    before the shuffle."""
    pr = (per_product(sales).join(products.select("product_id", "product_name", "category"), "product_id")
          .select("category", "product_id", "product_name", money("rev").alias("total_revenue")))
    w = Window.partitionBy("category").orderBy(F.desc("total_revenue"))
    return pr.withColumn("revenue_rank", F.rank().over(w).cast("long")).where(F.col("revenue_rank") <= k)


def _monthly_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy(month_of().alias("sales_month")).agg(F.sum("revenue").alias("_rev"))


def q27_running_monthly_revenue(sales: DataFrame) -> DataFrame:
    # One row per month: a global window over months is tiny.
    w = Window.orderBy("sales_month").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return _monthly_revenue(sales).select(
        "sales_month", money("_rev").alias("monthly_revenue"),
        money(F.sum("_rev").over(w)).alias("running_total_revenue"))


def q28_rolling_7d(sales: DataFrame, k: int = 15) -> DataFrame:
    daily = sales.groupBy("sale_date").agg(F.sum("revenue").alias("_rev"))
    w = Window.orderBy("sale_date").rowsBetween(-6, 0)
    out = daily.select(F.date_format("sale_date", "yyyy-MM-dd").alias("sale_date"), money("_rev").alias("daily_revenue"),
                       avg_money(F.sum("_rev").over(w), F.count("_rev").over(w)).alias("rolling_7d_avg"))
    return top_k(out, [F.desc("sale_date")], k)


def q29_mom_growth(sales: DataFrame) -> DataFrame:
    w = Window.orderBy("sales_month")
    prev = F.lag("_rev", 1).over(w)
    return _monthly_revenue(sales).select(
        "sales_month", money("_rev").alias("current_month_revenue"), money(prev).alias("prior_month_revenue"),
        pct(F.col("_rev") - prev, prev).alias("mom_growth_pct"))


def q30_quantity_percentile(sales: DataFrame, k: int = 15) -> DataFrame:
    """PERCENT_RANK over all sales, reported for the top-k quantities.

    percent_rank = (#rows with a smaller quantity) / (n - 1).  Instead of a
    global window over every sale: count rows per distinct quantity (partial
    aggregation), take the running count over quantities (``prefix_sum``),
    and look the k reported quantities up in it with an equi-join."""
    top = top_k(sales.select("sale_id", "product_id", "quantity_sold"),
                [F.desc("quantity_sold"), "sale_id", "product_id"], k)
    n = sales.agg(F.count(F.lit(1))).scalar()
    hist = sales.groupBy("quantity_sold").agg(F.count(F.lit(1)).alias("_c"))
    below = (prefix_sum(hist, ["quantity_sold"], {"_upto": "_c"})
             .select("quantity_sold", (F.col("_upto") - F.col("_c")).alias("_below")))
    pr = F.when(n > 1, F.col("_below") / (n - 1)).otherwise(F.lit(0.0))
    return (top.join(below, "quantity_sold")
            .select("sale_id", "product_id", "quantity_sold",
                    (round_half_up(pr, 4) * 100).alias("quantity_percentile")))


def q31_first_last_sale(sales: DataFrame, k: int | None = None) -> DataFrame:
    g = sales.groupBy("product_id").agg(F.min("sale_date").alias("first_sale_date"),
                                        F.max("sale_date").alias("last_sale_date"))
    out = g.select("product_id", F.date_format("first_sale_date", "yyyy-MM-dd").alias("first_sale_date"),
                   F.date_format("last_sale_date", "yyyy-MM-dd").alias("last_sale_date"),
                   F.datediff("last_sale_date", "first_sale_date").cast("double").alias("sales_duration_days"))
    return top_k(out, ["product_id"], k)


def basket_band(q):
    return band(q, [(q == 1, BASKETS[0]), (q.between(2, 5), BASKETS[1]), (q.between(6, 10), BASKETS[2]),
                    (None, BASKETS[3])])


def q32_basket_bands(sales: DataFrame) -> DataFrame:
    g = sales.groupBy(basket_band(F.col("quantity_sold")).alias("basket_size")).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("revenue").alias("_rev"), F.count("revenue").alias("_n"))
    return (g.select("basket_size", "order_count", money("_rev").alias("total_revenue"),
                     avg_money("_rev", "_n").alias("avg_order_revenue"))
            .orderBy(F.desc("order_count")))


def q33_large_baskets(sales: DataFrame, factor: float = 2.5, k: int = 10) -> DataFrame:
    avg_q = sales.agg(F.avg("quantity_sold")).scalar()
    out = (sales.where(F.col("quantity_sold") > avg_q * factor)
           .select("sale_id", F.date_format("sale_date", "yyyy-MM-dd").alias("sale_date"), "product_id",
                   "quantity_sold", money("revenue").alias("revenue"),
                   round_half_up(F.col("quantity_sold") - avg_q, 2).alias("variance_from_average")))
    return top_k(out, [F.desc("quantity_sold"), "sale_id", "product_id", "sale_date"], k)


def q34_rolling_3m_category_units(sales: DataFrame, products: DataFrame) -> DataFrame:
    agg = (per_product(sales, month_of().alias("sales_month"))
           .join(products.select("product_id", "category"), "product_id")
           .groupBy("sales_month", "category").agg(F.sum("qty").alias("monthly_units")))
    w = Window.partitionBy("category").orderBy("sales_month").rowsBetween(-2, 0)
    return (agg.select("sales_month", "category", "monthly_units",
                       round_half_up(F.avg("monthly_units").over(w), 1).alias("rolling_3m_avg_units"))
            .orderBy("category", "sales_month"))


def q35_best_channel_per_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    agg = (per_product(sales, "channel").join(products.select("product_id", "category"), "product_id")
           .groupBy("category", "channel").agg(F.sum("qty").alias("total_qty")))
    w = Window.partitionBy("category").orderBy(F.desc("total_qty"))
    return (agg.withColumn("_r", F.rank().over(w)).where(F.col("_r") == 1)
            .select("category", "channel", "total_qty"))

