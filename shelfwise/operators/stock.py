"""Inventory snapshot and supply-chain queries (Q16-Q25, Q36-Q38, Q45).

``ci`` is the current-inventory view (V03): one row per (SKU, warehouse)
at the latest snapshot.  Sales enter only pre-aggregated per SKU.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import band, money, pct, ratio, round_half_up, top_k
from shelfwise.operators.sales import latest_sale_date, per_product

# Pivoted warehouse ids, stock-status and movement labels.
WAREHOUSES = ["WH01", "WH02", "WH03", "WH04", "WH05"]
STATUS = ["1. Out of Stock", "2. Understocked", "3. Healthy", "4. Overstocked"]
MOVEMENT = ["Dead Stock (>90 Days)", "Slow Moving (30-90 Days)", "Active"]


def _costed(ci: DataFrame, products: DataFrame) -> DataFrame:
    return ci.join(products.select("product_id", "unit_cost", "unit_price"), "product_id")


def q16_inventory_valuation(ci, warehouses, products) -> DataFrame:
    g = _costed(ci, products).groupBy("warehouse_id").agg(
        F.sum("stock_on_hand").alias("total_units"),
        F.sum(F.col("stock_on_hand") * F.col("unit_cost")).alias("_cost"),
        F.sum(F.col("stock_on_hand") * F.col("unit_price")).alias("_retail"))
    return (g.join(warehouses.select("warehouse_id", "warehouse_name"), "warehouse_id")
            .select("warehouse_id", "warehouse_name", "total_units", money("_cost").alias("inventory_value_cost"),
                    money("_retail").alias("inventory_value_retail"))
            .orderBy(F.desc("inventory_value_cost")))


def q17_holding_cost(ci, warehouses, products, monthly_rate: float = 0.02) -> DataFrame:
    g = _costed(ci, products).groupBy("warehouse_id").agg(
        F.sum(F.col("stock_on_hand") * F.col("unit_cost")).alias("_v"))
    return (g.join(warehouses, "warehouse_id")
            .select("warehouse_id", "warehouse_name", money("_v").alias("current_inventory_value"),
                    money(F.col("_v") * F.lit(monthly_rate).cast("decimal(4,2)")).alias("monthly_holding_cost_est"),
                    F.col("operational_cost_monthly").alias("warehouse_fixed_cost")))


def q18_out_of_stock(ci) -> DataFrame:
    return (ci.where(F.col("stock_on_hand") == 0)
            .select("product_id", "product_name", "category", "warehouse_name", "stock_on_hand", "stock_on_order")
            .orderBy(F.desc("stock_on_order"), "product_id", "warehouse_name"))


def q19_over_allocated(ci) -> DataFrame:
    return (ci.where(F.col("stock_allocated") > F.col("stock_on_hand"))
            .select("product_id", "product_name", "warehouse_name", "stock_on_hand", "stock_allocated",
                    (F.col("stock_allocated") - F.col("stock_on_hand")).alias("short_units")))


def q20_stock_by_warehouse(ci, k: int | None = None, warehouses=WAREHOUSES) -> DataFrame:
    """Stock per SKU pivoted to fixed warehouse columns plus the total.

    ``warehouses`` names the pivoted ones; stock in any other warehouse is in
    the total only.

    Written as conditional sums so that the pivot columns and the total
    come out of one aggregate (one shuffle), exactly what a pivot with
    given values compiles to."""
    wh = F.col("warehouse_id")
    cols = [F.sum(F.when(wh == w, F.col("stock_on_hand")).otherwise(F.lit(0))).alias(f"{w.lower()}_stock")
            for w in warehouses]
    out = ci.groupBy("product_id", "product_name").agg(*cols, F.sum("stock_on_hand").alias("total_stock"))
    return top_k(out, ["product_id"], k)


def stock_status(on_hand):
    return band(on_hand, [(on_hand == 0, STATUS[0]), (on_hand < 20, STATUS[1]), (on_hand > 300, STATUS[3]),
                          (None, STATUS[2])])


def q21_stock_status(ci) -> DataFrame:
    return (ci.groupBy(stock_status(F.col("stock_on_hand")).alias("stock_status"))
            .agg(F.countDistinct("product_id").alias("unique_skus"),
                 F.sum("stock_on_hand").alias("total_units_in_status"))
            .orderBy("stock_status"))


def category_cogs(sales, products) -> DataFrame:
    return (per_product(sales).join(products.select("product_id", "category", "unit_cost"), "product_id")
            .groupBy("category").agg(F.sum(F.col("qty") * F.col("unit_cost")).alias("annual_cogs")))


def category_inventory_value(ci, products) -> DataFrame:
    return (ci.select("product_id", "stock_on_hand")
            .join(products.select("product_id", "category", "unit_cost"), "product_id")
            .groupBy("category").agg(F.sum(F.col("stock_on_hand") * F.col("unit_cost")).alias("inv_value")))


def q22_dio(ci, sales, products, days: int = 365) -> DataFrame:
    j = category_inventory_value(ci, products).join(category_cogs(sales, products), "category")
    return j.select("category", money("inv_value").alias("current_inventory_value"),
                    money("annual_cogs").alias("annual_cogs"),
                    round_half_up(ratio("inv_value", "annual_cogs") * F.lit(float(days)), 1)
                    .alias("days_inventory_outstanding"))


def q23_turnover(ci, sales, products) -> DataFrame:
    """The correlated per-category subquery becomes a LEFT join from the COGS side."""
    j = category_cogs(sales, products).join(category_inventory_value(ci, products), "category", "left")
    return j.select("category", money("annual_cogs").alias("annual_cogs"),
                    money("inv_value").alias("current_inv_value"),
                    round_half_up(ratio("annual_cogs", "inv_value"), 2).alias("inventory_turnover_ratio"))


def q24_lowest_sku_turnover(ci, sales, products, k: int = 10) -> DataFrame:
    inv = ci.groupBy("product_id").agg(F.sum("stock_on_hand").alias("total_stock"))
    sold = sales.groupBy("product_id").agg(F.sum("quantity_sold").alias("units_sold"))
    units = F.coalesce("units_sold", F.lit(0))
    out = (products.select("product_id", "product_name", "category").join(inv, "product_id")
           .join(sold, "product_id", "left")
           .select("product_id", "product_name", "category", units.alias("annual_units_sold"),
                   F.col("total_stock").alias("current_units_in_stock"),
                   round_half_up(ratio(units, "total_stock"), 2).alias("sku_turnover_ratio")))
    return top_k(out, [F.col("sku_turnover_ratio").asc_nulls_first(), "product_id"], k)


def q25_pending_ratio(ci) -> DataFrame:
    g = ci.groupBy("warehouse_name").agg(F.sum("stock_on_hand").alias("stock_on_hand"),
                                         F.sum("stock_allocated").alias("stock_allocated"),
                                         F.sum("stock_on_order").alias("stock_on_order"))
    return g.select("warehouse_name", "stock_on_hand", "stock_allocated", "stock_on_order",
                    pct("stock_allocated", "stock_on_hand").alias("allocation_percentage"),
                    pct("stock_on_order", "stock_on_hand").alias("replenishing_percentage"))


def q36_reorder_alerts(ci, sales, products, days: float = 365.0, safety_days: float = 2.0,
                       k: int = 15) -> DataFrame:
    dd = sales.groupBy("product_id").agg((F.sum("quantity_sold").cast("double") / F.lit(days)).alias("dd"))
    rop = F.col("dd") * F.col("lead_time_days") + F.col("dd") * F.lit(safety_days)
    out = (ci.join(products.select("product_id", "lead_time_days"), "product_id").join(dd, "product_id")
           .where((F.col("stock_on_hand") <= rop) & (F.col("stock_on_order") == 0))
           .select("product_id", "product_name", "warehouse_id", "stock_on_hand", "stock_on_order", "lead_time_days",
                   round_half_up("dd", 2).alias("daily_demand_units"), round_half_up(rop, 0).alias("reorder_point")))
    return top_k(out, ["stock_on_hand", "product_id", "warehouse_id"], k)


def movement_class(days):
    return band(days, [(days > 90, MOVEMENT[0]), (days > 30, MOVEMENT[1]), (None, MOVEMENT[2])])


def q37_slow_dead_stock(ci, sales, products, min_days: int = 30, k: int = 15) -> DataFrame:
    max_sys = latest_sale_date(sales)
    last = (sales.groupBy("product_id").agg(F.max("sale_date").alias("last_sold_date"))
            .withColumn("days_since_last_sale", F.datediff(max_sys, F.col("last_sold_date")))
            .where(F.col("days_since_last_sale") > min_days))
    stock = (ci.join(products.select("product_id", "unit_cost"), "product_id")
             .groupBy("product_id").agg(F.sum("stock_on_hand").alias("total_stock_on_hand"),
                                        F.sum(F.col("stock_on_hand") * F.col("unit_cost")).alias("_cap")))
    out = (last.join(products.select("product_id", "product_name", "category"), "product_id")
           .join(stock, "product_id")
           .select("product_id", "product_name", "category", "days_since_last_sale", "total_stock_on_hand",
                   money("_cap").alias("tied_up_capital"),
                   movement_class(F.col("days_since_last_sale")).alias("movement_class")))
    return top_k(out, [F.desc("tied_up_capital"), "product_id"], k)


def q38_eoq(sales, products, order_cost: float = 150.0, holding_rate: float = 0.15, k: int | None = None) -> DataFrame:
    d = sales.groupBy("product_id").agg(F.sum("quantity_sold").alias("annual_demand_units"))
    h = F.col("unit_cost").cast("double") * F.lit(holding_rate)
    eoq = F.sqrt(F.try_divide(F.lit(2.0) * F.col("annual_demand_units").cast("double") * F.lit(order_cost), h))
    out = (products.join(d, "product_id")
           .select("product_id", "product_name", "annual_demand_units",
                   F.col("unit_cost").cast("double").alias("unit_cost"),
                   money(F.col("unit_cost") * F.lit(holding_rate).cast("decimal(4,2)")).alias("unit_holding_cost_annual"),
                   round_half_up(eoq, 0).alias("economic_order_quantity"),
                   F.col("min_order_qty").alias("supplier_min_order")))
    return top_k(out, ["product_id"], k)


def q45_outages_by_supplier(ci, suppliers, products) -> DataFrame:
    j = (ci.select("product_id", "stock_on_hand")
         .join(products.select("product_id", "supplier_id", "lead_time_days"), "product_id"))
    g = j.groupBy("supplier_id").agg(F.count(F.when(F.col("stock_on_hand") == 0, 1)).alias("out_of_stock_skus"),
                                     F.avg("lead_time_days").alias("_lead"))
    return (suppliers.select("supplier_id", "supplier_name", "reliability_score").join(g, "supplier_id")
            .select("supplier_id", "supplier_name", "reliability_score", "out_of_stock_skus",
                    round_half_up("_lead", 1).alias("avg_lead_time_days"))
            .orderBy(F.desc("out_of_stock_skus"), "reliability_score"))
