"""The named business views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import pct, round_half_up


def product_profitability(products: DataFrame) -> DataFrame:
    """Unit margin and margin % of price (NULL when the price is 0)."""
    margin = F.col("unit_price") - F.col("unit_cost")
    return products.select(
        "product_id", "product_name", "category",
        F.col("unit_cost").cast("double").alias("unit_cost"),
        F.col("unit_price").cast("double").alias("unit_price"),
        margin.cast("double").alias("unit_margin"),
        pct(margin, "unit_price").alias("margin_percentage"))


def supplier_performance(suppliers: DataFrame, products: DataFrame) -> DataFrame:
    """Suppliers LEFT JOIN their products, pre-aggregated per supplier."""
    per_sup = products.groupBy("supplier_id").agg(
        F.countDistinct("product_id").alias("_n"), F.avg("lead_time_days").alias("_lead"))
    return (suppliers.join(per_sup, "supplier_id", "left")
            .select("supplier_id", "supplier_name", "rating", "reliability_score",
                    F.coalesce("_n", F.lit(0)).alias("products_supplied"),
                    round_half_up("_lead", 1).alias("avg_lead_time_days")))


def latest_snapshot(inventory: DataFrame, date=None) -> DataFrame:
    """Rows of the global latest snapshot date.

    ``date``: that date, where the layout tells it (``files.newest_partition``);
    then no other date's files are in the plan.  Without it a scalar subquery
    over the dates finds it, and prunes partitions at run time."""
    newest = inventory.agg(F.max("date")).scalar() if date is None else F.lit(date).cast("date")
    return inventory.where(F.col("date") == newest)


def current_inventory(inventory: DataFrame, products: DataFrame, warehouses: DataFrame, date=None) -> DataFrame:
    """Latest snapshot joined to products and warehouses."""
    cur = latest_snapshot(inventory, date)
    return (cur.join(products.select("product_id", "product_name", "category"), "product_id")
            .join(warehouses.select("warehouse_id", "warehouse_name"), "warehouse_id")
            .select("date", "product_id", "product_name", "category", "warehouse_id", "warehouse_name",
                    "stock_on_hand", "stock_allocated", "stock_on_order",
                    (F.col("stock_on_hand") - F.col("stock_allocated")).alias("net_available_stock")))


def iso_dates(df: DataFrame, *cols: str) -> DataFrame:
    """Render date columns as ISO text (the reference stores dates as text)."""
    for c in cols:
        df = df.withColumn(c, F.date_format(c, "yyyy-MM-dd"))
    return df

