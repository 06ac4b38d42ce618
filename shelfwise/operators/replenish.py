"""Replenishment parameters per SKU (O07-O14): safety factor, daily demand
statistics, annual demand, EOQ, safety stock and reorder point.

numpy rounds half to even on the binary value, so every rounding here is
``rint``; divisions are ``try_divide`` and fall back to the documented
defaults (EOQ -> minimum order quantity, SS -> 5, ROP -> 10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import band, exact_std
from shelfwise.operators.classify import o06_classification

# Fixed values of the reference's replenishment policy.
ORDERING_COST = 150.0          # per purchase order
HOLDING_RATE = 0.15            # annual holding cost as a share of unit cost
SAFETY_FACTORS = {"A": 2.33, "B": 1.65, "C": 1.28}   # 99 / 95 / 90 % service
DAYS_PER_YEAR = 365
DEFAULT_SAFETY_STOCK = 5
DEFAULT_ROP = 10

PRODUCT_COLS = ["product_name", "category", "unit_price", "unit_cost", "supplier_id", "lead_time_days",
                "min_order_qty"]


def safety_factor(abc, factors=SAFETY_FACTORS):
    """Service-level z by ABC class (anything else -> the C factor)."""
    return band(abc, [(abc == "A", factors["A"]), (abc == "B", factors["B"]), (None, factors["C"])])


def daily_demand_stats(sales: DataFrame, by=("product_id",)) -> DataFrame:
    """Mean and sample std of daily units over days with sales."""
    daily = sales.groupBy(*by, "sale_date").agg(F.sum("quantity_sold").alias("_q"))
    return daily.groupBy(*by).agg(F.avg("_q").alias("daily_mean"), exact_std("_q").alias("daily_std"))


def daily_demand(sales: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """O09 alone: every sold SKU with its daily mean and sample std (one sale day: 0)."""
    return daily_demand_stats(sales).withColumn("daily_std", F.coalesce("daily_std", F.lit(0.0)))


def annual_demand(sales: DataFrame, products: DataFrame, holding_rate: float = HOLDING_RATE) -> DataFrame:
    """O10 alone: annual demand and holding cost of every sold SKU (no classes needed)."""
    t = attach_products(daily_demand(sales), products)
    return (t.withColumn("annual_demand", F.col("daily_mean") * F.lit(DAYS_PER_YEAR))
            .withColumn("annual_holding_cost_per_unit", F.col("unit_cost") * F.lit(holding_rate)))


def order_quantities(sales: DataFrame, products: DataFrame, ordering_cost: float = ORDERING_COST,
                     holding_rate: float = HOLDING_RATE) -> DataFrame:
    """O11 alone: EOQ of every sold SKU (no classes needed)."""
    return with_eoq(annual_demand(sales, products, holding_rate), ordering_cost)


def with_eoq(t: DataFrame, ordering_cost: float = ORDERING_COST) -> DataFrame:
    """EOQ = max(rint(sqrt(2 D S / H)), MOQ); an impossible EOQ falls back to MOQ."""
    raw = F.sqrt(F.try_divide(F.lit(2.0) * F.col("annual_demand") * F.lit(ordering_cost), F.col("annual_holding_cost_per_unit")))
    moq = F.col("min_order_qty")
    return t.withColumn("eoq", F.greatest(F.coalesce(F.rint(raw), moq), moq).cast("long"))


def attach_products(classified: DataFrame, products: DataFrame) -> DataFrame:
    """Product attributes, left join by SKU (money as double, as in the frames)."""
    p = products.select("product_id", "product_name", "category",
                        F.col("unit_price").cast("double").alias("unit_price"),
                        F.col("unit_cost").cast("double").alias("unit_cost"),
                        "supplier_id", "lead_time_days", "min_order_qty")
    return classified.join(p, "product_id", "left")


def add_replenishment(t: DataFrame, ordering_cost: float = ORDERING_COST, holding_rate: float = HOLDING_RATE,
                      factors=SAFETY_FACTORS) -> DataFrame:
    """O08, O10-O13 from per-SKU inputs: abc_class, daily_mean, daily_std,
    unit_cost, lead_time_days, min_order_qty."""
    t = t.withColumn("safety_factor_z", safety_factor(F.col("abc_class"), factors))
    # O10
    t = (t.withColumn("annual_demand", F.col("daily_mean") * F.lit(DAYS_PER_YEAR))
          .withColumn("annual_holding_cost_per_unit", F.col("unit_cost") * F.lit(holding_rate)))
    t = with_eoq(t, ordering_cost)
    # O12, O13
    ss = F.rint(F.col("safety_factor_z") * F.col("daily_std") * F.sqrt(F.col("lead_time_days")))
    t = t.withColumn("safety_stock", F.coalesce(ss, F.lit(float(DEFAULT_SAFETY_STOCK))).cast("long"))
    rop = F.rint(F.col("daily_mean") * F.col("lead_time_days") + F.col("safety_stock"))
    return t.withColumn("rop", F.coalesce(rop, F.lit(float(DEFAULT_ROP))).cast("long"))


def optimization_table(sales: DataFrame, products: DataFrame, ordering_cost: float = ORDERING_COST,
                       holding_rate: float = HOLDING_RATE, factors=SAFETY_FACTORS,
                       by_warehouse: bool = False) -> DataFrame:
    """The 23-column inventory optimization table (O01-O13 in one plan).

    As in the reference, demand statistics (hence EOQ, safety stock, ROP)
    pool all warehouses.  ``by_warehouse=True`` computes them per
    (SKU, warehouse) instead -- one row per SKU and selling warehouse, with
    ``warehouse_id`` added -- while ABC/XYZ classes stay per SKU."""
    keys = ["product_id", "warehouse_id"] if by_warehouse else ["product_id"]
    t = attach_products(o06_classification(sales), products)                      # O07
    join = "inner" if by_warehouse else "left"
    t = (t.join(daily_demand_stats(sales, keys), "product_id", join)               # O09
         .withColumn("daily_mean", F.coalesce("daily_mean", F.lit(0.0)))
         .withColumn("daily_std", F.coalesce("daily_std", F.lit(0.0))))
    t = add_replenishment(t, ordering_cost, holding_rate, factors)
    return t.select(*keys, "revenue", "abc_class", "mean", "std", "cv", "xyz_class", "abc_xyz_segment",
                    *PRODUCT_COLS, "safety_factor_z", "daily_mean", "daily_std", "annual_demand",
                    "annual_holding_cost_per_unit", "eoq", "safety_stock", "rop")


# Column groups reported by the step IDs O07-O13 (all cut from one O14 plan).
STEP_COLUMNS = {
    "o07": ["product_id", "abc_xyz_segment", *PRODUCT_COLS],
    "o08": ["product_id", "abc_class", "safety_factor_z"],
    "o09": ["product_id", "daily_mean", "daily_std"],
    "o10": ["product_id", "annual_demand", "annual_holding_cost_per_unit"],
    "o11": ["product_id", "min_order_qty", "eoq"],
    "o12": ["product_id", "safety_factor_z", "daily_std", "lead_time_days", "safety_stock"],
    "o13": ["product_id", "daily_mean", "lead_time_days", "safety_stock", "rop"],
}
