"""Health score, recommendation and supplier risk per (SKU, warehouse)
at the latest snapshot (R01-R13).

The row functions of a pandas pipeline (``apply(axis=1)``) become CASE
expressions; the texts are built with ``concat``.  A SKU without
optimization parameters (never sold) has NULL ROP / safety stock: every
comparison with NULL is false, so the CASE ladders fall through exactly
like the reference's NaN comparisons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import band, fill, half_even
from shelfwise.operators.views import latest_snapshot

# Score weights, bands, labels and message texts of the
# health score, the recommendation and the supplier risk.
WEIGHTS = (0.40, 0.30, 0.30)            # availability, turnover, cost
HEALTH_LABELS = [(85, "Excellent"), (70, "Good"), (50, "Needs Attention")]
HEALTH_ELSE = "Critical"
OVERSTOCK_FACTOR = 4                    # stock above 4 x safety stock is overstock
RISK_RELIABILITY = 0.85
RISK_RATING = 3.8
MSG_STOCKOUT = "CRITICAL: Out of stock! Place emergency order of size {eoq} units immediately."
MSG_REORDER = "Reorder Alert: Stock is below Reorder Point ({rop}). Order {eoq} units."
MSG_PENDING = "Pending Replenishment: Stock is below ROP, but order of {on_order} units is in transit."
MSG_OVERSTOCK = ("Overstocked: Current stock ({stock}) is far above Safety Stock ({ss}). "
                 "Halt procurement; run markdown campaigns.")
MSG_OPTIMAL = "Optimal: Inventory levels are healthy. No action required."
RISK_HIGH = "High Risk (Supplier reliability is {pct}%). Evaluate alternative vendors."
RISK_MEDIUM = "Medium Risk (Supplier rating: {rating}). Review service-level agreement."
RISK_LOW = "Low Risk"

OUTPUT_COLS = ["product_id", "product_name", "category", "warehouse_name", "stock_on_hand", "stock_allocated",
               "stock_on_order", "rop", "eoq", "safety_stock", "stockout_days", "stock_availability_pct",
               "health_score", "health_label", "recommendation", "supplier_name", "supplier_risk_status"]


def snapshot_days(inventory: DataFrame) -> DataFrame:
    """Number of distinct snapshot dates in the whole table."""
    return inventory.agg(F.countDistinct("date").alias("total_days"))


def stockout_days(inventory: DataFrame) -> DataFrame:
    """Zero-stock snapshot days per (SKU, warehouse)."""
    return (inventory.where(F.col("stock_on_hand") == 0)
            .groupBy("product_id", "warehouse_id").agg(F.count("date").alias("stockout_days")))


def current_status(inventory: DataFrame, warehouses: DataFrame, date=None) -> DataFrame:
    """R03 + R04: latest snapshot with stockout days (0 if none), warehouse
    name and availability % = rint1((1 - stockout_days / total_days) * 100)."""
    total = snapshot_days(inventory).scalar()
    cur = (latest_snapshot(inventory, date)
           .join(stockout_days(inventory), ["product_id", "warehouse_id"], "left")
           .join(warehouses.select("warehouse_id", "warehouse_name"), "warehouse_id", "left")
           .withColumn("stockout_days", F.coalesce("stockout_days", F.lit(0)).cast("long")))
    avail = (F.lit(1.0) - F.col("stockout_days") / total) * F.lit(100.0)
    return cur.withColumn("stock_availability_pct", half_even(avail, 1))


def turnover_score(stock, rop):
    """R06"""
    return band(stock, [(stock == 0, 20.0), (stock < rop, 60.0), (stock <= rop * 2, 100.0),
                        (stock <= rop * 4, 70.0), (None, 40.0)])


def cost_score(stock, ss):
    """Stock relative to safety stock."""
    r = F.try_divide(stock.cast("double"), ss.cast("double"))
    return band(ss, [(ss == 0, 100.0), (r <= 2.0, 100.0), (r <= 4.0, 80.0), (r <= 6.0, 50.0), (None, 20.0)])


def health_label(score):
    """Label on the rounded score."""
    return band(score, [(score >= t, lab) for t, lab in HEALTH_LABELS] + [(None, HEALTH_ELSE)])


def _s(c):
    return c.cast("long")


def recommendation(stock, rop, on_order, ss, eoq, overstock: int = OVERSTOCK_FACTOR):
    """First matching rule of five.  EOQ is coalesced to 0 for a SKU
    without parameters (the reference would fail on int(NaN) there)."""
    eoq0 = _s(F.coalesce(eoq, F.lit(0)))
    return band(stock, [
        (stock == 0, fill(MSG_STOCKOUT, eoq=eoq0)),
        ((stock < rop) & (on_order == 0), fill(MSG_REORDER, rop=_s(rop), eoq=eoq0)),
        (stock < rop, fill(MSG_PENDING, on_order=_s(on_order))),
        (stock > ss * overstock, fill(MSG_OVERSTOCK, stock=_s(stock), ss=_s(ss))),
        (None, F.lit(MSG_OPTIMAL)),
    ])


def supplier_risk(reliability, rating):
    """Reliability below 85 % is high risk (percentage truncated to int)."""
    return band(reliability, [
        (reliability < RISK_RELIABILITY, fill(RISK_HIGH, pct=(reliability * 100).cast("int"))),
        (rating < RISK_RATING, fill(RISK_MEDIUM, rating=rating)),
        (None, F.lit(RISK_LOW)),
    ])


def recommendations(inventory: DataFrame, warehouses: DataFrame, suppliers: DataFrame,
                    optimization: DataFrame, weights=WEIGHTS, full: bool = False, date=None) -> DataFrame:
    """The 17-column recommendation table (``full`` keeps the
    warehouse id and the intermediate scores as well).  An optimization
    table built ``by_warehouse`` is joined on (SKU, warehouse)."""
    keys = ["product_id", "warehouse_id"] if "warehouse_id" in optimization.columns else ["product_id"]
    opt = optimization.select(*keys, "product_name", "category", "rop", "eoq", "safety_stock", "supplier_id")
    t = current_status(inventory, warehouses, date).join(opt, keys, "left")                 # R05
    stock, rop, ss = F.col("stock_on_hand"), F.col("rop"), F.col("safety_stock")
    t = (t.withColumn("turnover_score", turnover_score(stock, rop))
          .withColumn("cost_score", cost_score(stock, ss)))
    wa, wt, wc = weights
    score = (F.lit(wa) * F.col("stock_availability_pct") + F.lit(wt) * F.col("turnover_score")
             + F.lit(wc) * F.col("cost_score"))
    t = t.withColumn("health_score", half_even(score, 1))                               # R08
    t = t.withColumn("health_label", health_label(F.col("health_score")))               # R09
    t = t.withColumn("recommendation",
                     recommendation(stock, rop, F.col("stock_on_order"), ss, F.col("eoq")))  # R10
    sup = suppliers.select("supplier_id", "supplier_name", "rating", "reliability_score")
    t = (t.join(sup, "supplier_id", "left")
          .withColumn("supplier_risk_status", supplier_risk(F.col("reliability_score"), F.col("rating"))))  # R11
    if full:
        return t
    return t.select(*OUTPUT_COLS)                                                         # R12


def label_distribution(recs: DataFrame) -> DataFrame:
    """R13"""
    return recs.groupBy("health_label").agg(F.count(F.lit(1)).alias("sku_warehouse_count"))
