"""Supplier and warehouse scorecards (Q42-Q44)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import avg_money, band, money, ratio, round_half_up

# Supplier score weights and status labels.
SCORE_WEIGHTS = (60.0, 8.0)             # reliability, rating
SUPPLIER_STATUS = ["Preferred Partner", "Satisfactory", "High Risk / Under Review"]


def supplier_score(reliability, rating, w_rel: float = SCORE_WEIGHTS[0], w_rating: float = SCORE_WEIGHTS[1]):
    return reliability * F.lit(w_rel) + rating * F.lit(w_rating)


def q42_supplier_scorecard(suppliers: DataFrame) -> DataFrame:
    """Scores in (84, 85) fall through both bands to High Risk, as written."""
    s = supplier_score(F.col("reliability_score"), F.col("rating"))
    status = band(s, [(s >= 85, SUPPLIER_STATUS[0]), (s.between(70, 84), SUPPLIER_STATUS[1]),
                      (None, SUPPLIER_STATUS[2])])
    return (suppliers.select("supplier_id", "supplier_name", "rating", "reliability_score",
                             round_half_up(s, 1).alias("supplier_health_score"), status.alias("supplier_risk_status"))
            .orderBy(F.desc("supplier_health_score")))


def q43_warehouse_efficiency(sales: DataFrame, warehouses: DataFrame, months: int = 12) -> DataFrame:
    g = sales.groupBy("warehouse_id").agg(F.sum("revenue").alias("_rev"))
    annual = F.col("operational_cost_monthly") * F.lit(months)
    return (g.join(warehouses, "warehouse_id")
            .select("warehouse_id", "warehouse_name", annual.alias("annual_fixed_cost"),
                    money("_rev").alias("annual_sales_revenue"),
                    round_half_up(ratio("_rev", annual), 2).alias("efficiency_ratio"))
            .orderBy(F.desc("efficiency_ratio")))


def q44_supplier_category_skus(products: DataFrame, suppliers: DataFrame) -> DataFrame:
    g = (products.join(suppliers.select("supplier_id", "supplier_name"), "supplier_id")
         .groupBy("supplier_name", "category")
         .agg(F.count("product_id").alias("total_skus_supplied"), F.sum("unit_cost").alias("_c"),
              F.count("unit_cost").alias("_n")))
    return (g.select("supplier_name", "category", "total_skus_supplied", avg_money("_c", "_n").alias("average_cost"))
            .orderBy(F.desc("total_skus_supplied")))
