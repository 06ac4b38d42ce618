"""ABC / XYZ classification.

ABC needs a running revenue total over SKUs sorted by revenue -- a global
order.  It goes through ``prefix_sum`` (range partitioning + per-partition
offsets), never a single-task window.  XYZ is a two-level aggregate:
(SKU, month) totals, then mean / sample std per SKU.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import band, exact_std, money, prefix_sum, ratio, round_half_up, top_k
from shelfwise.operators.sales import month_of

# Class cut-offs of the reference (cumulative revenue share,
# coefficient of variation).
ABC_BANDS = (0.70, 0.90)
XYZ_BANDS = (0.25, 0.60)
XYZ_BANDS_MATRIX = (0.35, 0.70)   # the ABC-XYZ matrix query uses wider bands
XYZ_LABELS = ["X (Stable)", "Y (Variable)", "Z (Highly Erratic)"]


def abc_of(share, bands=ABC_BANDS):
    a, b = bands
    return band(share, [(share <= a, "A"), (share <= b, "B"), (None, "C")])


def xyz_of(cv, bands=XYZ_BANDS):
    """cv < x -> X, x <= cv <= y -> Y, else Z (a NULL cv is Z)."""
    x, y = bands
    return band(cv, [(cv < x, "X"), (cv.between(x, y), "Y"), (None, "Z")])


def sku_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_id").agg(F.sum("revenue").alias("revenue"))


def cumulative_revenue(sales: DataFrame, frame: str = "range") -> DataFrame:
    """Per-SKU revenue with its running total in descending revenue order.

    ``frame="range"``: SQL default frame, tied revenues share one value.
    ``frame="rows"``: row-wise running sum, ties broken by product_id.
    The grand total is a scalar subquery over all sales."""
    order = ["-revenue"] + (["product_id"] if frame == "rows" else [])
    per_sku = sku_revenue(sales)
    total = per_sku.agg(F.sum("revenue")).scalar()
    return (prefix_sum(per_sku, order, {"cum_revenue": "revenue"}, frame=frame)
            .withColumn("total_revenue", total))


def q39_abc(sales: DataFrame, k: int = 20, bands=ABC_BANDS) -> DataFrame:
    c = cumulative_revenue(sales, "range")
    cum_share = ratio("cum_revenue", "total_revenue")
    out = c.select("product_id", money("revenue").alias("sku_revenue"),
                   round_half_up(ratio("revenue", "total_revenue") * 100, 2).alias("revenue_share_pct"),
                   round_half_up(cum_share * 100, 2).alias("cumulative_share_pct"),
                   abc_of(cum_share, bands).alias("abc_class"))
    return top_k(out, [F.desc("sku_revenue"), "product_id"], k)


def monthly_demand_stats(sales: DataFrame) -> DataFrame:
    """Per SKU mean and sample std of monthly units (two-level aggregate)."""
    monthly = sales.groupBy("product_id", month_of().alias("_m")).agg(F.sum("quantity_sold").alias("_q"))
    return monthly.groupBy("product_id").agg(F.avg("_q").alias("mean"), exact_std("_q").alias("std"))


def q40_xyz(sales: DataFrame, products: DataFrame, k: int = 15, bands=XYZ_BANDS) -> DataFrame:
    st = monthly_demand_stats(sales).where(F.col("mean") > 0)
    cv = F.try_divide(F.col("std"), F.col("mean"))
    x, y = bands
    label = band(cv, [(cv < x, XYZ_LABELS[0]), (cv.between(x, y), XYZ_LABELS[1]), (None, XYZ_LABELS[2])])
    out = (st.join(products.select("product_id", "product_name", "category"), "product_id")
           .select("product_id", "product_name", "category",
                   round_half_up("mean", 1).alias("avg_monthly_demand"),
                   round_half_up("std", 1).alias("stddev_monthly_demand"),
                   round_half_up(cv, 3).alias("coefficient_of_variation"), label.alias("xyz_class")))
    return top_k(out, [F.col("coefficient_of_variation").asc_nulls_first(), "product_id"], k)


def abc_classes(sales: DataFrame, bands=ABC_BANDS, frame: str = "range") -> DataFrame:
    c = cumulative_revenue(sales, frame)
    return c.select("product_id", abc_of(ratio("cum_revenue", "total_revenue"), bands).alias("abc_class"))


def q41_abc_xyz_matrix(sales: DataFrame, ci: DataFrame, products: DataFrame,
                       abc_bands=ABC_BANDS, xyz_bands=XYZ_BANDS_MATRIX) -> DataFrame:
    st = monthly_demand_stats(sales)
    xyz = st.select("product_id", xyz_of(F.try_divide(F.col("std"), F.col("mean")), xyz_bands).alias("xyz_class"))
    stock = (ci.select("product_id", "stock_on_hand")
             .join(products.select("product_id", "unit_cost"), "product_id")
             .groupBy("product_id").agg(F.sum("stock_on_hand").alias("_units"),
                                        F.sum(F.col("stock_on_hand") * F.col("unit_cost")).alias("_value")))
    j = abc_classes(sales, abc_bands).join(xyz, "product_id").join(stock, "product_id")
    return (j.groupBy(F.concat("abc_class", "xyz_class").alias("matrix_segment"))
            .agg(F.countDistinct("product_id").alias("sku_count"), F.sum("_units").alias("total_stock_on_hand"),
                 money(F.sum("_value")).alias("total_inventory_value"))
            .orderBy(F.desc("total_inventory_value")))


# ---------------------------------------------------------------- O01-O06

def o01_revenue_share(sales: DataFrame) -> DataFrame:
    """Revenue, share and row-wise cumulative share (ties by product_id)."""
    c = cumulative_revenue(sales, "rows")
    return c.select("product_id", F.col("revenue").cast("double").alias("revenue"),
                    ratio("revenue", "total_revenue").alias("rev_share"),
                    ratio("cum_revenue", "total_revenue").alias("cum_share"))


def o02_abc(sales: DataFrame, bands=ABC_BANDS) -> DataFrame:
    r = o01_revenue_share(sales)
    return r.withColumn("abc_class", abc_of(F.col("cum_share"), bands))


def o04_xyz_stats(sales: DataFrame) -> DataFrame:
    """Monthly mean, std (NULL -> 0), cv (NULL -> 0)."""
    st = monthly_demand_stats(sales)
    std = F.coalesce(F.col("std"), F.lit(0.0))
    return st.select("product_id", "mean", std.alias("std"),
                     F.coalesce(F.try_divide(std, F.col("mean")), F.lit(0.0)).alias("cv"))


def o05_xyz(sales: DataFrame, bands=XYZ_BANDS) -> DataFrame:
    s = o04_xyz_stats(sales)
    x, y = bands
    cv = F.col("cv")
    return s.withColumn("xyz_class", band(cv, [(cv < x, "X"), (cv <= y, "Y"), (None, "Z")]))


def o03_class_counts(sales: DataFrame) -> DataFrame:
    """Class distributions, one row per (dimension, class)."""
    a = o02_abc(sales).groupBy(F.col("abc_class").alias("class_label")).count().withColumn("dimension", F.lit("ABC"))
    x = o05_xyz(sales).groupBy(F.col("xyz_class").alias("class_label")).count().withColumn("dimension", F.lit("XYZ"))
    return a.unionByName(x).select("dimension", "class_label", F.col("count").alias("sku_count"))


def o06_classification(sales: DataFrame) -> DataFrame:
    """Full outer join of ABC and XYZ with defaults C / Z / 0 / 999."""
    a = o02_abc(sales).select("product_id", "revenue", "abc_class")
    x = o05_xyz(sales).select("product_id", "mean", "std", "cv", "xyz_class")
    j = a.join(x, "product_id", "full")
    abc = F.coalesce("abc_class", F.lit("C"))
    xyz = F.coalesce("xyz_class", F.lit("Z"))
    return j.select("product_id", F.coalesce("revenue", F.lit(0.0)).alias("revenue"), abc.alias("abc_class"),
                    "mean", "std", F.coalesce("cv", F.lit(999.0)).alias("cv"), xyz.alias("xyz_class"),
                    F.concat(abc, xyz).alias("abc_xyz_segment"))
