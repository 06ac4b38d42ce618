"""C12 measured while cleaning: the cleaning plans carry flags, and the write that stores a table observes them.

``sales``, ``products`` and ``inventory`` clean like their namesakes in
``cleaning`` and keep what the report counts as helper columns (copies of a
row, sign errors, price outliers, missing values).  ``observe`` adds the
counts to the plan as an ``Observation`` and drops the helpers; call it last,
so that the counts are taken in the stage that writes, where a repeated task
is counted once.  No raw fact is read a second time for its report.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import cleaning

REPORT = "table_name string, check_name string, value long"


class Measured(NamedTuple):
    """A cleaning plan, the counts of its report, and the helper columns that they need."""
    df: DataFrame
    counts: dict[str, Column]
    helpers: tuple[str, ...] = ()


def _nulls(columns) -> Column:
    return F.sum(sum((F.col(c).isNull().cast("long") for c in columns), F.lit(0)))


def plain(df: DataFrame) -> Measured:
    """A table that cleaning leaves alone."""
    return Measured(df, {"null_values": _nulls(df.columns)})


def products(raw_products: DataFrame, mapping: dict | None = None) -> Measured:
    df = cleaning.clean_products(raw_products.withColumn("_missing", F.col("lead_time_days").isNull()), mapping)
    return Measured(df, {"missing_lead_time": F.count_if("_missing"), "null_values_after": _nulls(raw_products.columns)}, ("_missing",))


def sales(raw_sales: DataFrame, catalog: DataFrame, factor: int = cleaning.PRICE_OUTLIER_FACTOR) -> Measured:
    """C06-C10 in the reference's order; equal rows are counted while they are grouped."""
    once = raw_sales.groupBy(*raw_sales.columns).agg(F.count(F.lit(1)).alias("_copies"))
    prices = catalog.select("product_id", F.col("unit_price").alias("_catalog"))
    flags = once.join(prices, "product_id", "left").withColumns(
        {"_negative": F.col("quantity_sold") < 0, "_outlier": cleaning.price_outlier_flag("selling_price_per_unit", "_catalog", factor)})
    repaired = flags.withColumn("selling_price_per_unit", F.when(F.col("_outlier"), F.col("_catalog")).otherwise(F.col("selling_price_per_unit")))
    df = cleaning.add_revenue(cleaning.fix_quantity(repaired)).select(*raw_sales.columns, "revenue", "_copies", "_negative", "_outlier")
    rows_in = F.coalesce(F.sum("_copies"), F.lit(0))
    return Measured(df, {"rows_in": rows_in, "duplicates_removed": rows_in - F.count(F.lit(1)), "negative_quantity": F.count_if("_negative"),
                         "price_outliers": F.count_if("_outlier"), "rows_out": F.count(F.lit(1))}, ("_copies", "_negative", "_outlier"))


def inventory(raw_inventory: DataFrame) -> Measured:
    nulls = sum((F.col(c).isNull().cast("long") for c in raw_inventory.columns), F.lit(0))
    df = cleaning.clean_inventory(raw_inventory.withColumns({"_negative": F.col("stock_on_hand") < 0, "_nulls": nulls}))
    return Measured(df, {"negative_stock": F.count_if("_negative"), "null_values": F.sum("_nulls")}, ("_negative", "_nulls"))


def observe(m: Measured) -> tuple[DataFrame, Observation]:
    """The plan to write, and the observation that holds its counts afterwards."""
    seen = Observation()
    return m.df.observe(seen, *[c.cast("long").alias(k) for k, c in m.counts.items()]).drop(*m.helpers), seen


def report(spark: SparkSession, seen: dict[str, dict]) -> DataFrame:
    """C12 from the observed counts {table: {check: count}}; a table without rows has zeros."""
    return spark.createDataFrame([(t, k, int(v or 0)) for t, counts in seen.items() for k, v in counts.items()], REPORT)
