"""Cleaning of raw products, sales and inventory.

Everything is a column expression; the per-row loops and ``apply`` calls
of a pandas pipeline become CASE/COALESCE expressions in one projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The category synonym map of the reference catalog.
REFERENCE_CATEGORY_MAP = {
    "electronics": "Electronics",
    "ELECTR": "Electronics",
    "home & kitchen": "Home & Kitchen",
    "H&K": "Home & Kitchen",
}
DEFAULT_LEAD_TIME = 7
PRICE_OUTLIER_FACTOR = 5


def standardize_categories(products: DataFrame, mapping: dict | None = None) -> DataFrame:
    """Exact-match synonym replacement; unmapped values are kept."""
    mapping = REFERENCE_CATEGORY_MAP if mapping is None else mapping
    return products.replace(mapping, subset=["category"])


def impute_lead_time(products: DataFrame, default: int = DEFAULT_LEAD_TIME) -> DataFrame:
    """C04 + C05: NULL lead time -> median of its (standardised) category,
    then -> ``default``; finally truncated to int (9.5 -> 9).

    The median is an exact interpolating percentile computed per category
    with partial aggregation (value counts), then joined back -- no window
    holds a whole category in one task.
    """
    return default_lead_time(median_lead_time(products), default)


def median_lead_time(products: DataFrame) -> DataFrame:
    """C04 alone: NULL lead time -> median of its category, as a double (9.5 stays 9.5)."""
    med = products.groupBy("category").agg(F.median("lead_time_days").alias("_med_lead"))
    cols = products.columns
    return (products.join(med, "category", "left")
            .withColumn("lead_time_days", F.coalesce(F.col("lead_time_days").cast("double"), "_med_lead"))
            .select(*cols))


def default_lead_time(products: DataFrame, default: int = DEFAULT_LEAD_TIME) -> DataFrame:
    """C05 alone: what is still NULL -> ``default``, then truncated to int."""
    return products.withColumn("lead_time_days", F.coalesce("lead_time_days", F.lit(float(default))).cast("int"))


def clean_products(raw_products: DataFrame, mapping: dict | None = None,
                   default_lead: int = DEFAULT_LEAD_TIME) -> DataFrame:
    return impute_lead_time(standardize_categories(raw_products, mapping), default_lead)


def dedupe_sales(raw_sales: DataFrame, key: str | None = None) -> DataFrame:
    """Exact full-row de-duplication (or by ``key`` when given)."""
    return raw_sales.dropDuplicates([key]) if key else raw_sales.dropDuplicates()


def dedupe_by_digest(raw_sales: DataFrame, digest=None) -> DataFrame:
    """C06 for wide tables with few copies: digests meet instead of rows.

    Only (digest, count) is shuffled to find the digests of more than one row.
    Rows of those are compared whole, so two rows that merely share a digest
    both stay; all others go straight through.  ``digest``: the column to
    compare first, by default a 64-bit hash of the row."""
    cols = raw_sales.columns
    rows = raw_sales.withColumn("_digest", F.xxhash64(*cols) if digest is None else digest)
    twice = rows.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_digest")
    once = rows.join(twice, "_digest", "left_anti").select(*cols)
    again = rows.join(twice, "_digest", "left_semi").select(*cols).dropDuplicates()
    return once.unionByName(again)


def fix_quantity(sales: DataFrame) -> DataFrame:
    """Negative quantities are sign errors -> abs."""
    return sales.withColumn("quantity_sold", F.abs("quantity_sold"))


def price_outlier_flag(price, unit_price, factor: int = PRICE_OUTLIER_FACTOR):
    """Selling price strictly above ``factor`` x catalog price."""
    return F.coalesce(F.col(price) > F.col(unit_price) * F.lit(factor), F.lit(False))


def repair_prices(sales: DataFrame, products: DataFrame, factor: int = PRICE_OUTLIER_FACTOR) -> DataFrame:
    """C08 + C09: flag price outliers with a left join on the catalog and
    set exactly the flagged rows to the catalog unit price."""
    cols = sales.columns
    cat = products.select("product_id", F.col("unit_price").alias("_catalog_price"))
    flagged = price_outlier_flag("selling_price_per_unit", "_catalog_price", factor)
    return (sales.join(cat, "product_id", "left")
            .withColumn("selling_price_per_unit",
                        F.when(flagged, F.col("_catalog_price")).otherwise(F.col("selling_price_per_unit")))
            .select(*cols))


def add_revenue(sales: DataFrame) -> DataFrame:
    """revenue = quantity x price, exact to the cent."""
    return sales.withColumn(
        "revenue", (F.col("quantity_sold") * F.col("selling_price_per_unit")).cast("decimal(18,2)"))


def clean_sales(raw_sales: DataFrame, products: DataFrame, factor: int = PRICE_OUTLIER_FACTOR,
                dedupe_key: str | None = None) -> DataFrame:
    """C06 -> C07 -> C08/C09 -> C10, in the reference's order."""
    s = fix_quantity(dedupe_sales(raw_sales, dedupe_key))
    return add_revenue(repair_prices(s, products, factor))


def clean_inventory(raw_inventory: DataFrame) -> DataFrame:
    """K08 defaults (allocated/on order 0) and C11 clamp of negative stock."""
    return (raw_inventory
            .fillna(0, subset=["stock_allocated", "stock_on_order"])
            .withColumn("stock_on_hand", F.greatest(F.col("stock_on_hand"), F.lit(0)).cast("bigint"))
            .withColumn("stock_allocated", F.col("stock_allocated").cast("bigint"))
            .withColumn("stock_on_order", F.col("stock_on_order").cast("bigint")))


def set_null_dangling_supplier(products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """ON DELETE SET NULL -- a supplier_id with no supplier row becomes NULL."""
    cols = products.columns
    keys = suppliers.select(F.col("supplier_id").alias("_sid"))
    return (products.join(keys, F.col("supplier_id") == F.col("_sid"), "left")
            .withColumn("supplier_id", F.col("_sid")).select(*cols))
