"""Explicit schemas of the five business tables (no schema inference).

Money is decimal so that sums are exact and independent of row order;
dates are DateType; ratios are double.  Keys are typed by the caller's
data: the reference uses string ids (``PROD0001``), the test data bigint
ids, so the key type is a parameter.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
REVENUE = T.DecimalType(18, 2)


def suppliers_schema(key=T.StringType()) -> T.StructType:
    return T.StructType([
        T.StructField("supplier_id", key, False),
        T.StructField("supplier_name", T.StringType(), False),
        T.StructField("contact_name", T.StringType(), True),
        T.StructField("email", T.StringType(), True),
        T.StructField("rating", T.DoubleType(), True),
        T.StructField("reliability_score", T.DoubleType(), True),
    ])


def warehouses_schema() -> T.StructType:
    return T.StructType([
        T.StructField("warehouse_id", T.StringType(), False),
        T.StructField("warehouse_name", T.StringType(), False),
        T.StructField("location", T.StringType(), False),
        T.StructField("capacity_sqft", T.LongType(), True),
        T.StructField("operational_cost_monthly", T.DoubleType(), True),
    ])


def products_schema(key=T.StringType(), supplier_key=T.StringType()) -> T.StructType:
    # lead_time_days is double in the raw file: it carries nulls and is
    # imputed to int by cleaning.
    return T.StructType([
        T.StructField("product_id", key, False),
        T.StructField("product_name", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("unit_price", MONEY, False),
        T.StructField("unit_cost", MONEY, False),
        T.StructField("supplier_id", supplier_key, True),
        T.StructField("lead_time_days", T.DoubleType(), True),
        T.StructField("min_order_qty", T.IntegerType(), True),
    ])


def sales_schema(key=T.StringType()) -> T.StructType:
    return T.StructType([
        T.StructField("sale_id", T.StringType(), False),
        T.StructField("sale_date", T.DateType(), False),
        T.StructField("product_id", key, False),
        T.StructField("warehouse_id", T.StringType(), False),
        T.StructField("quantity_sold", T.IntegerType(), False),
        T.StructField("selling_price_per_unit", MONEY, False),
        T.StructField("channel", T.StringType(), True),
    ])


def inventory_schema(key=T.StringType()) -> T.StructType:
    return T.StructType([
        T.StructField("inventory_id", T.StringType(), True),
        T.StructField("date", T.DateType(), False),
        T.StructField("product_id", key, False),
        T.StructField("warehouse_id", T.StringType(), False),
        T.StructField("stock_on_hand", T.LongType(), True),
        T.StructField("stock_allocated", T.LongType(), True),
        T.StructField("stock_on_order", T.LongType(), True),
    ])


RAW_SCHEMAS = {
    "suppliers": suppliers_schema,
    "warehouses": warehouses_schema,
    "products": products_schema,
    "sales": sales_schema,
    "inventory": inventory_schema,
}

# Load order that satisfies the foreign keys (suppliers before products, ...).
FK_ORDER = ["suppliers", "warehouses", "products", "sales", "inventory"]
