"""Data-quality reports: C01, C02, C12 and the DDL constraints as
violation reports (K01-K05, K08).

Spark does not enforce PRIMARY KEY / NOT NULL / CHECK / FOREIGN KEY, so
each constraint becomes an aggregate that counts violating rows.  A NULL
passes a CHECK (NOT NULL-predicate is NULL, not true) exactly as in SQL.
All counts of one table come out of one aggregate (one scan).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import cleaning

PRIMARY_KEYS = {
    "suppliers": ["supplier_id"],
    "warehouses": ["warehouse_id"],
    "products": ["product_id"],
    "sales": ["sale_id"],
    "inventory": ["date", "product_id", "warehouse_id"],
}
NOT_NULL = {
    "suppliers": ["supplier_id", "supplier_name"],
    "warehouses": ["warehouse_id", "warehouse_name", "location"],
    "products": ["product_id", "product_name", "category", "unit_price", "unit_cost"],
    "sales": ["sale_id", "sale_date", "product_id", "warehouse_id", "quantity_sold", "selling_price_per_unit"],
    "inventory": ["date", "product_id", "warehouse_id", "stock_on_hand"],
}
# CHECK constraints of the schema, as (table, rule name, SQL predicate).
CHECKS = [
    ("suppliers", "rating_1_to_5", "rating BETWEEN 1 AND 5"),
    ("suppliers", "reliability_0_to_1", "reliability_score BETWEEN 0 AND 1"),
    ("warehouses", "capacity_positive", "capacity_sqft > 0"),
    ("warehouses", "cost_non_negative", "operational_cost_monthly >= 0"),
    ("products", "price_non_negative", "unit_price >= 0"),
    ("products", "cost_non_negative", "unit_cost >= 0"),
    ("products", "lead_time_non_negative", "lead_time_days >= 0"),
    ("products", "moq_non_negative", "min_order_qty >= 0"),
    ("sales", "quantity_positive", "quantity_sold > 0"),
    ("sales", "price_non_negative", "selling_price_per_unit >= 0"),
    ("sales", "channel_domain", "channel IN ('Online', 'Retail', 'Wholesale')"),
    ("inventory", "on_hand_non_negative", "stock_on_hand >= 0"),
    ("inventory", "allocated_non_negative", "stock_allocated >= 0"),
    ("inventory", "on_order_non_negative", "stock_on_order >= 0"),
]
CHANNELS = ["Online", "Retail", "Wholesale"]
FOREIGN_KEYS = [
    ("products", "supplier_id", "suppliers", "supplier_id"),
    ("sales", "product_id", "products", "product_id"),
    ("sales", "warehouse_id", "warehouses", "warehouse_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("inventory", "warehouse_id", "warehouses", "warehouse_id"),
]


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def null_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, null_count) for every column."""
    out = []
    for name, df in tables.items():
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"))
                                      for c in df.columns]))
        out.append(agg.select(F.lit(name).alias("table_name"), stacked.alias("p"))
                   .select("table_name", "p.column_name", "p.null_count"))
    return _union(out)


def category_lists(raw_products: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct categories before and after standardisation."""
    return (raw_products.select(F.lit("before").alias("stage"), "category").distinct()
            .unionByName(products.select(F.lit("after").alias("stage"), "category").distinct()))


def cleaning_report(suppliers: DataFrame, warehouses: DataFrame, raw_products: DataFrame, products: DataFrame,
                    raw_sales: DataFrame, raw_inventory: DataFrame,
                    factor: int = cleaning.PRICE_OUTLIER_FACTOR) -> DataFrame:
    """One row per (table, check) with the count the cleaning step saw.
    Each table is scanned once (all its checks in one aggregate); sales
    checks run on the de-duplicated rows, as in the reference."""
    def nulls(df):
        return F.sum(sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0)))

    def report(table: str, df: DataFrame, **checks) -> DataFrame:
        agg = df.agg(*[c.cast("long").alias(k) for k, c in checks.items()])
        rows = F.explode(F.array(*[F.struct(F.lit(k).alias("check_name"), F.col(k).alias("value")) for k in checks]))
        return agg.select(F.lit(table).alias("table_name"), rows.alias("r")).select(
            "table_name", "r.check_name", "r.value")

    # Equal rows are counted while they are grouped: one scan, one shuffle.
    dedup = raw_sales.groupBy(*raw_sales.columns).agg(F.count(F.lit(1)).alias("_copies")).join(
        products.select("product_id", F.col("unit_price").alias("_up")), "product_id", "left")
    rows_in = F.coalesce(F.sum("_copies"), F.lit(0))
    return _union([
        report("suppliers", suppliers, null_values=nulls(suppliers)),
        report("warehouses", warehouses, null_values=nulls(warehouses)),
        report("products", raw_products, missing_lead_time=F.count_if(F.col("lead_time_days").isNull())),
        report("products", products, null_values_after=nulls(products)),
        report("sales", dedup, rows_in=rows_in, duplicates_removed=rows_in - F.count(F.lit(1)),
               negative_quantity=F.count_if(F.col("quantity_sold") < 0),
               price_outliers=F.count_if(cleaning.price_outlier_flag("selling_price_per_unit", "_up", factor)),
               rows_out=F.count(F.lit(1))),
        report("inventory", raw_inventory, negative_stock=F.count_if(F.col("stock_on_hand") < 0),
               null_values=nulls(raw_inventory)),
    ])


def _day(df: DataFrame, cols: list[str]) -> str | None:
    return next((c for c, kind in df.select(*cols).dtypes if kind == "date"), None)


def _days(day: str):
    return F.expr(f"unix_date(`{day}`) - pmod(unix_date(`{day}`), 64)")


def folded_keys(df: DataFrame, cols: list[str]) -> DataFrame | None:
    """(key columns without the date, _days, _c, _seen): rows and days of each 64 days, the days as bits of a number.

    Snapshots that lie by SKU come down to a row or two a SKU and warehouse before they are shuffled.  None if the key has no date."""
    day = _day(df, cols)
    if day is None:
        return None
    fold = {"_days": _days(day), "_bit": F.expr(f"shiftleft(1L, pmod(unix_date(`{day}`), 64))")}
    return (df.select(*cols).withColumns(fold).groupBy(*[c for c in cols if c != day], "_days")
            .agg(F.count(F.lit(1)).alias("_c"), F.bit_or("_bit").alias("_seen")))


def repeated_keys(df: DataFrame, cols: list[str], folded: DataFrame | None = None) -> DataFrame:
    """(key columns, _c): the key values that occur _c > 1 times, NULLs being equal.

    Keys with a date are folded first (``folded``, if that has been done).  Only where there are more rows than days are
    keys grouped whole."""
    whole = df.select(*cols)
    day = _day(df, cols)
    if day is not None:
        folded = folded_keys(df, cols) if folded is None else folded
        others = [c for c in cols if c != day] + ["_days"]
        # Rows without a day are one key for each of the other columns' values.
        more = folded.where(F.col("_c") > F.coalesce(F.bit_count("_seen"), F.lit(1))).select(*[F.col(c).alias(f"_{c}") for c in others])
        if more.isEmpty():
            whole = whole.where(F.lit(False))
        else:
            rows = whole.withColumns({"_days": _days(day)})
            whole = rows.join(more, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in others]), "left_semi").select(*cols)
    return whole.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1)


def primary_key_violations(tables: dict[str, DataFrame], keys=PRIMARY_KEYS) -> DataFrame:
    """Per table, key values that occur more than once and the surplus rows."""
    out = []
    checks = [(name, cols) for name, cols in keys.items()]
    if "inventory" in keys and "inventory_id" in tables["inventory"].columns:
        checks.append(("inventory", ["inventory_id"]))      # the declared key, where the layout has it
    for name, cols in checks:
        dup = repeated_keys(tables[name], cols)
        out.append(dup.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                           F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("surplus_rows"))
                   .select(F.lit(name).alias("table_name"), F.lit(",".join(cols)).alias("key_columns"),
                           "duplicate_keys", "surplus_rows"))
    return _union(out)


def not_null_violations(tables: dict[str, DataFrame], rules=NOT_NULL) -> DataFrame:
    """(table_name, column_name, violations)."""
    return null_profile({t: tables[t].select(*cols) for t, cols in rules.items()}).withColumnRenamed(
        "null_count", "violations")


def check_violations(tables: dict[str, DataFrame], checks=CHECKS) -> DataFrame:
    """K03 + K04: (table_name, rule_name, violations); NULL passes a CHECK."""
    out = []
    for name in dict.fromkeys(t for t, _, _ in checks):
        rules = [(r, p) for t, r, p in checks if t == name]
        agg = tables[name].agg(*[F.count_if(~F.expr(p)).alias(r) for r, p in rules])
        stacked = F.explode(F.array(*[F.struct(F.lit(r).alias("rule_name"), F.col(r).alias("violations"))
                                      for r, _ in rules]))
        out.append(agg.select(F.lit(name).alias("table_name"), stacked.alias("p"))
                   .select("table_name", "p.rule_name", "p.violations"))
    return _union(out)


def channel_violations(sales: DataFrame, channels=CHANNELS) -> DataFrame:
    """Rows whose channel is outside the domain."""
    return sales.agg(F.count_if(~F.col("channel").isin(*channels)).alias("violations"))


def foreign_key_violations(tables: dict[str, DataFrame], fks=FOREIGN_KEYS) -> DataFrame:
    """Child rows whose (non-NULL) key has no parent row (anti joins).

    Child rows are counted per key first, so a hot key is one row of the join."""
    out = []
    for child, ck, parent, pk in fks:
        keys = tables[parent].select(F.col(pk).alias("_k"))
        orphans = (tables[child].where(F.col(ck).isNotNull()).groupBy(ck).agg(F.count(F.lit(1)).alias("_c"))
                   .join(keys, F.col(ck) == F.col("_k"), "left_anti"))
        out.append(orphans.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("violations")).select(
            F.lit(f"{child}.{ck} -> {parent}.{pk}").alias("foreign_key"), "violations"))
    return _union(out)


def generated_revenue(sales: DataFrame) -> DataFrame:
    """Rows, and rows whose stored revenue isn't quantity x price (NULLs only match NULLs)."""
    regenerated = cleaning.add_revenue(sales.select("quantity_sold", "selling_price_per_unit", F.col("revenue").alias("stored")))
    return regenerated.agg(F.count(F.lit(1)).alias("rows"),
                           F.count_if(~F.col("stored").eqNullSafe(F.col("revenue"))).alias("mismatches"))


def default_fills(raw_inventory: DataFrame) -> DataFrame:
    """How many NULLs the column defaults (0) fill."""
    return raw_inventory.agg(F.count_if(F.col("stock_allocated").isNull()).alias("stock_allocated"),
                             F.count_if(F.col("stock_on_order").isNull()).alias("stock_on_order")).select(
        F.explode(F.array(F.struct(F.lit("stock_allocated").alias("column_name"), F.col("stock_allocated").alias("filled")),
                          F.struct(F.lit("stock_on_order").alias("column_name"), F.col("stock_on_order").alias("filled"))))
        .alias("p")).select("p.column_name", "p.filled")
