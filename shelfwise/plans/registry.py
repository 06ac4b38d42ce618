"""Query registry: one callable per operator ID, ``(spark, sf_dir) -> DataFrame``.

Every entry reads the catalog tables derived from the given test data
(written once per session, see ``catalog``), so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import distinct as DI
from shelfwise.functions import round_half_up
from shelfwise.operators import arima as AR
from shelfwise.operators import classify as C
from shelfwise.operators import cleaning as C_
from shelfwise.operators import eda as E
from shelfwise.operators import forecast as FC
from shelfwise.operators import measured as ME
from shelfwise.operators import metrics as P
from shelfwise.operators import quality as Q
from shelfwise.operators import quarantine as QU
from shelfwise.operators import recommend as RC
from shelfwise.operators import replenish as RP
from shelfwise.operators import sales as S
from shelfwise.operators import stock as K
from shelfwise.operators import suppliers as SU
from shelfwise.operators import transfers as T
from shelfwise.operators import views as V
from shelfwise.plans.catalog import co_located, csv_export, database, load, optimization, quarantine
from shelfwise.sources import files as SF
from shelfwise.sources import versions as VS
from shelfwise.sources.testdata import TEST_CATEGORY_MAP as TEST_MAP

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _q(name: str, fn: Callable, *tables: str):
    """Register ``fn(*catalog tables)`` under ``name``."""
    QUERIES[name] = lambda spark, sf_dir: fn(*[getattr(load(spark, sf_dir), t) for t in tables])


# Group 1-2 and 4: sales analytics
_q("q01", S.q01_row_counts, "suppliers", "warehouses", "products", "sales", "inventory")
_q("q02", S.q02_top_unit_price, "products")
_q("q03", S.q03_skus_per_category, "products")
_q("q04", S.q04_channel_mix, "sales")
_q("q05", S.q05_supplier_averages, "suppliers")
_q("q06", S.q06_top_products_by_revenue, "daily", "products")
_q("q07", S.q07_monthly_trend, "sales")
_q("q08", S.q08_aov_by_channel, "sales")
_q("q09", S.q09_category_margin, "daily", "products")
_q("q10", S.q10_weekday_weekend, "sales")
_q("q11", S.q11_warehouse_contribution, "daily", "warehouses")
_q("q12", S.q12_warehouse_category, "daily", "warehouses", "products")
_q("q13", S.q13_markup, "products")
_q("q14", S.q14_daily_avg_by_month, "sales")
_q("q15", S.q15_low_revenue_skus, "daily", "products")
_q("q26", S.q26_top_per_category, "daily", "products")
_q("q27", S.q27_running_monthly_revenue, "daily")
_q("q28", S.q28_rolling_7d, "sales")
_q("q29", S.q29_mom_growth, "daily")
_q("q30", S.q30_quantity_percentile, "sales")
_q("q31", S.q31_first_last_sale, "daily")
_q("q32", S.q32_basket_bands, "sales")
_q("q33", S.q33_large_baskets, "sales")
_q("q34", S.q34_rolling_3m_category_units, "daily", "products")
_q("q35", S.q35_best_channel_per_category, "sales", "products")


def _ci(t):
    return V.current_inventory(t.inventory, t.products, t.warehouses, t.snapshot_date())


def _with_ci(fn: Callable, *tables: str):
    """Register helper for queries over the current-inventory view."""
    def run(spark, sf_dir):
        t = load(spark, sf_dir)
        return fn(_ci(t), *[getattr(t, n) for n in tables])
    return run


# Views
_q("v01", V.product_profitability, "products")
_q("v02", V.supplier_performance, "suppliers", "products")
QUERIES["v03"] = lambda spark, d: (lambda t: V.iso_dates(V.current_inventory(t.inventory, t.products, t.warehouses), "date"))(load(spark, d))
QUERIES["v03_by_name"] = lambda spark, d: V.iso_dates(_ci(load(spark, d)), "date")       # the date from the partition names

# Group 3 and 5: inventory and supply chain
QUERIES["q16"] = _with_ci(K.q16_inventory_valuation, "warehouses", "products")
QUERIES["q17"] = _with_ci(K.q17_holding_cost, "warehouses", "products")
QUERIES["q18"] = _with_ci(K.q18_out_of_stock)
QUERIES["q19"] = _with_ci(K.q19_over_allocated)
QUERIES["q20"] = _with_ci(K.q20_stock_by_warehouse)
QUERIES["q21"] = _with_ci(K.q21_stock_status)
QUERIES["q21_rollup"] = lambda spark, d: DI.rollup(
    _ci(load(spark, d)).withColumn("stock_status", K.stock_status(F.col("stock_on_hand"))), ["stock_status", "warehouse_id"], "product_id", "unique_skus")
QUERIES["q22"] = _with_ci(K.q22_dio, "daily", "products")
QUERIES["q23"] = _with_ci(K.q23_turnover, "daily", "products")
QUERIES["q24"] = _with_ci(K.q24_lowest_sku_turnover, "daily", "products")
QUERIES["q25"] = _with_ci(K.q25_pending_ratio)
QUERIES["q36"] = _with_ci(K.q36_reorder_alerts, "daily", "products")
QUERIES["q37"] = _with_ci(K.q37_slow_dead_stock, "daily_by_month", "products")
_q("q38", K.q38_eoq, "daily", "products")


def _by_sku(fn, *names):
    """The query over tables that lie bucketed by SKU (snapshot, daily, products): no row travels to meet its SKU's others."""
    return lambda spark, d: fn(*[co_located(spark, d)[n] for n in names])


QUERIES["q22_by_sku"] = _by_sku(K.q22_dio, "snapshot", "daily", "products")
QUERIES["q24_by_sku"] = _by_sku(K.q24_lowest_sku_turnover, "snapshot", "daily", "products")
QUERIES["q38_by_sku"] = _by_sku(K.q38_eoq, "daily", "products")
QUERIES["o11_by_sku"] = _by_sku(lambda daily, products: RP.order_quantities(daily, products).select(*RP.STEP_COLUMNS["o11"]), "daily", "products")
_q("q42", SU.q42_supplier_scorecard, "suppliers")
_q("q43", SU.q43_warehouse_efficiency, "daily", "warehouses")
_q("q44", SU.q44_supplier_category_skus, "products", "suppliers")
QUERIES["q45"] = _with_ci(K.q45_outages_by_supplier, "suppliers", "products")


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    """Round sample-std derived doubles to 6 places for reporting: their last
    digits depend on the summation order of the engine."""
    for c in cols:
        if c in df.columns:
            df = df.withColumn(c, round_half_up(c, 6))
    return df


# Classification and replenishment
_q("q39", C.q39_abc, "daily")
_q("q40", C.q40_xyz, "daily", "products")
QUERIES["q41"] = lambda spark, d: (lambda t: C.q41_abc_xyz_matrix(t.daily, _ci(t), t.products))(load(spark, d))
_q("o01", C.o01_revenue_share, "daily")
_q("o02", C.o02_abc, "daily")
_q("o03", C.o03_class_counts, "daily")
QUERIES["o04"] = lambda spark, d: _r6(C.o04_xyz_stats(load(spark, d).daily), "std", "cv")
QUERIES["o05"] = lambda spark, d: _r6(C.o05_xyz(load(spark, d).daily), "std", "cv")
QUERIES["o06"] = lambda spark, d: _r6(C.o06_classification(load(spark, d).daily), "std", "cv")


def _opt(spark, d):
    t = load(spark, d)
    return RP.optimization_table(t.daily, t.products)


# The steps that need no classes have plans of their own.
_OWN = {"o09": RP.daily_demand, "o10": RP.annual_demand, "o11": RP.order_quantities}
for _k, _cols in RP.STEP_COLUMNS.items():
    if _k in _OWN:
        QUERIES[_k] = (lambda fn, cols: lambda spark, d: (lambda t: _r6(fn(t.daily, t.products).select(*cols), "daily_std"))(load(spark, d)))(_OWN[_k], _cols)
    else:
        QUERIES[_k] = (lambda cols: lambda spark, d: _r6(_opt(spark, d).select(*cols), "daily_std"))(_cols)
QUERIES["o14"] = lambda spark, d: _r6(_opt(spark, d), "std", "cv", "daily_std")
QUERIES["o14_by_warehouse"] = lambda spark, d: _r6(optimization(spark, d, by_warehouse=True), "std", "cv", "daily_std")


# Health score and recommendations
def _recs(spark, d, full=True):
    """Recommendations read the persisted optimization table."""
    t = load(spark, d)
    return RC.recommendations(t.inventory, t.warehouses, t.suppliers, optimization(spark, d), full=full, date=t.snapshot_date())


def _cur(spark, d):
    t = load(spark, d)
    return RC.current_status(t.inventory, t.warehouses, t.snapshot_date())


KEY = ["product_id", "warehouse_id"]
QUERIES["r01"] = lambda spark, d: RC.snapshot_days(load(spark, d).inventory)
QUERIES["r02"] = lambda spark, d: RC.stockout_days(load(spark, d).inventory)
QUERIES["r03"] = lambda spark, d: V.iso_dates(_cur(spark, d).select(
    "date", *KEY, "stock_on_hand", "stock_allocated", "stock_on_order", "stockout_days", "warehouse_name"), "date")
QUERIES["r04"] = lambda spark, d: _cur(spark, d).select(*KEY, "stockout_days", "stock_availability_pct")
_RSTEPS = {
    "r05": ["product_name", "category", "rop", "eoq", "safety_stock", "supplier_id"],
    "r06": ["stock_on_hand", "rop", "turnover_score"],
    "r07": ["stock_on_hand", "safety_stock", "cost_score"],
    "r08": ["stock_availability_pct", "turnover_score", "cost_score", "health_score"],
    "r09": ["health_score", "health_label"],
    "r10": ["recommendation"],
    "r11": ["supplier_name", "supplier_risk_status"],
}
for _k, _cols in _RSTEPS.items():
    QUERIES[_k] = (lambda cols: lambda spark, d: _recs(spark, d).select(*KEY, *cols))(_cols)
QUERIES["r12"] = lambda spark, d: _recs(spark, d, full=False)
QUERIES["r13"] = lambda spark, d: RC.label_distribution(_recs(spark, d, full=False))
def _r12_by_warehouse(spark, d):
    """R12 with per-(SKU, warehouse) parameters.  A warehouse that never sold
    a SKU has no parameters there, so rop/eoq/safety_stock are reported as
    doubles with NULLs (as a pandas frame would hold them)."""
    t = load(spark, d)
    recs = RC.recommendations(t.inventory, t.warehouses, t.suppliers,
                              optimization(spark, d, by_warehouse=True), date=t.snapshot_date())
    for c in ["rop", "eoq", "safety_stock"]:
        recs = recs.withColumn(c, F.col(c).cast("double"))
    return recs


QUERIES["r12_by_warehouse"] = _r12_by_warehouse


# Demand forecasting (total weekly series, as in the reference; the
# functions take group_cols for per-SKU / per-category series)
def _split(spark, d):
    s = load(spark, d).daily
    return FC.split(FC.fill_weeks(FC.weekly_demand(s)))


def _wk(df: DataFrame) -> DataFrame:
    return df.withColumn("week", F.date_format("week", "yyyy-MM-dd"))


QUERIES["f01"] = lambda spark, d: _wk(FC.weekly_demand(load(spark, d).daily))
QUERIES["f02"] = lambda spark, d: _wk(FC.fill_weeks(FC.weekly_demand(load(spark, d).daily)))
QUERIES["f03"] = lambda spark, d: _wk(_split(spark, d).select("week", "t", "n", "demand", "is_test"))
QUERIES["f04"] = lambda spark, d: FC.ma_params(_split(spark, d))
QUERIES["f05"] = lambda spark, d: FC.lr_params(_split(spark, d))
QUERIES["f06"] = lambda spark, d: FC.arima_params(_split(spark, d))
QUERIES["f07"] = lambda spark, d: _wk(FC.forecasts(load(spark, d).daily)).withColumn(
    "forecast_lr", round_half_up("forecast_lr", 6)).withColumn("forecast_arima", round_half_up("forecast_arima", 6))
QUERIES["f08"] = lambda spark, d: FC.evaluation(load(spark, d).daily)
QUERIES["f09"] = lambda spark, d: FC.report(load(spark, d).daily)
QUERIES["f10"] = lambda spark, d: _wk(FC.comparison_series(load(spark, d).daily)).withColumn(
    "value", round_half_up("value", 6))


def _sales_by_category(spark, d):
    t = load(spark, d)
    return t.daily.join(t.products.select("product_id", "category"), "product_id")


def _f06_by_category(spark, d):
    s = FC.split(FC.fill_weeks(FC.weekly_demand(_sales_by_category(spark, d), ["category"]), ["category"]))
    return FC.arima_params(s, ["category"])


def _refined(df: DataFrame) -> DataFrame:
    """Parameters to 3 places and sums of squares relative to the grid's, which the engines' last digits don't reach."""
    return df.select(*[c for c in df.columns if c not in AR.FIELDS], round_half_up("phi", 3).alias("phi"), round_half_up("theta", 3).alias("theta"),
                     "last_d", "last_y", round_half_up("grid_sse", 3).alias("grid_sse"), round_half_up("sse", 3).alias("sse"))


QUERIES["f06_refined"] = lambda spark, d: _refined(AR.refined_params(_split(spark, d)))
QUERIES["f06_refined_by_category"] = lambda spark, d: _refined(AR.refined_params(
    FC.split(FC.fill_weeks(FC.weekly_demand(_sales_by_category(spark, d), ["category"]), ["category"])), ["category"]))
# The same forecasting plan, one series per category (the scale axis).
QUERIES["f06_by_category"] = _f06_by_category
QUERIES["f09_by_category"] = lambda spark, d: FC.report(_sales_by_category(spark, d), ["category"])
QUERIES["f09_by_warehouse"] = lambda spark, d: FC.report(load(spark, d).daily, ["warehouse_id"])


# EDA datasets


def _dbl(df: DataFrame) -> DataFrame:
    """Decimal money columns as double for reporting."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal"
                       else F.col(f.name) for f in df.schema.fields])


QUERIES["e01"] = lambda spark, d: (lambda t: _dbl(V.iso_dates(
    E.enriched_sales(t.sales, t.products, t.warehouses), "sale_date")))(load(spark, d))
_q("e02", E.monthly_revenue, "daily")
_q("e03", E.category_pareto, "daily", "products")
_q("e04", E.warehouse_revenue, "daily", "warehouses")
QUERIES["e05"] = lambda spark, d: E.histogram(load(spark, d).products, "unit_price")
QUERIES["e06"] = lambda spark, d: E.kde(load(spark, d).products, "unit_price")
_q("e07", E.correlation_matrix, "products")
QUERIES["e06_binned"] = lambda spark, d: E.kde_binned(load(spark, d).sales, "selling_price_per_unit")


def _priced(spark, d, table="sales"):
    t = load(spark, d)
    return getattr(t, table).join(t.products.select("product_id", "category"), "product_id").select(
        "sale_id", "product_id", "warehouse_id", "category", F.col("selling_price_per_unit").cast("double").alias("price"))


QUERIES["c04_selected"] = lambda spark, d: (lambda t: E.group_medians(C_.standardize_categories(
    t.raw_products, TEST_MAP), "category", "lead_time_days"))(load(spark, d))
QUERIES["e08_outliers"] = lambda spark, d: E.outliers(load(spark, d).sales.select("sale_id", "product_id", "warehouse_id", "quantity_sold"), "quantity_sold")
QUERIES["e08_price"] = lambda spark, d: E.box_stats(_priced(spark, d), "price")
QUERIES["e08_price_by_category"] = lambda spark, d: E.box_stats_by(_priced(spark, d), ["category"], "price")
QUERIES["e08_price_outliers"] = lambda spark, d: E.outliers(_priced(spark, d, "raw_sales"), "price", ["category"])     # before the repair
QUERIES["e08"] = lambda spark, d: E.box_stats(load(spark, d).sales, "quantity_sold")
_q("e09", E.supplier_scatter, "suppliers")


# Cleaning reports and constraint checks
def _raw(t):
    return {"suppliers": t.suppliers, "warehouses": t.warehouses, "raw_products": t.raw_products,
            "raw_sales": t.raw_sales, "raw_inventory": t.raw_inventory}


def _loaded(t):
    return {"suppliers": t.suppliers, "warehouses": t.warehouses, "products": t.products,
            "sales": t.sales, "inventory": t.inventory}


def _raw_as_loaded(t):
    return {"suppliers": t.suppliers, "warehouses": t.warehouses, "products": t.raw_products,
            "sales": t.raw_sales, "inventory": t.raw_inventory}


QUERIES["c01"] = lambda spark, d: Q.null_profile(_raw(load(spark, d)))
_q("c02", Q.category_lists, "raw_products", "products")
QUERIES["c03"] = lambda spark, d: (lambda t: C_.standardize_categories(t.raw_products, TEST_MAP).select(
    "product_id", "category"))(load(spark, d))
QUERIES["c04"] = lambda spark, d: (lambda t: C_.median_lead_time(C_.standardize_categories(
    t.raw_products, TEST_MAP)).select("product_id", "category", "lead_time_days"))(load(spark, d))
QUERIES["c05"] = lambda spark, d: (lambda t: C_.impute_lead_time(C_.standardize_categories(
    t.raw_products, TEST_MAP)).select("product_id", "category", "lead_time_days"))(load(spark, d))
QUERIES["c06"] = lambda spark, d: V.iso_dates(_dbl(C_.dedupe_sales(load(spark, d).raw_sales)), "sale_date")
QUERIES["c06_by_digest"] = lambda spark, d: V.iso_dates(_dbl(C_.dedupe_by_digest(load(spark, d).raw_sales)), "sale_date")
QUERIES["c07"] = lambda spark, d: V.iso_dates(_dbl(C_.fix_quantity(C_.dedupe_sales(load(spark, d).raw_sales))),
                                              "sale_date")
QUERIES["c08"] = lambda spark, d: (lambda t: V.iso_dates(_dbl(
    C_.fix_quantity(C_.dedupe_sales(t.raw_sales)).join(t.products.select("product_id", F.col("unit_price").alias("_up")), "product_id", "left")
    .where(C_.price_outlier_flag("selling_price_per_unit", "_up")).drop("_up")), "sale_date"))(load(spark, d))
QUERIES["c09"] = lambda spark, d: (lambda t: V.iso_dates(_dbl(C_.repair_prices(
    C_.fix_quantity(C_.dedupe_sales(t.raw_sales)), t.products)), "sale_date"))(load(spark, d))
QUERIES["c10"] = lambda spark, d: V.iso_dates(_dbl(load(spark, d).sales), "sale_date")
QUERIES["c11"] = lambda spark, d: V.iso_dates(load(spark, d).inventory, "date")
QUERIES["c12"] = lambda spark, d: ME.report(spark, load(spark, d).cleaning_counts())
QUERIES["k01"] = lambda spark, d: (lambda t: Q.primary_key_violations(
    {"suppliers": t.suppliers, "warehouses": t.warehouses, "products": t.products, "sales": t.once("sales"), "inventory": t.once("inventory")}))(load(spark, d))
QUERIES["k02"] = lambda spark, d: Q.not_null_violations(_loaded(load(spark, d)))
QUERIES["k03"] = lambda spark, d: Q.check_violations(_loaded(load(spark, d)))
QUERIES["k03_raw"] = lambda spark, d: Q.check_violations(_raw_as_loaded(load(spark, d)))
QUERIES["k04"] = lambda spark, d: Q.channel_violations(load(spark, d).sales)
QUERIES["k05"] = lambda spark, d: Q.foreign_key_violations(_loaded(load(spark, d)))
QUERIES["k06"] = lambda spark, d: (lambda t: C_.set_null_dangling_supplier(t.products, t.suppliers).select(
    "product_id", "supplier_id"))(load(spark, d))
_q("k07", Q.generated_revenue, "sales")
QUERIES["k08"] = lambda spark, d: Q.default_fills(load(spark, d).raw_inventory)


def _sink(spark, d, table, sink):
    folder, tables = quarantine(spark, d, [table])
    out = _dbl(QU.rows(spark, folder, table, tables[table].schema, sink))
    if sink == "rejected":
        out = out.withColumn(QU.BROKEN, F.array_join(QU.BROKEN, "; "))
    return V.iso_dates(out, "sale_date" if table == "sales" else "date")


for _t in ("sales", "inventory"):
    for _s in ("accepted", "rejected"):
        QUERIES[f"k_{_s}_{_t}"] = (lambda t, s: lambda spark, d: _sink(spark, d, t, s))(_t, _s)
QUERIES["k_report"] = lambda spark, d: QU.report(spark, *quarantine(spark, d))


# Sources and sinks
def _csv_tables(spark, d):
    t = load(spark, d)
    root = csv_export(spark, d)
    schemas = {n: df.schema for n, df in _loaded(t).items()}
    return SF.read_csv_tables(spark, root, schemas=schemas)


QUERIES["s01"] = lambda spark, d: SF.row_counts(_csv_tables(spark, d))
QUERIES["s02"] = lambda spark, d: V.iso_dates(_dbl(_csv_tables(spark, d)["sales"]), "sale_date")


def _s03(spark, d):
    """The sales table of a database of named tables, with its regenerated revenue."""
    return V.iso_dates(_dbl(spark.table(f"{database(spark, d)}.sales").select(
        "sale_id", "sale_date", "product_id", "quantity_sold", "selling_price_per_unit", "revenue")), "sale_date")


def _s04(spark, d):
    """Row counts of the five tables after a full rebuild, committed over an existing one."""
    folder = SF.folder_of(spark, d, "rebuild")
    VS.rebuild(spark, _loaded(load(spark, d)), folder)
    return VS.row_counts(spark, folder)


def _views(spark, d):
    t = load(spark, d)
    SF.register_views(spark, {
        "view_product_profitability": V.product_profitability(t.products),
        "view_supplier_performance": V.supplier_performance(t.suppliers, t.products),
        "view_current_inventory": _ci(t)})


QUERIES["s03"] = _s03
QUERIES["s04"] = _s04
QUERIES["s05"] = lambda spark, d: (_views(spark, d), spark.table("view_supplier_performance"))[1]
QUERIES["s06"] = lambda spark, d: (_views(spark, d), SF.row_counts(
    {n: spark.table(n) for n in ["view_product_profitability", "view_supplier_performance",
                                 "view_current_inventory"]}).withColumnRenamed("table_name", "view_name"))[1]


# Report-only metrics
def _recs_full(spark, d):
    return _recs(spark, d, full=True)


QUERIES["p01"] = lambda spark, d: P.p01_stockout_rate(load(spark, d).inventory)
QUERIES["p02"] = lambda spark, d: P.p02_overstock_capital(_recs(spark, d, full=False), load(spark, d).products)
QUERIES["p03"] = lambda spark, d: (lambda t: P.p03_dead_stock(_ci(t), t.daily_by_month, t.products))(load(spark, d))
_q("p04", P.p04_revenue_vs_space, "daily", "warehouses")
QUERIES["p05"] = lambda spark, d: P.p05_avg_stockout_days(_cur(spark, d))
QUERIES["p06"] = lambda spark, d: P.p06_transfer_candidates(_recs_full(spark, d))
QUERIES["p06_transfers"] = lambda spark, d: T.transfer_plan(T.offers(_recs_full(spark, d)))
_q("p07", P.p07_cost_per_sqft, "daily", "warehouses")
_q("p08", P.p08_lead_time_range, "products")
_q("p09", P.p09_single_source_share, "products")
QUERIES["p10"] = lambda spark, d: P.p10_a_class_share(C.o02_abc(load(spark, d).daily))
_q("p11", P.p11_category_markup_profit, "daily", "products")
_q("p12", P.p12_channel_share, "sales")
_q("p13", P.p13_weekend_uplift, "sales")
_q("p14", P.p14_low_margin_skus, "products")
