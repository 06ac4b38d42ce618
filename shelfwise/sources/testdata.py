"""Adapters: the TPC-H-style test tables -> the five raw business tables.

The test data has no retail schema, so these jobs derive one
deterministically (the view definitions of FIXTURES.md).  They also
inject the anomaly kinds the cleaning step repairs: category variants,
null lead times, repeated sales rows, negative quantities, x10 prices
and negative stock.

Scale notes: every join key is a large-table key, so joins are left to
the planner (AQE broadcasts a side only when its measured size is under
the threshold).  The line items travel twice, to their orders (which have
met their customers before) and to their parts.  The snapshot grid
(date x SKU x warehouse) never travels: one row per SKU meets its few runs
of constant stock and is unfolded behind the last shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# Fixed values of the adapter (FIXTURES.md): category variants and their
# standard names, used by C03 on the test data.
TEST_CATEGORY_MAP = {"economy": "ECONOMY", "ECON": "ECONOMY", "promo": "PROMO"}
SNAPSHOT_DAYS = 60


def read_base(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}


def suppliers(b) -> DataFrame:
    return b["supplier"].selectExpr(
        "s_suppkey AS supplier_id", "s_name AS supplier_name",
        "round(1.0 + 4.0 * least(greatest((s_acctbal + 1000.0) / 11000.0, 0.0), 1.0), 1) AS rating",
        "CAST(0.75 + (s_suppkey * 11 % 24) * 0.01 AS DOUBLE) AS reliability_score")


def warehouses(b) -> DataFrame:
    return b["region"].selectExpr(
        "concat('WH0', CAST(r_regionkey + 1 AS STRING)) AS warehouse_id",
        "r_name AS warehouse_name", "r_name AS location",
        "CAST(150000 + 50000 * r_regionkey AS BIGINT) AS capacity_sqft",
        "CAST(45000 + 12500 * r_regionkey AS DOUBLE) AS operational_cost_monthly")


def raw_products(b) -> DataFrame:
    n_sup = b["supplier"].agg(F.count(F.lit(1))).scalar()
    return b["part"].select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.expr("""CASE WHEN p_type = 'ECONOMY' AND p_partkey % 10 < 2 THEN 'economy'
                       WHEN p_type = 'ECONOMY' AND p_partkey % 10 = 2 THEN 'ECON'
                       WHEN p_type = 'PROMO' AND p_partkey % 10 = 3 THEN 'promo'
                       ELSE p_type END""").alias("category"),
        F.expr("CAST(p_retailprice AS DECIMAL(12,2))").alias("unit_price"),
        F.expr("""CAST(CAST(p_retailprice AS DECIMAL(12,2))
                       * CAST(0.400 + (p_partkey % 25) * 0.015 AS DECIMAL(5,3)) AS DECIMAL(12,2))""").alias("unit_cost"),
        (F.col("p_partkey") % n_sup).alias("supplier_id"),
        F.expr("CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE 3 + p_size % 19 END").cast("double").alias("lead_time_days"),
        F.expr("CASE p_partkey % 5 WHEN 0 THEN 10 WHEN 1 THEN 50 WHEN 2 THEN 100 WHEN 3 THEN 200 ELSE 500 END")
         .alias("min_order_qty"))


def _line_region(b) -> DataFrame:
    """lineitem with the customer's region key (-> warehouse) and the order's channel (0 Retail, 1 Online, 2 Wholesale)."""
    o = b["orders"].selectExpr(
        "o_orderkey", "o_custkey",
        """CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1
                     WHEN o_orderpriority = '5-LOW' THEN 2 ELSE 0 END AS TINYINT) AS channel_no""")
    c = b["customer"].select("c_custkey", "c_nationkey")
    n = b["nation"].select("n_nationkey", "n_regionkey")
    by_order = (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                .select("o_orderkey", "channel_no", "n_regionkey"))
    return b["lineitem"].join(by_order, F.col("l_orderkey") == F.col("o_orderkey"))


def raw_sales(b) -> DataFrame:
    p = b["part"].select("p_partkey", "p_retailprice")
    s = (_line_region(b).withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
         .join(p, F.col("l_partkey") == F.col("p_partkey"))
         .selectExpr(
            """concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-',
                      CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING)) AS sale_id""",
            "l_shipdate AS sale_date", "l_partkey AS product_id",
            "concat('WH0', CAST(n_regionkey + 1 AS STRING)) AS warehouse_id",
            "CAST(l_quantity AS INT) * (CASE WHEN l_orderkey % 997 = 0 THEN -1 ELSE 1 END) AS quantity_sold",
            """CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(1 - l_discount AS DECIMAL(4,2))
                   * (CASE WHEN l_orderkey % 499 = 1 THEN 10 ELSE 1 END) AS DECIMAL(12,2)) AS selling_price_per_unit""",
            "CASE channel_no WHEN 1 THEN 'Online' WHEN 2 THEN 'Wholesale' ELSE 'Retail' END AS channel",
            "l_orderkey"))
    # Injected exact copies (1 in 101 orders): one pass, each row emitted once or twice.
    copies = F.when(F.col("l_orderkey") % 101 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (s.withColumn("_copy", F.explode(copies))
             .select("sale_id", "sale_date", "product_id", "warehouse_id", "quantity_sold",
                     "selling_price_per_unit", "channel"))


def _grid_tasks(rows: int) -> int:
    """Tasks that unfold ``rows`` snapshot rows: 2 million rows in each up to 32 tasks, then up to 16 million."""
    return max(1, min(-(-rows // 2_000_000), 32), -(-rows // 16_000_000))


def raw_inventory(b, days: int = SNAPSHOT_DAYS) -> DataFrame:
    """Snapshots of the last ``days`` ship days: every date x SKU x warehouse (the table is that product).

    Stock left = opening - units sold up to and including the snapshot date.  It changes on days with sales only, so
    a SKU's row carries its runs (first date, date after the last one, units sold so far) and is unfolded without a
    shuffle or a sort of the grid."""
    li = b["lineitem"]
    ship = F.col("l_shipdate").cast("date")
    max_d = li.agg(F.max(ship)).scalar()
    in_window = ship > F.date_sub(max_d, days)
    # Bounded arrays: at most ``days`` dates, and the fixed region list.
    dates = li.where(in_window).agg(F.sort_array(F.collect_set(ship))).scalar()
    regions = b["region"].agg(F.collect_set("r_regionkey")).scalar()
    end = F.size(dates) + 1

    sold = (_line_region(b).where(in_window)
            .groupBy(ship.alias("snap"), F.col("l_partkey").alias("sold_pk"), F.col("n_regionkey").alias("rk"))
            .agg(F.sum("l_quantity").cast("double").alias("q")))
    w = Window.partitionBy("sold_pk", "rk").orderBy("start")
    runs = (sold.withColumn("start", F.array_position(dates, F.col("snap")).cast("int"))
            .select("sold_pk", "rk", "start", F.lead("start").over(w).alias("next"),
                    F.coalesce(F.sum("q").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0.0)).alias("units"))
            .groupBy("sold_pk").agg(F.collect_list(F.struct("rk", "start", "next", "units")).alias("runs")))

    # Line items without a part key count for parts without one.
    parts = b["part"].select(F.col("p_partkey").alias("pk"), "p_size")
    tasks = _grid_tasks(b["part"].count() * b["region"].count() * days)
    skus = (parts.join(runs, F.col("pk").eqNullSafe(F.col("sold_pk")), "left").select("pk", "p_size", "runs")
            .repartition(tasks, "pk", "p_size"))
    own = F.coalesce(F.filter("runs", lambda r: r["rk"] == F.col("rk")), F.array().cast("array<struct<rk:int,start:int,next:int,units:double>>"))
    first = F.struct(F.lit(1).alias("start"), F.array_min(F.transform("own", lambda r: r["start"])).alias("next"), F.lit(0.0).alias("units"))
    later = F.transform("own", lambda r: F.struct(r["start"].alias("start"), r["next"].alias("next"), r["units"].alias("units")))
    g = (skus.select("pk", "p_size", "runs", F.explode(regions).alias("rk"))
         .select("pk", "rk", "p_size", own.alias("own"))
         .select("pk", "rk", "p_size", F.explode(F.concat(F.array(first), later)).alias("run"))
         .withColumn("oh", F.greatest(F.lit(0), (F.col("pk") * 37 + F.col("rk") * 101) % 200 - F.col("run.units")).cast("bigint")))
    # All but the date is the same in a run, so it is worked out once.
    return g.selectExpr(
        "run", "pk AS product_id", "concat('WH0', CAST(rk + 1 AS STRING)) AS warehouse_id",
        "CASE WHEN (pk * 5 + rk) % 401 = 0 THEN -5 ELSE oh END AS stock_on_hand",
        "CAST(floor(oh * ((pk + rk) % 16) / 100.0) AS BIGINT) AS stock_allocated",
        "CASE WHEN oh < 2.5 * (3 + p_size % 19) AND (pk + rk) % 3 = 0 THEN 50 ELSE 0 END AS stock_on_order",
    ).select(F.explode(F.slice(dates, F.col("run.start"), F.coalesce(F.col("run.next"), end) - F.col("run.start"))).alias("date"),
             "product_id", "warehouse_id", "stock_on_hand", "stock_allocated", "stock_on_order")


def raw_tables(spark: SparkSession, sf_dir: str, days: int = SNAPSHOT_DAYS) -> dict[str, DataFrame]:
    b = read_base(spark, sf_dir)
    return {
        "suppliers": suppliers(b),
        "warehouses": warehouses(b),
        "raw_products": raw_products(b),
        "raw_sales": raw_sales(b),
        "raw_inventory": raw_inventory(b, days),
    }
