"""The batch decision job: raw -> clean -> optimize -> recommend (+ forecast).

Stages hand over through written tables, as in the reference: cleaned
tables, the per-SKU optimization table, the per-(SKU, warehouse)
recommendation table and the forecast evaluation, each overwritten on
every run (S02/S04).  Run as a module:

    python -m shelfwise.plans.batch --sf-dir /root/testdata/sf0.01 --out /path/to/out [--csv]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import cleaning, forecast, measured, quality, recommend, replenish
from shelfwise.session import ship_package
from shelfwise.sources.files import buckets, cluster, write_table


def clean(raw: dict[str, DataFrame], category_map: dict | None = None) -> dict[str, DataFrame]:
    products = cleaning.clean_products(raw["raw_products"], category_map)
    return {
        "suppliers": raw["suppliers"],
        "warehouses": raw["warehouses"],
        "products": cleaning.set_null_dangling_supplier(products, raw["suppliers"]),       # K06
        "sales": cleaning.clean_sales(raw["raw_sales"], products),
        "inventory": cleaning.clean_inventory(raw["raw_inventory"]),
    }


def stage(spark: SparkSession, df: DataFrame, path: str, fmt: str, partition_by=None) -> DataFrame:
    """Write one stage (overwrite) and hand the written table to the next."""
    write_table(df, path, fmt, partition_by=partition_by if fmt == "parquet" else None)
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.schema(df.schema).option("header", True).option("mode", "FAILFAST").csv(path)


def quality_report(cleaned: dict[str, DataFrame], cleaning_report: DataFrame) -> DataFrame:
    """What a database would refuse or the cleaning changed: (source, table_name, rule, violations)
    for keys, NOT NULLs, CHECKs and references of the cleaned tables, and the cleaning report (C12)."""
    def rows(source, df, table, rule, n):
        return df.select(F.lit(source).alias("source"), table.alias("table_name"), rule.alias("rule"), n.cast("long").alias("violations"))

    t = {k: cleaned[k] for k in ("suppliers", "warehouses", "products", "sales", "inventory")}
    c = F.col
    parts = [
        rows("primary key", quality.primary_key_violations(t), c("table_name"), c("key_columns"), c("surplus_rows")),
        rows("not null", quality.not_null_violations(t), c("table_name"), c("column_name"), c("violations")),
        rows("check", quality.check_violations(t), c("table_name"), c("rule_name"), c("violations")),
        rows("foreign key", quality.foreign_key_violations(t), F.split("foreign_key", r"\.")[0], c("foreign_key"), c("violations")),
        rows("cleaning", cleaning_report, c("table_name"), c("check_name"), c("value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run(spark: SparkSession, raw: dict[str, DataFrame], out: str, fmt: str = "parquet",
        category_map: dict | None = None) -> dict[str, str]:
    """Write every stage; later stages read the written output of earlier ones."""
    ship_package(spark)
    layout = {"inventory": ["date"], "sales": ["sale_month"]}
    t: dict[str, DataFrame] = {}
    counted: dict[str, dict] = {}

    def put(name: str, m: measured.Measured) -> None:
        """Writes a cleaned table; its cleaning report is counted by the write."""
        df, seen = measured.observe(m)
        t[name] = stage(spark, df, f"{out}/{name}", fmt, layout.get(name))
        counted[name] = seen.get

    put("suppliers", measured.plain(raw["suppliers"]))
    put("warehouses", measured.plain(raw["warehouses"]))
    m = measured.products(raw["raw_products"], category_map)
    put("products", m._replace(df=cleaning.set_null_dangling_supplier(m.df, raw["suppliers"])))       # K06
    sales, inventory = measured.sales(raw["raw_sales"], t["products"]), measured.inventory(raw["raw_inventory"])
    if fmt == "parquet":        # facts partitioned by date: snapshots by day, sales by month
        # As many files of a month or date as its rows need, and no more.
        months = raw["raw_sales"].groupBy(F.trunc("sale_date", "month")).count().agg(F.max("count")).first()[0] or 0
        dates = raw["raw_inventory"].groupBy("date").count().agg(F.max("count")).first()[0] or 0
        by_month = sales.df.withColumn("sale_month", F.trunc("sale_date", "month"))
        sales = sales._replace(df=cluster(by_month, "sale_month", "sale_id", buckets(spark, months)))
        inventory = inventory._replace(df=cluster(inventory.df, "date", "product_id", buckets(spark, dates)))
    put("sales", sales)
    put("inventory", inventory)
    stage(spark, quality_report(t, measured.report(spark, counted)), f"{out}/quality_report", fmt)
    opt = stage(spark, replenish.optimization_table(t["sales"], t["products"]),
                f"{out}/inventory_optimization", fmt)
    stage(spark, recommend.recommendations(t["inventory"], t["warehouses"], t["suppliers"], opt),
          f"{out}/inventory_recommendations", fmt)
    stage(spark, forecast.evaluation(t["sales"]), f"{out}/forecast_evaluation", fmt)
    names = list(t) + ["quality_report", "inventory_optimization", "inventory_recommendations", "forecast_evaluation"]
    return {n: f"{out}/{n}" for n in names}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--csv", action="store_true")
    a = ap.parse_args()
    from shelfwise.session import get_session
    from shelfwise.sources import testdata
    spark = get_session()
    paths = run(spark, testdata.raw_tables(spark, a.sf_dir), a.out, "csv" if a.csv else "parquet",
                testdata.TEST_CATEGORY_MAP)
    for k, v in paths.items():
        print(k, v)


if __name__ == "__main__":
    main()
