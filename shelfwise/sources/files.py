"""CSV/Parquet scans, table sinks, named tables and load checks."""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import app_id, shared_dir
from shelfwise.sources import versions
from shelfwise.sources.schema import FK_ORDER, RAW_SCHEMAS


def read_csv_tables(spark: SparkSession, directory: str, names=FK_ORDER,
                    schemas: dict | None = None) -> dict[str, DataFrame]:
    """Header CSV scan of the five tables with explicit schemas
    (``schemas`` overrides the reference layout, e.g. numeric keys)."""
    out = {}
    for name in names:
        schema = (schemas or {}).get(name) or RAW_SCHEMAS[name]()
        out[name] = (spark.read.schema(schema)
                     .option("header", True).option("mode", "FAILFAST")
                     .csv(f"{directory}/{name}.csv"))
    return out


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None, options: dict | None = None) -> None:
    """Overwrite one table.  Parquet by default; facts may be
    partitioned (inventory by date) so that date filters prune files."""
    w = df.write.mode("overwrite").options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """SQL settings for the plans that run inside, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def open_writers(spark: SparkSession, n: int = 100):
    """Partitioned writes inside keep ``n`` files of a task open instead of sorting its rows by partition (more values: the rest is sorted)."""
    return settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(n)})


ROWS_PER_FILE = "shelfwise.layout.rowsPerFile"


def buckets(spark: SparkSession, rows: int) -> int:
    """Files that ``rows`` rows of one partition value need: at most
    ``shelfwise.layout.rowsPerFile`` (default 4 million) in each."""
    return max(1, -(-rows // rows_per_file(spark)))


def rows_per_file(spark: SparkSession) -> int:
    return int(spark.conf.get(ROWS_PER_FILE, "4000000"))


def cluster(df: DataFrame, key: str, spread: str, n_buckets: int) -> DataFrame:
    """Rows of one ``key`` value in ``n_buckets`` places of the shuffle, by the
    hash of ``spread``: a write partitioned by ``key`` then makes at most so
    many files of each value, and a large value is no single task."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_buckets)
    return df.repartition(n, F.col(key), F.pmod(F.xxhash64(spread), F.lit(n_buckets)))


def write_bucketed(spark: SparkSession, df: DataFrame, table: str, key: str, n_buckets: int) -> DataFrame:
    """``df`` as a table whose rows lie in ``n_buckets`` files by the hash of ``key``, sorted by it.

    Tables with the same number of buckets join on ``key``, and group by it, where they lie."""
    (df.repartition(n_buckets, key).write.mode("overwrite").bucketBy(n_buckets, key).sortBy(key).format("parquet").saveAsTable(table))
    return spark.table(table)


def newest_partition(spark: SparkSession, path: str, column: str):
    """The greatest value of the partition column of a Parquet table, by the names of its folders; None without rows.

    Files are only opened to pass over partitions without rows.  ISO dates sort as text."""
    names = [n.split("=", 1)[1] for n in versions.list_names(spark, path) if n.startswith(f"{column}=")]
    table = spark.read.parquet(path) if names else None
    for value in sorted((n for n in names if not n.startswith("__HIVE_")), reverse=True):
        found = table.where(F.col(column).cast("string") == value) if dict(table.dtypes)[column] == "string" else table.where(
            F.col(column) == F.lit(value).cast(dict(table.dtypes)[column]))
        if not found.select(F.lit(1)).isEmpty():
            return value
    return None


def load_tables(spark: SparkSession, tables: dict[str, DataFrame], database: str | None = None) -> None:
    """Register cleaned tables under their names in FK order.

    The stored ``revenue`` of sales is dropped and regenerated from
    quantity x price (the generated column of the DDL)."""
    for name in FK_ORDER:
        if name not in tables:
            continue
        df = tables[name]
        if name == "sales":
            df = df.drop("revenue").withColumn(
                "revenue", (F.col("quantity_sold") * F.col("selling_price_per_unit")).cast("decimal(18,2)"))
        if database:
            df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
        else:
            df.createOrReplaceTempView(name)


def folder_of(spark: SparkSession, data: str, kind: str) -> str:
    """A folder for tables made from the data folder ``data`` in this application."""
    return shared_dir(spark, kind, app_id(spark), hashlib.sha1(data.encode()).hexdigest()[:12])


def create_database(spark: SparkSession, data: str) -> str:
    """A database for the tables of the data folder ``data``, kept in the shared folder."""
    name = "shelfwise_" + hashlib.sha1((app_id(spark) + data).encode()).hexdigest()[:12]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{folder_of(spark, data, 'database')}'")
    return name


def rebuild(spark: SparkSession, tables: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Every table written anew and committed as one version (see ``versions``); returns the tables read back."""
    versions.rebuild(spark, tables, folder)
    return versions.read(spark, folder)


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    """Named business views as temp views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count (UNION ALL of counts)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
