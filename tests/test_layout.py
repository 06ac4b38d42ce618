"""File layout, written tables, sinks and the batch job's quality report."""

import glob
import os
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise import session
from shelfwise.operators import cleaning
from shelfwise.plans import batch, catalog
from shelfwise.sources import files, testdata


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def files_per_value(path):
    return Counter(os.path.basename(os.path.dirname(f)) for f in glob.glob(f"{local(path)}/*/part-*.parquet"))


@pytest.fixture
def small_files(spark):
    spark.conf.set(files.ROWS_PER_FILE, "40")
    yield
    spark.conf.unset(files.ROWS_PER_FILE)


def test_months_and_dates_are_spread(spark, small_files):
    t = catalog.load(spark, SF_SMALL, refresh=True)
    t.all()
    assert max(files_per_value(f"{t._root}/sales").values()) > 1
    assert min(files_per_value(f"{t._root}/inventory").values()) > 1
    before = {n: df.count() for n, df in t.all().items()}
    spark.conf.unset(files.ROWS_PER_FILE)
    t = catalog.load(spark, SF_SMALL, refresh=True)
    assert {n: df.count() for n, df in t.all().items()} == before
    assert set(files_per_value(f"{t._root}/sales").values()) == {1}


def test_only_what_is_asked_for_is_written(spark, tmp_path):
    os.symlink(SF_SMALL, tmp_path / "data")            # a path of its own, so nothing is written yet
    t = catalog.load(spark, str(tmp_path / "data"))
    t.products.count()
    assert sorted(os.listdir(local(t._root))) == ["products", "raw_products"]
    with pytest.raises(AttributeError):
        t.nothing


def test_daily_adds_up_to_sales(spark):
    t = catalog.load(spark, SF_SMALL)
    sums = lambda df, n: df.agg(F.sum("quantity_sold"), F.sum("revenue"), n).first()
    assert sums(t.daily, F.sum("n_sales")) == sums(t.sales, F.count(F.lit(1)))
    assert t.daily.groupBy("product_id", "warehouse_id", "sale_date").count().where("count > 1").count() == 0


def test_no_silent_local_folder():
    def fake(master, folder=None, conf=None):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: folder, setCheckpointDir=lambda d: setattr(sc, "getCheckpointDir", lambda: d))
        return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d: conf or d))

    with pytest.raises(RuntimeError, match="shared folder"):
        session.ensure_checkpoint_dir(fake("spark://host:7077"))
    assert session.ensure_checkpoint_dir(fake("spark://host:7077", conf="hdfs://x/y")) == "hdfs://x/y"
    assert session.ensure_checkpoint_dir(fake("yarn", folder="hdfs://a")) == "hdfs://a"
    assert session.ensure_checkpoint_dir(fake("local[4]")).startswith("/tmp/")
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(fake("local-cluster[2,1,1024]"))


def test_named_tables_hold_regenerated_revenue(spark):
    t = catalog.load(spark, SF_SMALL)
    name = files.create_database(spark, "test of named tables")
    wrong = t.sales.withColumn("revenue", F.lit(-1).cast("decimal(18,2)"))
    frames = {"suppliers": t.suppliers, "warehouses": t.warehouses, "products": t.products, "sales": wrong, "inventory": t.inventory}
    for _ in range(2):                          # a second load replaces the first
        files.load_tables(spark, frames, name)
    got = spark.table(f"{name}.sales")
    assert got.count() == t.sales.count() and got.agg(F.sum("revenue")).first() == t.sales.agg(F.sum("revenue")).first()
    assert {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {name}").collect()} >= set(frames)


def test_rebuild_replaces_every_table(spark):
    t = catalog.load(spark, SF_SMALL)
    a, b = (files.folder_of(spark, x, "rebuild") for x in ("one", "two"))
    assert a != b
    frames = {"products": t.products, "suppliers": t.suppliers}
    files.rebuild(spark, {k: v.limit(3) for k, v in frames.items()}, a)
    out = files.rebuild(spark, frames, a)
    assert {k: v.count() for k, v in out.items()} == {k: v.count() for k, v in frames.items()}


def test_median_is_kept_before_truncation(spark):
    p = spark.createDataFrame([(1, "a", 9.0), (2, "a", 10.0), (3, "a", None), (4, "b", None)], "product_id int, category string, lead_time_days double")
    assert [r["lead_time_days"] for r in cleaning.median_lead_time(p).orderBy("product_id").collect()] == [9.0, 10.0, 9.5, None]
    assert [r["lead_time_days"] for r in cleaning.impute_lead_time(p).orderBy("product_id").collect()] == [9, 10, 9, 7]


def test_batch_reports_what_a_database_would_refuse(spark, tmp_path, small_files):
    raw = testdata.raw_tables(spark, SF_SMALL)
    raw = {k: v.limit(400) if k == "raw_sales" else v for k, v in raw.items()}
    raw["suppliers"] = raw["suppliers"].where("supplier_id <> 1")
    paths = batch.run(spark, raw, str(tmp_path / "out"), category_map=testdata.TEST_CATEGORY_MAP)
    rep = {(r["source"], r["table_name"], r["rule"]): r["violations"] for r in spark.read.parquet(paths["quality_report"]).collect()}
    assert rep["foreign key", "products", "products.supplier_id -> suppliers.supplier_id"] == 0       # set to NULL before
    assert rep["cleaning", "sales", "rows_in"] == 400
    assert {k[0] for k in rep} == {"primary key", "not null", "check", "foreign key", "cleaning"}
    products = spark.read.parquet(paths["products"])
    assert products.where("supplier_id IS NULL").count() > 0 and products.where("supplier_id = 1").count() == 0
    per = files_per_value(paths["inventory"])
    n = raw["raw_products"].count() * raw["warehouses"].count()
    assert 1 < max(per.values()) <= -(-n // 40)
