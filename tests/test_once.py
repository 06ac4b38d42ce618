"""Tables that are read once aren't written for that, and keys with a date are folded before they are grouped."""
import collections
import datetime
import os
import random

import pytest

from __spark_entry__ import queries
from shelfwise.operators.quality import primary_key_violations, repeated_keys
from shelfwise.plans.catalog import database, load

SF = "/root/testdata/sf0.001"
KEY = ["date", "product_id", "warehouse_id"]


@pytest.fixture
def fresh(spark, tmp_path):
    """The data folder under a path that no test has used, so its catalog is empty."""
    os.symlink(SF, tmp_path / "sf")
    return str(tmp_path / "sf")


def written_tables(t):
    return {n for n in t.NAMES if n in t._done}


def test_k01_writes_no_fact(spark, fresh):
    got = sorted(map(tuple, queries()["k01"](spark, fresh).collect()))
    t = load(spark, fresh)
    assert not written_tables(t) & {"sales", "inventory", "raw_sales", "raw_inventory"}
    loaded = {n: getattr(t, n) for n in ("suppliers", "warehouses", "products", "sales", "inventory")}
    assert got == sorted(map(tuple, primary_key_violations(loaded).collect()))


def test_daily_is_grouped_without_the_sales_table(spark, fresh):
    t = load(spark, fresh)
    rows = sorted(map(tuple, t.daily.collect()))
    assert "sales" not in written_tables(t)
    again = load(spark, fresh, refresh=True)
    assert again.sales.count() and sorted(map(tuple, again.daily.collect())) == rows       # from the written table


def test_database_is_filled_without_the_catalog(spark, fresh):
    name = database(spark, fresh)
    t = load(spark, fresh)
    assert not written_tables(t) & {"sales", "inventory"}
    for table in ("suppliers", "warehouses", "products", "sales", "inventory"):
        stored = spark.table(f"{name}.{table}")
        assert stored.columns == getattr(t, table).columns
        assert stored.exceptAll(getattr(t, table)).isEmpty() and stored.count() == getattr(t, table).count()


@pytest.mark.parametrize("n, days", [(60, 400), (400, 30), (300, 3), (0, 1)])
def test_repeated_keys_are_those_that_occur_more_than_once(spark, n, days):
    r = random.Random(n)
    first = datetime.date(1969, 11, 1)
    rows = [(r.choice([None, *[first + datetime.timedelta(days=k) for k in range(days)]]), r.choice([1, 2, None]), r.choice(["a", None])) for _ in range(n)]
    df = spark.createDataFrame(rows, "date date, product_id int, warehouse_id string")
    assert {tuple(x)[:3]: x["_c"] for x in repeated_keys(df, KEY).collect()} == {k: c for k, c in collections.Counter(rows).items() if c > 1}


def test_days_without_repeats_come_down_to_nothing(spark):
    rows = [(datetime.date(2020, 1, 1) + datetime.timedelta(days=k), p, "W") for k in range(60) for p in range(20)]
    out = repeated_keys(spark.createDataFrame(rows, "date date, product_id int, warehouse_id string"), KEY)
    assert out.isEmpty()
    assert "LocalTableScan" in out._jdf.queryExecution().optimizedPlan().toString() or "LocalRelation" in out._jdf.queryExecution().optimizedPlan().toString()
