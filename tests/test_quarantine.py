"""Accepted and rejected rows: a small load with every kind of fault, and the counts of K01-K05."""

import datetime
import os
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import quality, quarantine
from shelfwise.plans import catalog
from shelfwise.plans.registry import QUERIES

DAY = datetime.date(2025, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    money = Decimal("5.00")
    make = spark.createDataFrame
    return {
        "suppliers": make([(1, "S1", 4.0, 0.9), (2, None, 6.0, 0.5), (2, "S2", 3.0, 2.0), (None, "S3", None, None)],
                          "supplier_id long, supplier_name string, rating double, reliability_score double"),
        "warehouses": make([("W1", "One", "X", 100, 5.0), ("W2", "Two", None, 0, -1.0)],
                           "warehouse_id string, warehouse_name string, location string, capacity_sqft long, operational_cost_monthly double"),
        "products": make([(1, "P1", "C", money, money, 1, 3.0, 10), (2, "P2", "C", -money, money, 9, -1.0, 10), (3, "P3", None, None, money, None, 3.0, None)],
                         "product_id long, product_name string, category string, unit_price decimal(12,2), unit_cost decimal(12,2), "
                         "supplier_id long, lead_time_days double, min_order_qty int"),
        "sales": make([("a", DAY, 1, "W1", 5, money, "Online"), ("b", DAY, 1, "W1", 0, money, "Online"), ("c", DAY, 7, "W9", 5, money, "Fax"),
                       ("d", DAY, 1, "W1", 5, money, None), ("d", DAY, 1, "W1", -5, money, "Retail"), ("d", DAY, 1, "W1", 6, money, "Retail"),
                       ("e", DAY, 1, "W1", 5, money, "Retail"), ("e", DAY, 1, "W1", 5, money, "Retail"), ("e", DAY, 1, "W1", 5, money, "Retail"),
                       (None, None, None, "W1", 5, None, "Retail"), (None, DAY, 2, "W1", 5, money, "Retail")],
                      "sale_id string, sale_date date, product_id long, warehouse_id string, quantity_sold int, selling_price_per_unit decimal(12,2), channel string"),
        "inventory": make([(DAY, 1, "W1", 5, None, 0), (DAY, 1, "W1", -5, 1, 0), (DAY, 2, "W1", None, -1, -1), (DAY, 8, "W1", 0, 0, 0)],
                          "date date, product_id long, warehouse_id string, stock_on_hand long, stock_allocated long, stock_on_order long"),
    }


@pytest.fixture(scope="module")
def folder(spark, tables, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("quarantine"))
    quarantine.split(spark, tables, out)
    return out


def sink(spark, folder, tables, name, which):
    return quarantine.rows(spark, folder, name, tables[name].schema, which)


def test_sales(spark, tables, folder):
    bad = [(r["sale_id"], r["quantity_sold"], tuple(r["broken_rules"])) for r in sink(spark, folder, tables, "sales", "rejected").collect()]
    none = "not null: "
    assert Counter(bad) == Counter([
        ("b", 0, ("check: quantity_positive",)),
        ("c", 5, ("check: channel_domain", "foreign key: sales.product_id -> products.product_id", "foreign key: sales.warehouse_id -> warehouses.warehouse_id")),
        ("d", -5, ("check: quantity_positive", "unique: sale_id")), ("d", 6, ("unique: sale_id",)),
        ("e", 5, ("unique: sale_id",)), ("e", 5, ("unique: sale_id",)),
        (None, 5, (none + "product_id", none + "sale_date", none + "sale_id", none + "selling_price_per_unit", "unique: sale_id")),
        (None, 5, (none + "sale_id",))])
    good = sink(spark, folder, tables, "sales", "accepted")
    assert good.columns == tables["sales"].columns
    assert sorted((r["sale_id"], r["quantity_sold"]) for r in good.collect()) == [("a", 5), ("d", 5), ("e", 5)]


def test_every_row_is_in_one_sink(spark, tables, folder):
    for name, df in tables.items():
        both = sink(spark, folder, tables, name, "accepted").unionByName(sink(spark, folder, tables, name, "rejected").drop("broken_rules"))
        assert Counter(map(tuple, both.collect())) == Counter(map(tuple, df.collect()))


def counts(spark, folder, tables):
    return {(r["table_name"], r["rule"]): r["violations"] for r in quarantine.report(spark, folder, tables).collect()}


def of_the_checks(tables):
    out = Counter()
    for r in quality.primary_key_violations(tables).collect():
        out[r["table_name"], "unique: " + r["key_columns"]] += r["surplus_rows"]
    for r in quality.not_null_violations(tables).collect():
        out[r["table_name"], "not null: " + r["column_name"]] += r["violations"]
    for r in quality.check_violations(tables).collect():
        out[r["table_name"], "check: " + r["rule_name"]] += r["violations"]
    for r in quality.foreign_key_violations(tables).collect():
        out[r["foreign_key"].split(".")[0], "foreign key: " + r["foreign_key"]] += r["violations"]
    return {k: v for k, v in out.items() if v}


def test_counts_tie_to_the_checks(spark, tables, folder):
    got = counts(spark, folder, tables)
    assert got == of_the_checks(tables) and len(got) > 20


def test_counts_tie_on_the_test_data(spark):
    folder, tables = catalog.quarantine(spark, SF_SMALL)
    got = counts(spark, folder, tables)
    assert got == of_the_checks(tables) and got["sales", "unique: sale_id"] == 52
    assert QUERIES["k_accepted_sales"](spark, SF_SMALL).count() + QUERIES["k_rejected_sales"](spark, SF_SMALL).count() == tables["sales"].count()


def test_a_key_of_most_rows_leaves_one(spark, tables, tmp_path):
    many = spark.range(5000).select(F.lit("same").alias("sale_id"), F.lit(DAY).alias("sale_date"), F.lit(1).cast("long").alias("product_id"), F.lit("W1").alias("warehouse_id"),
                                    F.lit(5).alias("quantity_sold"), F.lit(Decimal("5.00")).cast("decimal(12,2)").alias("selling_price_per_unit"), F.lit("Online").alias("channel"))
    own = {**tables, "sales": many}
    quarantine.split(spark, own, str(tmp_path), ["sales"])
    assert sink(spark, str(tmp_path), own, "sales", "accepted").count() == 1
    assert sink(spark, str(tmp_path), own, "sales", "rejected").count() == 4999


def test_empty_tables(spark, tables, tmp_path):
    own = {n: df.limit(0) for n, df in tables.items()}
    quarantine.split(spark, own, str(tmp_path))
    assert all(sink(spark, str(tmp_path), own, n, s).count() == 0 for n in own for s in ("accepted", "rejected"))


def test_one_scan_of_all_columns(spark, tables):
    """The other scans of a fact read its key columns alone."""
    t = catalog.load(spark, SF_SMALL)
    own = {"suppliers": t.suppliers, "warehouses": t.warehouses, "products": t.raw_products, "sales": t.raw_sales, "inventory": t.raw_inventory}
    plan = quarantine.tag(own, "sales")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "quantity_sold" in line]
    assert len(scans) == 1


def test_keys_with_a_date_are_folded(spark, tables, tmp_path):
    """Key lists come from a row for each 64 days of the other columns' values; repeated and null keys are found all the same."""
    days = [DAY + datetime.timedelta(k) for k in range(50)]
    grid = [(d, p, w, 5, 0, 0) for d in days for p in (1, 2, 8, None) for w in ("W1", "W9")]
    odd = [(DAY, 1, "W1", 7, 0, 0), (None, 1, "W1", 5, 0, 0), (None, 2, "W1", 5, 0, 0), (None, 2, "W1", 4, 0, 0), (days[-1], None, "W9", 5, 0, 0)]
    own = {**tables, "inventory": spark.createDataFrame(grid + odd, tables["inventory"].schema)}
    quarantine.split(spark, own, str(tmp_path), ["inventory"])
    assert spark.read.parquet(str(tmp_path / "inventory" / "keys")).count() <= 8 * 2 + 2
    got = {(r["table_name"], r["rule"]): r["violations"] for r in quarantine.report(spark, str(tmp_path), {"inventory": own["inventory"]}).collect()}
    assert got == {k: v for k, v in of_the_checks(own).items() if k[0] == "inventory"} and got["inventory", "unique: date,product_id,warehouse_id"] == 3
    good = [tuple(r) for r in sink(spark, str(tmp_path), own, "inventory", "accepted").collect()]
    assert len(good) == 100 and good.count((DAY, 1, "W1", 5, 0, 0)) == 1 and (DAY, 1, "W1", 7, 0, 0) not in good


def test_snapshots_are_split_from_their_plan(spark, tmp_path):
    """The grid isn't written before it is split."""
    os.symlink(SF_SMALL, tmp_path / "data")
    got = sorted(map(tuple, QUERIES["k_report"](spark, str(tmp_path / "data")).collect()))
    t = catalog.load(spark, str(tmp_path / "data"))
    assert "raw_inventory" not in t._done
    folder, own = catalog.quarantine(spark, str(tmp_path / "data"), ["inventory"])
    both = [sink(spark, folder, own, "inventory", s).drop("broken_rules") for s in ("accepted", "rejected")]
    assert Counter(map(tuple, both[0].unionByName(both[1]).collect())) == Counter(map(tuple, t.raw_inventory.collect()))
    assert {(name, rule): n for name, rule, n in got} == of_the_checks({**{n: getattr(t, n) for n in ("suppliers", "warehouses")}, "products": t.raw_products,
                                                                        "sales": t.raw_sales, "inventory": t.raw_inventory})


def test_tagging_has_generated_code(spark, tables):
    plan = quarantine.tag(tables, "inventory", lambda keys, name: keys.limit(0))._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan
