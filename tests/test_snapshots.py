"""The snapshot grid and the sales plan: their rows, and what travels on the way to them."""

import datetime as dt
import os

import pytest

from conftest import SF_SMALL
from shelfwise.operators import quarantine
from shelfwise.plans import catalog
from shelfwise.plans.registry import QUERIES
from shelfwise.sources import files, testdata

DAY = dt.date(2024, 3, 1)


@pytest.fixture
def base(spark):
    """Parts that come twice or have no key, sales without a part or region, several a day, before and in the window."""
    items = [(1, 1, 5.0, 0), (1, 1, 2.0, 0), (1, 1, 4.0, 3), (2, 1, 7.0, 3), (1, 2, None, 1), (3, None, 9.0, 2), (1, 3, 500.0, 5), (2, 2, 3.0, -70), (4, 2, 8.0, 4),
             (9, 2, 8.0, 4), (2, 1, 1.0, 5)]
    return {
        "region": spark.createDataFrame([(0, "a"), (1, "b"), (None, "c")], "r_regionkey int, r_name string"),
        "nation": spark.createDataFrame([(0, 0), (1, 1), (2, None)], "n_nationkey int, n_regionkey int"),
        "customer": spark.createDataFrame([(10, 0), (11, 1), (12, 2)], "c_custkey long, c_nationkey int"),
        "orders": spark.createDataFrame([(1, 10, "1-URGENT"), (2, 11, None), (3, 10, "5-LOW"), (4, 12, "2-HIGH")], "o_orderkey long, o_custkey long, o_orderpriority string"),
        "part": spark.createDataFrame([(1, 5, 10.0), (1, 30, 10.0), (2, 1, 20.0), (3, None, 30.0), (None, 2, 40.0)], "p_partkey long, p_size int, p_retailprice double"),
        "lineitem": spark.createDataFrame([(o, 1, p, 1, q, 0.1, dt.datetime.combine(DAY + dt.timedelta(d), dt.time())) for o, p, q, d in items],
                                          "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_shipdate timestamp"),
    }


def walk(b):
    """The snapshots by plain loops."""
    rows = {n: df.collect() for n, df in b.items()}
    region = {r.n_nationkey: r.n_regionkey for r in rows["nation"]}
    place = {o.o_orderkey: region[{c.c_custkey: c.c_nationkey for c in rows["customer"]}[o.o_custkey]] for o in rows["orders"]}
    days = sorted({r.l_shipdate.date() for r in rows["lineitem"]})
    days = [d for d in days if d > days[-1] - dt.timedelta(60)]
    out = []
    for p in rows["part"]:
        for rk in sorted(r.r_regionkey for r in rows["region"] if r.r_regionkey is not None):
            for day in days:
                pk, size = p.p_partkey, p.p_size
                sold = sum(r.l_quantity or 0 for r in rows["lineitem"] if r.l_partkey == pk and r.l_orderkey in place and place[r.l_orderkey] == rk
                           and days[0] <= r.l_shipdate.date() <= day)
                oh = int(max(0, (pk * 37 + rk * 101) % 200 - sold)) if pk is not None else 0
                out.append((day, pk, f"WH0{rk + 1}", -5 if pk is not None and (pk * 5 + rk) % 401 == 0 else oh,
                            None if pk is None else oh * ((pk + rk) % 16) // 100,
                            50 if pk is not None and size is not None and (pk + rk) % 3 == 0 and oh < 2.5 * (3 + size % 19) else 0))
    return sorted(out, key=str)


def test_snapshots_by_a_plain_walk(spark, base):
    assert sorted(map(tuple, testdata.raw_inventory(base).collect()), key=str) == walk(base)


def test_the_grid_is_not_shuffled_or_sorted(spark):
    """Nothing but projections above the unfolded dates; the part row is what travels."""
    plan = testdata.raw_tables(spark, SF_SMALL)["raw_inventory"]._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.rindex("Generate explode(slice(")] if "Generate explode(slice(" in plan else plan
    assert "Generate" in plan and not [w for w in ("Exchange", "Sort", "Window") if w in above]


def test_line_items_travel_twice(spark):
    """To their orders and to their parts; equal rows are then grouped, and priced, where they lie."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    with files.settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        plan = catalog.build(spark, SF_SMALL)["sales"]._jdf.queryExecution().executedPlan().toString().split("\n")
    assert {k: spark.conf.get(k) for k in before} == before
    depth = [(len(x) - len(x.lstrip(" :+-|*()0123456789")), x) for x in plan]
    item = next(i for i, (_, x) in enumerate(depth) if "FileScan" in x and "l_orderkey" in x)
    path, at = [], depth[item][0]
    for d, x in reversed(depth[:item]):
        if d < at:
            path, at = [*path, x], d
    assert sum("Exchange" in x for x in path) == 2


def test_a_query_over_clean_tables_writes_no_raw_fact(spark, tmp_path):
    os.symlink(SF_SMALL, tmp_path / "data")
    t = catalog.load(spark, str(tmp_path / "data"))
    assert t.inventory.count() == t.raw_inventory.count() and t.sales.count() == t.raw_sales.dropDuplicates().count()
    again = catalog.load(spark, str(tmp_path / "data"), refresh=True)
    assert again.inventory.count() and again.sales.count()
    assert not {"raw_inventory", "raw_sales"} & set(again._done)


def test_quarantine_splits_what_is_asked_for(spark, tmp_path):
    """One table's sinks write no other fact; short key lists are stored first, so that rows don't travel to meet them."""
    os.symlink(SF_SMALL, tmp_path / "data")
    folder, tables = catalog.quarantine(spark, str(tmp_path / "data"), ["sales"])
    assert list(tables) == ["sales"]
    assert sorted(os.listdir(folder.removeprefix("file://").removeprefix("file:"))) == ["sales"]
    t = catalog.load(spark, str(tmp_path / "data"))
    assert "raw_inventory" not in t._done
    own = {"sales": t.raw_sales, "products": t.raw_products, "warehouses": t.warehouses}
    n = iter(range(9))
    plan = quarantine.tag(own, "sales", lambda keys, name: quarantine._stored(spark, keys, str(tmp_path / f"{next(n)}")))
    assert "Exchange hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()


def test_query_by_sku_makes_the_tables_it_reads(spark, tmp_path):
    os.symlink(SF_SMALL, tmp_path / "data")
    QUERIES["q38_by_sku"](spark, str(tmp_path / "data")).count()
    assert set(catalog.co_located(spark, str(tmp_path / "data"))._done) == {"daily", "products"}
    assert "inventory" not in catalog.load(spark, str(tmp_path / "data"))._done
    with pytest.raises(KeyError):
        catalog.co_located(spark, str(tmp_path / "data"))["sales"]


def test_csv_sink_is_compressed_and_whole(spark):
    t, root = catalog.load(spark, SF_SMALL), catalog.csv_export(spark, SF_SMALL)
    names = os.listdir(f"{root}/inventory.csv".removeprefix("file://").removeprefix("file:"))
    assert [n for n in names if n.endswith(".csv.gz")] and not [n for n in names if n.endswith(".csv")]
    back = files.read_csv_tables(spark, root, schemas={n: getattr(t, n).schema for n in files.FK_ORDER})
    assert {n: df.count() for n, df in back.items()} == {n: getattr(t, n).count() for n in files.FK_ORDER}
    assert back["sales"].exceptAll(t.sales).isEmpty()
