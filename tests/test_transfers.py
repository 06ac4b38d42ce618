"""The transfer plan against a plain two-pointer walk."""

import random
from collections import defaultdict

from conftest import SF_SMALL
from shelfwise.operators.transfers import offers, transfer_plan
from shelfwise.plans.registry import QUERIES

SCHEMA = "product_id long, warehouse_id string, stock_on_hand long, safety_stock long, rop long"


def walk(rows, overstock=4):
    """{product: [(from, to, qty)]}: both queues are served from the front."""
    give, need = defaultdict(list), defaultdict(list)
    for p, w, stock, ss, rop in rows:
        if rop is None or stock is None:
            continue
        if rop > stock:
            need[p].append((stock - rop, w))
        elif ss is not None and stock > overstock * ss:
            give[p].append((overstock * ss - stock, w))
    out = {}
    for p in give.keys() & need.keys():
        g, n = sorted(give[p]), sorted(need[p])
        i = j = 0
        left, miss, plan = -g[0][0], -n[0][0], []
        while True:
            q = min(left, miss)
            plan.append((g[i][1], n[j][1], q))
            left, miss = left - q, miss - q
            if left == 0:
                i += 1
                if i == len(g):
                    break
                left = -g[i][0]
            if miss == 0:
                j += 1
                if j == len(n):
                    break
                miss = -n[j][0]
        out[p] = plan
    return out


def planned(df):
    out = defaultdict(list)
    for r in df.orderBy("product_id", "step").collect():
        out[r["product_id"]].append((r["from_warehouse"], r["to_warehouse"], r["qty"]))
        assert r["step"] == len(out[r["product_id"]])
    return dict(out)


def some(rng, products, warehouses):
    return [(p, f"W{w:04d}", rng.choice([0, 5, 40, 90, rng.randint(0, 300), None]), rng.choice([0, 5, 10, 10, None]), rng.choice([0, 20, 60, 60, 100, None]))
            for p in range(products) for w in range(warehouses) if rng.random() < 0.9]


def test_plan_equals_the_walk(spark):
    for seed in range(4):
        rows = some(random.Random(seed), 60, 7)
        got = planned(transfer_plan(offers(spark.createDataFrame(rows, SCHEMA).repartition(5))))
        assert got == walk(rows) and len(got) > 20


def test_sums_and_bounds_of_a_sku_in_many_warehouses(spark):
    rng = random.Random(7)
    rows = [(1, f"W{w:05d}", rng.randint(0, 400), rng.randint(0, 20), rng.randint(0, 120)) for w in range(6000)] + some(rng, 3, 4)
    df = spark.createDataFrame(rows, SCHEMA)
    plan = transfer_plan(offers(df))
    assert planned(plan) == walk(rows)
    offered = offers(df).groupBy("product_id").pivot("side", ["from", "to"]).agg({"qty": "sum", "warehouse_id": "count"}).collect()
    hot = next(r for r in offered if r["product_id"] == 1)
    got = [r for r in plan.collect() if r["product_id"] == 1]
    assert sum(r["qty"] for r in got) == min(hot["from_sum(qty)"], hot["to_sum(qty)"])
    assert len(got) <= hot["from_count(warehouse_id)"] + hot["to_count(warehouse_id)"] - 1
    assert all(r["from_warehouse"] != r["to_warehouse"] for r in got)


def test_defined_cases(spark):
    rows = [(1, "A", 100, 10, 20), (1, "B", 15, 2, 40),                 # B is over 4 x its safety stock, but below its reorder point
            (2, "A", 10, 1, 10), (2, "B", 10, 5, 10),                   # nobody needs anything
            (3, "A", None, 1, 10), (3, "B", 0, None, 10), (4, "A", 50, 1, None), (4, "B", 0, 1, 10)]
    assert planned(transfer_plan(offers(spark.createDataFrame(rows, SCHEMA)))) == {1: [("A", "B", 25)]}
    assert planned(transfer_plan(offers(spark.createDataFrame([], SCHEMA)))) == {}


def test_plan_never_moves_more_than_the_totals_of_p06(spark):
    totals = {r["product_id"]: r for r in QUERIES["p06"](spark, SF_SMALL).collect()}
    moved = defaultdict(int)
    for r in QUERIES["p06_transfers"](spark, SF_SMALL).collect():
        moved[r["product_id"]] += r["qty"]
    assert moved and all(q <= totals[p]["transfer_qty"] for p, q in moved.items())
