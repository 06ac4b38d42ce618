"""Distinct counts by bitmaps against count_distinct, merged levels, string keys."""

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.functions import distinct
from shelfwise.plans import catalog
from shelfwise.plans.registry import QUERIES


def rows(seed=2):
    rng = random.Random(seed)
    keys = [0, 1, -1, -32768, -32769, 32767, 32768, 32769, 65536, 2 ** 40, -2 ** 40, None] + [rng.randint(-100000, 100000) for _ in range(200)]
    return [(rng.choice(["a", "b", None]), rng.randint(0, 3), rng.choice(keys)) for _ in range(3000)]


def frame(spark):
    return spark.createDataFrame(rows(), "g string, h int, k long").repartition(7)


def plain(by):
    out = {}
    for g, h, k in rows():
        out.setdefault((g, h)[:by], set()).update([] if k is None else [k])
    return {key: len(v) for key, v in out.items() if v}


def test_counts_are_exact(spark):
    got = distinct.counts(distinct.states(frame(spark), ["g", "h"], "k"), ["g", "h"])
    assert {(r["g"], r["h"]): r["n"] for r in got.collect()} == plain(2)


def test_levels_are_merged_not_added(spark):
    got = {}
    for r in distinct.rollup(frame(spark), ["g", "h"], "k").collect():
        got[(r["g"], r["h"])[:r["level"]]] = r["n"]
    assert got == {**plain(2), **plain(1), **plain(0)}


def test_one_state_for_a_group_and_bucket(spark):
    df = spark.range(100000).select((F.col("id") % 3).alias("g"), "id")
    found = distinct.states(df, ["g"], "id")
    assert found.count() == 3 * 4 + 1 and found.agg(F.max(F.length("_bits"))).first()[0] == 4096


def test_string_keys_are_numbered(spark):
    rng = random.Random(1)
    data = [(rng.choice("xyz"), rng.choice([None, "", "é", *[f"sku-{i}" for i in range(300)]])) for _ in range(2000)]
    df = distinct.dense_ids(spark.createDataFrame(data, "g string, s string"), "s", "place")
    assert df.count() == len(data)
    seen = {r["s"]: r["place"] for r in df.collect()}
    names = sorted((s for s in seen if s is not None), key=str.encode)
    assert [seen[s] for s in names] == list(range(1, len(names) + 1)) and seen[None] is None
    got = distinct.counts(distinct.states(df, ["g"], "place"), ["g"])
    assert {r["g"]: r["n"] for r in got.collect()} == {g: len({s for h, s in data if h == g and s is not None}) for g in "xyz"}


def test_empty(spark):
    df = spark.createDataFrame([(None, 1, None)], "g string, h int, k long")
    assert distinct.counts(distinct.states(df, ["g"], "k"), ["g"]).collect() == []
    assert [tuple(r) for r in distinct.counts(distinct.states(df, [], "k"), []).collect()] == [(0,)]


def test_status_counts_are_those_of_q21(spark):
    got = {r["stock_status"]: r["unique_skus"] for r in QUERIES["q21_rollup"](spark, SF_SMALL).where("level = 1").collect()}
    assert got == {r["stock_status"]: r["unique_skus"] for r in QUERIES["q21"](spark, SF_SMALL).collect()}
    products = catalog.load(spark, SF_SMALL).products
    assert QUERIES["q21_rollup"](spark, SF_SMALL).where("level = 0").first()["unique_skus"] == products.count()
