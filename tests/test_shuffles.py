"""What is read and shuffled: de-duplication by digest, and the newest snapshot from partition names."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import cleaning, views
from shelfwise.plans import catalog
from shelfwise.sources import files


def nodes(plan):
    """All physical operators of an executed plan, through adaptive stages."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from nodes(plan.executedPlan())
    elif "QueryStage" in name:
        yield from nodes(plan.plan())
    else:
        yield plan
        for i in range(plan.children().size()):
            yield from nodes(plan.children().apply(i))


def shuffled(df):
    """Rows of a result, and the bytes that its exchanges hold."""
    rows = df.collect()
    seen = {}
    for n in nodes(df._jdf.queryExecution().executedPlan()):
        if n.nodeName() == "Exchange":
            seen[n.id()] = n.metrics().apply("dataSize").value()
    return rows, sum(seen.values())


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """Rows of some 200 bytes, one in a hundred of them twice."""
    path = str(tmp_path_factory.mktemp("wide") / "rows")
    base = spark.range(0, 20000, 1, 6).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("text"), (F.col("id") % 7).alias("k"))
    base.unionByName(base.where("id % 100 = 0")).write.parquet(path)
    return spark.read.parquet(path)


def test_digests_shuffle_a_fraction_of_the_bytes(wide):
    rows, whole = shuffled(wide.dropDuplicates())
    got, few = shuffled(cleaning.dedupe_by_digest(wide))
    assert Counter(map(tuple, got)) == Counter(map(tuple, rows)) and len(rows) == 20000
    assert few < 0.25 * whole


def test_rows_that_share_a_digest_stay(spark):
    rows = [(1, "a", None), (1, "a", None), (2, "b", 1.0), (2, None, 1.0), (None, "b", 1.0), (None, "b", 1.0), (3, "c", 2.0)]
    df = spark.createDataFrame(rows, "x int, y string, z double")
    for digest in (None, F.lit(1), F.pmod(F.xxhash64("x"), F.lit(2))):
        got = cleaning.dedupe_by_digest(df, digest).collect()
        assert Counter(map(tuple, got)) == Counter(set(rows))


def test_digest_dedupe_equals_the_plain_one_on_the_test_data(spark):
    raw = catalog.load(spark, SF_SMALL).raw_sales
    a, b = cleaning.dedupe_by_digest(raw), cleaning.dedupe_sales(raw)
    assert a.count() == b.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert cleaning.dedupe_by_digest(raw.limit(0)).count() == 0


def test_newest_snapshot_reads_one_date(spark):
    t = catalog.load(spark, SF_SMALL)
    newest = t.inventory.agg(F.max("date")).first()[0]
    assert t.snapshot_date() == str(newest)
    by_name, by_query = views.latest_snapshot(t.inventory, t.snapshot_date()), views.latest_snapshot(t.inventory)
    assert by_name.exceptAll(by_query).isEmpty() and by_query.exceptAll(by_name).isEmpty()
    by_name.collect()
    scans = [n for n in nodes(by_name._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan parquet")]
    assert [n.metrics().apply("numPartitions").value() for n in scans] == [1]


def test_partitions_without_rows_are_passed_over(spark, tmp_path):
    path = str(tmp_path / "inventory")
    df = spark.createDataFrame([("2025-01-01", 1), ("2025-01-02", 2), (None, 3)], "day string, n int").withColumn("date", F.to_date("day")).drop("day")
    df.write.partitionBy("date").parquet(path)
    df.where("n < 0").drop("date").write.parquet(f"{path}/date=2025-01-09")
    (tmp_path / "inventory" / "date=2025-01-10").mkdir()
    assert files.newest_partition(spark, path, "date") == "2025-01-02"
    assert files.newest_partition(spark, str(tmp_path / "nothing"), "date") is None
