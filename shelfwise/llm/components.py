"""Connected components of a link table by large-star and small-star steps.

The links stay distributed; every step is a partial aggregate (the smallest
neighbour of a node) and a join, written to the shared folder.  The steps
halve distances, so long chains of links need few of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import written


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each pair with the smallest of u and all partners of u."""
    m = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return pairs.join(m, F.col("u") == F.col("w")).drop("w")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (x, y): component is the smallest node reachable."""
    e = links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u <> v").distinct()
    e = written(spark, e, "links")
    last = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        big = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _least(big)
        e = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(small.select("u", F.col("m").alias("v")))
        e = written(spark, e.where("u <> v").distinct(), "links")
        # Stars that no step changes any more: a fixed number of edges with fixed sums.
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == last:
            break
        last = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return written(spark, e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots), "components")
