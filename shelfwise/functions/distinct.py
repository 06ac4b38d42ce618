"""Exact distinct counts that can be merged: bitmaps of integer keys.

``count_distinct`` shuffles every (group, key) pair and its result can't be added up over groups.  Here the keys of a
group are bits: one state of 4 KB per (group, 32,768 neighbouring keys), built by a partial aggregate, merged by OR for
any coarser grouping, counted at the end.  This is for dense integer keys; a state costs 4 KB even for a single key, so
far-spread ones are numbered first (``dense_ids``), as are strings.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.ordering import prefix_sum


def states(df: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """(by..., _bucket, _bits): the keys of each group as bitmaps.  NULL keys don't count; a NULL group is a group."""
    return (df.where(F.col(key).isNotNull())
            .groupBy(*by, F.bitmap_bucket_number(F.col(key).cast("long")).alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key).cast("long"))).alias("_bits")))


def merge(found: DataFrame, by: Sequence[str]) -> DataFrame:
    """The states of a coarser grouping."""
    return found.groupBy(*by, "_bucket").agg(F.bitmap_or_agg("_bits").alias("_bits"))


def counts(found: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    """(by..., name): the number of different keys."""
    return found.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("_bits")), F.lit(0)).alias(name))


def rollup(df: DataFrame, by: Sequence[str], key: str, name: str = "n") -> DataFrame:
    """(by..., name) for ``by``, for ``by`` without its last column, ... and for all rows; columns left out are NULL.

    The table is read once; every coarser level is made from the states of the finer one."""
    by, level, out = list(by), states(df, by, key), []
    types = dict(df.select(*by).dtypes)
    for n in range(len(by), -1, -1):
        level = level if n == len(by) else merge(level, by[:n])
        out.append(counts(level, by[:n], name).select(*by[:n], *[F.lit(None).cast(types[c]).alias(c) for c in by[n:]], F.lit(n).alias("level"), name))
    return reduce(DataFrame.unionByName, out)


def dense_ids(df: DataFrame, key: str, id_col: str) -> DataFrame:
    """``df`` with the place (from 1) of its key among the different keys in order; NULL keys get none.

    Keys are numbered by a distributed running count, so none of them passes one task or the driver."""
    keys = df.select(F.col(key).alias("_key")).where("_key IS NOT NULL").distinct()
    numbered = prefix_sum(keys, ["_key"], {id_col: F.lit(1)})
    return df.join(numbered.select("_key", id_col), F.col(key) == F.col("_key"), "left").drop("_key")
