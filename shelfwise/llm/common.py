"""Helpers shared by the text operators: reading, written tables, words."""

from __future__ import annotations

import ctypes
import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import app_id, shared_dir, ship_package

#: The word classes of the query contracts, as regular expressions.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
ALNUM_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ALNUM_GAP_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _trim() -> None:
    """Lets go of what a step has left in the driver's Python, and so of the plans that it holds in the JVM."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):            # not glibc
        pass


def written(spark: SparkSession, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back; ``codec``: else the session's.

    Cuts the lineage at a place that survives lost executors.  The folder is
    new for every call, so a changed input is never answered from an old table.
    """
    path = shared_dir(spark, "llm", app_id(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path, compression=codec)
    _trim()
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would also fold other letters)."""
    return F.translate(c, UPPER, UPPER.lower())


def space_words(c: Column) -> Column:
    """Words between ASCII white space, in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), SPACE_CLASS), "")


def alnum_words(c: Column) -> Column:
    """Lower-cased runs of digits, letters and non-ASCII characters; a null text has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(c, F.lit(""))), ALNUM_GAP), "")


def count_alnum_words(c: Column) -> Column:
    """How many ``alnum_words`` a text has; lower-casing doesn't change that."""
    return F.size(F.array_remove(F.split(F.coalesce(c, F.lit("")), ALNUM_GAP_ANY_CASE), "")).cast("long")


def fresh(name: str, *dfs: DataFrame) -> str:
    """``name``, with underscores until no table has such a column."""
    while any(name in d.columns for d in dfs):
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
