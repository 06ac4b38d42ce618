"""Constraint checks that keep the rows: what a load accepts, and what it rejects with the rules each row breaks.

The counts of K01-K05 say how many rows break a rule; a load needs the rows.
``tag`` adds an array of broken rules to every row of a table in one scan,
with two kinds of small key lists joined to it: foreign keys without a parent,
and key values that occur more than once.  Both lists of a table whose key has
a date come from its folded keys (``quality.folded_keys``), made in one more
scan.  ``split`` writes the tagged rows into an accepted and a rejected sink.

Of the rows with one key the database would take the first and refuse the
rest.  Here the row that breaks the fewest other rules is taken, then the
least by its columns; the others break ``unique``.  Only rows of repeated keys
are compared, by a partial aggregate over numbered rows, so a key that a third
of all rows have is no single task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.quality import CHECKS, FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, folded_keys, repeated_keys
from shelfwise.sources.files import open_writers, rows_per_file

BROKEN = "broken_rules"


def unique_rule(table: str) -> str:
    return "unique: " + ",".join(PRIMARY_KEYS[table])


def _matches(df: DataFrame, keys: DataFrame, on: dict[str, str]):
    return reduce(lambda a, b: a & b, [df[c].eqNullSafe(keys[k]) for c, k in on.items()])


def orphans(df: DataFrame, column: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """(_orphan): the values of ``column`` that no row of ``parents`` has; rows are counted down to values first."""
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_orphan")).distinct()
    return values.join(parents.select(F.col(parent_key).alias("_parent")), F.col("_orphan") == F.col("_parent"), "left_anti")


def repeated(df: DataFrame, table: str, folded: DataFrame | None = None) -> DataFrame:
    """(_key_0, ...): the key values that more than one row has; nulls are values here, as in K01."""
    keys = [F.col(c).alias(f"_key_{i}") for i, c in enumerate(PRIMARY_KEYS[table])]
    return repeated_keys(df, PRIMARY_KEYS[table], folded).select(*keys, F.lit(True).alias("_contested"))


def tag(tables: dict[str, DataFrame], table: str, keep=lambda keys, name: keys) -> DataFrame:
    """The rows of a table with ``broken_rules`` (all but unique) and ``_contested``: whether other rows have its key.

    NULL passes a check and a foreign key, as in SQL.  ``keep(keys, name)`` may store a key list before it is joined, so
    that the planner knows its size and rows don't travel to meet a short one."""
    df = tables[table]
    columns = df.columns
    rules = [(F.col(c).isNull(), f"not null: {c}") for c in NOT_NULL[table]]
    rules += [(F.coalesce(~F.expr(p), F.lit(False)), f"check: {name}") for t, name, p in CHECKS if t == table]
    folded = folded_keys(df, PRIMARY_KEYS[table])
    folded = folded if folded is None else keep(folded, "keys")
    out = df
    for i, (child, column, parent, key) in enumerate(FOREIGN_KEYS):
        if child == table:
            values = df if folded is None or column not in folded.columns else folded
            without = keep(orphans(values, column, tables[parent], key), f"orphans_{column}").withColumnRenamed("_orphan", f"_orphan_{i}")
            out = out.join(without, F.col(column) == F.col(f"_orphan_{i}"), "left")
            rules.append((F.col(f"_orphan_{i}").isNotNull(), f"foreign key: {child}.{column} -> {parent}.{key}"))
    twice = keep(repeated(df, table, folded), "repeated")
    on = {c: f"_key_{i}" for i, c in enumerate(PRIMARY_KEYS[table])}
    out = out.join(twice, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in on.items()]), "left")
    # Arrays are made for rows that break a rule only, by expressions with generated code (``array_compact`` has none).
    none = F.array().cast("array<string>")
    broken = F.concat(*[F.when(c, F.array(F.lit(name))).otherwise(none) for c, name in rules])
    broken = F.when(reduce(lambda a, b: a | b, [c for c, _ in rules]), broken).otherwise(none)
    return out.select(*columns, broken.alias(BROKEN), F.coalesce("_contested", F.lit(False)).alias("_contested"))


def settle(contested: DataFrame, table: str) -> DataFrame:
    """Rows of repeated keys: one of each stays without the unique rule.  ``_row`` numbers the rows and doesn't change."""
    keys, columns = PRIMARY_KEYS[table], [c for c in contested.columns if c not in (BROKEN, "_row")]
    order = F.struct(F.size(BROKEN).alias("_size"), *columns, "_row")
    stays = contested.groupBy(*keys).agg(F.min(order).alias("_first")).select(F.col("_first._row").alias("_stays"))
    out = contested.join(stays, F.col("_row") == F.col("_stays"), "left")
    rules = F.when(F.col("_stays").isNull(), F.array_append(BROKEN, F.lit(unique_rule(table)))).otherwise(F.col(BROKEN))
    return out.select(*columns, rules.alias(BROKEN))


def split(spark: SparkSession, tables: dict[str, DataFrame], folder: str, names=None) -> None:
    """Writes every table's rows under ``folder/<table>``: ``tagged`` by the first scan, ``settled`` for repeated keys.

    Both are partitioned by ``sink`` (accepted or rejected; in the first also contested), so reading a sink reads its
    files only."""
    sink = F.when(F.size(BROKEN) == 0, "accepted").otherwise("rejected")
    for name in names or tables:
        first = tag(tables, name, lambda keys, kind: _stored(spark, keys, f"{folder}/{name}/{kind}"))
        kept = first.withColumn("sink", F.when(F.col("_contested"), "contested").otherwise(sink))
        kept = kept.withColumn(BROKEN, F.when(F.col("sink") != "accepted", F.col(BROKEN)))      # most rows: a null is written faster than no rules
        # Numbered in the written rows, so that a repeated task can't give one row two numbers below.
        kept = kept.withColumn("_row", F.when(F.col("_contested"), F.expr("uuid()"))).drop("_contested")
        with open_writers(spark):                               # three sinks: no sort of the rows by them
            (kept.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file(spark)).partitionBy("sink")
             .parquet(f"{folder}/{name}/tagged"))
        rows = _read(spark, f"{folder}/{name}/tagged", kept.schema)
        again = settle(rows.where("sink = 'contested'").drop("sink"), name).withColumn("sink", sink)
        again.write.mode("overwrite").partitionBy("sink").parquet(f"{folder}/{name}/settled")


def _stored(spark: SparkSession, keys: DataFrame, path: str) -> DataFrame:
    keys.write.mode("overwrite").parquet(path)
    return _read(spark, path, keys.schema)


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def rows(spark: SparkSession, folder: str, table: str, schema, sink: str) -> DataFrame:
    """What ``split`` has put into a sink of a table with ``schema``; rejected rows carry ``broken_rules``, sorted."""
    with_rules = spark.createDataFrame([], schema).withColumns({BROKEN: F.array().cast("array<string>"), "sink": F.lit("")}).schema
    both = [_read(spark, f"{folder}/{table}/{part}", with_rules).where(F.col("sink") == sink).drop("sink") for part in ("tagged", "settled")]
    out = both[0].unionByName(both[1])
    return out.drop(BROKEN) if sink == "accepted" else out.withColumn(BROKEN, F.array_sort(BROKEN))


def report(spark: SparkSession, folder: str, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rule, violations) of all tables, from the rejected rows alone."""
    parts = [rows(spark, folder, name, df.schema, "rejected").select(F.lit(name).alias("table_name"), F.explode(BROKEN).alias("rule"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionAll, parts).groupBy("table_name", "rule").agg(F.count(F.lit(1)).alias("violations"))
