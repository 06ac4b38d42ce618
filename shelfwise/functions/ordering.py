"""Global orderings that stay distributed.

``top_k`` is ORDER BY ... LIMIT k with a deterministic tie-break; Spark
plans it as TakeOrderedAndProject (k rows per task, merged once).

``prefix_sum`` is a running total over a *global* order (cumulative
revenue share, Pareto curves).  A ``Window.orderBy`` without
``partitionBy`` would pull every row into one task, so instead:

1. range-partition the rows on the order key (equal keys land in the
   same partition, which keeps SQL RANGE-frame ties together);
2. materialise the partition id with a reliable checkpoint, so the ids
   cannot change between the two uses below;
3. total each partition (one row per partition) and turn the totals
   into exclusive offsets -- this side is bounded by the partition count,
   so broadcasting it is safe;
4. run the running sum inside each partition and add its offset.

In RANGE mode the rows are first collapsed to one row per distinct order
key, so a key value shared by a third of the rows cannot overload the
partition that holds it; the cumulative value is joined back by key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import ensure_checkpoint_dir


def top_k(df: DataFrame, order: Sequence[Column | str], k: int | None) -> DataFrame:
    """First ``k`` rows by ``order`` (callers append a unique key as tie-break); all of them for None."""
    out = df.orderBy(*order)
    return out if k is None else out.limit(k)


def _running(df: DataFrame, order: Sequence[str], vals: dict, frame: str, n: int | None) -> DataFrame:
    """Running sums of ``vals`` over ``order`` with per-partition offsets."""
    order = [_sort(o) for o in order]
    # Without an explicit count AQE sizes the range partitions from the data;
    # the checkpoint then pins whichever partition ids this run produced.
    parted = df.repartitionByRange(n, *order) if n else df.repartitionByRange(*order)
    ranged = (parted
                .withColumn("_pid", F.spark_partition_id())
                .checkpoint(eager=True))
    totals = ranged.groupBy("_pid").agg(*[F.sum(k).alias(f"_t_{k}") for k in vals])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in vals])
    w = Window.partitionBy("_pid").orderBy(*order)
    w = (w.rangeBetween(Window.unboundedPreceding, Window.currentRow) if frame == "range"
         else w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = ranged.join(F.broadcast(offsets), "_pid")     # offsets: one row per partition
    for k in vals:
        out = out.withColumn(f"_cum_{k}", F.sum(k).over(w) + F.col(f"_o_{k}"))
    return out.drop("_pid", *[f"_o_{k}" for k in vals])


def prefix_sum(df: DataFrame, order: Sequence[str], sums: Mapping[str, Column | str],
               frame: str = "range", num_partitions: int | None = None) -> DataFrame:
    """Add one running-sum column per entry of ``sums`` over the global ``order``.

    ``order`` holds column names; a leading ``-`` sorts that column descending.
    ``frame="range"`` gives SQL's default frame (rows with equal order keys
    share one cumulative value); ``frame="rows"`` is a row-wise cumulative
    sum and needs a unique tie-break as the last order column.

    In RANGE mode rows are first aggregated per distinct order key, so a
    key shared by a large share of the rows becomes a single row before
    the range partitioning; its cumulative value is joined back.
    """
    if frame not in ("range", "rows"):
        raise ValueError(f"frame must be 'range' or 'rows', not {frame!r}")
    ensure_checkpoint_dir(df.sparkSession)
    n = num_partitions
    vals = {name: (F.col(v) if isinstance(v, str) else v) for name, v in sums.items()}
    inputs = {f"_v_{k}": v for k, v in vals.items()}
    base = df.select("*", *[v.alias(k) for k, v in inputs.items()])

    if frame == "rows":
        out = _running(base, order, inputs, "rows", n)
    else:
        keys = [o.lstrip("-") for o in order]
        per_key = base.groupBy(*keys).agg(*[F.sum(k).alias(k) for k in inputs])
        cum = _running(per_key, order, inputs, "range", n).select(
            *[F.col(k).alias(f"_key_{k}") for k in keys], *[f"_cum_{k}" for k in inputs])
        on = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]       # a NULL key is a group too
        out = base.join(cum, on).drop(*[f"_key_{k}" for k in keys])
    for name in vals:
        out = out.withColumn(name, F.col(f"_cum__v_{name}"))
    return out.drop(*inputs, *[f"_cum_{k}" for k in inputs])


def _sort(o: str) -> Column:
    """'-x' -> x descending, 'x' -> x ascending."""
    return F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc()
