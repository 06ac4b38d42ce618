"""Exact quantiles by distributed selection: histograms of a fixed size are refined around the wanted ranks.

The first pass counts values in bins of their binary order of magnitude (``PER_OCTAVE`` bins an octave) with each bin's
smallest and largest value; a bin of one value is an answer.  A wanted rank in a wider bin is looked for in the next
pass, among ``FINE`` equal bins between that bin's smallest and largest value.  Bins keep the order of values, so counts
below a bin are exact; each pass narrows a bin by ``FINE``, so doubles need five passes at the most, and whole numbers
below ``PER_OCTAVE`` or so need one.

A task holds counts of bins, never values: at most ``2 * 2100 * PER_OCTAVE`` of them for a column (the range of doubles),
a few hundred for usual data.  NULL and NaN are left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import ensure_checkpoint_dir

PER_OCTAVE = 64
FINE = 4096


def _octave(x: Column) -> Column:
    """A number that never falls as ``x`` rises; infinities lie beyond all others."""
    size = F.least(F.log2(F.abs(x) + 1.0), F.lit(2000.0))
    return F.floor(F.when(x < 0, -size).otherwise(size) * PER_OCTAVE).cast("int")


def _fine(x: Column, lo: Column, hi: Column) -> Column:
    """The place of ``x`` among ``FINE`` equal parts from lo to hi; infinite ends keep parts of their own."""
    part = F.floor(F.try_divide(x / 2 - lo / 2, hi / 2 - lo / 2) * FINE)
    return F.when(x <= lo, 0).when(x >= hi, FINE + 1).otherwise(F.coalesce(F.least(part, F.lit(FINE)), F.lit(1))).cast("int")


def _values(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    x = F.col(value).cast("double")
    return df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))


def _bins(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))


def quantiles(df: DataFrame, value: str, probs: Sequence[float]) -> tuple[int, list[float | None]]:
    """(number of values, the interpolated quantile of each of ``probs``) of one column; the driver sees bins only."""
    base = _values(df, value)
    found = sorted((r["_lo"], r["_hi"], r["_c"]) for r in _bins(base, _octave(F.col("_x")).alias("_bin")).collect())
    n = sum(c for _, _, c in found)
    if not n:
        return 0, [None] * len(probs)
    wanted = {r: None for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}
    spans = [(found, 0)]                                  # bins in order, and how many values lie before them
    while spans:
        open_: dict[tuple[float, float], int] = {}
        for bins, before in spans:
            for lo, hi, c in bins:
                for rank, known in wanted.items():
                    if known is None and before <= rank < before + c:
                        if lo == hi:
                            wanted[rank] = lo
                        else:
                            open_[lo, hi] = before
                before += c
        spans = []
        if open_:
            # The spans don't overlap, so a value lies in one of them.
            which, place = F.lit(None).cast("int"), F.lit(None).cast("int")
            for i, (lo, hi) in enumerate(open_):
                inside = F.col("_x").between(lo, hi)
                which = F.when(inside, i).otherwise(which)
                place = F.when(inside, _fine(F.col("_x"), F.lit(lo), F.lit(hi))).otherwise(place)
            rows = _bins(base.select("_x", which.alias("_span"), place.alias("_bin")).where("_span IS NOT NULL"), "_span", "_bin").collect()
            for i, before in enumerate(open_.values()):
                spans.append((sorted((r["_lo"], r["_hi"], r["_c"]) for r in rows if r["_span"] == i), before))
    return n, [_between(p * (n - 1), wanted) for p in probs]


def _between(at: float, values: dict[int, float]) -> float:
    lo, hi = values[math.floor(at)], values[math.ceil(at)]
    return lo if lo == hi else lo + (hi - lo) * (at - math.floor(at))


def grouped_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """(by..., n, a column of ``names`` per probability): exact quantiles of each group, all groups at once.

    Groups stay distributed; after each pass the open ranks (a few rows a group) are written to the checkpoint folder.
    A group without values has no row; a NULL key is a group.
    """
    by = list(by)
    ensure_checkpoint_dir(df.sparkSession)
    base = _values(df, value, by)
    order = Window.partitionBy(*by, "_from").orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_from") + F.coalesce(F.sum("_c").over(order), F.lit(0))
    first = _bins(base, *by, _octave(F.col("_x")).alias("_bin")).withColumns(
        {"_from": F.lit(0).cast("long"), "_n": F.sum("_c").over(Window.partitionBy(*by))}).withColumn("_below", below)
    at = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(a), F.ceil(a)) for a in at])))
    state = first.withColumn("_rank", F.explode(ranks))
    done = None
    while True:
        state = (state.where((F.col("_rank") >= F.col("_below")) & (F.col("_rank") < F.col("_below") + F.col("_c")))
                 .select(*by, "_n", "_rank", "_below", "_lo", "_hi").checkpoint())
        ready = state.where("_lo = _hi")
        done = ready if done is None else done.unionByName(ready)
        if state.where("_lo < _hi").isEmpty():
            break
        names_in = {k: f"_k{i}" for i, k in enumerate(by)}
        spans = state.where("_lo < _hi").select(*[F.col(k).alias(a) for k, a in names_in.items()], F.col("_below").alias("_from"),
                                                F.col("_lo").alias("_a"), F.col("_hi").alias("_b"))
        same = [F.col(k).eqNullSafe(F.col(a)) for k, a in names_in.items()] + [F.col("_x").between(F.col("_a"), F.col("_b"))]
        inside = base.join(spans.distinct(), same).withColumn("_bin", _fine(F.col("_x"), F.col("_a"), F.col("_b")))
        bins = _bins(inside, *by, "_from", "_bin").withColumn("_below", below)
        open_ranks = state.where("_lo < _hi").select(*[F.col(k).alias(a) for k, a in names_in.items()], "_n", "_rank", F.col("_below").alias("_f"))
        state = bins.join(open_ranks, [F.col(k).eqNullSafe(F.col(a)) for k, a in names_in.items()] + [F.col("_from") == F.col("_f")])
    picked = done.groupBy(*by).agg(F.max("_n").alias("_n"), F.map_from_entries(F.collect_list(F.struct("_rank", "_lo"))).alias("_at"))
    out = {}
    for name, a in zip(names, at):
        lo, hi = F.element_at("_at", F.floor(a)), F.element_at("_at", F.ceil(a))
        out[name] = F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (a - F.floor(a)))
    return picked.select(*by, F.col("_n").alias("n"), *[v.alias(k) for k, v in out.items()])
