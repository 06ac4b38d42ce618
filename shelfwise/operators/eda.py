"""The datasets behind the exploratory charts (drawing is not built).

Distribution statistics stay distributed: the histogram is a bin id per
row plus a count; the kernel density first collapses equal values to
(value, weight) and then sums weighted contributions to a fixed grid
(each distinct value explodes into ``gridsize`` terms, partial-aggregated
per task, so only ``gridsize`` rows per task are shuffled); quartiles are
selected by histograms of a fixed size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import money, ratio, round_half_up
from shelfwise.functions.selection import grouped_quantiles, quantiles
from shelfwise.operators.sales import month_of

HIST_BINS = 30
KDE_GRID = 200
CORR_COLUMNS = ["unit_price", "unit_cost", "lead_time_days", "min_order_qty"]
# The plotting window of the supplier scatter.
SCATTER_X = (0.70, 1.0)
SCATTER_Y = (2.5, 5.2)
PARETO_CUTOFF = 80.0


def enriched_sales(sales: DataFrame, products: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Sales LEFT JOIN products LEFT JOIN warehouses."""
    return sales.join(products, "product_id", "left").join(warehouses, "warehouse_id", "left")


def monthly_revenue(sales: DataFrame) -> DataFrame:
    """E02"""
    return (sales.groupBy(month_of().alias("year_month")).agg(money(F.sum("revenue")).alias("revenue"))
            .orderBy("year_month"))


def category_pareto(sales: DataFrame, products: DataFrame, cutoff: float = PARETO_CUTOFF) -> DataFrame:
    """Category revenue descending with cumulative % (a plain window: one
    row per category is left after the aggregate)."""
    cat = (sales.groupBy("product_id").agg(F.sum("revenue").alias("r"))
           .join(products.select("product_id", "category"), "product_id")
           .groupBy("category").agg(F.sum("r").alias("revenue")))
    total = sales.agg(F.sum("revenue")).scalar()
    w = Window.orderBy(F.desc("revenue"), "category").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = cat.withColumn("_cum", F.sum("revenue").over(w))
    cum_pct = round_half_up(ratio("_cum", total) * 100, 6)
    return c.select("category", money("revenue").alias("revenue"), cum_pct.alias("cum_pct"),
                    (ratio("_cum", total) * 100 <= cutoff).alias("within_cutoff"))


def warehouse_revenue(sales: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Revenue by warehouse name (pre-aggregated by id, then named)."""
    g = sales.groupBy("warehouse_id").agg(F.sum("revenue").alias("_r"))
    return (g.join(warehouses.select("warehouse_id", "warehouse_name"), "warehouse_id", "left")
            .groupBy("warehouse_name").agg(money(F.sum("_r")).alias("revenue"))
            .orderBy(F.desc("revenue")))


def _stats(df: DataFrame, **aggs) -> Column:
    """One aggregate over ``df`` as a single struct scalar subquery."""
    return df.agg(F.struct(*[a.alias(k) for k, a in aggs.items()]).alias("_s")).scalar()


def histogram(df: DataFrame, col: str, bins: int = HIST_BINS) -> DataFrame:
    """``bins`` equal-width bins from min to max, last bin closed; every
    bin reported (0 when empty)."""
    x = F.col(col).cast("double")
    st = _stats(df, lo=F.min(x), hi=F.max(x))
    lo, hi = st["lo"], st["hi"]
    width = (hi - lo) / F.lit(float(bins))
    idx = F.least(F.floor(F.try_divide(x - lo, width)), F.lit(bins - 1)).cast("int")
    counts = df.where(x.isNotNull()).groupBy(F.coalesce(idx, F.lit(0)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (edges.join(counts, "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("bin_start"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_end"),
                    F.coalesce("n", F.lit(0)).alias("count")))


def kde(df: DataFrame, col: str, gridsize: int = KDE_GRID, bins: int = HIST_BINS) -> DataFrame:
    """Gaussian kernel density, Scott bandwidth h = s * n^(-1/5), on
    ``gridsize`` points from min to max.  ``count_density`` is the density
    scaled to the counts of a ``bins``-bin histogram (n * bin width)."""
    x = F.col(col).cast("double")
    st = _stats(df, n=F.count(x), s=F.stddev_samp(x), lo=F.min(x), hi=F.max(x))
    n, s, lo, hi = st["n"], st["s"], st["lo"], st["hi"]
    h = s * F.pow(n.cast("double"), F.lit(-0.2))
    step = (hi - lo) / F.lit(float(gridsize - 1))
    norm = F.lit(1.0 / math.sqrt(2 * math.pi))
    # Rows with the same value contribute the same kernel: collapse them to
    # (value, weight) first, so the grid explode scales with distinct values.
    values = df.where(x.isNotNull()).groupBy(x.alias("_x")).agg(F.count(F.lit(1)).alias("_w"))
    terms = (values.select("_x", "_w", F.posexplode(F.array_repeat(F.lit(0), gridsize)).alias("g", "_z"))
             .withColumn("gx", lo + F.col("g") * step)
             .withColumn("k", F.col("_w") * F.exp(F.lit(-0.5) * F.pow((F.col("gx") - F.col("_x")) / h, 2))))
    dens = terms.groupBy("g", "gx").agg(F.sum("k").alias("_sk"))
    d = F.col("_sk") * norm / (n * h)
    return dens.select(F.col("g").cast("int").alias("grid_index"), round_half_up("gx", 6).alias("x"),
                       round_half_up(d, 12).alias("density"),
                       round_half_up(d * n * (hi - lo) / F.lit(float(bins)), 9).alias("count_density"))


FINE_BINS = 4096


def kde_binned(df: DataFrame, col: str, gridsize: int = KDE_GRID, bins: int = HIST_BINS, fine: int = FINE_BINS) -> DataFrame:
    """E06 for a large column: like ``kde``, but the values are shared out to ``fine`` + 1 nodes first.

    A value gives its weight to the two nodes around it, nearer one more
    (linear binning), in one aggregate of a fixed size; the kernel is then
    summed over nodes instead of values.  The density differs from the exact
    one by ``binning_error`` at the most.  A column of one value has NULLs."""
    x = F.col(col).cast("double")
    st = _stats(df, n=F.count(x), s=F.stddev_samp(x), lo=F.min(x), hi=F.max(x))
    n, s, lo, hi = st["n"], st["s"], st["lo"], st["hi"]
    h = s * F.pow(n.cast("double"), F.lit(-0.2))
    step, delta = (hi - lo) / F.lit(float(gridsize - 1)), (hi - lo) / F.lit(float(fine))
    at = F.coalesce(F.try_divide(x - lo, delta), F.lit(0.0))
    cell = F.least(F.floor(at), F.lit(fine - 1))
    cells = (df.where(x.isNotNull()).select(cell.alias("_cell"), (at - cell).alias("_part"))
             .groupBy("_cell").agg(F.count(F.lit(1)).alias("_c"), F.sum("_part").alias("_right")))
    sides = F.explode(F.array(F.struct(F.col("_cell").alias("node"), (F.col("_c") - F.col("_right")).alias("w")),
                              F.struct((F.col("_cell") + 1).alias("node"), F.col("_right").alias("w"))))
    nodes = cells.select(sides.alias("s")).groupBy("s.node").agg(F.sum("s.w").alias("_w")).select(
        (lo + F.col("node") * delta).alias("_x"), "_w")
    grid = F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1)))
    norm = F.lit(1.0 / math.sqrt(2 * math.pi))
    terms = nodes.select("_x", "_w", grid.alias("g")).withColumn("gx", lo + F.col("g") * step)
    kernel = F.exp(F.lit(-0.5) * F.pow(F.try_divide(F.col("gx") - F.col("_x"), h), 2))
    d = F.try_divide(F.sum(F.col("_w") * kernel) * norm, n * h)
    return terms.groupBy("g", "gx").agg(d.alias("_d")).select(
        F.col("g").alias("grid_index"), round_half_up("gx", 6).alias("x"), round_half_up("_d", 12).alias("density"),
        round_half_up(F.col("_d") * n * (hi - lo) / F.lit(float(bins)), 6).alias("count_density"))


def binning_error(h: float, delta: float) -> float:
    """The most that linear binning with nodes ``delta`` apart changes a Gaussian density of bandwidth ``h``: between two
    nodes the kernel is replaced by a straight line, which misses it by delta^2 / 8 of its greatest curvature."""
    return delta ** 2 / (8 * h ** 3 * math.sqrt(2 * math.pi))


def correlation_matrix(df: DataFrame, cols=CORR_COLUMNS) -> DataFrame:
    """Pearson correlations of every column pair, one aggregate, long form.

    Each pair is computed once (a column with itself too, which is NULL for a
    constant column) and reported in both orders."""
    pairs = [(a, b) for a in cols for b in cols]
    once = {(a, b): f"{a}__{b}" for i, a in enumerate(cols) for b in cols[i:]}
    agg = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(k) for (a, b), k in once.items()])
    stacked = F.explode(F.array(*[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"),
                                           F.col(once.get((a, b)) or once[(b, a)]).alias("corr")) for a, b in pairs]))
    return agg.select(stacked.alias("p")).select("p.var1", "p.var2", round_half_up("p.corr", 6).alias("corr"))


def fences(q1: Column, q3: Column, k: float) -> tuple[Column, Column]:
    return q1 - F.lit(k) * (q3 - q1), q3 + F.lit(k) * (q3 - q1)


def _whiskers(x: Column, lo_f: Column, hi_f: Column) -> list[Column]:
    return [F.min(F.when(x >= lo_f, x)).alias("lower_whisker"), F.max(F.when(x <= hi_f, x)).alias("upper_whisker"),
            F.count_if((x < lo_f) | (x > hi_f)).alias("n_outliers")]


def box_stats(df: DataFrame, col: str = "quantity_sold", k: float = 1.5) -> DataFrame:
    """Quartiles (exact, interpolated), IQR, fences, whiskers and the
    number of points outside the fences.

    Quartiles are selected by histograms of a fixed size (``selection``); one
    more pass over the column finds the whiskers."""
    _, (q1, median, q3) = quantiles(df, col, [0.25, 0.5, 0.75])
    q1, median, q3 = (F.lit(v).cast("double") for v in (q1, median, q3))
    lo_f, hi_f = fences(q1, q3, k)
    return df.agg(*_whiskers(F.col(col).cast("double"), lo_f, hi_f)).select(
        q1.alias("q1"), median.alias("median"), q3.alias("q3"), (q3 - q1).alias("iqr"),
        lo_f.alias("lower_fence"), hi_f.alias("upper_fence"), "lower_whisker", "upper_whisker", "n_outliers")


def box_stats_by(df: DataFrame, by: list[str], col: str, k: float = 1.5) -> DataFrame:
    """E08 for every group: quartiles of all groups are selected at once, so no
    task holds a group's values; the whiskers are a partial aggregate."""
    q = grouped_quantiles(df, by, col, [0.25, 0.5, 0.75], ["q1", "median", "q3"]).drop("n")
    lo_f, hi_f = fences(F.col("q1"), F.col("q3"), k)
    q = q.withColumns({"iqr": F.col("q3") - F.col("q1"), "lower_fence": lo_f, "upper_fence": hi_f})
    own = q.select(*[F.col(c).alias(f"_by_{c}") for c in by], *[c for c in q.columns if c not in by])
    rows = df.join(own, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
    stats = rows.groupBy(*by).agg(*[F.first(c).alias(c) for c in own.columns[len(by):]],
                                  *_whiskers(F.col(col).cast("double"), F.col("lower_fence"), F.col("upper_fence")))
    return stats.select(*by, "q1", "median", "q3", "iqr", "lower_fence", "upper_fence", "lower_whisker", "upper_whisker", "n_outliers")


def outliers(df: DataFrame, col: str, by: list[str] | None = None, k: float = 1.5) -> DataFrame:
    """The rows outside the fences of the column, or of their group's values, with ``side`` (low or high)."""
    x = F.col(col).cast("double")
    if by:
        q = grouped_quantiles(df, by, col, [0.25, 0.75], ["_q1", "_q3"])
        own = q.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_q1", "_q3")
        rows, (lo_f, hi_f) = df.join(own, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]), fences(F.col("_q1"), F.col("_q3"), k)
    else:
        _, ends = quantiles(df, col, [0.25, 0.75])
        rows, (lo_f, hi_f) = df, fences(*[F.lit(v).cast("double") for v in ends], k)
    side = F.when(x < lo_f, "low").when(x > hi_f, "high")
    return rows.select(*df.columns, side.alias("side")).where(F.col("side").isNotNull())


def group_medians(df: DataFrame, by: str, col: str) -> DataFrame:
    """C04's medians by selection: (by, n, median)."""
    return grouped_quantiles(df, [by], col, [0.5], ["median"])


def supplier_scatter(suppliers: DataFrame, x=SCATTER_X, y=SCATTER_Y) -> DataFrame:
    """(reliability, rating) points inside the plotting window."""
    return (suppliers.where(F.col("reliability_score").between(*x) & F.col("rating").between(*y))
            .select("supplier_id", "supplier_name", "reliability_score", "rating"))
