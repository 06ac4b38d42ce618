"""Weekly demand forecasting.

The reference forecasts one total weekly series; every function here
takes ``group_cols`` (default: none) so the same plan forecasts per SKU,
warehouse or category -- groups are the scale axis, each weekly series
is short (one row per week).

* MA-4 and the linear trend are plain aggregates.  The trend uses exact
  integer moment sums (t and demand are integers), so the slope is one
  division of exact integers.
* ARIMA(1,1,1) without constant is fitted by conditional sum of squares
  over a (phi, theta) grid, then refined on a finer grid round the best
  point.  The recursion e_t = d_t - phi d_{t-1} - theta e_{t-1} has no
  efficient built-in form, so each series goes through ``applyInPandas``
  where numpy evaluates all grid points at once (Spark shuffles by group).
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import half_even

TEST_WEEKS = 8
MA_WINDOW = 4
HISTORY_WEEKS = 12
ARIMA_FALLBACK = 0.95
# Grid of the CSS fit: coarse steps of 0.05 in (-1, 1), then +-10 steps of 0.005.
COARSE = [float(Decimal(i - 19) * Decimal("0.05")) for i in range(39)]
FINE = [float(Decimal(j - 10) * Decimal("0.005")) for j in range(21)]
MODELS = ["MA", "LR", "ARIMA"]


def week_ending_sunday(col: str = "sale_date"):
    return F.date_add(F.date_trunc("week", F.col(col)).cast("date"), 6)


def weekly_demand(sales: DataFrame, group_cols=(), drop_partial: bool = False) -> DataFrame:
    """units per (group, week ending Sunday).

    ``drop_partial=True`` removes a group's first week when its first sale
    is after that week's Monday and its last week when its last sale is
    before that week's Sunday (the reference keeps both)."""
    weekly = (sales.groupBy(*group_cols, week_ending_sunday().alias("week"))
              .agg(F.sum("quantity_sold").alias("demand")))
    if not drop_partial:
        return weekly
    span = sales.groupBy(*group_cols).agg(F.min("sale_date").alias("_d0"), F.max("sale_date").alias("_d1"))
    first_partial = (F.col("week") == week_ending_sunday("_d0")) & (F.date_sub("week", 6) < F.col("_d0"))
    last_partial = (F.col("week") == week_ending_sunday("_d1")) & (F.col("week") > F.col("_d1"))
    return (attach(weekly, span, group_cols).where(~first_partial & ~last_partial)
            .select(*group_cols, "week", "demand"))


def fill_weeks(weekly: DataFrame, group_cols=()) -> DataFrame:
    """every week from the first to the last of each group (0 if none),
    with the week index ``t`` (0-based) and the series length ``n``."""
    span = weekly.groupBy(*group_cols).agg(F.min("week").alias("_w0"), F.max("week").alias("_w1"))
    if group_cols:
        # one small row per series explodes into one row per week: spread the
        # spans over explicit tasks first so the explode is not squeezed into
        # the few partitions a byte-sized shuffle would be coalesced to
        span = span.repartition(fit_partitions(weekly.sparkSession), *group_cols)
    n = (F.datediff("_w1", "_w0") / 7).cast("int") + 1
    grid = span.select(*group_cols, n.alias("n"),
                       F.posexplode(F.sequence("_w0", "_w1", F.expr("INTERVAL 7 DAYS"))).alias("t", "week"))
    return (grid.join(weekly, [*group_cols, "week"], "left")
            .select(*group_cols, "week", "t", "n", F.coalesce("demand", F.lit(0)).cast("long").alias("demand")))


def split(filled: DataFrame, test_weeks: int = TEST_WEEKS) -> DataFrame:
    """the last ``test_weeks`` weeks of each group are the test part."""
    return (filled.withColumn("is_test", F.col("t") >= F.col("n") - test_weeks)
            .withColumn("n_train", F.col("n") - test_weeks))


def ma_params(s: DataFrame, group_cols=(), window: int = MA_WINDOW) -> DataFrame:
    """mean of the last ``window`` training weeks (NULL if fewer)."""
    last = s.where(~F.col("is_test") & (F.col("t") >= F.col("n_train") - window))
    return (last.groupBy(*group_cols)
            .agg(F.when(F.count(F.lit(1)) == window, F.avg("demand")).alias("ma")))


def lr_params(s: DataFrame, group_cols=()) -> DataFrame:
    """OLS of demand on t over the training weeks, from exact sums."""
    tr = s.where(~F.col("is_test"))
    g = tr.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("t").alias("_st"), F.sum("demand").alias("_sy"),
        F.sum(F.col("t") * F.col("t")).alias("_stt"), F.sum(F.col("t") * F.col("demand")).alias("_sty"))
    num = F.col("_n") * F.col("_sty") - F.col("_st") * F.col("_sy")
    den = F.col("_n") * F.col("_stt") - F.col("_st") * F.col("_st")
    slope = F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))
    return g.select(*group_cols, slope.alias("slope"),
                    ((F.col("_sy") - slope * F.col("_st")) / F.col("_n")).alias("intercept"))


def _css(y: np.ndarray, phis: np.ndarray, thetas: np.ndarray):
    """SSE of the ARMA(1,1) recursion on the first differences of y for each
    (phi, theta) pair; returns (sse, last d, last e) arrays."""
    d = np.diff(y)
    pd_ = np.zeros_like(phis)
    pe = np.zeros_like(phis)
    sse = np.zeros_like(phis)
    for x in d:
        e = x - phis * pd_ - thetas * pe
        sse = sse + e * e
        pd_ = np.full_like(phis, x)
        pe = e
    return sse, pd_, pe


def _best(sse, phis, thetas):
    order = np.lexsort((thetas, phis, sse))
    return order[0]


def arima_fit(y: np.ndarray):
    """Coarse then fine CSS grid search; None when the series is too short."""
    if len(y) < 4:
        return None
    cp, ct = np.meshgrid(np.array(COARSE), np.array(COARSE), indexing="ij")
    cp, ct = cp.ravel(), ct.ravel()
    sse, _, _ = _css(y, cp, ct)
    b = _best(sse, cp, ct)
    fp, ft = np.meshgrid(cp[b] + np.array(FINE), ct[b] + np.array(FINE), indexing="ij")
    fp, ft = fp.ravel(), ft.ravel()
    keep = (np.abs(fp) < 1.0) & (np.abs(ft) < 1.0)
    fp, ft = fp[keep], ft[keep]
    sse, last_d, last_e = _css(y, fp, ft)
    b = _best(sse, fp, ft)
    return fp[b], ft[b], last_d[b], last_e[b], y[-1]


def arima_params(s: DataFrame, group_cols=()) -> DataFrame:
    """per-group CSS fit; one row per group with phi, theta, the last
    difference and residual, and the last training value."""
    gcols = list(group_cols)
    tr = s.where(~F.col("is_test")).select(*gcols, "t", F.col("demand").cast("double").alias("y"))
    fields = [tr.schema[c] for c in gcols]
    schema = T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in
                                    ["phi", "theta", "last_d", "last_e", "last_y"]])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t")
        r = arima_fit(pdf["y"].to_numpy(dtype="float64"))
        row = {c: pdf[c].iloc[0] for c in gcols}
        vals = r if r is not None else (None,) * 5
        row.update(dict(zip(["phi", "theta", "last_d", "last_e", "last_y"], vals)))
        return pd.DataFrame([row], columns=[f.name for f in schema.fields])

    if gcols:
        # The fit is CPU-bound while its input is small in bytes, so adaptive
        # execution would coalesce the feeding shuffle into very few tasks.
        # A hash repartition on the series key with its own explicit count is
        # kept as is (AQE does not coalesce a user-given count); the grouping
        # reuses this partitioning.
        tr = tr.repartition(fit_partitions(tr.sparkSession), *gcols)
    return tr.groupBy(*gcols).applyInPandas(fit, schema)


def series_params(s: DataFrame, group_cols=(), window: int = MA_WINDOW) -> DataFrame:
    """F04-F06 of each series in one row, from one grouped pass: the series is
    collected once (a row per week, so it is short) and fitted in the same
    task that holds its sums."""
    gcols = list(group_cols)
    tr = s.where(~F.col("is_test"))
    if gcols:
        tr = tr.repartition(fit_partitions(tr.sparkSession), *gcols)
    last = F.when(F.col("t") >= F.col("n_train") - window, F.col("demand"))
    g = tr.groupBy(*gcols).agg(
        F.when(F.count(last) == window, F.avg(last)).alias("ma"),
        F.count(F.lit(1)).alias("_n"), F.sum("t").alias("_st"), F.sum("demand").alias("_sy"),
        F.sum(F.col("t") * F.col("t")).alias("_stt"), F.sum(F.col("t") * F.col("demand")).alias("_sty"),
        F.sort_array(F.collect_list(F.struct("t", F.col("demand").cast("double").alias("y")))).alias("_ys"))
    num = F.col("_n") * F.col("_sty") - F.col("_st") * F.col("_sy")
    den = F.col("_n") * F.col("_stt") - F.col("_st") * F.col("_st")
    slope = F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))
    g = g.select(*gcols, "ma", slope.alias("slope"), ((F.col("_sy") - slope * F.col("_st")) / F.col("_n")).alias("intercept"),
                 F.transform("_ys", lambda x: x["y"]).alias("_ys"))
    if not gcols:
        g = g.where("slope IS NOT NULL")             # no training weeks, no row
    names = ["phi", "theta", "last_d", "last_e", "last_y"]
    kept = [c for c in g.columns if c != "_ys"]
    schema = T.StructType([g.schema[c] for c in kept] + [T.StructField(c, T.DoubleType()) for c in names])

    def fit(frames):
        for pdf in frames:
            fits = [arima_fit(np.asarray(y, dtype="float64")) or (None,) * 5 for y in pdf["_ys"]]
            yield pd.concat([pdf[kept].reset_index(drop=True), pd.DataFrame(fits, columns=names, dtype="float64")], axis=1)

    return g.mapInPandas(fit, schema)


FIT_PARTITIONS = "shelfwise.forecast.fitPartitions"


def fit_partitions(spark) -> int:
    """Tasks for the per-series fit: ``shelfwise.forecast.fitPartitions``,
    by default twice the shuffle width."""
    default = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return int(spark.conf.get(FIT_PARTITIONS, str(default)))


def arima_path(h, phi, theta, last_d, last_e, last_y):
    """Forecast h steps ahead: d1 = phi d_T + theta e_T, d_k = phi d_{k-1},
    y_T + sum of the d's (evaluated step by step with ``aggregate``)."""
    d1 = phi * last_d + theta * last_e
    init = F.struct(F.lit(0.0).alias("dh"), F.lit(0.0).alias("cum"))
    acc = F.aggregate(F.sequence(F.lit(1), h), init,
                      lambda a, j: F.struct(
                          F.when(j == 1, d1).otherwise(phi * a["dh"]).alias("dh"),
                          (a["cum"] + F.when(j == 1, d1).otherwise(phi * a["dh"])).alias("cum")))
    return last_y + acc["cum"]


def attach(df: DataFrame, params: DataFrame, group_cols) -> DataFrame:
    """Attach per-series parameters: an equi-join on the series key, or --
    for the single total series -- the one parameter row as a scalar
    struct subquery (no join at all)."""
    g = list(group_cols)
    if g:
        return df.join(params, g, "left")
    row = params.select(F.struct(*params.columns).alias("_p")).scalar()
    return df.select("*", *[row[c].alias(c) for c in params.columns])


def _forecasts(sales: DataFrame, g, test_weeks: int):
    s = split(fill_weeks(weekly_demand(sales, g), g), test_weeks)
    test = attach(s.where(F.col("is_test")), series_params(s, g), g)
    h = F.col("t") - F.col("n_train") + 1
    lr = F.col("intercept") + F.col("slope") * F.col("t")
    arima = arima_path(h, F.col("phi"), F.col("theta"), F.col("last_d"), F.col("last_e"), F.col("last_y"))
    return s, test.select(*g, "week", "t", F.col("demand").cast("double").alias("actual"),
                          F.col("ma").alias("forecast_ma"), lr.alias("forecast_lr"),
                          F.coalesce(arima, F.lit(ARIMA_FALLBACK) * lr).alias("forecast_arima"))


def forecasts(sales: DataFrame, group_cols=(), test_weeks: int = TEST_WEEKS) -> DataFrame:
    """Test weeks with actual demand and the three forecasts."""
    return _forecasts(sales, list(group_cols), test_weeks)[1]


def long_form(fc: DataFrame, group_cols=()) -> DataFrame:
    """(group, week, model, actual, forecast) rows."""
    stacked = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"forecast_{m.lower()}").alias("forecast"))
                                   for m in MODELS]))
    return fc.select(*group_cols, "week", "actual", stacked.alias("_m")).select(
        *group_cols, "week", "actual", "_m.model", "_m.forecast")


def evaluation(sales: DataFrame, group_cols=(), test_weeks: int = TEST_WEEKS) -> DataFrame:
    """MAE, RMSE and MAPE (%) per model; MAPE divides by max(1, actual).
    Rounded half-even to 2 places like the reference report."""
    gk = list(group_cols)
    lf = long_form(_forecasts(sales, gk, test_weeks)[1], gk)
    err = F.col("actual") - F.col("forecast")
    g = lf.groupBy(*gk, "model").agg(
        F.avg(F.abs(err)).alias("_mae"), F.avg(err * err).alias("_mse"),
        F.avg(F.abs(err) / F.greatest(F.lit(1.0), F.col("actual"))).alias("_mape"))
    return g.select(*gk, "model", half_even("_mae", 2).alias("mae"), half_even(F.sqrt("_mse"), 2).alias("rmse"),
                    half_even(F.col("_mape") * 100, 2).alias("mape"))


def report(sales: DataFrame, group_cols=(), test_weeks: int = TEST_WEEKS) -> DataFrame:
    """one row per model with flags for the best model on each metric
    (ties broken by model name; a NULL error is never best, and nothing is
    flagged where all are NULL)."""
    gk = list(group_cols)
    out = evaluation(sales, gk, test_weeks)
    w = Window.partitionBy(*gk)    # three rows per series
    for m in ["mae", "rmse", "mape"]:
        # A model without a forecast has no error and is never the best.
        best = F.min_by(F.when(F.col(m).isNotNull(), F.col("model")),
                        F.struct(F.col(m).isNull(), F.col(m), F.col("model"))).over(w)
        out = out.withColumn(f"best_{m}", F.coalesce(best == F.col("model"), F.lit(False)))
    return out


def comparison_series(sales: DataFrame, group_cols=(), test_weeks: int = TEST_WEEKS,
                      history: int = HISTORY_WEEKS) -> DataFrame:
    """last ``history`` training weeks, the test weeks and the three
    forecasts in long form (week, series, value)."""
    g = list(group_cols)
    s, fc = _forecasts(sales, g, test_weeks)
    train = (s.where(~F.col("is_test") & (F.col("t") >= F.col("n") - test_weeks - history))
             .select(*g, "week", F.lit("train").alias("series"), F.col("demand").cast("double").alias("value")))
    test = fc.select(*g, "week", F.lit("test").alias("series"), F.col("actual").alias("value"))
    models = long_form(fc, g).select(*g, "week", F.col("model").alias("series"), F.col("forecast").alias("value"))
    return train.unionByName(test).unionByName(models)
