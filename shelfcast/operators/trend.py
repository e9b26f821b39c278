"""Per-store macro trend (O-54): an autoregressive moving-average model with
exogenous regressors on log1p daily store totals, for every store at once.

The reference fits SARIMAX(1,0,1)(1,0,1,7) per store in a driver loop. The
autoregressive part (1 - phi B)(1 - Phi B^7) y_t expands to y_{t-1}, y_{t-7},
y_{t-8}, the moving-average part (1 + theta B)(1 + Theta B^7) e_t to e_{t-1},
e_{t-7}, e_{t-8}; plus intercept, SNAP flag and event flag. The expanded
coefficients are estimated freely by two regressions (Hannan and Rissanen):

1. a long autoregression, whose residuals stand for the unseen shocks e_t;
2. the model itself, with those residuals at lags 1, 7 and 8 as regressors.

Work split:
  * Spark: store-day totals, lags (window per store; one row per day, so a
    store's partition is bounded by the number of days), and the normal
    equations X'X, X'y of either regression summed per store in ONE groupBy
    (map-side partial sums).
  * Python: per store, one input row (Gram matrix, X'y; for the forecast the
    last 8 totals and shocks and the regressors of the days to come) -> a
    ridge-stabilised solve and the recursion, in ``applyInPandas``. No group
    ever holds more than one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import bounded_broadcast

REGRESSORS = ["one", "y1", "y7", "y8", "snap", "is_event"]
LAGS = {"y1": 1, "y7": 7, "y8": 8}
SHOCKS = {"e1": 1, "e7": 7, "e8": 8}
#: The long autoregression's lags: all of two weeks and a bit, then those near
#: the following weeks, which a weekly moving average needs.
LONG_LAGS = {f"y{n}": n for n in (*range(1, 17), 21, 22, 23, 28, 29)}
LONG_REGRESSORS = ["one", *LONG_LAGS, "snap", "is_event"]
MODEL = [*REGRESSORS, *SHOCKS]
HORIZON = 28
TAIL = 8
RIDGE = 1e-6


def design(store_day: DataFrame, store: str = "store_id", day: str = "day_num",
           lags: dict[str, int] = LAGS) -> DataFrame:
    """log1p totals and their lags per store; rows with all lags present."""
    w = Window.partitionBy(store).orderBy(day)
    y = F.log1p(F.col("sales").cast("double"))
    out = store_day.select(store, day, y.alias("y"), F.col("snap").cast("double").alias("snap"),
                           F.col("is_event").cast("double").alias("is_event"))
    out = out.withColumns({k: F.lag("y", n).over(w) for k, n in lags.items()})
    return out.withColumn("one", F.lit(1.0)).dropna(subset=list(lags))


def gram_sums(x: DataFrame, store: str = "store_id", regressors: Sequence[str] = REGRESSORS) -> DataFrame:
    """Upper triangle of X'X, X'y and the row count per store: one aggregate."""
    aggs = []
    for i, a in enumerate(regressors):
        for b in regressors[i:]:
            aggs.append(F.sum(F.col(a) * F.col(b)).alias(f"xx_{a}_{b}"))
        aggs.append(F.sum(F.col(a) * F.col("y")).alias(f"xy_{a}"))
    aggs.append(F.count(F.lit(1)).alias("n_obs"))
    return x.groupBy(store).agg(*aggs)


def _solve(row, regressors: Sequence[str]):
    import numpy as np
    k = len(regressors)
    xx, xy = np.zeros((k, k)), np.zeros(k)
    for i, a in enumerate(regressors):
        for j in range(i, k):
            xx[i, j] = xx[j, i] = row[f"xx_{a}_{regressors[j]}"]
        xy[i] = row[f"xy_{a}"]
    return np.linalg.solve(xx + RIDGE * np.trace(xx) / k * np.eye(k), xy)


def coefficients(gram: DataFrame, regressors: Sequence[str], store: str = "store_id") -> DataFrame:
    """(store, beta_<regressor>...) from the sums of ``gram_sums``."""
    def run(pdf):
        import pandas as pd
        r = pdf.iloc[0]
        return pd.DataFrame([(r[store], *map(float, _solve(r, regressors)))], columns=[store, *(f"beta_{n}" for n in regressors)])

    kind = T.StructType([gram.schema[store]] + [T.StructField(f"beta_{n}", T.DoubleType()) for n in regressors])
    return gram.groupBy(store).applyInPandas(run, schema=kind)


def _fitted(regressors: Sequence[str]):
    return sum((F.col(n) * F.col(f"beta_{n}") for n in regressors[1:]), F.col(f"beta_{regressors[0]}") * F.col(regressors[0]))


def shocks(store_day: DataFrame, store: str = "store_id", day: str = "day_num") -> DataFrame:
    """Residuals e of the long autoregression, per store and day."""
    x = design(store_day, store, day, LONG_LAGS)
    beta = coefficients(gram_sums(x, store, LONG_REGRESSORS), LONG_REGRESSORS, store).checkpoint(eager=True)  # a row per store
    return x.join(bounded_broadcast(beta), on=store).select(store, day, (F.col("y") - _fitted(LONG_REGRESSORS)).alias("e"))


def design_ma(store_day: DataFrame, shock: DataFrame, store: str = "store_id", day: str = "day_num") -> DataFrame:
    """``design`` with the shocks at lags 1, 7 and 8 (rows with all of them).
    A store's days are joined on both keys, which it is partitioned by."""
    w = Window.partitionBy(store).orderBy(day)
    x = design(store_day, store, day).join(shock, on=[store, day], how="left")
    x = x.withColumns({k: F.lag("e", n).over(w) for k, n in SHOCKS.items()})
    return x.dropna(subset=list(SHOCKS))


def future_regressors(store_day: DataFrame, last_day: int, horizon: int = HORIZON,
                      store: str = "store_id", day: str = "day_num") -> DataFrame:
    """(store, future: array of (day, snap, is_event)) of the ``horizon`` days
    after ``last_day`` that ``store_day`` knows: at most ``horizon`` a store."""
    days = store_day.where((F.col(day) > last_day) & (F.col(day) <= last_day + horizon))
    each = F.struct(F.col(day).alias("day"), F.col("snap").cast("double").alias("snap"), F.col("is_event").cast("double").alias("is_event"))
    return days.groupBy(store).agg(F.sort_array(F.collect_list(each)).alias("future"))


def _recursion(pdf, horizon: int, store: str, day: str):
    import numpy as np
    import pandas as pd
    r = pdf.iloc[0]
    beta = _solve(r, MODEL)
    y, e = [v["y"] for v in r["tail"]], [v["e"] or 0.0 for v in r["tail"]]
    known = {v["day"]: (v["snap"], v["is_event"]) for v in r["future"]} if r["future"] is not None else {}
    out = []
    for h in range(1, horizon + 1):
        at = int(r["last_day"]) + h
        snap, event = known.get(at, (float(r["last_snap"]), 0.0))
        x = [1.0, y[-1], y[-7], y[-8], snap, event, e[-1], e[-7], e[-8]]
        y.append(float(np.dot(beta, x)))
        e.append(0.0)
        out.append((r[store], at, float(np.expm1(y[-1])), *map(float, beta)))
    return pd.DataFrame(out, columns=[store, day, "store_trend", *(f"beta_{n}" for n in MODEL)])


def fit_forecast(store_day: DataFrame, last_day: int, horizon: int = HORIZON,
                 store: str = "store_id", day: str = "day_num", future: DataFrame | None = None) -> DataFrame:
    """Fit every store on its days up to ``last_day`` and forecast the
    ``horizon`` days after it.

    ``future`` (from ``future_regressors``) gives the SNAP and event flags of
    the days to come; days it doesn't have, and all days without it, follow
    the reference's production run: the last SNAP value repeated, no event.
    A store without a total on each of the last 8 days gets no forecast."""
    return _fit(store_day, last_day, horizon, store, day, future)[0]


def _fit(store_day: DataFrame, last_day: int, horizon: int, store: str, day: str, future: DataFrame | None):
    known = store_day.where(F.col(day) <= last_day).select(store, day, "sales", "snap", "is_event")
    known = known.checkpoint(eager=True)  # a row per store and day, read by both regressions
    e = shocks(known, store, day)
    x = design_ma(known, e, store, day).checkpoint(eager=True)
    recent = known.where(F.col(day) > last_day - TAIL).join(e, on=[store, day], how="left")
    tail = (recent.groupBy(store)
                  .agg(F.sort_array(F.collect_list(F.struct(F.col(day), F.log1p(F.col("sales").cast("double")).alias("y"), "e"))).alias("tail"),
                       F.max_by("snap", day).alias("last_snap"))
                  .where(F.size("tail") == TAIL))
    rows = gram_sums(x, store, MODEL).join(tail, on=store).withColumn("last_day", F.lit(last_day))
    rows = rows.join(future, on=store, how="left") if future is not None else rows.withColumn(
        "future", F.lit(None).cast("array<struct<day:int,snap:double,is_event:double>>"))
    kind = T.StructType([store_day.schema[store], T.StructField(day, T.IntegerType()), T.StructField("store_trend", T.DoubleType())]
                        + [T.StructField(f"beta_{n}", T.DoubleType()) for n in MODEL])
    return rows.groupBy(store).applyInPandas(lambda pdf: _recursion(pdf, horizon, store, day), schema=kind), x


def fitted_history(x: DataFrame, coefs: DataFrame, store: str = "store_id", day: str = "day_num") -> DataFrame:
    """One-step in-sample fitted totals, expm1(x . beta), per row of
    ``design_ma`` (``trend_mode='fitted'``: no same-day actuals leak into
    features)."""
    b = coefs.select(store, *[f"beta_{n}" for n in MODEL]).distinct()
    return x.join(bounded_broadcast(b), on=store).select(store, day, F.expm1(_fitted(MODEL)).alias("store_trend"))


def trend_lookup(store_day: DataFrame, last_day: int, mode: str = "fitted", horizon: int = HORIZON,
                 store: str = "store_id", day: str = "day_num", known_future: bool = False) -> DataFrame:
    """(store, day) -> store_trend for the history up to ``last_day`` and the
    horizon after it (O-71 union).

    ``mode='actual'`` reproduces the reference (history = same-day actual
    totals); ``'fitted'`` uses one-step fitted values instead. With
    ``known_future`` the days after ``last_day`` in ``store_day`` give the
    horizon's SNAP and event flags (a backtest's held-out days); their sales
    are never read."""
    future = future_regressors(store_day, last_day, horizon, store, day) if known_future else None
    fc, x = _fit(store_day, last_day, horizon, store, day, future)
    # Used twice below (coefficients and forecast rows): materialise the
    # small result (horizon rows per store) so the per-store solve runs once.
    fc = fc.checkpoint(eager=True)
    if mode == "actual":
        hist = store_day.where(F.col(day) <= last_day).select(store, day, F.col("sales").cast("double").alias("store_trend"))
    else:
        hist = fitted_history(x, fc, store, day)
    return hist.unionByName(fc.select(store, day, "store_trend"))
