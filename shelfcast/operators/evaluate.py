"""Backtest split and forecast metrics (O-59..O-62, O-70).

All metrics are grouped aggregates over (series, day) rows; only the final
per-store / per-series / global numbers are small. Series-level frames are
joined on the series key, which they are already partitioned by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SERIES = ("item_id", "store_id")
HORIZON = 28


# O-70 -----------------------------------------------------------------------
def time_split(df: DataFrame, last_day: int, horizon: int = HORIZON, day: str = "day_num"
               ) -> DataFrame:
    """Flag rows instead of copying them: train = up to ``last_day -
    horizon``, test = the ``horizon`` days after that."""
    cut = last_day - horizon
    return df.withColumn("split", F.when(F.col(day) <= cut, F.lit("train"))
                         .when(F.col(day) <= last_day, F.lit("test")))


def naive_forecast(df: DataFrame, horizon: int = HORIZON, sales: str = "sales",
                   keys: Sequence[str] = SERIES, day: str = "day_num", out: str = "yhat"
                   ) -> DataFrame:
    """Seasonal-naive baseline: the value ``horizon`` days earlier. Needs
    no recursion because the lag is at least the horizon."""
    w = Window.partitionBy(*keys).orderBy(day)
    return df.withColumn(out, F.lag(F.col(sales).cast("double"), horizon).over(w))


# O-59 -----------------------------------------------------------------------
def store_rmse(pred: DataFrame, y: str = "sales", yhat: str = "yhat", store: str = "store_id"
               ) -> DataFrame:
    e = F.col(y).cast("double") - F.col(yhat)
    return pred.groupBy(store).agg(F.sqrt(F.avg(e * e)).alias("rmse"),
                                   F.count(F.lit(1)).alias("n_rows"))


def mean_store_rmse(per_store: DataFrame) -> DataFrame:
    return per_store.agg(F.avg("rmse").alias("mean_store_rmse"),
                         F.count(F.lit(1)).alias("n_stores"))


# O-60 -----------------------------------------------------------------------
def global_metrics(pred: DataFrame, y: str = "sales", yhat: str = "yhat") -> DataFrame:
    """RMSE, WMAPE = sum|e| / sum y, volume accuracy = 1 - |sum y - sum yhat| / sum y."""
    yy = F.col(y).cast("double")
    e = yy - F.col(yhat)
    s = pred.agg(F.avg(e * e).alias("mse"), F.sum(F.abs(e)).alias("abs_err"),
                 F.sum(yy).alias("sum_y"), F.sum(F.col(yhat)).alias("sum_yhat"),
                 F.count(F.lit(1)).alias("n_rows"))
    return s.select(
        F.sqrt("mse").alias("rmse"),
        F.try_divide(F.col("abs_err"), F.col("sum_y")).alias("wmape"),
        (F.lit(1.0) - F.try_divide(F.abs(F.col("sum_y") - F.col("sum_yhat")), F.col("sum_y")))
        .alias("volume_accuracy"),
        "n_rows")


# O-61 -----------------------------------------------------------------------
def rmsse(history: DataFrame, pred: DataFrame, keys: Sequence[str] = SERIES,
          y: str = "sales", yhat: str = "yhat", day: str = "day_num",
          horizon: int = HORIZON) -> DataFrame:
    """Per series: sqrt( (1/h) sum e^2 / ((1/(n-1)) sum (y_i - y_{i-1})^2) ).

    The scale uses the series' training history; a zero scale (constant
    history) gives null. ``h`` is the horizon, not the history length."""
    w = Window.partitionBy(*keys).orderBy(day)
    yy = F.col(y).cast("double")
    diff = yy - F.lag(yy, 1).over(w)
    scale = (history.select(*keys, diff.alias("__d"))
                    .groupBy(*keys).agg(F.avg(F.col("__d") * F.col("__d")).alias("scale")))
    e = F.col(y).cast("double") - F.col(yhat)
    err = pred.groupBy(*keys).agg((F.sum(e * e) / float(horizon)).alias("mse"),
                                  F.count(F.lit(1)).alias("n_test"))
    return (err.join(scale, on=list(keys), how="left")
               .withColumn("rmsse", F.when(F.col("scale") > 0, F.sqrt(F.col("mse") / F.col("scale"))))
               .select(*keys, "rmsse", "scale", "n_test"))


# O-62 -----------------------------------------------------------------------
def value_weights(history: DataFrame, last_train_day: int, keys: Sequence[str] = SERIES,
                  y: str = "sales", price: str = "sell_price", day: str = "day_num",
                  window: int = HORIZON, share: bool = True) -> DataFrame:
    """Weight of each series = its sales value (units x price) over the last
    ``window`` training days, as a share of the total (``share=False`` keeps
    raw values, which is all WRMSSE needs)."""
    recent = history.where((F.col(day) > last_train_day - window) & (F.col(day) <= last_train_day))
    val = recent.groupBy(*keys).agg(
        F.sum(F.col(y).cast("double") * F.coalesce(F.col(price), F.lit(0.0))).alias("value"))
    if not share:
        return val
    # The share needs the grand total: one scalar aggregate, not a window
    # over all series in one partition.
    total = val.agg(F.sum("value")).first()[0]
    return val.withColumn("weight", F.try_divide(F.col("value"), F.lit(total)))


def wrmsse(per_series: DataFrame, weights: DataFrame, keys: Sequence[str] = SERIES
           ) -> DataFrame:
    """Value-weighted mean of RMSSE over series with a defined RMSSE (weights
    renormalised over those series, so raw values serve as weights)."""
    j = per_series.join(weights, on=list(keys), how="inner").where(F.col("rmsse").isNotNull())
    return j.agg(F.try_divide(F.sum(F.col("value") * F.col("rmsse")), F.sum("value")).alias("wrmsse"),
                 F.count(F.lit(1)).alias("n_series"))


# O-61 / O-62 in one pass -------------------------------------------------------
def scaled_errors(df: DataFrame, last_train_day: int, keys: Sequence[str] = SERIES, y: str = "sales",
                  yhat: str = "yhat", price: str = "sell_price", day: str = "day_num",
                  horizon: int = HORIZON, window: int = HORIZON) -> DataFrame:
    """rmsse, scale, n_test and value of every series that has test rows, from
    one frame of training and test days: one window and one aggregate, both on
    the series key, in place of a branch for each part and joins between them.
    Same numbers as ``rmsse`` and ``value_weights`` on the split frames."""
    w = Window.partitionBy(*keys).orderBy(day)
    yy = F.col(y).cast("double")
    train, test = F.col(day) <= last_train_day, (F.col(day) > last_train_day) & (F.col(day) <= last_train_day + horizon)
    step, e = yy - F.lag(yy, 1).over(w), yy - F.col(yhat)
    rows = df.select(*keys, F.when(train, step * step).alias("__step"), F.when(test, e * e).alias("__error"), test.alias("__test"),
                     F.when(train & (F.col(day) > last_train_day - window), yy * F.coalesce(F.col(price), F.lit(0.0))).alias("__value"))
    out = rows.groupBy(*keys).agg(F.avg("__step").alias("scale"), (F.sum("__error") / float(horizon)).alias("mse"),
                                  F.count_if("__test").alias("n_test"), F.sum("__value").alias("value"))
    return (out.where(F.col("n_test") > 0)
               .withColumn("rmsse", F.when(F.col("scale") > 0, F.sqrt(F.col("mse") / F.col("scale"))))
               .select(*keys, "rmsse", "scale", "n_test", "value"))
