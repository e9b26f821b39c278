"""Forecast horizon, backtest and submission (O-30, O-32, O-38, O-58, O-63, O-71).

One DataFrame holds all stores and series; there is no per-store loop.
History and future rows share the series partitioning, so the horizon
features (lags >= horizon, rolling stats of the lag) are computed by the
same single window pass as in training.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import day_label, horizon_label
from ..operators.aggregates import last_known_attrs
from ..operators.joins import future_grid, join_last_known
from ..operators.reshape import const_columns, pivot_labels, snap_for_state
from ..operators.windows import lag_features, rolling_lagged
from ..sources.tpch_panel import Panel

HORIZON = 28
LAST_ATTRS = ["item_id", "dept_id", "cat_id", "store_id", "state_id", "sell_price", "snap"]


def history_with_snap(panel: Panel) -> DataFrame:
    """Fact rows with the row's own-state SNAP flag (O-27)."""
    return snap_for_state(panel.fact(), [s for s, _ in panel.states])


def future_rows(history: DataFrame, last_day: int, horizon: int = HORIZON,
                attrs: Sequence[str] = LAST_ATTRS) -> DataFrame:
    """Rows for the ``horizon`` days after ``last_day``: every id (O-39) x
    future days (O-32), attributes of the last observed day (O-38, O-30),
    no event, unknown sales (O-26)."""
    last = last_known_attrs(history, list(attrs), key="id", day="day_num", last_day=last_day)
    ids = last.select("id")
    grid = future_grid(ids, last_day + 1, horizon)
    fut = join_last_known(grid, last, on="id")
    fut = const_columns(fut, {"event_name_1": "NoEvent", "event_type_1": "NoEvent", "sales": None},
                        {"sales": "double"})
    return fut.withColumn("d", day_label(F.col("day_num")))


def extend_history(history: DataFrame, last_day: int, horizon: int = HORIZON) -> DataFrame:
    """History plus future rows (O-71: union by name, missing columns null).
    History events are normalised to 'NoEvent' like the future ones."""
    hist = history.withColumns({
        "sales": F.col("sales").cast("double"),   # unknown future sales are null
        "event_name_1": F.coalesce("event_name_1", F.lit("NoEvent")),
        "event_type_1": F.coalesce("event_type_1", F.lit("NoEvent")),
    })
    fut = future_rows(history, last_day, horizon)
    return hist.unionByName(fut, allowMissingColumns=True)


def horizon_features(df: DataFrame) -> DataFrame:
    """Per-store model features (HTR set): lag 28/35 and 7-row rolling mean
    and std of lag 28, one window pass over the series."""
    out = lag_features(df, (28, 35), "sales", keys=("id",))
    return rolling_lagged(out, 7, 28, "sales", keys=("id",),
                          names=("rolling_mean_28_7", "rolling_std_28_7"))


def naive_horizon(panel: Panel, horizon: int = HORIZON) -> DataFrame:
    """O-58 with the seasonal-naive model: the forecast for day t is the
    value at t - 28 (always history, since lag >= horizon)."""
    lo, hi = panel.bounds
    ext = extend_history(history_with_snap(panel), hi, horizon)
    feats = lag_features(ext.select("id", "day_num", "sales"), (28,), "sales", keys=("id",))
    return (feats.where(F.col("day_num") > hi)
                 .select("id", "day_num", F.col("lag_28").cast("double").alias("sales")))


def submission(pred: DataFrame, last_day: int, horizon: int = HORIZON,
               value: str = "sales") -> DataFrame:
    """id x F1..F28 (O-19, labels in numeric order, not text order)."""
    lab = pred.select("id", horizon_label(F.col("day_num"), last_day).alias("F"), value)
    return pivot_labels(lab, "id", "F", value, [f"F{i}" for i in range(1, horizon + 1)])
