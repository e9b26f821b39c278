"""Model training plans.

``global_backtest``: the time-split backtest of the global model (VAL / SKL /
LGB feature set: lags 28/35/42/49, rolling mean/std of lag 28, price
momentum and volatility, calendar and SNAP columns, categories as categories).

``hybrid_fit``: the per-store hybrid (HTR, HVAL): per-store trend (O-54) as a
feature next to lag 28/35 and 7-row rolling stats, one boosted model per store.
All stores' trees grow in the same passes (``operators/histboost.py``), in
place of a driver loop over stores.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hash_bucket
from ..operators import evaluate as EV
from ..operators import histboost as H
from ..operators import trend as TR
from ..operators.aggregates import store_day_agg
from ..operators.boosting import BoostParams
from ..operators.joins import join_trend
from ..operators.reshape import fill_features
from ..operators.windows import series_features
from ..session import checkpoint_dir
from ..sources.tpch_panel import ORIGIN, Panel, snap_column, source_signature
from . import forecast as FC

HORIZON = 28
# Bump when binning, blocks or growth change, so rounds of older code are not gone on with.
FIT_FORMAT = 2
GLOBAL_CATS = ["store_id", "dept_id", "cat_id", "state_id", "event_name_1", "event_type_1"]
GLOBAL_NUMERIC = ["lag_28", "lag_35", "lag_42", "lag_49", "roll_mean_28", "roll_std_28",
                  "price_momentum", "price_roll_std_7"]
HYBRID_CATS = ["dept_id", "cat_id", "event_name_1"]
HYBRID_NUMERIC = ["store_trend", "lag_28", "lag_35", "rolling_mean_28_7", "rolling_std_28_7",
                  "sell_price", "snap", "wday", "month", "day"]


def state_path(panel: Panel, name: str, params: H.HistParams) -> str:
    """Folder of a fit's rounds, one for each source snapshot and settings: a
    stopped fit goes on there, and queries on one fit train it once."""
    kept = {k: v for k, v in asdict(params).items() if k != "rounds" or params.early_stopping_rounds}
    key = hashlib.sha1(json.dumps([FIT_FORMAT, name, panel.sf_dir, source_signature(panel.spark, panel.sf_dir), kept], sort_keys=True).encode()).hexdigest()[:16]
    return f"{checkpoint_dir(panel.spark).rstrip('/')}/fit-{name}-{key}"


def hist_params(params: H.HistParams | BoostParams) -> H.HistParams:
    """Settings of the MLlib booster as those of the histogram booster."""
    if isinstance(params, H.HistParams):
        return params
    return H.HistParams(power=params.power, rounds=params.rounds, learning_rate=params.learning_rate, num_leaves=2 ** params.max_depth,
                        max_depth=params.max_depth, min_instances=params.min_instances, max_bins=params.max_bins,
                        row_fraction=params.row_fraction, col_fraction=params.col_fraction, seed=params.seed,
                        early_stopping_rounds=params.early_stopping_rounds)


def global_frame(panel: Panel, one_in: int | None = None) -> tuple[DataFrame, list[str]]:
    """Fact + features + split flag; returns the frame and the numeric
    features. ``one_in`` keeps whole series, one in so many by a hash of the id
    (O-52: the reference trains and validates its global models on one in 20);
    None keeps all."""
    lo, hi = panel.bounds
    checkpoint_dir(panel.spark)
    fact = panel.fact()
    f = series_features(fact if one_in is None else fact.where(hash_bucket("id", one_in, "md5") == 0))
    f = fill_features(f, GLOBAL_NUMERIC)
    f = EV.time_split(f, hi)
    snaps = [snap_column(s) for s, _ in panel.states]
    # Every remaining column is a feature (as VAL:94-100), except ids/keys.
    numeric = ["wday", "month", "year", *snaps, "sell_price", "price_max", *GLOBAL_NUMERIC]
    f = fill_features(f, ["sell_price", "price_max"])
    return f.select("item_id", "day_num", "sales", "split", *GLOBAL_CATS, *numeric), numeric


def global_fit(panel: Panel, params: H.HistParams, one_in: int | None = None) -> tuple[H.HistResult, DataFrame]:
    params = hist_params(params)
    f, numeric = global_frame(panel, one_in)
    # Materialise once in the shared checkpoint folder: binning, blocks and
    # scoring read this instead of re-running the scan, joins and windows.
    f = f.checkpoint(eager=True)
    train, test = f.where(F.col("split") == "train"), f.where(F.col("split") == "test")
    res = H.fit(train, numeric, GLOBAL_CATS, "sales", params, valid=test if params.early_stopping_rounds else None,
                state=state_path(panel, f"global-{one_in}", params))
    return res, test


def global_backtest(panel: Panel, params: H.HistParams, one_in: int | None = None) -> tuple[H.HistResult, DataFrame]:
    res, test = global_fit(panel, params, one_in)
    return res, res.model.predict(test, "yhat").select("item_id", "store_id", "day_num", "sales", "yhat")


def hybrid_frame(panel: Panel, trend_mode: str = "fitted", last_day: int | None = None
                 ) -> tuple[DataFrame, int]:
    """Rows up to ``last_day`` and the 28 days after it with the hybrid
    features. Without ``last_day`` the days after the data's end are added as
    the reference's production run does (last known attributes, no event);
    before the end they are the held-out rows themselves, with their real
    prices, flags and events, and the trend knows those flags too. Lags are at
    least the horizon, so held-out sales are in no feature."""
    lo, hi = panel.bounds
    checkpoint_dir(panel.spark)
    last = hi if last_day is None else last_day
    hist = FC.history_with_snap(panel)
    trend = TR.trend_lookup(store_day_agg(hist), last, trend_mode, HORIZON, known_future=last < hi)
    trend = trend.checkpoint(eager=True)  # a row per store and day, counted and joined
    if last < hi:
        ext = hist.where(F.col("day_num") <= last + HORIZON).withColumns({c: F.coalesce(c, F.lit("NoEvent")) for c in ("event_name_1", "event_type_1")})
    else:
        ext = FC.extend_history(hist, last)
    ext = join_trend(ext, trend, trend_rows=None)
    ext = FC.horizon_features(ext)
    dt = F.date_add(F.lit(ORIGIN).cast("date"), F.col("day_num") - 1)
    ext = ext.withColumns({"wday": F.weekday(dt), "month": F.month(dt), "day": F.dayofmonth(dt)})
    ext = fill_features(ext, ["store_trend", "lag_28", "lag_35", "rolling_std_28_7", "sell_price"])
    # Rows without the rolling mean (first 34 days of each series) are dropped (O-25).
    ext = ext.dropna(subset=["rolling_mean_28_7"])
    return ext.select("id", "store_id", "day_num", "sales", *HYBRID_CATS, *HYBRID_NUMERIC).checkpoint(eager=True), last


def hybrid_fit(panel: Panel, params: H.HistParams, trend_mode: str = "fitted", last_day: int | None = None
               ) -> tuple[list[H.HistResult], DataFrame, int]:
    """One model per store (up to ``MAX_GROUPS`` stores grow together, more
    stores take turns): results, horizon rows with ``yhat``, last day."""
    params = hist_params(params)
    ext, last = hybrid_frame(panel, trend_mode, last_day)
    train, after = ext.where(F.col("day_num") <= last), ext.where(F.col("day_num") > last)
    stores = sorted(r[0] for r in train.select("store_id").distinct().collect())
    results, scored = [], None
    for first in range(0, len(stores), H.MAX_GROUPS):
        turn = F.col("store_id").isin(stores[first:first + H.MAX_GROUPS])
        valid = after.where(turn) if params.early_stopping_rounds else None
        path = f"{state_path(panel, f'hybrid-{trend_mode}-{last}', params)}-{first}"
        res = H.fit(train.where(turn), HYBRID_NUMERIC, HYBRID_CATS, "sales", params, valid, "store_id", path)
        pred = res.model.predict(after.where(turn), "yhat")
        results.append(res)
        scored = pred if scored is None else scored.unionByName(pred)
    return results, scored, last


def hybrid_forecast(panel: Panel, params: H.HistParams, trend_mode: str = "fitted",
                    last_day: int | None = None) -> tuple[list[H.HistResult], DataFrame, int]:
    results, scored, last = hybrid_fit(panel, params, trend_mode, last_day)
    return results, scored.select("id", "day_num", F.col("yhat").alias("sales")), last


def best_rounds(spark, results: list[H.HistResult]) -> DataFrame:
    """store_id, best_round: rounds kept of each store's model."""
    rows = [(s, int(b)) for r in results for s, b in zip(r.model.groups, r.model.best_round or [len(r.model.trees)] * len(r.model.groups))]
    return spark.createDataFrame(rows, "store_id string, best_round int")


def learning_curve(spark, results: list[H.HistResult]) -> DataFrame:
    """round (from 1), store_id, valid_rmse, best_round of every trained round."""
    rows = [(h["round"] + 1, s, e, int(b)) for r in results for h in r.history
            for s, e, b in zip(r.model.groups, h["valid_rmse"], r.model.best_round) if e is not None]
    return spark.createDataFrame(rows, "round int, store_id string, valid_rmse double, best_round int")
