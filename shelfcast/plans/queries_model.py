"""Forecast, evaluation and modelling queries (O-30..O-32, O-38, O-53..O-63, O-70, O-71)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as E
from ..operators import evaluate as EV
from ..operators import histboost as H
from ..operators import sample as SM
from ..operators import trend as TR
from ..operators.aggregates import last_known_attrs, store_day_agg
from ..session import scratch_path
from . import forecast as FC
from . import train as TRN
from .catalog import register
from .oracle import SNAP_OWN, gram_sql, q, q_recursive, solve_sql

SNAP_CASE = SNAP_OWN

NAIVE_SQL = """,
pred AS (
  SELECT item_id, store_id, day_num, sales, sell_price,
         LAG(CAST(sales AS DOUBLE), 28) OVER (PARTITION BY item_id, store_id ORDER BY day_num) AS yhat
  FROM fact),
test AS (SELECT * FROM pred WHERE day_num > (SELECT hi FROM bounds) - 28),
train AS (SELECT * FROM pred WHERE day_num <= (SELECT hi FROM bounds) - 28)
"""


def _naive_split(p):
    lo, hi = p.bounds
    f = p.fact().select("item_id", "store_id", "day_num", "sales", "sell_price")
    return EV.time_split(EV.naive_forecast(f), hi), hi


@register("time_split", q("""
SELECT CASE WHEN day_num <= (SELECT hi FROM bounds) - 28 THEN 'train' ELSE 'test' END AS split,
       CAST(COUNT(*) AS BIGINT) AS n_rows, MIN(day_num) AS first_day, MAX(day_num) AS last_day,
       CAST(SUM(sales) AS BIGINT) AS sales
FROM fact GROUP BY 1"""))
def time_split_q(p):
    lo, hi = p.bounds
    s = EV.time_split(p.fact(), hi)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.min("day_num").alias("first_day"),
                                  F.max("day_num").alias("last_day"),
                                  F.sum("sales").cast("bigint").alias("sales"))


@register("backtest_store_rmse", q(NAIVE_SQL + """
SELECT store_id, SQRT(AVG((sales - yhat) * (sales - yhat))) AS rmse, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM test GROUP BY store_id"""), rnd=("rmse",))
def backtest_store_rmse(p):
    s, hi = _naive_split(p)
    return EV.store_rmse(s.where(F.col("split") == "test"))


@register("backtest_mean_rmse", q(NAIVE_SQL + """
SELECT AVG(rmse) AS mean_store_rmse, CAST(COUNT(*) AS BIGINT) AS n_stores FROM (
  SELECT store_id, SQRT(AVG((sales - yhat) * (sales - yhat))) AS rmse FROM test GROUP BY store_id) t"""),
          rnd=("mean_store_rmse",))
def backtest_mean_rmse(p):
    s, hi = _naive_split(p)
    return EV.mean_store_rmse(EV.store_rmse(s.where(F.col("split") == "test")))


@register("metrics_global", q(NAIVE_SQL + """
SELECT SQRT(AVG((sales - yhat) * (sales - yhat))) AS rmse,
       SUM(ABS(sales - yhat)) / SUM(CAST(sales AS DOUBLE)) AS wmape,
       1.0 - ABS(SUM(CAST(sales AS DOUBLE)) - SUM(yhat)) / SUM(CAST(sales AS DOUBLE)) AS volume_accuracy,
       CAST(COUNT(*) AS BIGINT) AS n_rows
FROM test"""), rnd=("rmse", "wmape", "volume_accuracy"))
def metrics_global(p):
    s, hi = _naive_split(p)
    return EV.global_metrics(s.where(F.col("split") == "test"))


RMSSE_SQL = NAIVE_SQL + """,
scale AS (
  SELECT item_id, store_id, AVG(dd * dd) AS scale FROM (
    SELECT item_id, store_id,
           CAST(sales AS DOUBLE) - LAG(CAST(sales AS DOUBLE)) OVER (PARTITION BY item_id, store_id ORDER BY day_num) AS dd
    FROM train) t GROUP BY 1, 2),
err AS (SELECT item_id, store_id, SUM((sales - yhat) * (sales - yhat)) / 28.0 AS mse,
               CAST(COUNT(*) AS BIGINT) AS n_test FROM test GROUP BY 1, 2),
rs AS (SELECT e.item_id, e.store_id, CASE WHEN s.scale > 0 THEN SQRT(e.mse / s.scale) END AS rmsse,
              s.scale, e.n_test FROM err e LEFT JOIN scale s USING (item_id, store_id)),
val AS (SELECT item_id, store_id, SUM(CAST(sales AS DOUBLE) * COALESCE(sell_price, 0.0)) AS value
        FROM train WHERE day_num > (SELECT hi FROM bounds) - 56 GROUP BY 1, 2)
"""


def _rmsse(p):
    lo, hi = p.bounds
    f = p.fact().select("item_id", "store_id", "day_num", "sales", "sell_price")
    return EV.scaled_errors(EV.naive_forecast(f), hi - 28)


@register("rmsse", q(RMSSE_SQL + "SELECT item_id, store_id, rmsse, scale, n_test FROM rs"),
          rnd=("rmsse", "scale"))
def rmsse_q(p):
    return _rmsse(p).drop("value")


@register("wrmsse", q(RMSSE_SQL + """
SELECT SUM(v.value * rs.rmsse) / SUM(v.value) AS wrmsse, CAST(COUNT(*) AS BIGINT) AS n_series
FROM rs JOIN val v USING (item_id, store_id) WHERE rs.rmsse IS NOT NULL"""), rnd=("wrmsse",))
def wrmsse_q(p):
    r = _rmsse(p).where(F.col("rmsse").isNotNull() & F.col("value").isNotNull())
    return r.agg(F.try_divide(F.sum(F.col("value") * F.col("rmsse")), F.sum("value")).alias("wrmsse"), F.count(F.lit(1)).alias("n_series"))


# ----------------------------------------------------------- forecast frame
LAST_SQL = f"""
SELECT id, item_id, dept_id, cat_id, store_id, state_id, sell_price, {SNAP_CASE} AS snap
FROM fact WHERE day_num = (SELECT hi FROM bounds)"""


@register("last_known_attrs", q(LAST_SQL))
def last_known_q(p):
    lo, hi = p.bounds
    return last_known_attrs(FC.history_with_snap(p), FC.LAST_ATTRS, "id", "day_num", hi)


FUTURE_SQL = f""",
lastv AS ({LAST_SQL}),
fut AS (
  SELECT l.id, CAST(g AS INTEGER) AS day_num, l.item_id, l.dept_id, l.cat_id, l.store_id, l.state_id,
         l.sell_price, l.snap, 'NoEvent' AS event_name_1, 'NoEvent' AS event_type_1,
         CAST(NULL AS DOUBLE) AS sales, 'd_' || CAST(g AS VARCHAR) AS d
  FROM lastv l, (SELECT unnest(generate_series(hi + 1, hi + 28)) AS g FROM bounds) t)
"""


@register("cross_future_grid", q(FUTURE_SQL + "SELECT id, day_num FROM fut"))
def cross_future_grid_q(p):
    from ..operators.joins import future_grid
    lo, hi = p.bounds
    ids = p.fact().select("id").distinct()
    return future_grid(ids, hi + 1, 28)


@register("join_last_known", q(FUTURE_SQL + """
SELECT id, day_num, d, item_id, dept_id, cat_id, store_id, state_id, sell_price, snap,
       event_name_1, event_type_1, sales FROM fut"""))
def join_last_known_q(p):
    lo, hi = p.bounds
    return FC.future_rows(FC.history_with_snap(p), hi).select(
        "id", "day_num", "d", "item_id", "dept_id", "cat_id", "store_id", "state_id", "sell_price",
        "snap", "event_name_1", "event_type_1", "sales")


@register("union_by_name", q(FUTURE_SQL + f"""
SELECT id, day_num, CAST(sales AS DOUBLE) AS sales, COALESCE(event_name_1, 'NoEvent') AS event_name_1,
       sell_price, {SNAP_CASE} AS snap, CAST(wm_yr_wk AS DOUBLE) AS wm_yr_wk
FROM fact
UNION ALL
SELECT id, day_num, sales, event_name_1, sell_price, snap, CAST(NULL AS DOUBLE) AS wm_yr_wk FROM fut"""))
def union_by_name_q(p):
    lo, hi = p.bounds
    ext = FC.extend_history(FC.history_with_snap(p), hi)
    # wm_yr_wk is missing on future rows (null), so it comes out as a double,
    # as a column missing from one side of a pandas concat does.
    return ext.select("id", "day_num", "sales", "event_name_1", "sell_price", "snap",
                      F.col("wm_yr_wk").cast("double").alias("wm_yr_wk"))


PRED_SQL = FUTURE_SQL + """,
ext AS (SELECT id, day_num, CAST(sales AS DOUBLE) AS sales FROM fact UNION ALL SELECT id, day_num, sales FROM fut),
naive AS (SELECT id, day_num, LAG(sales, 28) OVER (PARTITION BY id ORDER BY day_num) AS sales FROM ext)
"""


@register("predict_horizon", q(PRED_SQL + "SELECT id, day_num, sales FROM naive WHERE day_num > (SELECT hi FROM bounds)"))
def predict_horizon_q(p):
    return FC.naive_horizon(p)


SUBMISSION_BODY = """
SELECT * FROM (
  PIVOT (SELECT id, 'F' || CAST(day_num - (SELECT hi FROM bounds) AS VARCHAR) AS F, sales
         FROM naive WHERE day_num > (SELECT hi FROM bounds))
  ON F IN ('F1','F2','F3','F4','F5','F6','F7','F8','F9','F10','F11','F12','F13','F14',
           'F15','F16','F17','F18','F19','F20','F21','F22','F23','F24','F25','F26','F27','F28')
  USING first(sales) GROUP BY id)"""


@register("submission", q(PRED_SQL + SUBMISSION_BODY))
def submission_q(p):
    lo, hi = p.bounds
    return FC.submission(FC.naive_horizon(p), hi)


@register("horizon_features", q(FUTURE_SQL + """,
ext AS (SELECT id, day_num, CAST(sales AS DOUBLE) AS sales FROM fact UNION ALL SELECT id, day_num, sales FROM fut),
lg AS (SELECT id, day_num, sales, LAG(sales, 28) OVER w AS lag_28, LAG(sales, 35) OVER w AS lag_35
       FROM ext WINDOW w AS (PARTITION BY id ORDER BY day_num))
SELECT id, day_num, sales, lag_28, lag_35,
  CASE WHEN COUNT(lag_28) OVER r = 7 THEN AVG(lag_28) OVER r END AS rolling_mean_28_7,
  CASE WHEN COUNT(lag_28) OVER r = 7 THEN STDDEV_SAMP(lag_28) OVER r END AS rolling_std_28_7
FROM lg WINDOW r AS (PARTITION BY id ORDER BY day_num ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""),
          rnd=("rolling_mean_28_7", "rolling_std_28_7"))
def horizon_features_q(p):
    lo, hi = p.bounds
    ext = FC.extend_history(FC.history_with_snap(p), hi).select("id", "day_num", "sales")
    return FC.horizon_features(ext)


# ------------------------------------------------------------------ models

# The reference's settings. Global models: 200 rounds at 0.01 with 127 leaves on
# one series in 20; per-store models: 90 rounds at 0.1 with 31 leaves, or up to
# 1,000 with a patience of 30. The depth bounds the passes of a round.
ONE_IN = 20
GLOBAL = dict(rounds=200, learning_rate=0.01, num_leaves=127, max_depth=8, max_bins=63)
STORE = dict(power=1.1, learning_rate=0.1, num_leaves=31, max_depth=6, max_bins=63, row_fraction=0.8, col_fraction=0.8)
TWEEDIE = H.HistParams(power=1.1, **GLOBAL)
BACKTEST = H.HistParams(rounds=1000, early_stopping_rounds=30, **STORE)

ENC_COLS = ["store_id", "dept_id", "cat_id", "event_name_1"]


@register("ordinal_encode", q(""",
tr AS (SELECT * FROM fact WHERE day_num <= (SELECT hi FROM bounds) - 28),
""" + ",\n".join(f"""m_{c} AS (SELECT v, CAST(ROW_NUMBER() OVER (ORDER BY v ASC NULLS FIRST) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT {c} AS v FROM tr) t),
a_{c} AS (SELECT '{c}' AS column_name, a.v AS value, CAST(COALESCE(m.code, -1) AS INTEGER) AS code
          FROM (SELECT DISTINCT {c} AS v FROM fact) a LEFT JOIN m_{c} m ON a.v IS NOT DISTINCT FROM m.v)"""
                 for c in ENC_COLS) + "\n" + " UNION ALL ".join(f"SELECT * FROM a_{c}" for c in ENC_COLS)))
def ordinal_encode_q(p):
    lo, hi = p.bounds
    f = p.fact()
    maps = E.fit_ordinal(f.where(F.col("day_num") <= hi - 28), ENC_COLS)
    enc = E.apply_ordinal(f, maps)
    # One pass over the encoded rows: stack (column, value, code) triples.
    triples = ", ".join(f"'{c}', CAST(`{c}` AS STRING), `{c}_code`" for c in ENC_COLS)
    return enc.select(F.expr(f"stack({len(ENC_COLS)}, {triples}) AS (column_name, value, code)")).distinct()


TREND_SQL = f""",
sd AS (SELECT store_id, day_num, SUM(sales) AS sales, MAX({SNAP_CASE}) AS snap,
              CASE WHEN COALESCE(MAX(event_name_1), 'NoEvent') = 'NoEvent' THEN 0 ELSE 1 END AS is_event
       FROM fact GROUP BY store_id, day_num),
x AS (SELECT store_id, day_num, LN(1 + CAST(sales AS DOUBLE)) AS y, CAST(snap AS DOUBLE) AS snap,
             CAST(is_event AS DOUBLE) AS is_event, 1.0 AS one,
             LAG(LN(1 + CAST(sales AS DOUBLE)), 1) OVER w AS y1, LAG(LN(1 + CAST(sales AS DOUBLE)), 7) OVER w AS y7,
             LAG(LN(1 + CAST(sales AS DOUBLE)), 8) OVER w AS y8
      FROM sd WINDOW w AS (PARTITION BY store_id ORDER BY day_num)),
xf AS (SELECT * FROM x WHERE y1 IS NOT NULL AND y7 IS NOT NULL AND y8 IS NOT NULL)
"""
_GRAM_COLS = gram_sql(TR.REGRESSORS)


@register("trend_gram", q(TREND_SQL + "SELECT store_id, " + ", ".join(f"{e} AS {n}" for e, n in _GRAM_COLS)
                          + ", CAST(COUNT(*) AS BIGINT) AS n_obs FROM xf GROUP BY store_id"),
          rnd=tuple(n for _, n in _GRAM_COLS), digits=4)
def trend_gram_q(p):
    sd = store_day_agg(FC.history_with_snap(p))
    return TR.gram_sums(TR.design(sd))


# The second regression: shocks from the long autoregression, their lags as regressors.
_LONG_LAGS = ", ".join(f"LAG(y, {n}) OVER w AS {k}" for k, n in TR.LONG_LAGS.items() if k not in TR.LAGS)
_SUMS = lambda names: ", ".join(f"{e} AS {n}" for e, n in gram_sql(names))
_DOT = lambda names, beta: " + ".join(f"{beta}[{i + 1}] * {n}" for i, n in enumerate(names))
SHOCK_SQL = TREND_SQL + f""",
xl AS MATERIALIZED (
  SELECT * FROM (SELECT *, {_LONG_LAGS} FROM x WINDOW w AS (PARTITION BY store_id ORDER BY day_num)) t
  WHERE {" AND ".join(f"{k} IS NOT NULL" for k in TR.LONG_LAGS)}),
gl AS (SELECT store_id, {_SUMS(TR.LONG_REGRESSORS)} FROM xl GROUP BY store_id),
{solve_sql("gl", TR.LONG_REGRESSORS, TR.RIDGE, "long")},
sh AS MATERIALIZED (SELECT xl.store_id, day_num, y - ({_DOT(TR.LONG_REGRESSORS, "beta")}) AS e FROM xl JOIN long USING (store_id)),
xm AS MATERIALIZED (
  SELECT * FROM (
    SELECT xf.*, {", ".join(f"LAG(e, {n}) OVER w AS {k}" for k, n in TR.SHOCKS.items())}
    FROM xf LEFT JOIN sh USING (store_id, day_num) WINDOW w AS (PARTITION BY store_id ORDER BY day_num)) t
  WHERE {" AND ".join(f"{k} IS NOT NULL" for k in TR.SHOCKS)}),
gm AS (SELECT store_id, {_SUMS(TR.MODEL)}, CAST(COUNT(*) AS BIGINT) AS n_obs FROM xm GROUP BY store_id)
"""

ARMA_SQL = SHOCK_SQL + f""",
{solve_sql("gm", TR.MODEL, TR.RIDGE, "model")},
tail AS (SELECT x.store_id, list(y ORDER BY x.day_num) AS ys, list(e ORDER BY x.day_num) AS es, arg_max(x.snap, x.day_num) AS last_snap
         FROM x LEFT JOIN sh USING (store_id, day_num) WHERE x.day_num > (SELECT hi FROM bounds) - {TR.TAIL} GROUP BY x.store_id),
fc AS (
  SELECT store_id, 0 AS h, ys, es, last_snap, beta FROM tail JOIN model USING (store_id)
  UNION ALL
  SELECT store_id, h + 1, list_append(ys, beta[1] + beta[2] * ys[-1] + beta[3] * ys[-7] + beta[4] * ys[-8] + beta[5] * last_snap
                                          + beta[7] * es[-1] + beta[8] * es[-7] + beta[9] * es[-8]),
         list_append(es, 0.0), last_snap, beta
  FROM fc WHERE h < {TR.HORIZON}),
forecast AS (SELECT store_id, CAST((SELECT hi FROM bounds) + h AS INTEGER) AS day_num, EXP(ys[-1]) - 1 AS store_trend, beta FROM fc WHERE h > 0)
"""


@register("trend_gram_ma", q_recursive(SHOCK_SQL + "SELECT * FROM gm"), rnd=tuple(n for _, n in gram_sql(TR.MODEL)), digits=3)
def trend_gram_ma_q(p):
    sd = store_day_agg(FC.history_with_snap(p)).checkpoint(eager=True)
    return TR.gram_sums(TR.design_ma(sd, TR.shocks(sd)), regressors=TR.MODEL)


_BETAS = [f"beta_{n}" for n in TR.MODEL]


@register("trend_arx", q_recursive(ARMA_SQL + "SELECT store_id, day_num, store_trend, "
                                   + ", ".join(f"beta[{i + 1}] AS {b}" for i, b in enumerate(_BETAS)) + " FROM forecast"),
          rnd=("store_trend", *_BETAS), digits=4)
def trend_arx_q(p):
    lo, hi = p.bounds
    sd = store_day_agg(FC.history_with_snap(p))
    return TR.fit_forecast(sd, hi)


@register("trend_lookup", q_recursive(ARMA_SQL + f"""
SELECT store_id, day_num, EXP({_DOT(TR.MODEL, "beta")}) - 1 AS store_trend FROM xm JOIN model USING (store_id)
UNION ALL SELECT store_id, day_num, store_trend FROM forecast"""), rnd=("store_trend",), digits=3)
def trend_lookup_q(p):
    lo, hi = p.bounds
    sd = store_day_agg(FC.history_with_snap(p))
    return TR.trend_lookup(sd, hi, "fitted")


@register("boost_histogram", q(f"""
, tr AS (SELECT store_id, dept_id, CAST(sales AS DOUBLE) AS y FROM fact WHERE day_num <= (SELECT hi FROM bounds) - 28),
m AS (SELECT store_id, LN(AVG(y)) AS m FROM tr GROUP BY store_id)
SELECT store_id, dept_id, CAST(COUNT(*) AS BIGINT) AS n,
       SUM(-y * EXP(({1 - TWEEDIE.power}) * m) + EXP(({2 - TWEEDIE.power}) * m)) AS g,
       SUM(-y * ({1 - TWEEDIE.power}) * EXP(({1 - TWEEDIE.power}) * m) + ({2 - TWEEDIE.power}) * EXP(({2 - TWEEDIE.power}) * m)) AS h
FROM tr JOIN m USING (store_id) GROUP BY store_id, dept_id"""), rnd=("g", "h"), digits=0)
def boost_histogram_q(p):
    # Gradient and hessian sums of the first pass, by store and department.
    lo, hi = p.bounds
    train = p.fact().where(F.col("day_num") <= hi - 28).select("store_id", "dept_id", "sales")
    return H.category_histogram(train, "dept_id", "sales", TWEEDIE, "store_id").withColumnsRenamed({"grp": "store_id", "value": "dept_id"})


@register("train_poisson", None)
def train_poisson_q(p):
    return TRN.global_backtest(p, H.HistParams(power=1.0, **GLOBAL), ONE_IN)[1]


@register("train_tweedie", None)
def train_tweedie_q(p):
    return TRN.global_backtest(p, TWEEDIE, ONE_IN)[1]


@register("model_save_load", q(f"""
SELECT store_id, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(*) AS BIGINT) AS n_same FROM fact
WHERE day_num > (SELECT hi FROM bounds) - 28 AND (CAST(('0x' || SUBSTR(md5(id), 1, 8)) AS BIGINT) % {ONE_IN}) = 0
GROUP BY store_id"""))
def model_save_load_q(p):
    # The model of train_tweedie (its stored rounds are gone on with, not
    # trained again): every held-out row must get the same forecast from the
    # saved and loaded model.
    res, test = TRN.global_fit(p, TWEEDIE, ONE_IN)
    path = scratch_path(p.spark, "model")
    res.model.save(p.spark, path)
    both = H.HistModel.load(p.spark, path).predict(res.model.predict(test, "yhat"), "yhat_loaded")
    return both.groupBy("store_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                        F.sum((F.col("yhat") == F.col("yhat_loaded")).cast("bigint")).alias("n_same"))


@register("hybrid_submission", None)
def hybrid_submission_q(p):
    results, pred, last = TRN.hybrid_forecast(p, H.HistParams(rounds=90, **STORE))
    return FC.submission(pred, last)


@register("early_stop", None)
def early_stop_q(p):
    lo, hi = p.bounds
    results, scored, last = TRN.hybrid_fit(p, BACKTEST, last_day=hi - 28)
    return TRN.learning_curve(p.spark, results)


@register("hybrid_backtest", None)
def hybrid_backtest_q(p):
    # Real prices, flags and events of the held-out days; one row a store with
    # the rounds kept, as the reference's report (O-59).
    lo, hi = p.bounds
    results, scored, last = TRN.hybrid_fit(p, BACKTEST, last_day=hi - 28)
    return EV.store_rmse(scored).join(F.broadcast(TRN.best_rounds(p.spark, results)), "store_id")  # a row per store


@register("row_sample", q("""
SELECT id, day_num, sales FROM fact
WHERE sales > 0 AND substr(md5(id || '|' || CAST(day_num AS VARCHAR)), 1, 2) < '1a'"""))
def row_sample_q(p):
    # A tenth (26 of 256 hash values) of the non-zero rows, by a hash of
    # series and day: the same rows in every run and at any partitioning.
    key = F.md5(F.concat_ws("|", "id", F.col("day_num").cast("string")).cast("binary"))
    return p.fact().where((F.col("sales") > 0) & (F.substring(key, 1, 2) < "1a")).select("id", "day_num", "sales")


@register("sample_fixed", q("""
SELECT id, day_num, sales FROM fact WHERE sales > 0
ORDER BY md5(id || '|' || CAST(day_num AS VARCHAR)), id, day_num LIMIT 10000"""))
def sample_fixed_q(p):
    # The size is the feature: 10,000 of the non-zero rows, no more, no less.
    return SM.fixed_size_sample(p.fact().where(F.col("sales") > 0).select("id", "day_num", "sales"), ["id", "day_num"], 10_000)


@register("sample_department", q("""
SELECT id, day_num, sell_price, sales FROM fact
WHERE dept_id = 'DEPT_3' AND substr(md5(id || '|' || CAST(day_num AS VARCHAR)), 1, 8) < '028f5c29'"""))
def sample_department_q(p):
    # 1 % of one department's rows (price against sales).
    dept = p.fact().where(F.col("dept_id") == "DEPT_3").select("id", "day_num", "sell_price", "sales")
    return SM.fraction_sample(dept, ["id", "day_num"], 0.01)


@register("join_trend", q(f""",
sd AS (SELECT store_id, day_num, CAST(SUM(sales) AS DOUBLE) AS store_trend FROM fact GROUP BY 1, 2)
SELECT f.id, f.day_num, f.sales, sd.store_trend
FROM fact f LEFT JOIN sd ON f.store_id = sd.store_id AND f.day_num = sd.day_num"""))
def join_trend_q(p):
    # trend_mode='actual': the history part of the trend lookup is the
    # store's same-day total (deterministic, so oracle-checkable).
    from ..operators.joins import join_trend
    f = p.fact()
    sd = store_day_agg(FC.history_with_snap(p)).select(
        "store_id", "day_num", F.col("sales").cast("double").alias("store_trend")).checkpoint(eager=True)
    # (counted and joined: a row per store and day, computed once)
    return join_trend(f, sd, trend_rows=None).select("id", "day_num", "sales", "store_trend")
