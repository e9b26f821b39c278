"""Panel construction, reshape, join and window queries (O-15..O-32, O-44..O-50, O-67)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import day_number, horizon_label
from ..operators import joins as J
from ..operators import reshape as R
from ..operators import windows as W
from .catalog import register
from .etl import ID_COLS, etl_flagship, wide_sales
from .oracle import SNAP_COLS, SNAP_OWN, q

FACT_SELECT = ("store_id, item_id, wm_yr_wk, d, id, dept_id, cat_id, state_id, sales, wday, month, "
               f"year, event_name_1, event_type_1, {SNAP_COLS}, sell_price, day_num")


@register("etl_flagship", q(f"SELECT {FACT_SELECT} FROM fact"))
def etl_flagship_q(p):
    return etl_flagship(p)


# ---------------------------------------------------------------- reshapes

DENSE_IDS = ("SELECT item_id || '_' || store_id AS id, item_id, "
             "'DEPT_' || CAST(CAST(regexp_extract(item_id, '(\\d+)$', 1) AS INTEGER) % 6 AS VARCHAR) AS dept_id, "
             "'CAT_' || CAST(CAST(regexp_extract(item_id, '(\\d+)$', 1) AS INTEGER) % 6 % 3 AS VARCHAR) AS cat_id, "
             "store_id, state_id, day_num, sales FROM dense")


@register("melt", q(f"""
SELECT id, item_id, dept_id, cat_id, store_id, state_id, 'd_' || day_num AS d, sales
FROM ({DENSE_IDS}) t"""))
def melt_q(p):
    return R.melt(wide_sales(p), ID_COLS, r"^d_\d+$", "d", "sales")


@register("pivot_horizon", q("""
SELECT * FROM (
  PIVOT (SELECT id, 'F' || CAST(day_num - (SELECT hi FROM bounds) + 28 AS VARCHAR) AS F, sales
         FROM fact WHERE day_num > (SELECT hi FROM bounds) - 28)
  ON F IN ('F1','F2','F3','F4','F5','F6','F7','F8','F9','F10','F11','F12','F13','F14',
           'F15','F16','F17','F18','F19','F20','F21','F22','F23','F24','F25','F26','F27','F28')
  USING first(sales) GROUP BY id)"""))
def pivot_horizon_q(p):
    # The last 28 days (the forecast horizon length) of every series as
    # columns F1..F28, labels given explicitly in numeric order.
    lo, hi = p.bounds
    last = hi - 28
    f = p.fact().where(F.col("day_num") > last).select(
        "id", horizon_label(F.col("day_num"), last).alias("F"), "sales")
    return R.pivot_labels(f, "id", "F", "sales", [f"F{i}" for i in range(1, 29)])


@register("project_reorder", q("""
SELECT id, d, sales, store_id, item_id FROM fact"""))
def project_reorder_q(p):
    return R.project_reorder(p.fact(), ["id", "d", "sales", "store_id", "item_id"])


@register("drop_if_exists", q(f"""
SELECT store_id, item_id, dept_id, cat_id, state_id, sales, wday, month, year, event_name_1, event_type_1,
       {SNAP_COLS}, sell_price FROM fact"""))
def drop_if_exists_q(p):
    # 'date' is absent and silently ignored, as in the reference.
    return R.drop_if_exists(p.fact(), ["d", "day_num", "id", "date", "wm_yr_wk"])


@register("rename", q("""
SELECT store_id, day_num, CAST(SUM(sales) AS BIGINT) AS store_trend FROM fact GROUP BY 1, 2"""))
def rename_q(p):
    agg = p.fact().groupBy("store_id", "day_num").agg(F.sum("sales").cast("bigint").alias("sales"))
    return R.rename(agg, {"sales": "store_trend"})


@register("filter_predicates", q("""
SELECT id, day_num, sales, sell_price FROM fact
WHERE sales > 0 AND sell_price IS NOT NULL AND cat_id = 'CAT_0' AND day_num <= 2000 AND day_num > 100"""))
def filter_predicates_q(p):
    f = p.fact()
    return R.filter_where(
        f, (F.col("sales") > 0) & F.col("sell_price").isNotNull() & (F.col("cat_id") == "CAT_0")
        & (F.col("day_num") <= 2000) & (F.col("day_num") > 100)
    ).select("id", "day_num", "sales", "sell_price")


@register("filter_suffix", q("""
SELECT id, day_num, sales FROM fact
WHERE id LIKE '%\\_NATION\\_1' ESCAPE '\\' OR id LIKE '%\\_NATION\\_2' ESCAPE '\\' OR id LIKE '%\\_NATION\\_3' ESCAPE '\\'"""))
def filter_suffix_q(p):
    return R.filter_suffix(p.fact(), "id", ["_NATION_1", "_NATION_2", "_NATION_3"]).select(
        "id", "day_num", "sales")


@register("filter_not_like", q("""
SELECT state_id, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(SUM(sales) AS BIGINT) AS sales
FROM fact WHERE state_id NOT LIKE 'A%' GROUP BY state_id"""))
def filter_not_like_q(p):
    f = R.filter_not_like(p.fact(), "state_id", "A%")
    return f.groupBy("state_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.sum("sales").cast("bigint").alias("sales"))


@register("narrow_types", q("""
SELECT store_id, item_id, day_num, CAST(sales AS INTEGER) AS sales, CAST(sell_price AS FLOAT) AS sell_price,
       CAST(total AS INTEGER) AS total
FROM (SELECT store_id, item_id, day_num, sales, sell_price,
             CAST(SUM(sales) OVER (PARTITION BY store_id, item_id) AS BIGINT) AS total FROM fact) t"""))
def narrow_types_q(p):
    from pyspark.sql import Window
    f = p.fact().select("store_id", "item_id", "day_num", "sales", "sell_price")
    f = f.withColumn("total", F.sum("sales").over(Window.partitionBy("store_id", "item_id")).cast("bigint"))
    return R.narrow_types(f)


LAGS_SQL = """,
lagged AS (
  SELECT item_id, store_id, day_num, sales, sell_price,
    CAST(LAG(sales, 28) OVER w AS DOUBLE) AS lag_28, CAST(LAG(sales, 35) OVER w AS DOUBLE) AS lag_35,
    CAST(LAG(sales, 42) OVER w AS DOUBLE) AS lag_42, CAST(LAG(sales, 49) OVER w AS DOUBLE) AS lag_49
  FROM fact WINDOW w AS (PARTITION BY item_id, store_id ORDER BY day_num)),
rolled AS (
  SELECT *,
    CASE WHEN COUNT(lag_28) OVER r28 = 28 THEN AVG(lag_28) OVER r28 END AS roll_mean_28,
    CASE WHEN COUNT(lag_28) OVER r28 = 28 THEN STDDEV_SAMP(lag_28) OVER r28 END AS roll_std_28,
    CASE WHEN COUNT(lag_28) OVER r7 = 7 THEN AVG(lag_28) OVER r7 END AS rolling_mean_28_7,
    CASE WHEN COUNT(lag_28) OVER r7 = 7 THEN STDDEV_SAMP(lag_28) OVER r7 END AS rolling_std_28_7,
    MAX(sell_price) OVER (PARTITION BY item_id, store_id) AS price_max,
    CASE WHEN COUNT(sell_price) OVER r7 = 7 THEN STDDEV_SAMP(sell_price) OVER r7 END AS price_roll_std_7
  FROM lagged
  WINDOW r28 AS (PARTITION BY item_id, store_id ORDER BY day_num ROWS BETWEEN 27 PRECEDING AND CURRENT ROW),
         r7 AS (PARTITION BY item_id, store_id ORDER BY day_num ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
"""


@register("lag_features", q(LAGS_SQL + """
SELECT item_id, store_id, day_num, sales, lag_28, lag_35, lag_42, lag_49 FROM rolled"""))
def lag_features_q(p):
    f = p.fact().select("item_id", "store_id", "day_num", "sales")
    return W.lag_features(f, (28, 35, 42, 49))


@register("rolling_lagged_28", q(LAGS_SQL + """
SELECT item_id, store_id, day_num, roll_mean_28, roll_std_28 FROM rolled"""),
          rnd=("roll_mean_28", "roll_std_28"))
def rolling_lagged_28_q(p):
    f = p.fact().select("item_id", "store_id", "day_num", "sales")
    return W.rolling_lagged(f, 28, 28).drop("sales")


@register("rolling_lagged_7", q(LAGS_SQL + """
SELECT item_id, store_id, day_num, rolling_mean_28_7, rolling_std_28_7 FROM rolled"""),
          rnd=("rolling_mean_28_7", "rolling_std_28_7"))
def rolling_lagged_7_q(p):
    f = p.fact().select("item_id", "store_id", "day_num", "sales")
    return W.rolling_lagged(f, 7, 28, names=("rolling_mean_28_7", "rolling_std_28_7")).drop("sales")


@register("price_features", q(LAGS_SQL + """
SELECT item_id, store_id, day_num, sell_price, price_max, sell_price / price_max AS price_momentum FROM rolled"""),
          rnd=("price_momentum",))
def price_features_q(p):
    f = p.fact().select("item_id", "store_id", "day_num", "sell_price")
    return W.price_features(f)


@register("price_volatility_7", q(LAGS_SQL + """
SELECT item_id, store_id, day_num, price_roll_std_7 FROM rolled"""), rnd=("price_roll_std_7",))
def price_volatility_q(p):
    f = p.fact().select("item_id", "store_id", "day_num", "sell_price")
    return W.price_volatility(f, 7).drop("sell_price")


FEATURES = ["lag_28", "lag_35", "lag_42", "lag_49", "roll_mean_28", "roll_std_28",
            "price_momentum", "price_roll_std_7"]


@register("fill_features", q(LAGS_SQL + """
SELECT item_id, store_id, day_num,
  COALESCE(lag_28, -1) AS lag_28, COALESCE(lag_35, -1) AS lag_35, COALESCE(lag_42, -1) AS lag_42,
  COALESCE(lag_49, -1) AS lag_49, COALESCE(roll_mean_28, -1) AS roll_mean_28,
  COALESCE(roll_std_28, -1) AS roll_std_28, COALESCE(sell_price / price_max, -1) AS price_momentum,
  COALESCE(price_roll_std_7, -1) AS price_roll_std_7
FROM rolled"""), rnd=("roll_mean_28", "roll_std_28", "price_momentum", "price_roll_std_7"))
def fill_features_q(p):
    f = p.fact().select("item_id", "store_id", "day_num", "sales", "sell_price")
    f = W.series_features(f)
    return R.fill_features(f, FEATURES).select("item_id", "store_id", "day_num", *FEATURES)


@register("dropna_subset", q(LAGS_SQL + """
SELECT item_id, store_id, day_num, sales, rolling_mean_28_7 FROM rolled WHERE rolling_mean_28_7 IS NOT NULL"""),
          rnd=("rolling_mean_28_7",))
def dropna_subset_q(p):
    f = p.fact().select("item_id", "store_id", "day_num", "sales")
    f = W.rolling_lagged(f, 7, 28, names=("rolling_mean_28_7", "rolling_std_28_7"))
    return R.dropna_subset(f, ["rolling_mean_28_7"]).drop("rolling_std_28_7")


@register("const_columns", q("""
SELECT id, CAST(g AS INTEGER) AS day_num, 'NoEvent' AS event_name_1, 'NoEvent' AS event_type_1,
       CAST(NULL AS DOUBLE) AS sales
FROM (SELECT DISTINCT id FROM fact) i, (SELECT unnest(generate_series(hi + 1, hi + 28)) AS g FROM bounds) t"""))
def const_columns_q(p):
    # Constants of the future rows (O-26): no event, unknown sales, on the
    # whole 28-day grid of every series.
    lo, hi = p.bounds
    grid = J.future_grid(p.fact().select("id").distinct(), hi + 1, 28)
    return R.const_columns(grid, {"event_name_1": "NoEvent", "event_type_1": "NoEvent", "sales": None},
                           {"sales": "double"})


@register("snap_for_state", q(f"""
SELECT id, day_num, state_id,
  {SNAP_OWN} AS snap
FROM fact"""))
def snap_for_state_q(p):
    f = R.snap_for_state(p.fact(), [s for s, _ in p.states])
    return f.select("id", "day_num", "state_id", "snap")


@register("features_all", q(LAGS_SQL + """
SELECT item_id, store_id, day_num, sales, sell_price, lag_28, lag_35, lag_42, lag_49, roll_mean_28, roll_std_28,
  price_max, sell_price / price_max AS price_momentum, price_roll_std_7 FROM rolled"""),
          rnd=("roll_mean_28", "roll_std_28", "price_momentum", "price_roll_std_7"))
def features_all_q(p):
    f = p.fact().select("item_id", "store_id", "day_num", "sales", "sell_price")
    return W.series_features(f)


# ------------------------------------------------------------------- joins
@register("join_calendar", q("""
SELECT c.item_id, c.store_id, c.day_num, c.sales, cal.d, cal.wday, cal.month, cal.year, cal.event_name_1
FROM cells c LEFT JOIN calendar cal ON c.day_num = cal.day_num"""))
def join_calendar_q(p):
    lo, hi = p.bounds
    cal = p.calendar().select("day_num", "d", "wday", "month", "year", "event_name_1")
    return J.join_calendar(p.cells().select("item_id", "store_id", "day_num", "sales"), cal,
                           on="day_num", cal_rows=hi - lo + 1)


@register("join_prices", q("""
SELECT c.item_id, c.store_id, c.day_num, c.sales, c.wm_yr_wk, pr.sell_price
FROM (SELECT *, CAST(floor((day_num - 1) / 7) AS INTEGER) AS wm_yr_wk FROM cells) c
LEFT JOIN prices pr ON pr.store_id = c.store_id AND pr.item_id = c.item_id AND pr.wm_yr_wk = c.wm_yr_wk"""))
def join_prices_q(p):
    c = p.cells().select("item_id", "store_id", "day_num", "sales").withColumn(
        "wm_yr_wk", F.floor((F.col("day_num") - 1) / 7).cast("int"))
    return J.join_prices(c, p.prices()).select("item_id", "store_id", "day_num", "sales",
                                               "wm_yr_wk", "sell_price")


@register("densify_panel", q("SELECT item_id, store_id, state_id, day_num, sales FROM dense"))
def densify_panel_q(p):
    return p.dense()


@register("day_number", q("""
SELECT d, TRY_CAST(SUBSTR(d, 3) AS INTEGER) AS n_substring,
  TRY_CAST(split_part(d, '_', 2) AS INTEGER) AS n_split,
  TRY_CAST(NULLIF(regexp_extract(d, '(\\d+)', 1), '') AS INTEGER) AS n_regex
FROM (SELECT DISTINCT d FROM fact)"""))
def day_number_q(p):
    f = p.fact().select("d").distinct()
    return f.select("d", day_number("d", "substring").alias("n_substring"),
                    day_number("d", "split").alias("n_split"),
                    day_number("d", "regex").alias("n_regex"))
