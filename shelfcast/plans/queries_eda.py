"""Exploratory queries (O-33..O-43, O-51, O-52, O-68, O-72, S-functions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (day_label, day_to_date, date_parts, event_flag, hash_bucket, horizon_label,
                         log_scale, pct, safe_ratio, state_prefix, unlog_scale)
from ..operators import aggregates as A
from ..operators.reshape import snap_for_state
from ..operators.windows import sale_gaps
from .catalog import register
from .oracle import SNAP_OWN, q

SNAP_CASE = SNAP_OWN


def _with_snap(p):
    return snap_for_state(p.fact(), [s for s, _ in p.states])


@register("row_count", q("SELECT CAST(COUNT(*) AS BIGINT) AS row_count FROM fact"))
def row_count(p):
    return A.row_count(p.fact())


@register("global_trend", q("""
SELECT CAST(SUBSTR(d, 3) AS INTEGER) AS day_num, CAST(SUM(sales) AS BIGINT) AS total_sales
FROM fact GROUP BY 1 ORDER BY 1"""))
def global_trend(p):
    return A.global_trend(p.fact())


@register("seasonality_weekday", q("""
SELECT wday, AVG(sales) AS avg_sales FROM fact GROUP BY wday ORDER BY wday"""), rnd=("avg_sales",))
def seasonality_weekday(p):
    return A.seasonality(p.fact(), "wday")


@register("seasonality_month", q("""
SELECT month, AVG(sales) AS avg_sales FROM fact GROUP BY month ORDER BY month"""), rnd=("avg_sales",))
def seasonality_month(p):
    return A.seasonality(p.fact(), "month")


@register("snap_effect", q(f"""
SELECT state_id, cat_id, CAST({SNAP_CASE} AS INTEGER) AS snap, AVG(sales) AS avg_sales,
       CAST(COUNT(*) AS BIGINT) AS n_rows
FROM fact GROUP BY 1, 2, 3 ORDER BY 1, 2, 3"""), rnd=("avg_sales",))
def snap_effect(p):
    return A.snap_effect(_with_snap(p))


@register("category_balance", q("""
SELECT cat_id, CAST(COUNT(*) AS BIGINT) AS count FROM fact GROUP BY cat_id ORDER BY count DESC, cat_id"""))
def category_balance(p):
    return A.category_balance(p.fact())


@register("zero_rate", q("""
SELECT CAST(COUNT(*) AS BIGINT) AS total_rows,
       CAST(SUM(CASE WHEN sales = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_rows,
       SUM(CASE WHEN sales = 0 THEN 1 ELSE 0 END) * 100.0 / COUNT(*) AS sparsity_pct,
       100.0 - SUM(CASE WHEN sales = 0 THEN 1 ELSE 0 END) * 100.0 / COUNT(*) AS non_zero_pct
FROM fact"""), rnd=("sparsity_pct", "non_zero_pct"))
def zero_rate(p):
    return A.zero_rate(p.fact())


@register("distinct_pairs", q("""
SELECT DISTINCT item_id, sell_price FROM fact WHERE sell_price IS NOT NULL"""))
def distinct_pairs(p):
    return A.distinct_pairs(p.fact(), ["item_id", "sell_price"], not_null=["sell_price"])


@register("distinct_ids", q("SELECT DISTINCT id FROM fact"))
def distinct_ids(p):
    return A.distinct_pairs(p.fact(), ["id"])


@register("store_day_agg", q(f"""
SELECT store_id, day_num, CAST(SUM(sales) AS BIGINT) AS sales, CAST(MAX({SNAP_CASE}) AS INTEGER) AS snap,
       MAX(event_name_1) AS event_name_1,
       CASE WHEN COALESCE(MAX(event_name_1), 'NoEvent') = 'NoEvent' THEN 0 ELSE 1 END AS is_event
FROM fact GROUP BY store_id, day_num"""))
def store_day_agg(p):
    return A.store_day_agg(_with_snap(p))


GAPS_SQL = """
gaps AS (
  SELECT item_id, store_id, day_num,
         CAST(day_num - LAG(day_num) OVER (PARTITION BY item_id, store_id ORDER BY day_num) AS INTEGER) AS gap
  FROM fact WHERE sales > 0)"""


@register("sale_gaps", q(f""", {GAPS_SQL}
SELECT item_id, store_id, day_num, gap FROM gaps WHERE gap IS NOT NULL"""))
def sale_gaps_q(p):
    return sale_gaps(p.fact())


@register("gap_summary", q(f""", {GAPS_SQL}
SELECT item_id, AVG(gap) AS avg_gap, MAX(gap) AS max_gap, CAST(COUNT(*) AS BIGINT) AS n_gaps
FROM gaps WHERE gap IS NOT NULL GROUP BY item_id"""), rnd=("avg_gap",))
def gap_summary(p):
    return A.gap_summary(sale_gaps(p.fact()), by=["item_id"])


def _hist_sql(src: str, col: str, bins: int) -> str:
    return f""", hsrc AS ({src}),
hb AS (SELECT MIN(CAST({col} AS DOUBLE)) AS lo, MAX(CAST({col} AS DOUBLE)) AS hi FROM hsrc)
SELECT CAST(CASE WHEN hb.hi = hb.lo THEN 0
                 ELSE LEAST(FLOOR((CAST({col} AS DOUBLE) - hb.lo) / ((hb.hi - hb.lo) / {bins})), {bins - 1}) END
            AS INTEGER) AS bin,
       ANY_VALUE(hb.lo + (hb.hi - hb.lo) * CAST(CASE WHEN hb.hi = hb.lo THEN 0
                 ELSE LEAST(FLOOR((CAST({col} AS DOUBLE) - hb.lo) / ((hb.hi - hb.lo) / {bins})), {bins - 1}) END
            AS INTEGER) / {bins}) AS bin_start,
       CAST(COUNT(*) AS BIGINT) AS count
FROM hsrc, hb WHERE {col} IS NOT NULL GROUP BY 1"""


@register("histogram_sales", q(_hist_sql("SELECT sales FROM fact WHERE sales > 0", "sales", 50)),
          rnd=("bin_start",))
def histogram_sales(p):
    return A.histogram(p.fact().where(F.col("sales") > 0), "sales", 50)


@register("histogram_gaps", q(f""", {GAPS_SQL}""" + _hist_sql(
    "SELECT gap FROM gaps WHERE gap IS NOT NULL", "gap", 30)), rnd=("bin_start",))
def histogram_gaps(p):
    return A.histogram(sale_gaps(p.fact()), "gap", 30)


@register("price_kde", q(""",
pts AS (SELECT DISTINCT item_id, sell_price AS v FROM fact WHERE sell_price IS NOT NULL),
st AS (SELECT COUNT(*) AS n, STDDEV_SAMP(v) AS sd, MIN(v) AS lo, MAX(v) AS hi FROM pts),
grid AS (SELECT CAST(k AS INTEGER) AS k, lo + (hi - lo) * k / 199 AS x, sd * POW(n, -0.2) AS h, n
         FROM st, range(0, 200) AS r(k))
SELECT g.k, ANY_VALUE(g.x) AS x,
       SUM(EXP(-0.5 * ((g.x - pts.v) / g.h) * ((g.x - pts.v) / g.h))) / (ANY_VALUE(g.n) * ANY_VALUE(g.h) * SQRT(2 * PI())) AS density
FROM grid g, pts GROUP BY g.k"""), rnd=("x", "density"))
def price_kde(p):
    pts = A.distinct_pairs(p.fact(), ["item_id", "sell_price"], not_null=["sell_price"])
    return A.price_kde(pts, "sell_price", 200)


@register("price_response", q("""
SELECT dept_id, FLOOR(sell_price / 1.0) * 1.0 AS price_bucket, AVG(sales) AS avg_sales,
       CAST(COUNT(*) AS BIGINT) AS n_rows
FROM fact WHERE sell_price IS NOT NULL GROUP BY 1, 2"""), rnd=("price_bucket", "avg_sales"))
def price_response(p):
    return A.price_response(p.fact())


@register("price_sales_corr", q("""
SELECT dept_id, CORR(sell_price, CAST(sales AS DOUBLE)) AS price_sales_corr, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM fact WHERE sell_price IS NOT NULL GROUP BY dept_id"""), rnd=("price_sales_corr",))
def price_sales_corr(p):
    return A.price_sales_corr(p.fact())


@register("order_limit", q("""
SELECT CAST(SUBSTR(d, 3) AS INTEGER) AS day_num, CAST(SUM(sales) AS BIGINT) AS total_sales
FROM fact GROUP BY 1 ORDER BY total_sales DESC, day_num LIMIT 5"""))
def order_limit(p):
    # Top-5 busiest days: the limit is the feature (a top-k report).
    return A.global_trend(p.fact()).orderBy(F.desc("total_sales"), "day_num").limit(5)


@register("series_sample", q("""
SELECT item_id, store_id, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(SUM(sales) AS BIGINT) AS sales
FROM fact
WHERE (CAST(('0x' || SUBSTR(md5(item_id), 1, 8)) AS BIGINT) % 20) = 0
GROUP BY item_id, store_id"""))
def series_sample(p):
    # Keep whole series whose item hashes to bucket 0 of 20 (O-52). The
    # oracle uses an MD5-prefix bucket, which both engines can compute.
    f = p.fact().where(hash_bucket("item_id", 20, "md5") == 0)
    return f.groupBy("item_id", "store_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("sales").cast("bigint").alias("sales"))


# ------------------------------------------------------- scalar functions


@register("day_to_date", q("""
SELECT DISTINCT day_num, CAST(DATE '2011-01-29' + (day_num - 1) AS DATE) AS date FROM fact"""))
def day_to_date_q(p):
    return p.fact().select("day_num").distinct().select("day_num", day_to_date("day_num").alias("date"))


@register("date_parts", q("""
SELECT day_num, CAST(isodow(dt) - 1 AS TINYINT) AS wday, CAST(month(dt) AS TINYINT) AS month,
       CAST(day(dt) AS TINYINT) AS day
FROM (SELECT DISTINCT day_num, CAST(DATE '2011-01-29' + (day_num - 1) AS DATE) AS dt FROM fact) t"""))
def date_parts_q(p):
    f = p.fact().select("day_num").distinct().withColumn("dt", day_to_date("day_num"))
    parts = date_parts("dt")
    return f.select("day_num", parts["wday"].alias("wday"), parts["month"].alias("month"),
                    parts["day"].alias("day"))


@register("build_labels", q("""
SELECT id, day_num, 'd_' || CAST(day_num AS VARCHAR) AS d_label,
       'F' || CAST(day_num - ((SELECT hi FROM bounds) - 28) AS VARCHAR) AS f_label
FROM fact WHERE day_num > (SELECT hi FROM bounds) - 28"""))
def build_labels_q(p):
    lo, hi = p.bounds
    f = p.fact().where(F.col("day_num") > hi - 28)
    return f.select("id", "day_num", day_label(F.col("day_num")).alias("d_label"),
                    horizon_label(F.col("day_num"), hi - 28).alias("f_label"))


@register("event_flag", q("""
SELECT event_name_1, CASE WHEN COALESCE(event_name_1, 'NoEvent') = 'NoEvent' THEN 0 ELSE 1 END AS is_event,
       CAST(COUNT(*) AS BIGINT) AS n_rows
FROM fact GROUP BY event_name_1"""))
def event_flag_q(p):
    return (p.fact().groupBy("event_name_1").agg(F.count(F.lit(1)).alias("n_rows"))
             .select("event_name_1", event_flag("event_name_1").alias("is_event"), "n_rows"))


@register("log_scale", q(f"""
SELECT store_id, day_num, LN(1 + CAST(sales AS DOUBLE)) AS log_sales,
       EXP(LN(1 + CAST(sales AS DOUBLE))) - 1 AS sales_back
FROM (SELECT store_id, day_num, SUM(sales) AS sales FROM fact GROUP BY 1, 2) t"""),
          rnd=("log_sales", "sales_back"))
def log_scale_q(p):
    agg = p.fact().groupBy("store_id", "day_num").agg(F.sum("sales").alias("sales"))
    return agg.select("store_id", "day_num", log_scale(F.col("sales").cast("double")).alias("log_sales"),
                      unlog_scale(log_scale(F.col("sales").cast("double"))).alias("sales_back"))


@register("state_prefix", q("""
SELECT DISTINCT store_id, SUBSTR(store_id, 1, 2) AS prefix FROM fact"""))
def state_prefix_q(p):
    return p.fact().select("store_id", state_prefix("store_id").alias("prefix")).distinct()


@register("arith_misc", q("""
SELECT store_id, CAST(SUM(CASE WHEN sales = 0 THEN 1 ELSE 0 END) AS BIGINT) * 100.0 / COUNT(*) AS zero_pct,
       SUM(CAST(sales AS DOUBLE)) / NULLIF(SUM(CASE WHEN sales > 0 THEN 1 ELSE 0 END), 0) AS units_per_sale_day,
       ABS(SUM(CAST(sales AS DOUBLE)) - 1000.0) AS abs_gap,
       SQRT(SUM(CAST(sales AS DOUBLE))) AS sqrt_units,
       SUM(CAST(sales AS DOUBLE)) * SUM(CAST(sales AS DOUBLE)) AS square_units
FROM fact GROUP BY store_id"""), rnd=("zero_pct", "units_per_sale_day", "abs_gap", "sqrt_units",
                                     "square_units"))
def arith_misc_q(p):
    s = F.col("sales").cast("double")
    g = p.fact().groupBy("store_id").agg(
        F.sum(F.when(F.col("sales") == 0, 1).otherwise(0)).alias("zeros"),
        F.count(F.lit(1)).alias("n"), F.sum(s).alias("units"),
        F.sum(F.when(F.col("sales") > 0, 1).otherwise(0)).alias("sale_days"))
    return g.select("store_id", pct("zeros", "n").alias("zero_pct"),
                    safe_ratio("units", F.col("sale_days").cast("double")).alias("units_per_sale_day"),
                    F.abs(F.col("units") - 1000.0).alias("abs_gap"), F.sqrt("units").alias("sqrt_units"),
                    (F.col("units") * F.col("units")).alias("square_units"))


@register("hash_bucket", q("""
SELECT DISTINCT item_id, CAST(CAST(('0x' || SUBSTR(md5(item_id), 1, 8)) AS BIGINT) % 20 AS BIGINT) AS bucket
FROM fact"""))
def hash_bucket_q(p):
    return p.fact().select("item_id", hash_bucket("item_id", 20, "md5").alias("bucket")).distinct()


@register("seasonality", q("""
SELECT 'wday' AS grain, wday AS period, AVG(sales) AS avg_sales FROM fact GROUP BY wday
UNION ALL
SELECT 'month' AS grain, month AS period, AVG(sales) AS avg_sales FROM fact GROUP BY month"""),
          rnd=("avg_sales",))
def seasonality_q(p):
    f = p.fact()
    w = A.seasonality(f, "wday").select(F.lit("wday").alias("grain"), F.col("wday").alias("period"), "avg_sales")
    m = A.seasonality(f, "month").select(F.lit("month").alias("grain"), F.col("month").alias("period"),
                                         "avg_sales")
    return w.unionByName(m)


@register("event_gaps", """
WITH act AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
g AS (SELECT user_id, CAST(date_diff('day', LAG(day) OVER (PARTITION BY user_id ORDER BY day), day) AS INTEGER) AS gap
      FROM act)
SELECT user_id, AVG(gap) AS avg_gap, MAX(gap) AS max_gap, CAST(COUNT(*) AS BIGINT) AS n_gaps
FROM g WHERE gap IS NOT NULL GROUP BY user_id""", rnd=("avg_gap",))
def event_gaps_q(p):
    # Inter-arrival gaps on the events table: user x active day, the same
    # gap operator (O-49) and summary (O-42) with the user as series key.
    ev = p.table("events").select("user_id", F.to_date("ts").alias("day")).distinct()
    ev = ev.withColumn("day_num", F.datediff("day", F.lit("1970-01-01").cast("date"))) \
           .withColumn("active", F.lit(1))
    gaps = sale_gaps(ev, keys=("user_id",), order="day_num", sales="active")
    return A.gap_summary(gaps, by=["user_id"])


@register("gap_summary_item_mixed", q(""",
g AS (
  SELECT item_id,
         CAST(day_num - LAG(day_num) OVER (PARTITION BY item_id ORDER BY day_num) AS INTEGER) AS gap
  FROM fact WHERE sales > 0)
SELECT item_id, AVG(gap) AS avg_gap, MAX(gap) AS max_gap, CAST(COUNT(*) AS BIGINT) AS n_gaps,
       CAST(SUM(CASE WHEN gap = 0 THEN 1 ELSE 0 END) AS BIGINT) AS same_day_gaps
FROM g WHERE gap IS NOT NULL GROUP BY item_id"""), rnd=("avg_gap",))
def gap_summary_item_mixed_q(p):
    # The series key is selectable (O-49): keyed by item only, the sale days
    # of all its stores are interleaved, so same-day sales in two stores give
    # a 0-day gap. Computed with at most one row per (item, day) in any window.
    return A.mixed_gap_summary(p.fact(), "item_id")
