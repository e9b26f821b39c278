from pyspark.sql import functions as F

from shelfcast.operators import windows as W


def _series(spark, values, item="A", store="S"):
    return spark.createDataFrame([(item, store, i + 1, v) for i, v in enumerate(values)],
                                 "item_id string, store_id string, day_num int, sales int")


def test_lag_equals_self_join(spark):
    df = _series(spark, list(range(60)))
    lagged = W.lag_features(df, (28, 35))
    j = (df.alias("a").join(df.alias("b"), F.col("b.day_num") == F.col("a.day_num") - 28, "left")
           .select(F.col("a.day_num").alias("day_num"), F.col("b.sales").alias("exp")))
    got = {r.day_num: r.lag_28 for r in lagged.collect()}
    exp = {r.day_num: r.exp for r in j.collect()}
    assert got == exp
    assert got[28] is None and got[29] == 0


def test_min_periods_rule_short_series(spark):
    # 27 days: no lag-28 values at all; 56 days: first full 7-row window of
    # lag 28 ends on day 35 (lag defined from day 29).
    short = W.rolling_lagged(_series(spark, [1] * 27), 7, 28, names=("m", "s"))
    assert short.where(F.col("m").isNotNull()).count() == 0
    longer = W.rolling_lagged(_series(spark, list(range(56))), 7, 28, names=("m", "s"))
    first = longer.where(F.col("m").isNotNull()).agg(F.min("day_num")).first()[0]
    assert first == 35


def test_running_sum_stats_equal_moving_frame(spark):
    vals = [(i * 7919) % 13 for i in range(120)]
    df = _series(spark, vals)
    a = W.rolling_lagged(df, 28, 28, integer_valued=True).orderBy("day_num").collect()
    b = W.rolling_lagged(df, 28, 28, integer_valued=False).orderBy("day_num").collect()
    for x, y in zip(a, b):
        assert (x.roll_mean_28 is None) == (y.roll_mean_28 is None)
        if x.roll_mean_28 is not None:
            assert abs(x.roll_mean_28 - y.roll_mean_28) < 1e-12
            assert abs(x.roll_std_28 - y.roll_std_28) < 1e-9


def test_sale_gaps_first_dropped_and_zero_series(spark):
    df = _series(spark, [0, 3, 0, 0, 2, 0, 1]).unionByName(_series(spark, [0] * 7, item="Z"))
    gaps = W.sale_gaps(df).orderBy("day_num").collect()
    assert [g.gap for g in gaps] == [3, 2]          # first sale has no gap
    one = W.sale_gaps(_series(spark, [0, 0, 5, 0]))
    assert one.count() == 0                          # one sale only: no gap


def test_densify_fills_zero(spark):
    cells = spark.createDataFrame([("A", "S", 2, 4), ("A", "S", 5, 1), ("B", "S", 1, 2)],
                                  "item_id string, store_id string, day_num int, sales int")
    d = W.densify_panel(cells, 1, 5)
    assert d.count() == 10
    got = {(r.item_id, r.day_num): r.sales for r in d.collect()}
    assert got[("A", 1)] == 0 and got[("A", 2)] == 4 and got[("B", 5)] == 0


def test_price_features_mid_series_start(spark):
    df = spark.createDataFrame(
        [("A", "S", i, None if i < 4 else float(i)) for i in range(1, 12)],
        "item_id string, store_id string, day_num int, sell_price double")
    out = W.price_volatility(W.price_features(df), 7).orderBy("day_num").collect()
    assert out[0].price_max == 11.0 and out[0].price_momentum is None
    assert out[-1].price_momentum == 1.0
    # first full 7-row window of non-null prices ends on day 10
    assert [r.day_num for r in out if r.price_roll_std_7 is not None][0] == 10


def test_dropna_drops_whole_34_day_series(spark):
    from shelfcast.operators.reshape import dropna_subset
    s34 = W.rolling_lagged(_series(spark, [1] * 34), 7, 28, names=("rolling_mean_28_7", "s"))
    assert dropna_subset(s34, ["rolling_mean_28_7"]).count() == 0
    s35 = W.rolling_lagged(_series(spark, [1] * 35), 7, 28, names=("rolling_mean_28_7", "s"))
    assert dropna_subset(s35, ["rolling_mean_28_7"]).count() == 1


def test_rolling_of_fractions_at_any_window(spark):
    from pyspark.sql import functions as F

    from shelfcast.operators.windows import rolling_lagged
    df = spark.range(60).select(F.lit("s").alias("id"), F.lit("a").alias("item_id"), F.lit("b").alias("store_id"),
                                (F.col("id") + 1).cast("int").alias("day_num"), F.lit(0.6).alias("price"))
    for win in (7, 28):
        out = rolling_lagged(df, win, 1, "price", keys=("id",)).where(f"roll_mean_{win} is not null")
        low, high, n = out.agg(F.min(f"roll_mean_{win}"), F.max(f"roll_mean_{win}"), F.count("*")).first()
        assert n == 60 - win and abs(low - 0.6) < 1e-9 and abs(high - 0.6) < 1e-9
