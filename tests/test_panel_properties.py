"""Properties of the panel and the backtest on the smallest driver data."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from shelfcast.functions import hash_bucket
from shelfcast.operators import boosting as B
from shelfcast.operators import evaluate as EV
from shelfcast.plans import train as TRN
from shelfcast.sources.tpch_panel import Panel


def test_dense_panel_is_complete_and_unique(spark):
    p = Panel(spark, SF_SMALL)
    lo, hi = p.bounds
    d = p.dense()
    stats = d.agg(F.count(F.lit(1)).alias("n"),
                  F.countDistinct("item_id", "store_id").alias("s"),
                  F.countDistinct("item_id", "store_id", "day_num").alias("k")).first()
    assert stats.n == stats.k == stats.s * (hi - lo + 1)
    # densify keeps every observed unit
    assert d.agg(F.sum("sales")).first()[0] == p.cells().agg(F.sum("sales")).first()[0]


def test_series_sample_keeps_whole_series(spark):
    p = Panel(spark, SF_SMALL)
    lo, hi = p.bounds
    s = p.fact().where(hash_bucket("item_id", 20, "md5") == 0)
    per = s.groupBy("item_id", "store_id").count().collect()
    assert per and all(r["count"] == hi - lo + 1 for r in per)


def test_boosted_backtest_beats_naive(spark):
    p = Panel(spark, SF_SMALL)
    lo, hi = p.bounds
    res, pred = TRN.global_backtest(p, B.BoostParams(power=1.1, rounds=6, learning_rate=0.3,
                                                     max_depth=4, checkpoint_every=3))
    boosted = EV.global_metrics(pred).first()
    f = p.fact().select("item_id", "store_id", "day_num", "sales", "sell_price")
    s = EV.time_split(EV.naive_forecast(f), hi)
    naive = EV.global_metrics(s.where(F.col("split") == "test")).first()
    assert boosted.n_rows == naive.n_rows
    assert boosted.rmse < naive.rmse
