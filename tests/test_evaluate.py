from pyspark.sql import functions as F

from shelfcast.operators import evaluate as EV


def test_time_split_disjoint_complete(spark):
    df = spark.range(1, 101).select(F.col("id").cast("int").alias("day_num"))
    s = EV.time_split(df, 100).groupBy("split").count().collect()
    got = {r.split: r["count"] for r in s}
    assert got == {"train": 72, "test": 28}


def test_global_metrics(spark):
    df = spark.createDataFrame([(2, 1.0), (4, 5.0)], "sales int, yhat double")
    r = EV.global_metrics(df).first()
    assert abs(r.rmse - 1.0) < 1e-12
    assert abs(r.wmape - 2.0 / 6.0) < 1e-12
    assert abs(r.volume_accuracy - 1.0) < 1e-12


def test_rmsse_zero_scale_is_null(spark):
    hist = spark.createDataFrame([("A", "S", d, 3) for d in range(1, 10)] +
                                 [("B", "S", d, d % 2) for d in range(1, 10)],
                                 "item_id string, store_id string, day_num int, sales int")
    pred = spark.createDataFrame([("A", "S", 10, 3, 2.0), ("B", "S", 10, 1, 0.0)],
                                 "item_id string, store_id string, day_num int, sales int, yhat double")
    got = {r.item_id: r for r in EV.rmsse(hist, pred, horizon=1).collect()}
    assert got["A"].rmsse is None                 # constant history: zero scale
    assert abs(got["B"].rmsse - 1.0) < 1e-12      # scale 1, error 1


def test_wrmsse_weights(spark):
    per = spark.createDataFrame([("A", "S", 1.0), ("B", "S", 3.0)], "item_id string, store_id string, rmsse double")
    w = spark.createDataFrame([("A", "S", 1.0), ("B", "S", 1.0)], "item_id string, store_id string, value double")
    assert abs(EV.wrmsse(per, w).first().wrmsse - 2.0) < 1e-12
