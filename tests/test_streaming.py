from pyspark.sql import functions as F

from shelfcast.sources import files as IO
from shelfcast.streaming.ingest import long_fact_stream, run_available_now, wide_stream


def test_stream_ingest_exactly_once(spark, tmp_path):
    labels = ["d_1", "d_2", "d_3"]
    landing, sink, ckpt = (str(tmp_path / n) for n in ("landing", "sink", "ckpt"))
    batch1 = spark.createDataFrame([("a_S", "a", "D", "C", "S", "T", 1, 0, 2)], IO.wide_schema(labels))
    batch2 = spark.createDataFrame([("b_S", "b", "D", "C", "S", "T", 0, None, 4)], IO.wide_schema(labels))
    cal = spark.createDataFrame([(f"d_{i}", 0, i) for i in (1, 2, 3)], "d string, wm_yr_wk int, wday int")
    prices = spark.createDataFrame([("S", "a", 0, 1.5)], "store_id string, item_id string, wm_yr_wk int, sell_price double")
    cols = ["store_id", "item_id", "d", "sales", "wday", "sell_price"]

    def run():
        stream = wide_stream(spark, landing, IO.wide_schema(labels))
        run_available_now(long_fact_stream(stream, IO.ID_FIELDS, cal, prices, cols, cal_rows=3), sink, ckpt)

    batch1.write.mode("append").option("header", True).csv(landing)
    run()
    assert spark.read.parquet(sink).count() == 3
    batch2.write.mode("append").option("header", True).csv(landing)
    run()
    run()  # nothing new: the checkpoint prevents duplicates
    out = spark.read.parquet(sink)
    assert out.count() == 6
    assert out.where(F.col("sales").isNull()).count() == 1
    assert out.where((F.col("item_id") == "a") & (F.col("sell_price") == 1.5)).count() == 3
