import math

from pyspark.sql import functions as F

from shelfcast.operators import aggregates as A


def test_histogram_last_bin_closed_and_total(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 2, 3, 10]], "x double")
    h = A.histogram(df, "x", 3).collect()
    assert sum(r["count"] for r in h) == 5
    assert h[-1]["bin"] == 2 and h[-1]["count"] == 1     # max value in the last bin


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(4.0,)] * 3, "x double")
    h = A.histogram(df, "x", 50).collect()
    assert len(h) == 1 and h[0]["count"] == 3


def test_zero_rate(spark):
    df = spark.createDataFrame([(0,), (0,), (1,), (5,)], "sales int")
    r = A.zero_rate(df).first()
    assert r.total_rows == 4 and r.zero_rows == 2 and r.sparsity_pct == 50.0


def test_kde_integrates_to_one(spark):
    vals = [(float(v),) for v in [1, 2, 2, 3, 4, 4, 4, 5, 8, 9]]
    k = A.price_kde(spark.createDataFrame(vals, "sell_price double"), grid_size=200).collect()
    step = k[1].x - k[0].x
    # mass inside [min, max] of a Gaussian KDE: below 1, well above 0.5
    mass = sum(r.density for r in k) * step
    assert 0.6 < mass < 1.0
    assert all(r.density >= 0 for r in k)


def test_last_known_attrs_deterministic_with_duplicates(spark):
    df = spark.createDataFrame([("a", 5, 1.0), ("a", 5, 2.0), ("a", 4, 9.0)], "id string, day_num int, p double")
    r = A.last_known_attrs(df, ["p"], "id", "day_num").collect()
    assert len(r) == 1 and r[0].p == 2.0


def test_store_day_agg_event_flag(spark):
    df = spark.createDataFrame(
        [("S", 1, 2, 1, None), ("S", 1, 3, 1, None), ("S", 2, 0, 0, "Christmas")],
        "store_id string, day_num int, sales int, snap int, event_name_1 string")
    got = {r.day_num: r for r in A.store_day_agg(df).collect()}
    assert got[1].sales == 5 and got[1].is_event == 0 and got[2].is_event == 1


def test_mixed_gap_summary(spark):
    rows = [("A", "S1", 1, 2), ("A", "S1", 3, 1), ("A", "S2", 3, 5), ("A", "S2", 7, 1), ("A", "S2", 2, 0),
            ("B", "S1", 5, 1), ("B", "S2", 5, 1), ("C", "S1", 9, 4)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, day_num int, sales int")
    got = {r.item_id: r for r in A.mixed_gap_summary(df).collect()}
    # A: sale events on days 1, 3, 3, 7 -> gaps 2, 0, 4
    assert (got["A"].avg_gap, got["A"].max_gap, got["A"].n_gaps, got["A"].same_day_gaps) == (2.0, 4, 3, 1)
    # B: two stores on the same day -> one gap of 0
    assert (got["B"].avg_gap, got["B"].max_gap, got["B"].n_gaps) == (0.0, 0, 1)
    assert "C" not in got                      # a single sale has no gap
