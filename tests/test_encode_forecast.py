from pyspark.sql import functions as F

from shelfcast.operators import encode as E
from shelfcast.operators.joins import future_grid
from shelfcast.plans import forecast as FC


def test_ordinal_unseen_and_null(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "c string")
    test = spark.createDataFrame([("a",), ("zz",), (None,), ("b",)], "c string")
    enc = E.apply_ordinal(test, E.fit_ordinal(train, ["c"]))
    got = {r.c: r.c_code for r in enc.collect()}
    assert got == {None: 0, "a": 1, "b": 2, "zz": -1}


def test_ordinal_numbers_over_ranges(spark):
    import random
    values = [f"v{i:04d}" for i in range(700)] + [None]
    rows = [(v, f"x{i % 3}") for i, v in enumerate(values * 2)]
    random.Random(1).shuffle(rows)
    maps = E.fit_ordinal(spark.createDataFrame(rows, "a string, b string").repartition(5), ["a", "b"])
    got = {r.value: r.code for r in maps["a"].collect()}
    assert got == {v: i for i, v in enumerate([None, *values[:-1]])}
    assert {r.value: r.code for r in maps["b"].collect()} == {"x0": 0, "x1": 1, "x2": 2} and maps.n_values == 704


def test_broadcast_is_bounded_in_bytes(spark):
    from shelfcast.operators.joins import bounded_broadcast
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 10_000).alias("text"), F.array("id").alias("a"))
    assert hinted(bounded_broadcast(wide)) and not hinted(bounded_broadcast(wide, max_rows=99))
    spark.conf.set("spark.shelfcast.broadcastByteLimit", "900000")
    try:
        assert not hinted(bounded_broadcast(wide)) and hinted(bounded_broadcast(wide.select("id")))
        assert not hinted(bounded_broadcast(wide, known_rows=20_000)) and hinted(bounded_broadcast(wide, known_rows=100))
    finally:
        spark.conf.unset("spark.shelfcast.broadcastByteLimit")


def test_future_rows(spark):
    hist = spark.createDataFrame(
        [("A_S", "A", "D", "C", "S", "ST", 9.5, 1, d, 2, "x", None, None) for d in range(1, 41)],
        "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, "
        "sell_price double, snap int, day_num int, sales int, d string, event_name_1 string, event_type_1 string")
    fut = FC.future_rows(hist, 40)
    rows = fut.orderBy("day_num").collect()
    assert len(rows) == 28 and rows[0].day_num == 41 and rows[-1].day_num == 68
    assert all(r.event_name_1 == "NoEvent" and r.sales is None and r.sell_price == 9.5 for r in rows)
    assert rows[0].d == "d_41"
    ext = FC.extend_history(hist, 40)
    assert ext.count() == 68 and ext.where(F.col("event_name_1").isNull()).count() == 0


def test_future_grid_no_join(spark):
    ids = spark.createDataFrame([("a",), ("b",)], "id string")
    g = future_grid(ids, 101, 28)
    assert g.count() == 56
    assert "Join" not in g._jdf.queryExecution().optimizedPlan().toString()


def test_submission_pivot(spark):
    pred = spark.createDataFrame([("a", 100 + h, float(h)) for h in range(1, 29)], "id string, day_num int, sales double")
    sub = FC.submission(pred, 100)
    r = sub.first()
    assert sub.columns[:3] == ["id", "F1", "F2"] and r.F28 == 28.0
