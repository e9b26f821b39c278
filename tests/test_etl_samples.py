"""CSV-to-Parquet chain, keyed append, samples, as-of attributes, catalog choice."""

import os

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import sample as S
from shelfcast.operators.aggregates import last_known_attrs
from shelfcast.plans import etl
from shelfcast.plans import forecast as FC
from shelfcast.sources import files as IO


def _put(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


CALENDAR = "date,wm_yr_wk,weekday,wday,month,year,d,event_name_1,event_type_1,event_name_2,event_type_2,snap_CA"


def test_csv_to_parquet_chain(spark, tmp_path):
    # Day columns in the header's own order and number; one bad line.
    sales = _put(tmp_path / "sales.csv", "id,item_id,dept_id,cat_id,store_id,state_id,d_2,d_1",
                 "a_S,a,D,C,S,T,5,4", "b_S,b,D,C,S,T,many,1", "c_U,c,D,C,007,T,,0")
    cal = _put(tmp_path / "calendar.csv", CALENDAR, "2011-01-29,1,Saturday,1,1,2011,d_1,,,,,1", "2011-01-30,1,Sunday,2,1,2011,d_2,Feast,Cultural,,,0")
    prices = _put(tmp_path / "prices.csv", "store_id,item_id,wm_yr_wk,sell_price", "S,a,1,2.5")
    out = str(tmp_path / "fact")
    for _ in range(2):  # published over itself
        fact = etl.csv_to_parquet(spark, sales, cal, prices, out)
        assert {r.store_id for r in fact.collect()} == {"S", "007"}  # the folder's name is no number
        rows = {(r.id, r.d): (r.sales, r.sell_price, r.event_name_1, r.snap_CA, r.day_num) for r in fact.collect()}
        assert rows == {("a_S", "d_1"): (4, 2.5, None, 1, 1), ("a_S", "d_2"): (5, 2.5, "Feast", 0, 2),
                        ("c_U", "d_1"): (0, None, None, 1, 1), ("c_U", "d_2"): (None, None, "Feast", 0, 2)}
    bad = spark.read.parquet(out + "_rejects").collect()
    assert [r.line for r in bad] == ["b_S,b,D,C,S,T,many,1"]
    assert sorted(x for x in os.listdir(tmp_path) if ".new-" in x or ".old-" in x) == []


def test_header_must_fit(spark, tmp_path):
    with pytest.raises(ValueError, match="price"):
        IO.scan_wide_header(spark, _put(tmp_path / "x.csv", "id,item_id,dept_id,cat_id,store_id,state_id,d_1,price", "a,a,D,C,S,T,1,2"))
    with pytest.raises(ValueError, match="store_id"):
        IO.scan_wide_header(spark, _put(tmp_path / "y.csv", "id,item_id,dept_id,cat_id,state_id,d_1", "a,a,D,C,T,1"))


def test_failed_publish_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    IO.publish(spark.range(3).write.parquet, spark, path)

    def broken(folder):
        spark.range(9).write.parquet(folder)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        IO.publish(broken, spark, path)
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmp_path) == ["t"]


def test_keyed_append_is_repeatable(spark, tmp_path):
    src, table = str(tmp_path / "src"), str(tmp_path / "table")
    one = lambda rows, name: spark.createDataFrame(rows, "k string, v int").coalesce(1).write.parquet(f"{src}/{name}")
    one([("a", 1), ("b", 2), ("b", 1)], "p=1")
    first = IO.keyed_append(spark, src, table, ["k"]).collect()
    assert [(r.rows, r.added, r.running_total) for r in first] == [(3, 2, 3)]
    one([("b", 9), ("c", 3)], "p=2")
    for _ in range(2):
        again = IO.keyed_append(spark, src, table, ["k"]).orderBy("file_path").collect()
        assert [(r.rows, r.added, r.running_total) for r in again] == [(3, 2, 3), (2, 1, 5)]
    import shutil
    shutil.rmtree(table + "_manifest")  # a run that died before its manifest
    IO.keyed_append(spark, src, table, ["k"])
    assert sorted((r.k, r.v, r.p) for r in spark.read.parquet(table).collect()) == [("a", 1, 1), ("b", 1, 1), ("c", 3, 2)]


@pytest.mark.parametrize("k", [0, 1, 17, 999, 1000, 5000])
def test_fixed_size_sample(spark, monkeypatch, k):
    import hashlib
    monkeypatch.setattr(S, "SETTLED", 5)
    monkeypatch.setattr(S, "DIGITS", 1)
    df = spark.range(1000).withColumn("name", F.when(F.col("id") % 2 == 0, F.col("id").cast("string")))
    want = sorted(range(1000), key=lambda i: hashlib.md5((f"{i}|{i}" if i % 2 == 0 else f"{i}").encode()).hexdigest())[:k]
    got = S.fixed_size_sample(df, ["id", "name"], k)
    assert sorted(r.id for r in got.collect()) == sorted(want) and got.columns == ["id", "name"]
    assert S.fixed_size_sample(df.repartition(7), ["id", "name"], k).count() == len(want)


def test_fraction_sample(spark):
    df = spark.range(20000)
    n = S.fraction_sample(df, ["id"], 0.1).count()
    assert 1700 < n < 2300 and S.fraction_sample(df, ["id"], 1.0).count() == 20000 and S.fraction_sample(df, ["id"], 0.0).isEmpty()
    assert S.fraction_sample(df, ["id"], 0.05).exceptAll(S.fraction_sample(df, ["id"], 0.1)).isEmpty()


def test_sparse_ids_keep_their_horizon(spark):
    hist = spark.createDataFrame(
        [(i, "A", "D", "C", "S", "ST", 9.5 + d, d % 2, d, 2, "x", None, None) for i, days in (("A_S", range(1, 41)), ("B_S", range(1, 31))) for d in days],
        "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, "
        "sell_price double, snap int, day_num int, sales int, d string, event_name_1 string, event_type_1 string")
    fut = FC.future_rows(hist, 40)
    assert {(r["id"], r["n"]) for r in fut.groupBy("id").agg(F.count("*").alias("n")).collect()} == {("A_S", 28), ("B_S", 28)}
    assert {(r["id"], r.sell_price, r.snap) for r in fut.collect()} == {("A_S", 49.5, 0), ("B_S", 39.5, 0)}
    early = {r["id"]: r.sell_price for r in last_known_attrs(hist, ["sell_price"], last_day=25).collect()}
    assert early == {"A_S": 34.5, "B_S": 34.5}  # nothing from after the day asked for


def test_copy_largest_of_the_catalog(spark, tmp_path):
    for name, n in (("pick_small", 3), ("pick_big", 50), ("pick_none", 0), ("sqlite_pick", 900)):
        spark.range(n).createOrReplaceTempView(name)
    path = str(tmp_path / "copy")
    r = IO.copy_largest(spark, path, names_like="*pick*").collect()
    assert [tuple(x) for x in r] == [("pick_big", 50, 50)]
    assert spark.read.parquet(path).count() == 50 and any(f.endswith(".snappy.parquet") for f in os.listdir(path))
    with pytest.raises(ValueError):
        IO.copy_largest(spark, path, names_like="pick_none")


def test_damaged_files_are_named_and_the_others_counted(spark, tmp_path):
    from shelfcast.operators.quality import verify_files
    path = tmp_path / "t"
    spark.range(4000).withColumn("x", F.rand(1)).repartition(4).write.parquet(str(path))
    spark.range(0).withColumn("x", F.rand(1)).coalesce(1).write.mode("append").parquet(str(path))
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    full = [f for f in files if spark.read.parquet(str(path / f)).count()]
    for f in files:
        (path / f".{f}.crc").unlink(missing_ok=True)
    pages, footer = path / full[0], path / full[1]
    data = bytearray(pages.read_bytes())
    data[4:len(data) // 2] = bytes(len(data) // 2 - 4)
    pages.write_bytes(data)
    footer.write_bytes(footer.read_bytes()[:-40])
    out = {os.path.basename(r.file_path): r for r in verify_files(spark, str(path)).collect()}
    assert sorted(out) == files
    assert {f: out[f].status for f in files} == {f: {full[0]: "damaged", full[1]: "unreadable"}.get(f, "ok") for f in files}
    assert sum(out[f].decoded_rows for f in full[2:]) == 2000 and out[full[2]].non_null_cells == 2 * out[full[2]].decoded_rows


def test_narrow_types(spark):
    from shelfcast.operators.reshape import narrow_types
    df = spark.sql("SELECT 1.5D AS a, 2L AS b, 'x' AS c, CAST(3 AS FLOAT) AS d, 4 AS e")
    assert narrow_types(df, widen=["d"]).dtypes == [("a", "float"), ("b", "int"), ("c", "string"), ("d", "double"), ("e", "int")]
    assert narrow_types(df, mapping={"int": "smallint"}).dtypes[4] == ("e", "smallint")


def test_scaled_errors_equal_the_split_form(spark):
    from shelfcast.operators import evaluate as EV
    rows = [(i, "S", d, (d * (3 if i == "A" else 7)) % 11 if i != "C" else 2, 1.0 + d % 3 if d % 5 else None) for i in "ABC" for d in range(1, 101) if (i, d) != ("B", 90)]
    f = EV.naive_forecast(spark.createDataFrame(rows, "item_id string, store_id string, day_num int, sales int, sell_price double"))
    s = EV.time_split(f, 100)
    train, test = s.where("split = 'train'"), s.where("split = 'test'")
    want = EV.rmsse(train, test).join(EV.value_weights(train, 72, share=False), ["item_id", "store_id"])
    key = lambda df: sorted((r.item_id, r.rmsse and round(r.rmsse, 9), round(r.scale, 9), r.n_test, round(r.value, 6)) for r in df.collect())
    assert key(EV.scaled_errors(f, 72)) == key(want)
