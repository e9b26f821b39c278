from pyspark.sql import functions as F

from shelfcast.operators import quality as Q
from shelfcast.sources import files as IO


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("S", "I", "d_1"), ("S", "I", "d_1"), ("S", "I", "d_2")],
                               "store_id string, item_id string, d string")
    r = Q.duplicate_keys(df, ["store_id", "item_id", "d"]).collect()
    assert len(r) == 1 and r[0].cnt == 2


def test_wide_csv_round_trip_and_conservation(spark, tmp_path):
    wide = spark.createDataFrame([("a_S", "a", "D", "C", "S", "T", 1, None, 3)],
                                 "id string, item_id string, dept_id string, cat_id string, "
                                 "store_id string, state_id string, d_1 int, d_2 int, d_3 int")
    p = str(tmp_path / "wide")
    IO.write_csv(wide, p)
    back = IO.scan_wide(spark, p, ["d_1", "d_2", "d_3"])
    assert back.schema == IO.wide_schema(["d_1", "d_2", "d_3"])
    assert back.first().d_2 is None
    from shelfcast.operators.reshape import melt
    long = melt(back, IO.ID_FIELDS)
    r = Q.row_conservation(long, ["item_id", "store_id"], "d").first()
    assert r.rows == 3 and r.expected_rows == 3 and r.conserved


def test_file_verify_and_counts(spark, tmp_path):
    df = spark.range(1000).withColumn("store_id", (F.col("id") % 3).cast("string"))
    p = str(tmp_path / "t")
    IO.write_fact(df, p, "store_id")
    v = Q.file_verify(spark, p).first()
    assert v.rows == 1000 and v.size_warning and v.non_null_cells == 2000
    counts = IO.file_row_counts(spark, p).agg(F.sum("rows"), F.max("running_total")).first()
    assert counts[0] == 1000 and counts[1] == 1000


def test_largest_table(spark):
    t = {"a": spark.range(3), "b": spark.range(7), "empty": spark.range(0)}
    r = IO.largest_table(t).collect()
    assert [(x.table_name, x.rows) for x in r] == [("b", 7)]


def test_file_row_counts_by_path(spark, tmp_path):
    import shutil
    a = str(tmp_path / "t")
    spark.range(10).coalesce(1).write.parquet(a + "/k=1")
    shutil.copytree(a + "/k=1", a + "/k=2")   # files of the same name
    rows = IO.file_row_counts(spark, a).orderBy("file_path").collect()
    assert [(r["rows"], r["running_total"]) for r in rows] == [(10, 10), (10, 20)]
