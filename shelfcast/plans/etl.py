"""ETL flagship (O-67): raw CSV files -> long fact table, published and read.

wide sales CSV (one row per series, one column per day; schema from its header)
  -> lines that don't fit go to a table of rejects
  -> melt (O-18, narrow ``stack`` generator)
  -> left join calendar CSV on ``d`` (O-28, broadcast: one row per day)
  -> left join weekly prices CSV on (store, item, week) (O-29, shuffle join)
  -> project to the fact layout (O-15)
  -> Parquet partitioned by store (O-4), put in place by a rename
  -> read back (O-5)

Melt runs first, right after the wide scan: a scan with thousands of columns
falls out of the vectorized reader and codegen, and everything after the
melt is narrow again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import day_number
from ..operators.joins import join_calendar, join_prices
from ..operators.reshape import FACT_COLUMNS, melt
from ..session import checkpoint_dir, scratch_path
from ..sources import files as IO
from ..sources.tpch_panel import Panel, item_attrs, snap_column, source_signature

ID_COLS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]


def wide_sales(panel: Panel) -> DataFrame:
    """Wide sales (A1) for every series and every day of the panel.

    Each series' days are gathered into one day-sorted array (bounded: one
    element per calendar day) and element i becomes column ``d_{lo+i}``.
    On the dense panel position i is exactly day lo+i; this is cheaper than
    a 2,500-value ``pivot``. ``pivot_labels`` (O-19) remains the general
    long->wide operator."""
    lo, hi = panel.bounds
    dense = panel.dense().withColumns({
        "id": F.concat_ws("_", "item_id", "store_id"),
        **item_attrs(F.col("item_id")),
    })
    arr = dense.groupBy(*ID_COLS).agg(
        F.sort_array(F.collect_list(F.struct("day_num", "sales"))).alias("__days"))
    # One selectExpr call: thousands of day columns are parsed in the JVM in
    # a single round trip instead of several py4j calls per column.
    return arr.selectExpr(*ID_COLS, *[f"__days[{i}].sales AS d_{lo + i}"
                                      for i in range(hi - lo + 1)])


def melt_to_fact(wide: DataFrame, panel: Panel) -> DataFrame:
    """The reference's transform: melt, calendar join, price join, project."""
    lo, hi = panel.bounds
    long = melt(wide, ID_COLS, r"^d_\d+$", "d", "sales")
    cal = panel.calendar().select("d", "wm_yr_wk", "wday", "month", "year",
                                  "event_name_1", "event_type_1",
                                  *[snap_column(s) for s, _ in panel.states], "day_num")
    f = join_calendar(long, cal, on="d", cal_rows=hi - lo + 1)
    f = join_prices(f, panel.prices())
    return f.select(*FACT_COLUMNS, *[snap_column(s) for s, _ in panel.states],
                    "sell_price", "day_num")


def raw_csv(panel: Panel) -> str:
    """Folder with the panel's raw inputs as the reference has them: wide
    sales, calendar and prices as CSV with headers. They stand in for files
    from elsewhere, so they are written once per source snapshot."""
    base = checkpoint_dir(panel.spark).rstrip("/")
    path = f"{base}/raw-csv-v1-{source_signature(panel.spark, panel.sf_dir)}"
    if not IO._exists(panel.spark, path):
        def write(folder: str) -> None:
            IO.write_csv(wide_sales(panel), f"{folder}/sales")
            IO.write_csv(panel.calendar().drop("day_num"), f"{folder}/calendar")
            IO.write_csv(panel.prices(), f"{folder}/prices")

        IO.publish(write, panel.spark, path)
    return path


def csv_to_parquet(spark: SparkSession, sales: str, calendar: str, prices: str, out: str) -> DataFrame:
    """The whole chain over three CSV paths; returns the published table.
    Lines of the sales file that don't fit its header are in ``<out>_rejects``
    (column ``line``, beside the columns that could be read)."""
    raw = IO.scan_wide_header(spark, sales)
    snaps = [c for c in IO.csv_columns(spark, calendar) if c.startswith("snap_")]
    cal = IO.scan_calendar(spark, calendar, snaps).select("d", "wm_yr_wk", "wday", "month", "year", "event_name_1", "event_type_1", *snaps)
    good = raw.where(F.col(IO.REJECTED).isNull()).drop(IO.REJECTED)
    long = melt(good, ID_COLS, r"^d_\d+$", "d", "sales")
    fact = join_prices(join_calendar(long, cal, on="d"), IO.scan_prices(spark, prices))
    fact = fact.select(*FACT_COLUMNS, *snaps, "sell_price", day_number("d").alias("day_num"))
    bad = raw.where(F.col(IO.REJECTED).isNotNull()).withColumnRenamed(IO.REJECTED, "line")
    IO.publish(bad.write.mode("overwrite").parquet, spark, f"{out}_rejects")
    IO.publish(lambda folder: IO.write_fact(fact, folder), spark, out)
    return IO.scan_fact(spark, out, fact.schema)


def etl_flagship(panel: Panel) -> DataFrame:
    raw = raw_csv(panel)
    fact = csv_to_parquet(panel.spark, f"{raw}/sales", f"{raw}/calendar", f"{raw}/prices", scratch_path(panel.spark, "fact"))
    return fact.select(*FACT_COLUMNS, *[snap_column(s) for s, _ in panel.states], "sell_price", "day_num")
