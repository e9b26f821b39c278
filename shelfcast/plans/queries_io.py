"""Source, sink and data-quality queries (O-1..O-13, O-64..O-66).

Write-then-read queries stage their output in a fresh folder under the
session's shared checkpoint folder and return the read-back DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..session import scratch_path
from ..sources import files as IO
from ..sources.tpch_panel import TABLES, snap_column, source_signature
from . import forecast as FC
from .catalog import register
from .etl import ID_COLS, wide_sales
from .oracle import SNAP_COLS, q
from .queries_panel import FACT_SELECT

FACT_COLS = [c.strip() for c in FACT_SELECT.split(",")]
SALES_KEY = ["store_id", "item_id", "d"]


# The fact as written by this application, by source snapshot and layout:
# queries that read a written fact share one copy of it.
_FACTS: dict[tuple, str] = {}


def _written_fact(p, partition_by="store_id"):
    key = (p.spark.sparkContext.applicationId, p.sf_dir, source_signature(p.spark, p.sf_dir), partition_by)
    if key not in _FACTS or not IO._exists(p.spark, _FACTS[key]):
        path = scratch_path(p.spark, "fact")
        IO.write_fact(p.fact(), path, partition_by)
        _FACTS[key] = path
    return _FACTS[key]


# Fixed value: the driver's line items span 2,499 days at every scale factor.
_DAYS = ", ".join(f"'d_{n}'" for n in range(1, 2500))


@register("scan_wide", q(f"""
SELECT * FROM (
  PIVOT (SELECT item_id || '_' || store_id AS id, item_id,
                'DEPT_' || CAST(CAST(regexp_extract(item_id, '(\\d+)$', 1) AS INTEGER) % 6 AS VARCHAR) AS dept_id,
                'CAT_' || CAST(CAST(regexp_extract(item_id, '(\\d+)$', 1) AS INTEGER) % 6 % 3 AS VARCHAR) AS cat_id,
                store_id, state_id, 'd_' || CAST(day_num AS VARCHAR) AS d, sales FROM dense)
  ON d IN ({_DAYS}) USING first(sales) GROUP BY id, item_id, dept_id, cat_id, store_id, state_id)"""))
def scan_wide_q(p):
    lo, hi = p.bounds
    path = scratch_path(p.spark, "wide_csv")
    IO.write_csv(wide_sales(p), path)
    return IO.scan_wide(p.spark, path, [f"d_{n}" for n in range(lo, hi + 1)])


@register("scan_calendar", q(f"""
SELECT date, wm_yr_wk, weekday, wday, month, year, d, event_name_1, event_type_1, event_name_2,
       event_type_2, {SNAP_COLS} FROM calendar"""))
def scan_calendar_q(p):
    path = scratch_path(p.spark, "calendar_csv")
    snaps = [snap_column(s) for s, _ in p.states]
    IO.write_csv(p.calendar().drop("day_num"), path)
    return IO.scan_calendar(p.spark, path, snaps)


@register("scan_prices", q("SELECT store_id, item_id, wm_yr_wk, sell_price FROM prices"))
def scan_prices_q(p):
    path = scratch_path(p.spark, "prices_csv")
    IO.write_csv(p.prices(), path)
    return IO.scan_prices(p.spark, path)


@register("write_fact", q(f"SELECT {FACT_SELECT} FROM fact"))
def write_fact_q(p):
    # O-4 write + O-5 full scan of what was written.
    return IO.scan_fact(p.spark, _written_fact(p)).select(*FACT_COLS)


@register("scan_store_slice", q("""
SELECT id, item_id, dept_id, cat_id, store_id, d, sales, sell_price, event_name_1, event_type_1,
       snap_AMERICA FROM fact WHERE store_id = 'NATION_1'"""))
def scan_store_slice_q(p):
    # NATION_1 belongs to region AMERICA (key 1): its own SNAP column.
    path = _written_fact(p)
    return IO.scan_store_slice(p.spark, path, "NATION_1", "snap_AMERICA")


@register("sql_on_file", q("""
SELECT CAST(SUBSTR(d, 3) AS INTEGER) AS day_num, CAST(SUM(sales) AS BIGINT) AS total_sales
FROM fact GROUP BY 1"""))
def sql_on_file_q(p):
    path = _written_fact(p, None)
    return IO.sql_on_file(p.spark, path, """
        SELECT CAST(SUBSTR(d, 3) AS INT) AS day_num, CAST(SUM(sales) AS BIGINT) AS total_sales
        FROM {t} GROUP BY 1 ORDER BY 1""")


@register("write_parquet_snappy", "SELECT * FROM lineitem")
def write_parquet_snappy_q(p):
    path = scratch_path(p.spark, "lineitem_snappy")
    IO.write_parquet_snappy(p.table("lineitem"), path)
    return p.spark.read.parquet(path)


@register("table_append_batches", q("""
SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, CAST(SUM(sales) AS BIGINT) AS total_sales FROM fact"""))
def table_append_batches_q(p):
    # Run twice: the second run finds every file in the manifest.
    staged, table = _written_fact(p), scratch_path(p.spark, "sales_table")
    for _ in range(2):
        IO.keyed_append(p.spark, staged, table, SALES_KEY)
    t = p.spark.read.parquet(table)
    return t.agg(F.count(F.lit(1)).alias("total_rows"), F.sum("sales").cast("bigint").alias("total_sales"))


@register("table_append_keyed", q("""
SELECT store_id AS part, CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(*) AS BIGINT) AS added,
       CAST(SUM(COUNT(*)) OVER (ORDER BY store_id) AS BIGINT) AS running_total
FROM fact GROUP BY store_id"""))
def table_append_keyed_q(p):
    # The manifest after two runs, rolled up to the store folders.
    staged, table = _written_fact(p), scratch_path(p.spark, "sales_keyed")
    IO.keyed_append(p.spark, staged, table, SALES_KEY)
    per_file = IO.keyed_append(p.spark, staged, table, SALES_KEY)
    return (per_file.groupBy(F.regexp_extract("file_path", r"store_id=([^/]+)", 1).alias("part"))
                    .agg(F.sum("rows").cast("bigint").alias("rows"), F.sum("added").cast("bigint").alias("added"),
                         F.max("running_total").cast("bigint").alias("running_total")))


@register("file_row_counts", q("""
SELECT store_id AS part, CAST(COUNT(*) AS BIGINT) AS rows,
       CAST(SUM(COUNT(*)) OVER (ORDER BY store_id) AS BIGINT) AS running_total
FROM fact GROUP BY store_id"""))
def file_row_counts_q(p):
    # Rows per file, rolled up to the store folder each file sits in (file
    # names are random); a folder's last running total is its own.
    per_file = IO.file_row_counts(p.spark, _written_fact(p))
    return (per_file.groupBy(F.regexp_extract("folder", r"store_id=([^/]+)", 1).alias("part"))
                    .agg(F.sum("rows").cast("bigint").alias("rows"), F.max("running_total").cast("bigint").alias("running_total")))


@register("largest_table", "SELECT table_name, rows FROM (" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows FROM {t}" for t in TABLES)
    + ") t WHERE rows > 0 ORDER BY rows DESC, table_name LIMIT 1")
def largest_table_q(p):
    return IO.largest_table({t: p.table(t) for t in TABLES})


@register("copy_largest", "SELECT 'raw_' || table_name AS table_name, rows, rows AS rows_copied FROM (" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows FROM {t}" for t in TABLES)
    + ") t WHERE rows > 0 ORDER BY rows DESC, table_name LIMIT 1")
def copy_largest_q(p):
    for t in TABLES:
        p.table(t).createOrReplaceTempView(f"raw_{t}")
    return IO.copy_largest(p.spark, scratch_path(p.spark, "largest"), names_like="raw_*")


def _submission_sql():
    from .queries_model import PRED_SQL, SUBMISSION_BODY
    return q(PRED_SQL + SUBMISSION_BODY)


@register("write_submission_csv", _submission_sql())
def write_submission_csv_q(p):
    lo, hi = p.bounds
    path = scratch_path(p.spark, "submission_csv")
    sub = FC.submission(FC.naive_horizon(p), hi)
    IO.write_submission_csv(sub, path)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.StringType())] +
                          [T.StructField(f"F{i}", T.DoubleType()) for i in range(1, 29)])
    return p.spark.read.schema(schema).option("header", True).csv(path)


@register("sql_store_summary", q("""
SELECT store_id, CAST(COUNT(*) AS BIGINT) AS row_count, CAST(SUM(sales) AS BIGINT) AS total_sales
FROM fact GROUP BY store_id ORDER BY store_id"""))
def sql_store_summary_q(p):
    path = _written_fact(p)
    view = "sales_data_" + path.rsplit("-", 1)[-1]
    p.spark.read.parquet(path).createOrReplaceTempView(view)
    return p.spark.sql(f"""
        SELECT store_id, COUNT(*) AS row_count, CAST(SUM(sales) AS BIGINT) AS total_sales
        FROM {view} GROUP BY store_id ORDER BY store_id""")


# ----------------------------------------------------------------- quality
@register("dq_duplicate_keys", q("""
SELECT store_id, item_id, d, CAST(COUNT(*) AS BIGINT) AS cnt FROM fact
GROUP BY store_id, item_id, d HAVING COUNT(*) > 1"""))
def dq_duplicate_keys_q(p):
    return Q.duplicate_keys(p.fact(), ["store_id", "item_id", "d"])


@register("dq_duplicate_lines", """
SELECT l_orderkey, l_linenumber, CAST(COUNT(*) AS BIGINT) AS cnt FROM lineitem
GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def dq_duplicate_lines_q(p):
    # (l_orderkey, l_linenumber) is not unique in the driver data: the check
    # must find and report all duplicated keys.
    return Q.duplicate_keys(p.table("lineitem"), ["l_orderkey", "l_linenumber"])


@register("dq_file_verify", q(f"""
SELECT TRUE AS size_warning, {len(FACT_COLS)} AS n_columns, CAST(COUNT(*) AS BIGINT) AS rows,
       CAST({' + '.join(f'COUNT({c})' for c in FACT_COLS)} AS BIGINT) AS non_null_cells
FROM fact"""))
def dq_file_verify_q(p):
    path = scratch_path(p.spark, "fact_flat")
    IO.write_fact(p.fact(), path, None)
    return Q.file_verify(p.spark, path).select("size_warning", "n_columns", "rows", "non_null_cells")


@register("dq_verify_files", q(f"""
SELECT store_id AS part, CAST(COUNT(*) AS BIGINT) AS footer_rows, CAST(COUNT(*) AS BIGINT) AS decoded_rows,
       CAST({' + '.join(f'COUNT({c})' for c in FACT_COLS)} AS BIGINT) AS non_null_cells, CAST(0 AS BIGINT) AS n_bad
FROM fact GROUP BY store_id"""))
def dq_verify_files_q(p):
    # File by file, rolled up to the store folders (file names are random).
    per_file = Q.verify_files(p.spark, _written_fact(p))
    total = lambda c: F.sum(c).cast("bigint").alias(c)
    return (per_file.groupBy(F.regexp_extract("file_path", r"store_id=([^/]+)", 1).alias("part"))
                    .agg(total("footer_rows"), total("decoded_rows"), total("non_null_cells"), F.count_if(F.col("status") != "ok").alias("n_bad")))


@register("dq_row_conservation", q("""
SELECT CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(DISTINCT (item_id, store_id)) AS BIGINT) AS n_series,
       CAST(COUNT(DISTINCT d) AS BIGINT) AS n_days,
       CAST(COUNT(DISTINCT (item_id, store_id)) * COUNT(DISTINCT d) AS BIGINT) AS expected_rows,
       COUNT(*) = COUNT(DISTINCT (item_id, store_id)) * COUNT(DISTINCT d) AS conserved,
       CAST(COUNT(*) AS BIGINT) AS rows_written, TRUE AS write_conserved
FROM (SELECT item_id, store_id, 'd_' || day_num AS d FROM dense) t"""))
def dq_row_conservation_q(p):
    from ..operators.reshape import melt
    long = melt(wide_sales(p), ID_COLS, r"^d_\d+$", "d", "sales")
    path = scratch_path(p.spark, "melted")
    long.write.mode("overwrite").parquet(path)
    return Q.row_conservation(long, ["item_id", "store_id"], "d", written=p.spark.read.parquet(path))


# --------------------------------------------------------------- streaming
@register("stream_ingest_fact", q(f"SELECT {FACT_SELECT} FROM fact"))
def stream_ingest_fact_q(p):
    """Wide sales land as files (one per state); a Structured Streaming
    query appends them to the fact table; the table is read back."""
    from ..streaming.ingest import long_fact_stream, run_available_now, wide_stream
    lo, hi = p.bounds
    labels = [f"d_{n}" for n in range(lo, hi + 1)]
    landing = scratch_path(p.spark, "landing")
    wide = wide_sales(p)
    # Several files in the landing folder (one per write task).
    wide.write.option("header", True).csv(landing)
    snaps = [snap_column(s) for s, _ in p.states]
    cal = p.calendar().select("d", "wm_yr_wk", "wday", "month", "year", "event_name_1",
                              "event_type_1", *snaps, "day_num")
    stream = wide_stream(p.spark, landing, IO.wide_schema(labels))
    fact = long_fact_stream(stream, ID_COLS, cal, p.prices(), FACT_COLS, cal_rows=hi - lo + 1)
    sink = scratch_path(p.spark, "fact_stream")
    run_available_now(fact, sink, scratch_path(p.spark, "fact_stream_ckpt"))
    return p.spark.read.parquet(sink).select(*FACT_COLS)


@register("scan_fact", q(f"SELECT {FACT_SELECT} FROM fact"))
def scan_fact_q(p):
    # O-5: full scan of a fact table written unpartitioned (O-4 writes it).
    path = _written_fact(p, None)
    return IO.scan_fact(p.spark, path).select(*FACT_COLS)
