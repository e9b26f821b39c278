"""File sources and sinks (O-1..O-14).

Schemas are explicit at every CSV read (no inference pass). Parquet is the
table format; the long fact is written partitioned by store so a store slice
prunes to its own folder. Paths are whatever the caller passes; helpers that
need scratch space use the shared checkpoint folder of the session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID_FIELDS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]


# Schemas (A1..A3) -----------------------------------------------------------
def wide_schema(day_labels: Sequence[str]) -> T.StructType:
    """6 string ids + one int column per day label (``d_1 ... d_N``)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in ID_FIELDS]
                        + [T.StructField(d, T.IntegerType(), True) for d in day_labels])


def calendar_schema(snap_columns: Sequence[str]) -> T.StructType:
    return T.StructType([
        T.StructField("date", T.DateType(), True),
        T.StructField("wm_yr_wk", T.IntegerType(), True),
        T.StructField("weekday", T.StringType(), True),
        T.StructField("wday", T.IntegerType(), True),
        T.StructField("month", T.IntegerType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("d", T.StringType(), True),
        T.StructField("event_name_1", T.StringType(), True),
        T.StructField("event_type_1", T.StringType(), True),
        T.StructField("event_name_2", T.StringType(), True),
        T.StructField("event_type_2", T.StringType(), True),
    ] + [T.StructField(c, T.IntegerType(), True) for c in snap_columns])


PRICES_SCHEMA = T.StructType([
    T.StructField("store_id", T.StringType(), True),
    T.StructField("item_id", T.StringType(), True),
    T.StructField("wm_yr_wk", T.IntegerType(), True),
    T.StructField("sell_price", T.DoubleType(), True),
])


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


# O-1 / O-2 / O-3 --------------------------------------------------------------
def scan_wide(spark: SparkSession, path: str, day_labels: Sequence[str]) -> DataFrame:
    return _csv(spark, path, wide_schema(day_labels))


def scan_calendar(spark: SparkSession, path: str, snap_columns: Sequence[str]) -> DataFrame:
    return _csv(spark, path, calendar_schema(snap_columns))


def scan_prices(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, PRICES_SCHEMA)


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """The header of a CSV file or folder, as its first row has it."""
    return spark.read.option("header", True).csv(path).columns


REJECTED = "_rejected"


def scan_wide_header(spark: SparkSession, path: str, day_pattern: str = r"^d_\d+$") -> DataFrame:
    """Wide sales whose schema comes from the file's own header: the six ids
    as strings and every day column as int, in the header's order, plus
    ``_rejected``: the whole line where it does not fit (null elsewhere), so a
    bad line is kept for a report and never turns into nulls unseen. Only
    columns that a query reads are looked at, so read all of them with it. A
    header that lacks an id or has a column of neither kind is an error."""
    import re
    names = csv_columns(spark, path)
    odd = [c for c in names if c not in ID_FIELDS and not re.match(day_pattern, c)]
    lacking = [c for c in ID_FIELDS if c not in names]
    if odd or lacking or len(names) == len(ID_FIELDS):
        raise ValueError(f"not a wide sales header: unknown {odd[:5]}, missing {lacking}")
    schema = T.StructType([T.StructField(c, T.StringType() if c in ID_FIELDS else T.IntegerType(), True) for c in names]
                          + [T.StructField(REJECTED, T.StringType(), True)])
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", REJECTED).csv(path))


# O-4 / O-5 / O-6 --------------------------------------------------------------
def write_fact(fact: DataFrame, path: str, partition_by: str | None = "store_id") -> None:
    w = fact.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def scan_fact(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The written fact; with its ``schema`` a store named like a number stays
    a string, where the folder name alone would make it one."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


SLICE_COLUMNS = ["id", "item_id", "dept_id", "cat_id", "store_id", "d", "sales", "sell_price",
                 "event_name_1", "event_type_1"]


def scan_store_slice(spark: SparkSession, path: str, store: str, snap_column: str,
                     columns: Sequence[str] = SLICE_COLUMNS) -> DataFrame:
    """One store's rows and 11 columns: the store filter prunes partitions
    (``PartitionFilters``) and the projection prunes columns (``ReadSchema``)."""
    return (spark.read.parquet(path).where(F.col("store_id") == store)
                 .select(*columns, snap_column))


# O-7 ------------------------------------------------------------------------
def sql_on_file(spark: SparkSession, path: str, select_sql: str) -> DataFrame:
    """Run SQL straight over a Parquet path: ``{t}`` in ``select_sql`` is
    replaced by the path as a table."""
    return spark.sql(select_sql.format(t=f"parquet.`{path}`"))


# O-8 ------------------------------------------------------------------------
def write_parquet_snappy(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


# O-9 / O-10 -----------------------------------------------------------------
def table_append(df: DataFrame, table_path: str) -> None:
    """Append a whole folder of part files to a table in one distributed
    write (the reference loops over files, 50,000 rows at a time)."""
    df.write.mode("append").parquet(table_path)


def file_row_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per Parquet file (by path: folders may hold files of one name),
    its folder, and the running total in path order.

    Running totals are summed within each folder and added to the total of
    the folders before, so one task sees a folder's files or one row per
    folder, never one row per file of the whole table."""
    counts = (spark.read.parquet(path)
                   .groupBy(F.col("_metadata.file_path").alias("file_path"))
                   .agg(F.count(F.lit(1)).alias("rows"))
                   .withColumn("folder", F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1)))
    within = Window.partitionBy("folder").orderBy("file_path").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("folder").rowsBetween(Window.unboundedPreceding, -1)
    folders = (counts.groupBy("folder").agg(F.sum("rows").alias("in_folder"))
                     .select("folder", F.coalesce(F.sum("in_folder").over(before), F.lit(0)).alias("base")))
    return (counts.withColumn("own", F.sum("rows").over(within)).join(folders, "folder")
                  .select("file_path", "folder", "rows", (F.col("own") + F.col("base")).alias("running_total")))


def publish(write, spark: SparkSession, path: str) -> None:
    """Runs ``write(folder)`` on a private folder beside ``path`` and puts that
    in place by renames: a reader sees the old table or the new one, never a
    part of either, and a failed write leaves the old one."""
    import uuid
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    tag = uuid.uuid4().hex[:8]
    final, fresh, old = (Path(x) for x in (path, f"{path}.new-{tag}", f"{path}.old-{tag}"))
    fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        write(fresh.toString())
        if fs.exists(final):
            fs.rename(final, old)
        if not fs.rename(fresh, final):
            fs.rename(old, final)
            raise OSError(f"could not publish {path}")
        fs.delete(old, True)
    finally:
        fs.delete(fresh, True)


MANIFEST = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("rows", T.LongType()), T.StructField("added", T.LongType())])


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def keyed_append(spark: SparkSession, folder: str, table_path: str, keys: Sequence[str]) -> DataFrame:
    """Appends a folder's part files to a table with a key (O-9), so that it
    can be run again at any time. Returns the manifest: file_path, rows, added,
    running_total (rows up to the file, in path order).

    Files that ``<table>_manifest`` lists are not read again. Of the new
    files' rows, one a key goes in, and none whose key the table has: the row
    of the first file in path order (ties: the smallest row). The table is
    written before the manifest; a run that dies in between is made good by the
    next one, whose rows the key then holds back."""
    manifest = f"{table_path}_manifest"
    listed = spark.read.schema(MANIFEST).parquet(manifest) if _exists(spark, manifest) else spark.createDataFrame([], MANIFEST)
    known = {r[0] for r in listed.select("file_path").collect()}  # as many as the listing below has
    # The listing writes local paths as file:///x, the rows' metadata as file:/x.
    files = sorted(f for f in spark.read.parquet(folder).inputFiles() if f.replace("file:///", "file:/", 1) not in known)
    if files:
        rows = spark.read.option("basePath", folder).parquet(*files).withColumn("__file", F.col("_metadata.file_path"))
        names = [c for c in rows.columns if c != "__file"]
        rest = F.struct(*[c for c in names if c not in keys]) if len(names) > len(keys) else F.lit(0)
        fresh = rows
        if _exists(spark, table_path):
            fresh = rows.join(spark.read.parquet(table_path).select(*keys), list(keys), "left_anti")
        first = fresh.groupBy(*keys).agg(F.min(F.struct(F.col("__file"), rest.alias("__rest"))).alias("__one"))
        kept = first.select(*keys, *([F.col("__one.__rest.*")] if len(names) > len(keys) else []), F.col("__one.__file").alias("__file"))
        # Staged: the table it is held against is the one it goes to.
        from ..session import drop_path, stage_table
        staged, staging = stage_table(kept, "keyed-append")
        staged.select(*names).write.mode("append").parquet(table_path)
        added = staged.groupBy(F.col("__file").alias("file_path")).agg(F.count(F.lit(1)).alias("added"))
        counts = rows.groupBy(F.col("__file").alias("file_path")).agg(F.count(F.lit(1)).alias("rows"))
        counts.join(added, "file_path", "left").select("file_path", "rows", F.coalesce("added", F.lit(0).cast("bigint")).alias("added")).write.mode("append").parquet(manifest)
        drop_path(spark, staging)
    whole = spark.read.schema(MANIFEST).parquet(manifest) if _exists(spark, manifest) else listed
    # One row a file: the running total is a window over file names, not over rows.
    return whole.withColumn("running_total", F.sum("rows").over(Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, 0)))


# O-11 -----------------------------------------------------------------------
def largest_table(tables: dict[str, DataFrame], exclude_like: str | None = None) -> DataFrame:
    """Row count of every table, biggest first; raises when no table has rows.

    Counts are computed as one union of one-row aggregates."""
    if not tables:
        raise ValueError("no tables to inspect")
    parts = []
    for name, df in tables.items():
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if exclude_like:
        out = out.where(~F.col("table_name").like(exclude_like))
    return out.where(F.col("rows") > 0).orderBy(F.desc("rows"), "table_name").limit(1)


def copy_largest(spark: SparkSession, path: str, database: str | None = None, names_like: str | None = None,
                 exclude_like: str = "sqlite_%") -> DataFrame:
    """Chooses among the session catalog's tables and views (O-11): of those
    ``names_like`` (a pattern of ``listTables``) that are not LIKE
    ``exclude_like``, the one with most rows, which is copied to ``path`` as
    Snappy Parquet (O-8). Returns table_name, rows, rows_copied; tables that
    can't be read are passed over, as are empty ones."""
    tables = {}
    for t in spark.catalog.listTables(database, names_like):
        name = ".".join([*(t.namespace or []), t.name])
        try:
            tables[name] = spark.table(name)
        except Exception as e:  # a view on a table that is gone
            if "AnalysisException" not in type(e).__name__ and "AnalysisException" not in str(type(e).__mro__):
                raise
    best = largest_table(tables, exclude_like).first()
    if best is None:
        raise ValueError("no table with rows")
    publish(lambda folder: write_parquet_snappy(spark.table(best["table_name"]), folder), spark, path)
    copied = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_copied"))
    return copied.select(F.lit(best["table_name"]).alias("table_name"), F.lit(best["rows"]).cast("bigint").alias("rows"), "rows_copied")


# O-12 -----------------------------------------------------------------------
def write_submission_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Headered CSV, no index column. ``single_file`` coalesces to one part
    (fine for a submission of one row per series and 28 values)."""
    out = df.coalesce(1) if single_file else df
    write_csv(out, path)
