"""Data-quality checks (O-64..O-66), each a distributed aggregate.

Checks return DataFrames (one row per finding or one summary row) rather than
printing, so they can be asserted on, stored, or joined to other reports.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: file size below which the integrity check warns (0.1 GB).
MIN_FILE_BYTES = int(0.1 * 1024 ** 3)


# O-64 -----------------------------------------------------------------------
def duplicate_keys(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """All keys that occur more than once (with their counts); ``limit``
    reports the first few in key order instead."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)
    return out.orderBy(*keys).limit(limit) if limit else out


# O-65 -----------------------------------------------------------------------
def file_verify(spark: SparkSession, path: str, min_bytes: int = MIN_FILE_BYTES) -> DataFrame:
    """Integrity of a Parquet table: size on disk (warn below ``min_bytes``),
    schema readable, and a full scan touching every column.

    A bare ``count(*)`` is answered from footers; counting every column
    forces each column chunk to be decoded."""
    df = spark.read.parquet(path)
    size = _path_bytes(spark, path)
    counts = [F.count(F.col(f"`{c}`")).alias(f"nn_{i}") for i, c in enumerate(df.columns)]
    agg = df.agg(F.count(F.lit(1)).alias("rows"), *counts)
    nn = [F.col(f"nn_{i}") for i in range(len(df.columns))]
    return agg.select(
        F.lit(path).alias("path"), F.lit(size).cast("bigint").alias("bytes"),
        F.lit(size < min_bytes).alias("size_warning"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.col("rows").cast("bigint").alias("rows"),
        sum(nn[1:], nn[0]).cast("bigint").alias("non_null_cells") if nn else F.lit(0).alias("non_null_cells"),
    )


def _path_bytes(spark: SparkSession, path: str) -> int:
    """Total size through the Hadoop file system API (works for any scheme
    the cluster is configured for)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    return int(fs.getContentSummary(p).getLength())


def verify_files(spark: SparkSession, path: str) -> DataFrame:
    """Every Parquet file under ``path`` on its own: file_path, bytes,
    footer_rows (what its footer says), decoded_rows (rows of which every
    column could be decoded), non_null_cells and status: ``ok``, ``damaged``
    (fewer rows than the footer says) or ``unreadable`` (no footer).

    Two scans by file, one without columns (answered from the footers) and one
    of all columns; unreadable parts are passed over, so the other files are
    still counted. Files are listed apart from the scans, so none is missed."""
    skip = spark.read.option("ignoreCorruptFiles", True)
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
                   .select(F.col("path").alias("file_path"), F.col("length").alias("bytes")))
    df = skip.parquet(path)
    file = F.col("_metadata.file_path").alias("file_path")
    footers = skip.schema(df.schema).parquet(path).groupBy(file).agg(F.count(F.lit(1)).alias("footer_rows"))
    cells = [F.count(F.col(f"`{c}`")).cast("bigint") for c in df.columns]
    decoded = skip.schema(df.schema).parquet(path).groupBy(file).agg(F.count(F.lit(1)).alias("decoded_rows"), sum(cells[1:], cells[0]).alias("non_null_cells"))
    out = listed.join(footers, "file_path", "left").join(decoded, "file_path", "left").checkpoint(eager=True)
    # Neither scan shows a file without rows; is it empty or unreadable?
    for r in out.where(F.col("footer_rows").isNull()).select("file_path").collect():
        try:
            spark.read.option("ignoreCorruptFiles", False).parquet(r["file_path"])
        except Exception:
            continue
        out = out.withColumn("footer_rows", F.when(F.col("file_path") == r["file_path"], 0).otherwise(F.col("footer_rows")))
    rows = F.coalesce("decoded_rows", F.lit(0).cast("bigint"))
    status = F.when(F.col("footer_rows").isNull(), "unreadable").when(F.col("footer_rows") > rows, "damaged").otherwise("ok")
    return out.select("file_path", "bytes", "footer_rows", rows.alias("decoded_rows"), F.coalesce("non_null_cells", F.lit(0).cast("bigint")).alias("non_null_cells"), status.alias("status"))


# O-66 -----------------------------------------------------------------------
def row_conservation(long: DataFrame, series_keys: Sequence[str], day: str = "d",
                     written: DataFrame | None = None) -> DataFrame:
    """rows == series x days on a long panel (and, when a written copy is
    given, rows written == rows read back), in one summary row."""
    agg = long.agg(F.count(F.lit(1)).alias("rows"),
                   F.countDistinct(*[F.col(k) for k in series_keys]).alias("n_series"),
                   F.countDistinct(day).alias("n_days"))
    out = agg.withColumn("expected_rows", F.col("n_series") * F.col("n_days")) \
             .withColumn("conserved", F.col("rows") == F.col("expected_rows"))
    if written is not None:
        # One scalar job; the summary stays a single row without a join.
        n_written = written.count()
        out = out.withColumn("rows_written", F.lit(n_written)).withColumn(
            "write_conserved", F.col("rows") == F.col("rows_written"))
    return out.select(*[F.col(c).cast("bigint") if c in ("rows", "n_series", "n_days", "expected_rows",
                                                        "rows_written") else F.col(c)
                        for c in out.columns])
