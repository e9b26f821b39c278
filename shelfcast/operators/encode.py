"""Ordinal encoding of categorical columns (O-53).

Categories are learned on the training rows only: the distinct values of a
column (compared as strings), sorted ascending with null first (null is a
category of its own), numbered from 0. Values never seen in training get -1.
The category table has one row per distinct value (a dimension: tens to
thousands of values), so it is broadcast after a size check and the encode is
a map-side join. Numbering runs over ranges of the distinct values, so no task
holds a column's values, and never over the fact rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import bounded_broadcast

UNSEEN = -1


class CategoryMaps(dict):
    """column -> (value, code) table; ``n_values`` (all columns together)
    bounds the size of every table, so one count serves every broadcast."""
    n_values: int | None = None


def fit_ordinal(train: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """Category tables of several columns from ONE pass over the training
    rows: (column, value) pairs are stacked, de-duplicated and numbered per
    column. The small result is checkpointed so each later broadcast reads
    the dictionary, not the training rows again."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    stacked = train.select(F.expr(f"stack({len(columns)}, {pairs}) AS (column_name, value)"))
    # Ranges of (column, value), numbered each for itself; a range begins where
    # the column's ranges before it end (one count a range).
    ranges = (stacked.distinct().repartitionByRange("column_name", F.col("value").asc_nulls_first())
                     .withColumn("__range", F.spark_partition_id()).checkpoint(eager=True))
    own = Window.partitionBy("column_name", "__range").orderBy(F.col("value").asc_nulls_first())
    before = Window.partitionBy("column_name").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranges.groupBy("column_name", "__range").agg(F.count(F.lit(1)).alias("n"))
                    .select("column_name", "__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start")))
    table = (ranges.withColumn("__row", F.row_number().over(own)).join(starts, ["column_name", "__range"])
                   .select("column_name", "value", (F.col("__start") + F.col("__row") - 1).cast("int").alias("code"))
                   .checkpoint(eager=True))
    maps = CategoryMaps({c: table.where(F.col("column_name") == c).select("value", "code")
                         for c in columns})
    maps.n_values = table.count()
    return maps


def apply_ordinal(df: DataFrame, maps: dict[str, DataFrame], suffix: str = "_code") -> DataFrame:
    out = df
    known = getattr(maps, "n_values", None)
    for c, m in maps.items():
        m = bounded_broadcast(m.select(F.col("value").alias(f"__v_{c}"), F.col("code").alias(c + suffix)),
                              known_rows=known)
        out = (out.join(m, F.col(c).cast("string").eqNullSafe(F.col(f"__v_{c}")), "left")
                  .drop(f"__v_{c}")
                  .withColumn(c + suffix, F.coalesce(F.col(c + suffix), F.lit(UNSEEN))))
    return out
