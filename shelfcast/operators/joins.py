"""Joins (O-28..O-32).

Broadcasts are only requested for sides whose size is bounded by
construction (one row per calendar day, one row per series) *and* checked
at run time with ``bounded_broadcast``; beyond the limit the plain join is
left to Catalyst and AQE (sort-merge / shuffled hash, skew splitting).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest side we are willing to ship to every executor: rows and bytes.
BROADCAST_ROW_LIMIT = 2_000_000
BROADCAST_BYTE_LIMIT = 256 << 20


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: strings as long as they are, nested ones as JSON."""
    total = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("array", "map", "struct"):
            c = F.to_json(F.struct(c))
        total = total + (8 if kind not in ("string", "binary", "array", "map", "struct") else F.coalesce(F.octet_length(c), F.lit(0)) + 16)
    return total


def bounded_broadcast(df: DataFrame, max_rows: int | None = None,
                      known_rows: int | None = None) -> DataFrame:
    """Broadcast hint only when the side is proven small, in rows and bytes.

    ``known_rows`` lets callers pass a bound they already know (for example
    the number of calendar days), strings then count 64 bytes each; otherwise
    one job over ``limit(max_rows + 1)`` counts rows and measures their values,
    which stops reading as soon as the limit is crossed. The limits default to
    ``spark.shelfcast.broadcastRowLimit`` (2,000,000) and
    ``spark.shelfcast.broadcastByteLimit`` (256 MB).
    """
    conf = df.sparkSession.conf
    if max_rows is None:
        max_rows = int(conf.get("spark.shelfcast.broadcastRowLimit", str(BROADCAST_ROW_LIMIT)))
    max_bytes = int(conf.get("spark.shelfcast.broadcastByteLimit", str(BROADCAST_BYTE_LIMIT)))
    if known_rows is None:
        n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()
    else:
        n, size = known_rows, known_rows * sum(64 if f.dataType.typeName() in ("string", "binary") else 8 for f in df.schema.fields)
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df


# O-28 ----------------------------------------------------------------------
def join_calendar(fact: DataFrame, cal: DataFrame, on: str | Sequence[str] = "d",
                  cal_rows: int | None = None) -> DataFrame:
    """Left join of facts to the (per-day) calendar; broadcast when bounded."""
    return fact.join(bounded_broadcast(cal, known_rows=cal_rows), on=on, how="left")


# O-29 ----------------------------------------------------------------------
def join_prices(fact: DataFrame, price: DataFrame,
                keys: Sequence[str] = ("store_id", "item_id", "wm_yr_wk")) -> DataFrame:
    """Left join on (store, item, week). Prices grow with the data: no hint,
    Catalyst/AQE pick the strategy."""
    return fact.join(price, on=list(keys), how="left")


# O-30 ----------------------------------------------------------------------
def join_last_known(future: DataFrame, last_attrs: DataFrame, on: str = "id") -> DataFrame:
    """Future rows take the attributes of the series' last observed day."""
    return future.join(last_attrs, on=on, how="left")


# O-31 ----------------------------------------------------------------------
def join_trend(fact: DataFrame, trend: DataFrame,
               keys: Sequence[str] = ("store_id", "day_num"), trend_rows: int | None = None
               ) -> DataFrame:
    """Store-day trend (stores x days rows) joined onto the facts."""
    return fact.join(bounded_broadcast(trend, known_rows=trend_rows), on=list(keys), how="left")


# O-32 ----------------------------------------------------------------------
def future_grid(ids: DataFrame, first_day: int, horizon: int = 28,
                day_col: str = "day_num") -> DataFrame:
    """Every series id x the ``horizon`` days after ``first_day - 1``.

    Written as a per-row generator (``explode(sequence)``) rather than a join:
    each id row fans out to exactly ``horizon`` rows in its own task.
    """
    return ids.select(*ids.columns, F.explode(
        F.sequence(F.lit(int(first_day)), F.lit(int(first_day + horizon - 1)))).alias(day_col))
