"""Scalar column expressions (S1..S9).

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the retail calendar: day 1 of the reference panel.
REFERENCE_ORIGIN = "2011-01-29"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# S1 ------------------------------------------------------------------------
def day_number(d, how: str = "substring") -> Column:
    """``'d_17'`` -> 17. Three spellings, all null on a malformed value."""
    d = _c(d)
    if how == "substring":
        return F.substring(d, 3, 1 << 20).try_cast("int")
    if how == "split":
        return F.try_element_at(F.split(d, "_"), F.lit(2)).try_cast("int")
    if how == "regex":
        digits = F.regexp_extract(d, r"(\d+)", 1)
        return F.when(digits != "", digits.try_cast("int"))
    raise ValueError(how)


# S2 ------------------------------------------------------------------------
def day_to_date(n, origin: str = REFERENCE_ORIGIN) -> Column:
    """date = origin + (n - 1)."""
    return F.date_add(F.lit(origin).cast("date"), (_c(n) - 1).cast("int"))


# S3 ------------------------------------------------------------------------
def date_parts(date) -> dict[str, Column]:
    """weekday (Monday=0), month and day of month, as bytes."""
    date = _c(date)
    return {
        "wday": F.weekday(date).cast("byte"),
        "month": F.month(date).cast("byte"),
        "day": F.dayofmonth(date).cast("byte"),
    }


def retail_wday(date) -> Column:
    """Retail-calendar weekday number: Saturday=1 ... Friday=7."""
    return (F.dayofweek(_c(date)) % 7 + 1).cast("int")


# S4 ------------------------------------------------------------------------
def day_label(n) -> Column:
    return F.concat(F.lit("d_"), _c(n).cast("string"))


def horizon_label(n, last_day) -> Column:
    return F.concat(F.lit("F"), (_c(n) - _c(last_day) if not isinstance(last_day, int)
                                 else _c(n) - F.lit(last_day)).cast("string"))


# S5 ------------------------------------------------------------------------
def event_flag(name) -> Column:
    """null or 'NoEvent' -> 0, anything else -> 1."""
    return F.when(F.coalesce(_c(name), F.lit("NoEvent")) == "NoEvent", 0).otherwise(1)


# S6 ------------------------------------------------------------------------
def log_scale(x) -> Column:
    return F.log1p(_c(x))


def unlog_scale(x) -> Column:
    return F.expm1(_c(x))


# S7 ------------------------------------------------------------------------
def state_prefix(store) -> Column:
    return F.substring(_c(store), 1, 2)


# S8 ------------------------------------------------------------------------
def safe_ratio(a, b) -> Column:
    return F.try_divide(_c(a), _c(b))


def pct(part, whole) -> Column:
    return F.try_divide(_c(part) * 100.0, _c(whole))


# S9 ------------------------------------------------------------------------
def hash_bucket(key, buckets: int = 20, how: str = "murmur") -> Column:
    """Stable bucket of a key. ``murmur`` is Spark's ``hash``; ``md5`` takes
    the first 8 hex digits of the MD5 digest, which any SQL engine can
    reproduce."""
    if how == "murmur":
        return F.pmod(F.hash(_c(key)), F.lit(buckets))
    if how == "md5":
        return F.pmod(F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10)
                      .cast("bigint"), F.lit(buckets))
    raise ValueError(how)
