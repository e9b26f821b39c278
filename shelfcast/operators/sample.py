"""Samples (O-52, O-69): by hash, so that a row is in or out whatever the
partitioning, the run or the engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of the hash that one step of ``fixed_size_sample`` tells apart.
DIGITS = 3
#: A hash range of at most so many rows is settled row by row.
SETTLED = 1_000


def row_hash(keys: Sequence[str]) -> Column:
    """MD5 (hex) of the keys as text, joined by '|' (nulls left out)."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).cast("binary"))


def fraction_sample(df: DataFrame, keys: Sequence[str], fraction: float) -> DataFrame:
    """About ``fraction`` of the rows: those whose hash lies below it."""
    cut = f"{min(16 ** 8, max(0, round(fraction * 16 ** 8))):08x}"
    return df if fraction >= 1 else df.where(F.substring(row_hash(keys), 1, 8) < cut)


def fixed_size_sample(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The ``k`` rows with the smallest (hash, keys): just ``k`` of them, or all
    if there are no more. ``keys`` should tell rows apart; rows with equal keys
    are in or out together, so more than ``k`` can come with them.

    No task holds the sample. Rows are counted by the first hash digits; the
    range that the k-th row falls in is counted by the next digits until it is
    small, and its last row in the sample gives the bound that every row is
    held against. Only counts, and at most ``SETTLED`` keys, reach the driver;
    each step counts a 4,096th of the rows of the step before."""
    hashed = df.withColumn("__h", row_hash(keys))
    if k <= 0:
        return df.limit(0)
    prefix, before = "", 0
    while True:
        part = hashed.where(F.col("__h").startswith(prefix)) if prefix else hashed
        counts = part.groupBy(F.substring("__h", 1, len(prefix) + DIGITS).alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
        if not prefix and sum(r["n"] for r in counts) <= k:
            return df
        for r in counts:
            if before + r["n"] >= k:
                break
            before += r["n"]
        prefix, n = r["p"], r["n"]
        if n <= SETTLED or len(prefix) >= 32:
            break
    order = ["__h", *keys]
    rows = hashed.where(F.col("__h").startswith(prefix)).select(*order).orderBy(*order).limit(k - before).collect()
    last, ties = rows[-1], [r for r in rows if r["__h"] == rows[-1]["__h"]]
    inside = F.col("__h") < last["__h"]
    for r in ties:  # equal hashes: told apart by the keys
        same = F.col("__h") == r["__h"]
        for key in keys:
            same = same & F.col(key).eqNullSafe(F.lit(r[key]))
        inside = inside | same
    return hashed.where(inside).drop("__h")
