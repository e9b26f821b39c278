"""Exploratory aggregates (O-33..O-43, O-68, O-72).

Every aggregate is a ``groupBy().agg()`` with built-in functions, so Spark
runs a partial (map-side) aggregate before the shuffle and a final one after
it: hot keys collapse to one row per map task before any exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import day_number


# O-33 ----------------------------------------------------------------------
def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


# O-34 ----------------------------------------------------------------------
def global_trend(fact: DataFrame, day: str = "d", sales: str = "sales") -> DataFrame:
    """Total units per day, in day order."""
    return (fact.groupBy(day_number(day).alias("day_num"))
                .agg(F.sum(sales).cast("bigint").alias("total_sales"))
                .orderBy("day_num"))


# O-35 ----------------------------------------------------------------------
def seasonality(fact: DataFrame, by: str = "wday", sales: str = "sales") -> DataFrame:
    """Average units per weekday (``by='wday'``) or per month."""
    return fact.groupBy(by).agg(F.avg(sales).alias("avg_sales")).orderBy(by)


# O-36 ----------------------------------------------------------------------
def snap_effect(fact: DataFrame, snap: str = "snap", by: Sequence[str] = ("state_id", "cat_id"),
                sales: str = "sales") -> DataFrame:
    """Average units on benefit vs ordinary days, for every (state, category)
    at once; the reference's single slice is a ``where`` on this result."""
    return (fact.groupBy(*by, snap)
                .agg(F.avg(sales).alias("avg_sales"), F.count(F.lit(1)).alias("n_rows"))
                .orderBy(*by, snap))


# O-37 ----------------------------------------------------------------------
def category_balance(fact: DataFrame, by: str = "cat_id") -> DataFrame:
    return fact.groupBy(by).count().orderBy(F.desc("count"), by)


# O-38 ----------------------------------------------------------------------
def last_known_attrs(fact: DataFrame, attrs: Sequence[str], key: str = "id",
                     day: str = "day_num", last_day: int | None = None) -> DataFrame:
    """Attributes of each series at its own last observed day (up to
    ``last_day``, if given), one row per key. A series that has no row on
    ``last_day`` itself is there with its latest earlier one. ``max_by`` is
    deterministic even when the key is duplicated on that day."""
    src = fact if last_day is None else fact.where(F.col(day) <= last_day)
    packed = F.struct(*[F.col(a) for a in attrs])
    return (src.groupBy(key)
               .agg(F.max_by(packed, F.struct(F.col(day), packed)).alias("__a"))
               .select(key, *[F.col(f"__a.{a}").alias(a) for a in attrs]))


# O-39 ----------------------------------------------------------------------
def distinct_pairs(df: DataFrame, columns: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    out = df.select(*columns)
    for c in not_null:
        out = out.where(F.col(c).isNotNull())
    return out.distinct()


# O-40 ----------------------------------------------------------------------
def store_day_agg(fact: DataFrame, snap: str = "snap", store: str = "store_id",
                  day: str = "day_num", sales: str = "sales", event: str = "event_name_1"
                  ) -> DataFrame:
    """Per store and day: total units, the day's SNAP flag and event.

    Snap and event are functions of (state, day), so ``max`` equals the
    reference's first non-null value and is order-independent. A maximum of
    strings can't be kept in a hash table's buffer, so the rows are first summed
    with the event as a key; the maximum is then taken over one row or two."""
    from ..functions import event_flag
    by_event = fact.groupBy(store, day, event).agg(F.sum(sales).alias("sales"), F.max(snap).alias("snap"))
    return (by_event.groupBy(store, day)
                    .agg(F.sum("sales").cast("bigint").alias("sales"),
                         F.max("snap").alias("snap"),
                         F.max(event).alias("event_name_1"))
                    .withColumn("is_event", event_flag("event_name_1")))


# O-41 ----------------------------------------------------------------------
def zero_rate(fact: DataFrame, sales: str = "sales") -> DataFrame:
    """Rows, zero rows and their shares in percent, in one pass."""
    zero = F.when(F.col(sales) == 0, 1).otherwise(0)
    return (fact.agg(F.count(F.lit(1)).alias("total_rows"),
                     F.sum(zero).cast("bigint").alias("zero_rows"))
                .withColumn("sparsity_pct", F.col("zero_rows") * 100.0 / F.col("total_rows"))
                .withColumn("non_zero_pct", 100.0 - F.col("sparsity_pct")))


# O-42 ----------------------------------------------------------------------
def gap_summary(gaps: DataFrame, by: Sequence[str] = ("item_id",), gap: str = "gap") -> DataFrame:
    return gaps.groupBy(*by).agg(F.avg(gap).alias("avg_gap"), F.max(gap).alias("max_gap"),
                                 F.count(F.lit(1)).alias("n_gaps"))


# O-43 ----------------------------------------------------------------------
def value_range(df: DataFrame, col: str) -> tuple[float | None, float | None]:
    """(min, max) of a column: one scalar aggregate job."""
    r = df.agg(F.min(F.col(col).cast("double")).alias("lo"),
               F.max(F.col(col).cast("double")).alias("hi")).first()
    return r["lo"], r["hi"]


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram between min and max; the last bin is closed.

    The two bounds come from one scalar aggregate; the bin index is then a
    literal expression and one more aggregate counts rows per bin (partial
    aggregation map side, so a hot bin costs one row per task)."""
    lo, hi = value_range(df, col)
    x = F.col(col).cast("double")
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_start double, count bigint")
    width = (hi - lo) / bins
    if width == 0:
        b = F.lit(0)
    else:
        b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
    return (df.where(x.isNotNull())
              .groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
              .withColumn("bin_start", F.lit(lo) + F.lit(hi - lo) * F.col("bin") / bins)
              .select("bin", "bin_start", "count")
              .orderBy("bin"))


# O-68 ----------------------------------------------------------------------
def price_kde(points: DataFrame, col: str = "sell_price", grid_size: int = 200) -> DataFrame:
    """Gaussian kernel density of ``col`` on an even grid over [min, max].

    Scott's bandwidth h = std * n^(-1/5). Values are first collapsed to
    (value, multiplicity); each distinct value then fans out to the fixed
    ``grid_size`` grid points with a generator (no join), and one aggregate
    per grid point sums the kernels (partial sums map side)."""
    x = F.col(col)
    # The collapsed values feed three jobs (moments, variance, density):
    # materialise them once in the shared checkpoint folder.
    vals = (points.where(x.isNotNull()).groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("m"))
                  .checkpoint(eager=True))
    st = vals.agg(F.sum("m").alias("n"),
                  (F.sum(F.col("m") * F.col("v")) / F.sum("m")).alias("mean"),
                  F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if st["n"] is None:
        return points.sparkSession.createDataFrame([], "k int, x double, density double")
    n, mean, lo, hi = int(st["n"]), float(st["mean"]), float(st["lo"]), float(st["hi"])
    # Two-pass sample variance over the collapsed values (numerically stable).
    var = vals.agg((F.sum(F.col("m") * (F.col("v") - F.lit(mean)) ** 2) / F.lit(max(n - 1, 1)))
                   .alias("var")).first()["var"]
    h = (var ** 0.5) * n ** (-0.2)
    step = (hi - lo) / (grid_size - 1) if grid_size > 1 else 0.0
    # Each value only reaches grid points within CUTOFF bandwidths: beyond
    # that a kernel term is below exp(-50) of its peak, far under double
    # precision of the sum. This keeps the fan-out per value bounded by the
    # bandwidth, not by the grid size.
    reach = KDE_CUTOFF * h
    if step > 0:
        kmin = F.greatest(F.lit(0), F.ceil((F.col("v") - F.lit(reach) - F.lit(lo)) / F.lit(step)).cast("int"))
        kmax = F.least(F.lit(grid_size - 1),
                       F.floor((F.col("v") + F.lit(reach) - F.lit(lo)) / F.lit(step)).cast("int"))
    else:
        kmin, kmax = F.lit(0), F.lit(grid_size - 1)
    k = F.explode(F.sequence(kmin, kmax)).alias("k")
    gx = F.lit(lo) + F.lit(hi - lo) * F.col("k") / F.lit(grid_size - 1)
    u = (gx - F.col("v")) / F.lit(h)
    norm = 1.0 / (n * h * (2 * 3.141592653589793) ** 0.5)
    dens = (vals.where(kmin <= kmax).select("v", "m", k)
                .groupBy("k").agg((F.sum(F.col("m") * F.exp(-0.5 * u * u)) * F.lit(norm)).alias("density")))
    # Grid points no value reaches have density 0 (fixed-size grid: 200 rows).
    grid = vals.sparkSession.range(grid_size).select(F.col("id").cast("int").alias("k"))
    return (grid.join(dens, "k", "left")
                .select("k", (F.lit(lo) + F.lit(hi - lo) * F.col("k") / F.lit(grid_size - 1)).alias("x"),
                        F.coalesce("density", F.lit(0.0)).alias("density"))
                .orderBy("k"))


KDE_CUTOFF = 10.0


# O-72 ----------------------------------------------------------------------
def price_response(fact: DataFrame, price: str = "sell_price", sales: str = "sales",
                   by: Sequence[str] = ("dept_id",), bucket: float = 1.0) -> DataFrame:
    """Average units per price bucket over all rows (re-aimed from a 1%
    scatter sample): one aggregate, no sampling."""
    p = F.col(price)
    return (fact.where(p.isNotNull())
                .groupBy(*by, (F.floor(p / bucket) * bucket).alias("price_bucket"))
                .agg(F.avg(sales).alias("avg_sales"), F.count(F.lit(1)).alias("n_rows"))
                .orderBy(*by, "price_bucket"))


def price_sales_corr(fact: DataFrame, price: str = "sell_price", sales: str = "sales",
                     by: Sequence[str] = ("dept_id",)) -> DataFrame:
    return (fact.where(F.col(price).isNotNull()).groupBy(*by)
                .agg(F.corr(price, F.col(sales).cast("double")).alias("price_sales_corr"),
                     F.count(F.lit(1)).alias("n_rows")))


def mixed_gap_summary(fact: DataFrame, key: str = "item_id", day: str = "day_num",
                      sales: str = "sales") -> DataFrame:
    """Gap summary per ``key`` with all of its series interleaved (O-49 with
    a coarser key): every sale day of every store is one event, so k sales on
    the same day add k-1 gaps of 0 days.

    Exact and bounded by the number of days per key: sales are first counted
    per (key, day) (partial aggregation), gaps are taken between distinct
    days only, and the same-day zeros are added arithmetically; no window
    ever holds more than one row per day."""
    from pyspark.sql import Window
    per_day = (fact.where(F.col(sales) > 0).groupBy(key, day)
                   .agg(F.count(F.lit(1)).alias("__k")))
    w = Window.partitionBy(key).orderBy(day)
    g = per_day.withColumn("__gap", (F.col(day) - F.lag(day, 1).over(w)).cast("int"))
    s = g.groupBy(key).agg(F.count("__gap").alias("__ng"), F.sum("__gap").alias("__sg"),
                           F.max("__gap").alias("__mg"), F.sum(F.col("__k") - 1).alias("__z"))
    n = F.col("__ng") + F.col("__z")
    return (s.where(n > 0).select(
        key,
        (F.coalesce(F.col("__sg"), F.lit(0)).cast("double") / n).alias("avg_gap"),
        F.when(F.col("__ng") > 0, F.col("__mg")).otherwise(F.lit(0)).cast("int").alias("max_gap"),
        n.cast("bigint").alias("n_gaps"),
        F.col("__z").cast("bigint").alias("same_day_gaps")))
