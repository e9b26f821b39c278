"""Time-series window features (O-44..O-50).

All features of one series share a single window specification
``partitionBy(series keys).orderBy(day)``, so Catalyst plans ONE hash
exchange on the series keys for lags, rolling statistics and series
maxima together. Per-series rows are bounded by the number of days on a
dense panel, so no window partition grows with the data volume.

Min-period rule (pandas default): a rolling value exists only when the frame
holds ``win`` non-null values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES = ("item_id", "store_id")


def series_window(keys: Sequence[str] = SERIES, order: str = "day_num"):
    return Window.partitionBy(*keys).orderBy(order)


def _rolling(w, win: int):
    return w.rowsBetween(-(win - 1), 0)


def rolling(x: Column | str, win: int, agg: str, keys=SERIES, order="day_num") -> Column:
    """pandas ``rolling(win).<agg>()`` over a series (min_periods = win)."""
    x = F.col(x) if isinstance(x, str) else x
    f = _rolling(series_window(keys, order), win)
    fn = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum, "max": F.max, "min": F.min}[agg]
    return F.when(F.count(x).over(f) == win, fn(x).over(f))


# O-44 ----------------------------------------------------------------------
def lag_features(df: DataFrame, lags: Sequence[int] = (28, 35, 42, 49), col: str = "sales",
                 keys=SERIES, order: str = "day_num", prefix: str = "lag_") -> DataFrame:
    """Position lags: correct only on a dense panel (see ``densify_panel``).
    Lags are doubles (null before the series has k rows), like a pandas
    ``shift``."""
    w = series_window(keys, order)
    return df.withColumns({f"{prefix}{k}": F.lag(F.col(col).cast("double"), k).over(w) for k in lags})


def rolling_integer_stats(df: DataFrame, x: str, win: int, mean_name: str, std_name: str,
                          keys=SERIES, order: str = "day_num") -> DataFrame:
    """Rolling mean / sample std (min_periods = win) of an integer-valued
    column in O(rows): running sums from the series start (an incremental
    frame) differenced ``win`` rows apart. 64-bit integer sums are exact, so
    the mean equals the moving-frame result bit for bit; the std comes from
    exact sums of squares. A moving frame instead re-aggregates ``win`` rows
    for every output row."""
    w = series_window(keys, order)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    v = F.col(x).cast("long")
    t = [f"__{x}_{n}" for n in ("n", "s1", "s2")]
    out = df.withColumns({
        t[0]: F.count(v).over(run),
        t[1]: F.coalesce(F.sum(v).over(run), F.lit(0)),
        t[2]: F.coalesce(F.sum(v * v).over(run), F.lit(0)),
    })
    d = {c: F.col(c) - F.lag(c, win, 0).over(w) for c in t}
    n, s1, s2 = d[t[0]], d[t[1]], d[t[2]]
    full = n == win
    var = (s2 * win - s1 * s1).cast("double") / float(win * (win - 1))
    out = out.withColumns({
        mean_name: F.when(full, s1.cast("double") / float(win)),
        std_name: F.when(full, F.sqrt(F.greatest(var, F.lit(0.0)))),
    })
    return out.drop(*t)


# O-45 / O-46 ---------------------------------------------------------------
def rolling_lagged(df: DataFrame, win: int = 28, shift: int = 28, col: str = "sales",
                   keys=SERIES, order: str = "day_num", names: tuple[str, str] | None = None,
                   integer_valued: bool | None = None) -> DataFrame:
    """Rolling mean and sample std over ``win`` rows of ``lag(col, shift)``.

    Columns of an integer type (unit sales) use exact running sums, O(rows);
    others a moving frame, O(rows x win), as a cast to integers would lose
    their fractions. ``integer_valued`` says so of a column of another type
    that is known to hold whole numbers only."""
    if integer_valued is None:
        integer_valued = isinstance(df.schema[col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    lagged = F.lag(col, shift).over(series_window(keys, order))
    tmp = f"__lag_{shift}"
    mean_name, std_name = names or (f"roll_mean_{win}", f"roll_std_{win}")
    out = df.withColumn(tmp, lagged)
    if integer_valued:
        out = rolling_integer_stats(out, tmp, win, mean_name, std_name, keys, order)
    else:
        out = out.withColumns({mean_name: rolling(tmp, win, "mean", keys, order),
                               std_name: rolling(tmp, win, "std", keys, order)})
    return out.drop(tmp)


# O-47 ----------------------------------------------------------------------
def price_features(df: DataFrame, price: str = "sell_price", keys=SERIES,
                   order: str = "day_num", ref: str = "series") -> DataFrame:
    """price_max over the series (``ref='series'``, as the reference: it
    sees the future) or up to the current day (``ref='to_date'``), and
    price_momentum = price / price_max."""
    w = Window.partitionBy(*keys)
    if ref == "to_date":
        w = series_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return (df.withColumn("price_max", F.max(price).over(w))
              .withColumn("price_momentum", F.try_divide(F.col(price), F.col("price_max"))))


# O-48 ----------------------------------------------------------------------
def price_volatility(df: DataFrame, win: int = 7, price: str = "sell_price", keys=SERIES,
                     order: str = "day_num", name: str | None = None) -> DataFrame:
    return df.withColumn(name or f"price_roll_std_{win}", rolling(price, win, "std", keys, order))


# O-49 ----------------------------------------------------------------------
def sale_gaps(df: DataFrame, keys: Sequence[str] = SERIES, order: str = "day_num",
              sales: str = "sales") -> DataFrame:
    """Days between consecutive non-zero sales of a series; each series'
    first sale has no gap and is dropped."""
    sold = df.where(F.col(sales) > 0).select(*keys, order)
    w = Window.partitionBy(*keys).orderBy(order)
    gap = (F.col(order) - F.lag(order, 1).over(w)).cast("int")
    return sold.withColumn("gap", gap).where(F.col("gap").isNotNull())


# O-50 ----------------------------------------------------------------------
def densify_panel(cells: DataFrame, first_day: int, last_day: int,
                  series_keys: Sequence[str] = SERIES, carry: Sequence[str] = (),
                  day_col: str = "day_num", value_col: str = "sales",
                  fill_value=0) -> DataFrame:
    """Complete series x day grid; missing values become ``fill_value``.

    The grid is generated per series with ``explode(sequence(...))`` (narrow,
    no cross join), then matched to the observed cells with one equi join.
    ``carry`` are series-level attributes (functions of the series keys).
    """
    keys = list(series_keys) + list(carry)
    series = cells.select(*keys).distinct()
    grid = series.select(*keys, F.explode(F.sequence(F.lit(int(first_day)), F.lit(int(last_day))))
                         .alias(day_col))
    obs = cells.select(*series_keys, day_col, value_col)
    return (grid.join(obs, on=list(series_keys) + [day_col], how="left")
                .withColumn(value_col, F.coalesce(F.col(value_col), F.lit(fill_value))))


def series_features(df: DataFrame, lags: Sequence[int] = (28, 35, 42, 49),
                    roll: tuple[int, int] | None = (28, 28), price_win: int | None = 7,
                    price_ref: str = "series", keys=SERIES, order: str = "day_num",
                    sales: str = "sales", price: str = "sell_price") -> DataFrame:
    """All per-series features of the global model (VAL feature set) in one
    pass: every expression shares the same partitioning, so the plan has a
    single hash exchange on the series keys."""
    out = lag_features(df, lags, sales, keys, order)
    if roll:
        win, shift = roll
        out = rolling_lagged(out, win, shift, sales, keys, order)
    if price_win:
        out = price_features(out, price, keys, order, price_ref)
        out = price_volatility(out, price_win, price, keys, order)
    return out
