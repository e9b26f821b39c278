"""Spark queries against their DuckDB oracle SQL on the smallest data set."""

import math

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from shelfcast.sources.tpch_panel import TABLES

FAST = ["row_count", "global_trend", "seasonality_weekday", "snap_effect", "zero_rate",
        "store_day_agg", "gap_summary", "histogram_sales", "price_kde", "features_all",
        "rmsse", "wrmsse", "submission", "pivot_horizon", "ordinal_encode", "trend_gram",
        "dq_duplicate_lines", "largest_table", "etl_flagship", "gap_summary_item_mixed", "const_columns",
        "trend_gram_ma", "trend_arx", "table_append_keyed", "dq_verify_files", "copy_largest", "sample_department"]


def _norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
    except TypeError:
        pass
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL).toPandas()
    odf = con.sql(E.oracle_sql()[name]).df()
    assert _rows(sdf) == _rows(odf)


def test_every_query_has_callable_and_entry(spark):
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    df = E.entry(spark)
    assert len(df.columns) > 10
