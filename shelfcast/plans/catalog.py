"""Registry of runnable queries: a Spark builder and, where one exists, the
DuckDB oracle SQL computing the same result over the driver's tables.

Each entry's Spark callable takes ``(spark, sf_dir)``. Double columns listed
in ``rnd`` are rounded to ``digits`` places at the very end on both sides
(engines differ in the last bits of sums of fractions); inputs are never
rounded.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_defaults
from ..sources.tpch_panel import Panel


@dataclass
class Entry:
    build: Callable[[Panel], DataFrame]
    sql: str | None = None
    rnd: tuple[str, ...] = field(default_factory=tuple)
    digits: int = 6


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, rnd: tuple[str, ...] = (), digits: int = 6):
    def deco(fn):
        REGISTRY[name] = Entry(fn, sql, tuple(rnd), digits)
        return fn
    return deco


def spark_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    e = REGISTRY[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_defaults(spark)
        df = e.build(Panel(spark, sf_dir))
        if e.rnd:
            df = df.withColumns({c: F.round(F.col(c).cast("double"), e.digits) for c in e.rnd})
        return df

    run.__name__ = name
    return run


def oracle(name: str) -> str | None:
    e = REGISTRY[name]
    if e.sql is None:
        return None
    if not e.rnd:
        return e.sql
    rep = ", ".join(f"round(CAST({c} AS DOUBLE), {e.digits}) AS {c}" for c in e.rnd)
    return f"SELECT * REPLACE ({rep}) FROM ({e.sql}) AS t"


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: spark_query(k) for k in REGISTRY}


def all_oracles() -> dict[str, str]:
    _load()
    out = {}
    for k in REGISTRY:
        s = oracle(k)
        if s is not None:
            out[k] = s
    return out


def _load():
    # Importing the modules registers their queries.
    from . import queries_eda, queries_io, queries_model, queries_panel  # noqa: F401
