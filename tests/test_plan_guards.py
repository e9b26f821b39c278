"""Guards over the physical plans of every registered data query."""

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E

# Model fits and write-then-read queries are covered elsewhere; their plans
# are fits or file round trips rather than one query plan.
SKIP = {"train_poisson", "train_tweedie", "early_stop", "model_save_load", "hybrid_submission",
        "hybrid_backtest", "stream_ingest_fact"}
PYTHON_OK = {"trend_arx", "trend_lookup"}    # per-store 6x6 solve in applyInPandas


def _names():
    return sorted(k for k in E.queries() if k not in SKIP)


@pytest.mark.parametrize("name", _names())
def test_plan_guards(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"
    for udf in ("BatchEvalPython", "ArrowEvalPython"):
        assert udf not in plan, f"{name}: row/vectorised Python UDF in plan"
    if name not in PYTHON_OK:
        assert "FlatMapGroupsInPandas" not in plan and "MapInPandas" not in plan, name
