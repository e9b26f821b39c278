"""Plan-shape checks: the physical plans we rely on for scale."""

from conftest import SF_SMALL

from shelfcast.plans.catalog import all_queries
from shelfcast.sources.files import scan_store_slice
from shelfcast.sources.tpch_panel import Panel


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_reuse_series_partitioning(spark):
    # Simulate large tables (no size-based broadcast): the densify join, the
    # weekly-price join and all series windows must then sit on the one
    # partitioning created on the series key; no other hash exchange.
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(all_queries()["features_all"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Window" in plan
    shuffles = [l for l in plan.split("\n") if "Exchange hashpartitioning" in l]
    assert shuffles and all("REPARTITION_BY_NUM" in l for l in shuffles), shuffles
    top = plan.split("SortMergeJoin")[0]
    assert "Exchange" not in top


def test_calendar_join_is_broadcast(spark):
    df = all_queries()["join_calendar"](spark, SF_SMALL)
    assert "BroadcastHashJoin" in _plan(df)


def test_store_slice_prunes_partitions(spark, tmp_path):
    p = Panel(spark, SF_SMALL)
    path = str(tmp_path / "fact")
    p.fact().write.partitionBy("store_id").parquet(path)
    df = scan_store_slice(spark, path, "NATION_1", "snap_AMERICA")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(store_id" in plan and "NATION_1" in plan
    assert "ReadSchema" in plan and "wm_yr_wk" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_no_cross_joins_in_panel(spark):
    for name in ["etl_flagship", "densify_panel", "price_kde", "histogram_sales", "submission"]:
        plan = _plan(all_queries()[name](spark, SF_SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
