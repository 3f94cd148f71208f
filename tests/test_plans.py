"""Plan properties that matter at scale: pruning, pushdown, shared exchanges, no needless joins."""
import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from stridex.sources import read_training
from stridex.operators import selection as sel


def plan_of(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_and_time_steps_read_three_columns(spark):
    for name in ["distinct_users", "gap_sessions", "time_bounds"]:
        plan = plan_of(E.queries()[name](spark, SF_SMALL))
        schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))
        assert schemas == {"struct<ts:timestamp_ntz,user_id:bigint,event_type:string>"}, (name, schemas)
        assert "json_tuple" not in plan


def test_user_filter_and_range_reach_the_scan(spark, tmp_shared):
    path = tmp_shared("native")
    E.queries()["scan_training"](spark, SF_SMALL).write.parquet(path)
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        df = sel.filter_open_range(sel.filter_user(read_training(spark, path), "7"), 10, 2 * 10**18)
        plan = plan_of(df)
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)[0]
    assert "EqualTo(user_id,7)" in pushed and "GreaterThan(timestamp,10)" in pushed
    assert "LessThan(timestamp," in pushed


def test_sessionization_without_hot_keys_is_one_exchange(spark):
    """No chunks, no join: the samples are read once (after the sketch) and shuffled once."""
    plan = plan_of(E.queries()["gap_sessions"](spark, SF_SMALL))
    assert "_chunk" not in plan and "Join" not in plan and plan.count("FileScan parquet") == plan.count("hashpartitioning(") == 1


def test_sessionization_shares_the_samples_exchange(spark):
    from stridex import queries as Q
    from stridex.operators.sessions import gap_sessions
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(gap_sessions(Q._domain(spark, SF_SMALL), method="chunk", **Q.SET_A), run=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    final = re.sub(r"#\d+L?", "", plan.split("== Initial Plan ==")[0])
    assert "ReusedExchange" in final
    assert final.count("FileScan parquet") == 1
    assert "SortMergeJoin [user_id, activity, _chunk]" in final


def test_moment_features_need_no_join(spark):
    plan = plan_of(E.queries()["feat_mean"](spark, SF_SMALL))
    assert "Join" not in plan
    plan = plan_of(E.queries()["feat_abs_dev"](spark, SF_SMALL))
    assert "Join" in plan


def test_partial_aggregation_before_shuffle(spark):
    plan = plan_of(E.queries()["time_bounds"](spark, SF_SMALL))
    assert re.search(r"partial_min\(timestamp", plan) and re.search(r"partial_count", plan)


def test_driver_filters_reach_the_scan(spark):
    """User and time predicates are translated to the raw event columns."""
    from stridex.plans import prediction as pred
    from stridex.sources.readers import live_from_events
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plans = {n: plan_of(E.queries()[n](spark, SF_SMALL)) for n in ("filter_user", "filter_open_range", "latest_n_user")}
        plans["R1"] = plan_of(pred.latest_features(live_from_events(spark, SF_SMALL, users=["7", "x"]), 5, ["7", "x"]))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    pushed = {n: re.findall(r"PushedFilters: \[([^\]]*)\]", p)[0] for n, p in plans.items()}
    for n in ("filter_user", "latest_n_user", "R1"):
        assert "EqualTo(user_id,7)" in pushed[n], (n, pushed[n])
    assert "GreaterThan(ts,2024-01-01T00:00:07.179575)" in pushed["filter_open_range"]
    assert "LessThan(ts,2024-01-11T00:00:07.179575)" in pushed["filter_open_range"]


def test_named_users_of_a_sample_table_are_pushed(spark, tmp_shared):
    path = tmp_shared("native")
    E.queries()["scan_live"](spark, SF_SMALL).write.parquet(path)
    plan = plan_of(sel.restrict_to_users(spark.read.parquet(path), ["7", "8"]))
    assert "In(user_id, [7,8])" in plan and "Join" not in plan


def test_range_join_runs_once(spark):
    plan = plan_of(E.queries()["labeled_points"](spark, SF_SMALL), run=True)
    assert "_b" not in plan.split("== Initial Plan ==")[0].replace("_base", "")
