"""What the physical plans must look like for the operators to hold up at scale."""

import re

import pytest

import duskwatch as dw
import scenario
from duskwatch.operators import evidence
from duskwatch.plans import response_chain
from duskwatch.sources.staging import stage

EVENTS = "/root/testdata/sf0.001/events.parquet"
ORDERS = "/root/testdata/sf0.001/orders.parquet"


@pytest.fixture
def events(spark):
    return spark.read.parquet(EVENTS)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """The final adaptive plan, after running the frame, without the plans it started from."""
    df.collect()
    kept, skip_deeper_than = [], None
    for line in planned(df).splitlines():
        depth = len(line) - len(line.lstrip(" :"))
        if skip_deeper_than is not None and depth > skip_deeper_than:
            continue
        skip_deeper_than = depth if "== Initial Plan ==" in line else None
        if skip_deeper_than is None:
            kept.append(line)
    return "\n".join(kept)


def read_columns(plan):
    return [sorted(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan)]


@pytest.mark.parametrize(
    ("build", "pushed"),
    [
        (lambda e: dw.filter_column_by_value(e, "event_type", "error"), "EqualTo(event_type,error)"),
        (lambda e: dw.filter_column_by_value(e, "user_id", "7"), "EqualTo(user_id,7)"),
        (lambda e: dw.filter_columns_by_values(e, {"event_type": ["a", "b"]}), "In(event_type, [a,b])"),
        (lambda e: dw.filter_by_time(e, "2024-01-10", "2024-01-12", "ts"), "GreaterThanOrEqual(ts,2024-01-10"),
        (
            lambda e: dw.filter_by_relative_time(e, days=1, time_column="ts", as_of="2024-01-31"),
            "GreaterThanOrEqual(ts,2024-01-30",
        ),
        (lambda e: dw.filter_by_relative_time(e, days=1, time_column="ts"), "GreaterThanOrEqual(ts,20"),
        (lambda e: dw.filter_rows_with_all_null(e, ["event_type", "value"]), "IsNull(event_type)"),
    ],
)
def test_filters_reach_the_scan(events, build, pushed):
    # the plan text shortens long filter lists, the scan itself does not
    scan = build(events)._jdf.queryExecution().sparkPlan()
    filters = scan.toString() + str(_metadata(scan))
    assert pushed in filters


def _metadata(plan):
    leaves = plan.collectLeaves()
    return [leaves.apply(i).metadata().toString() for i in range(leaves.size())]


@pytest.mark.parametrize(
    ("build", "columns"),
    [
        (lambda e: dw.threshold_based_rule(e, 5, "user_id"), ["user_id"]),
        (
            lambda e: dw.statistically_significant_window_by_std(e, "user_id", "ts", as_of="2024-01-30"),
            ["ts", "user_id"],
        ),
        (lambda e: dw.trending_based_rule(e, "ts", "user_id", "value"), ["ts", "user_id", "value"]),
    ],
)
def test_rules_read_only_their_columns(events, build, columns):
    assert read_columns(planned(build(events))) == [columns]


def test_rules_combine_rows_before_every_shuffle(events):
    plan = planned(dw.statistically_significant_window_by_std(events, "user_id", "ts", as_of="2024-01-30"))
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("partial_") >= 2


def test_group_outliers_read_the_log_once(events):
    plan = executed(dw.statistical_anomaly_detection_group_by(events, "user_id", "value", z_score_threshold=1.0))
    assert plan.count("FileScan parquet") == 1
    assert "ReusedExchange" in plan and "ReusedSubquery" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_trend_windows_are_cut_by_time(events):
    plan = planned(dw.trending_based_rule(events, "ts", "user_id", "value"))
    windows = re.findall(r"Window \[.*?\], \[(.*?)\], \[", plan)
    assert windows and all("__chunk" in w for w in windows)
    assert "SinglePartition" not in plan  # no window over the whole frame
    assert plan.count("unboundedpreceding") >= len(windows)  # running sums, not sliding frames
    assert "-86400" not in plan and "-3600" not in plan
    # by (entity, time), by (entity, second), once for both averages, by entity
    assert plan.count("Exchange hashpartitioning") == 4
    assert plan.count("Generate inline") == 1
    assert plan.count("Sort [") == 2  # one up, one down


def test_semi_join_moves_below_the_aggregation(spark, events):
    few = stage(spark.createDataFrame([("1",), ("2",)], "user string"), "few")
    logins = events.selectExpr("ts AS date", "CAST(user_id AS STRING) AS user_id", "props AS dest_hostname", "props AS src_ip")
    plan = planned(evidence.entity_footprint(logins, few, "2024-01-31"))
    below = plan[plan.rindex("HashAggregate"):]
    assert "BroadcastHashJoin" in below and "LeftSemi" in below


def test_big_flagged_sets_are_not_broadcast(spark, events):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = events.selectExpr("CAST(user_id AS STRING) AS user").distinct()
        logins = events.selectExpr("ts AS date", "CAST(user_id AS STRING) AS user_id", "props AS dest_hostname", "props AS src_ip")
        plan = planned(evidence.entity_footprint(logins, flagged, "2024-01-31"))
        assert "Broadcast" not in plan and "SortMergeJoin" in plan
        # distinct triples are shuffled, not raw logins
        assert plan.index("SortMergeJoin") < plan.rindex("HashAggregate")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_proxy_log_is_read_once(spark):
    spark.read.parquet(EVENTS).selectExpr(
        "ts AS date", "props AS ip_address", "CAST(user_id AS STRING) AS domain",
        "'Malware' AS url_category",
    ).createOrReplaceTempView("proxy")
    where = stage(
        spark.sql("SELECT DISTINCT domain AS user, 'h' AS dest_hostname, ip_address AS src_ip FROM proxy"), "where"
    )
    # a shuffle used several times shows as reused only in a plan that is final
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = planned(evidence.url_counts(where, spark.table("proxy"), "2024-01-10"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count(EVENTS.rsplit("/", 2)[1] + "/events.parquet") == 1


def test_proxy_log_is_read_once_where_plans_adapt(spark):
    log = spark.read.parquet(EVENTS).selectExpr(
        "ts AS date", "props AS ip_address", "nullif(CAST(user_id AS STRING), '7') AS domain",
        "'Malware' AS url_category",
    )
    where = log.selectExpr("domain AS user", "'h' AS dest_hostname", "ip_address AS src_ip").distinct()
    plan = executed(evidence.url_counts(stage(where, "where"), log, "2024-01-10"))
    assert plan.count(EVENTS.rsplit("/", 2)[1] + "/events.parquet") == 1


def test_building_runs_no_job(spark, events):
    tracker = spark.sparkContext.statusTracker()
    tables = scenario.tables(spark)
    spark.sparkContext.setJobGroup("building", "no job may start here")
    try:
        dw.trending_based_rule(events, "ts", "user_id", "value")
        dw.statistical_anomaly_detection_group_by(events, "user_id", "value")
        dw.statistically_significant_window_by_std(events, "user_id", "ts")
        response_chain.run(tables, as_of=scenario.NOW, keep=lambda df, name: df)
        assert tracker.getJobIdsForGroup("building") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rules_need_no_python_workers(events):
    for df in (
        dw.trending_based_rule(events, "ts", "user_id", "value"),
        dw.statistical_anomaly_detection(events, "value"),
    ):
        assert "Python" not in planned(df)
