"""One query per scan, projection, filter, join, aggregation, sort and rule.

``QUERIES`` maps a name to ``(spark, directory) -> DataFrame``; ``ORACLES`` maps the same name
to standard SQL over views called like the tables.  Fractional results are rounded to six
places on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

import duskwatch as dw
from duskwatch.operators.relational import (
    derive_by_category,
    distinct_columns,
    with_surrogate_ids,
)
from duskwatch.operators.evidence import users_of
from duskwatch.plans.history import surges_in_totals, window_totals
from duskwatch.sources.staging import shared_folder
from duskwatch.sources.tables import append, get_table, overwrite, read_path, sql_over_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str | None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return register


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return read_path(spark, f"{directory}/{name}.parquet")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- scans ---------------------------------------------------------------------------------

@check("SELECT * FROM events")
def scan_by_name(spark, directory):
    table(spark, directory, "events").createOrReplaceTempView("duskwatch_events")
    return get_table("duskwatch_events", spark)


@check("SELECT * FROM orders")
def scan_by_path(spark, directory):
    return read_path(spark, f"{directory}/orders.parquet")


@check("SELECT * FROM customer")
def scan_by_sql(spark, directory):
    return sql_over_path(spark, f"{directory}/customer.parquet")


@check("SELECT c_custkey FROM customer WHERE c_name = 'Customer#000000007'")
def point_lookup(spark, directory):
    return sql_over_path(
        spark, f"{directory}/customer.parquet", ["c_custkey"], "c_name = :name",
        {"name": "Customer#000000007"},
    )


@check("""
    SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders
    WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
""")
def write_merged_schema(spark, directory):
    """A table of fewer columns, rows with one more added, both read under the wider schema."""
    orders = table(spark, directory, "orders")
    path = f"{shared_folder(spark)}/merged-{uuid.uuid4().hex}"
    overwrite(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus"), path)
    append(orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), path)
    return read_path(spark, path, merge_schema=True)


@check("""
    SELECT user_id, count(*) AS n, max(ts) AS last_seen FROM events GROUP BY user_id
    UNION ALL
    SELECT user_id, count(*) AS n, max(ts) AS last_seen FROM events
    WHERE event_type = 'error' GROUP BY user_id
""")
def write_overwrite_append(spark, directory):
    """Totals of all events written over a table, totals of errors added, both read back."""
    events = table(spark, directory, "events")
    path = f"{shared_folder(spark)}/totals-{uuid.uuid4().hex}"

    def totals(rows):
        return dw.aggregate_data(
            rows, ["user_id"], ["event_id", "ts"], [F.count, F.max], ["n", "last_seen"]
        )

    overwrite(totals(events), path)
    append(totals(dw.filter_column_by_value(events, "event_type", "error")), path)
    return read_path(spark, path)


# --- projection ----------------------------------------------------------------------------

@check("SELECT user_id, event_type, ts FROM events")
def select_named(spark, directory):
    return dw.select_columns(table(spark, directory, "events"), "user_id", "event_type", "ts")


@check("SELECT DISTINCT user_id, event_type FROM events")
def distinct_pairs(spark, directory):
    return distinct_columns(table(spark, directory, "events"), "user_id", "event_type")


@check("""
    SELECT event_id, event_type,
           CASE WHEN event_type IN ('error', 'signup') THEN 'Blocked' ELSE 'Allowed' END AS outcome
    FROM events
""")
def derived_outcome(spark, directory):
    events = table(spark, directory, "events").select("event_id", "event_type")
    return derive_by_category(
        events, "outcome", "event_type", ["error", "signup"], "Blocked", "Allowed"
    )


@check("""
    SELECT o_orderdate, count(*) AS n_rows, count(*) AS n_ids, TRUE AS before_next_date
    FROM orders GROUP BY o_orderdate
""")
def surrogate_ids(spark, directory):
    """Ids are unique and rise with the sort order; they are not consecutive."""
    numbered = with_surrogate_ids(
        table(spark, directory, "orders").select("o_orderdate"), "id", "o_orderdate", start=5021
    )
    by_date = numbered.groupBy("o_orderdate").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("id").alias("n_ids"),
        F.min("id").alias("first"),
        F.max("id").alias("last"),
    )
    dates = Window.orderBy("o_orderdate")  # one row for each day of the calendar
    following = F.lead("first", 1, 2**63 - 1).over(dates)
    rising = (F.col("last") < following) & (F.col("first") >= 5021)
    return by_date.select("o_orderdate", "n_rows", "n_ids", rising.alias("before_next_date"))


# --- filters -------------------------------------------------------------------------------

@check("SELECT * FROM events WHERE event_type = 'error'")
def filter_value(spark, directory):
    return dw.filter_column_by_value(table(spark, directory, "events"), "event_type", "error")


@check("SELECT * FROM events WHERE event_type IN ('error', 'signup') AND user_id = 7")
def filter_values_and(spark, directory):
    return dw.filter_columns_by_values(
        table(spark, directory, "events"), {"event_type": ["error", "signup"], "user_id": 7}
    )


@check("SELECT * FROM events WHERE event_type = 'error' OR user_id IN (7, 8)")
def filter_values_or(spark, directory):
    return dw.filter_columns_by_values(
        table(spark, directory, "events"), {"event_type": "error", "user_id": [7, 8]},
        is_and_operator=False,
    )


@check("SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def filter_category(spark, directory):
    return dw.filter_column_by_category(
        table(spark, directory, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"]
    )


@check("""
    SELECT * FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def filter_categories(spark, directory):
    return dw.filter_columns_by_categories(
        table(spark, directory, "orders"),
        {"o_orderstatus": "F", "o_orderpriority": ["1-URGENT", "2-HIGH"]},
    )


@check("""
    SELECT * FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1996-12-31'
""")
def filter_date_range(spark, directory):
    return dw.filter_column_by_date_range(
        table(spark, directory, "orders"), "o_orderdate", "1996-01-01", "1996-12-31"
    )


@check("""
    SELECT * FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-01-31'
       OR o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-01-31'
""")
def filter_date_ranges(spark, directory):
    return dw.filter_columns_by_date_ranges(
        table(spark, directory, "orders"),
        {"o_orderdate": [("1996-01-01", "1996-01-31"), ("1998-01-01", "1998-01-31")]},
    )


@check("""
    SELECT * FROM events
    WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts <= TIMESTAMP '2024-01-12 18:00:00'
""")
def filter_time(spark, directory):
    return dw.filter_by_time(
        table(spark, directory, "events"), "2024-01-10 06:00:00", "2024-01-12 18:00:00", "ts"
    )


@check("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00'")
def filter_relative_time(spark, directory):
    return dw.filter_by_relative_time(
        table(spark, directory, "events"), days=1, time_column="ts", as_of="2024-01-31 00:00:00"
    )


_SPARSE = """
    SELECT event_id, nullif(event_type, 'error') AS event_type,
           CASE WHEN value >= 5 THEN value END AS value
    FROM events
"""


def _sparse(spark, directory):
    return table(spark, directory, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 5, F.col("value")).alias("value"),
    )


@check(f"SELECT * FROM ({_SPARSE}) AS sparse WHERE event_type IS NULL OR value IS NULL")
def filter_any_null(spark, directory):
    return dw.filter_rows_with_any_null(_sparse(spark, directory), ["event_type", "value"])


@check(f"SELECT * FROM ({_SPARSE}) AS sparse WHERE event_type IS NULL AND value IS NULL")
def filter_all_null(spark, directory):
    return dw.filter_rows_with_all_null(_sparse(spark, directory), ["event_type", "value"])


@check("SELECT * FROM part WHERE regexp_matches(p_name, '^red|ring$')")
def filter_pattern(spark, directory):
    return dw.filter_column_by_string_pattern(table(spark, directory, "part"), "p_name", "^red|ring$")


@check("""
    SELECT * FROM part
    WHERE (regexp_matches(p_name, '^a') OR regexp_matches(p_name, 'e$'))
      AND regexp_matches(p_type, 'O')
""")
def filter_patterns(spark, directory):
    return dw.filter_columns_by_string_pattern(
        table(spark, directory, "part"), {"p_name": ["^a", "e$"], "p_type": "O"}
    )


@check("SELECT * FROM events WHERE event_type = 'purchase' AND value > 100")
def filter_both_conditions(spark, directory):
    return dw.filter_column_by_multiple_conditions(
        table(spark, directory, "events"), F.col("event_type") == "purchase", F.col("value") > 100
    )


@check("SELECT * FROM events WHERE event_type = 'purchase' OR value > 100")
def filter_any_condition(spark, directory):
    return dw.filter_columns_by_multiple_conditions(
        table(spark, directory, "events"), [F.col("event_type") == "purchase", F.col("value") > 100]
    )


@check("SELECT * FROM events WHERE value > 200")
def filter_custom(spark, directory):
    return dw.filter_column_by_custom_function(
        table(spark, directory, "events"), "value", lambda v: v > 200
    )


@check("SELECT * FROM events WHERE value > 200 OR value < 1")
def filter_customs(spark, directory):
    return dw.filter_columns_by_custom_function(
        table(spark, directory, "events"), {"value": [lambda v: v > 200, lambda v: v < 1]}
    )


# --- joins, aggregation, sort ----------------------------------------------------------------

@check("""
    SELECT o.o_orderkey AS orderkey, o.o_totalprice, l.l_linenumber, l.l_quantity
    FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""")
def join_inner(spark, directory):
    orders = table(spark, directory, "orders").select(
        F.col("o_orderkey").alias("orderkey"), "o_totalprice"
    )
    lines = table(spark, directory, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity"
    )
    return dw.join_tables(orders, lines, "orderkey")


@check("""
    SELECT * FROM events
    WHERE user_id IN (SELECT user_id FROM events GROUP BY user_id HAVING count(*) > 75)
""")
def join_semi(spark, directory):
    events = table(spark, directory, "events")
    busy = dw.threshold_based_rule(events, 75, "user_id")
    return events.join(busy, "user_id", "left_semi")


@check("""
    SELECT e.event_id, e.user_id, c.c_name, c.c_mktsegment
    FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
""")
def join_lookup(spark, directory):
    events = table(spark, directory, "events").select("event_id", "user_id")
    names = table(spark, directory, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment"
    )
    return events.join(names, "user_id", "left")


@check("""
    SELECT DISTINCT CAST(e.user_id AS VARCHAR) AS "user"
    FROM events e
    WHERE NOT EXISTS (
      SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id AND c.c_acctbal >= 0
    )
""")
def join_unknown_entities(spark, directory):
    """Entities missing from a directory (here: of the accounts that are not in the red)."""
    accounts = table(spark, directory, "customer").where("c_acctbal >= 0")
    known = users_of(accounts, "c_custkey")
    return users_of(table(spark, directory, "events"), "user_id").join(known, "user", "left_anti")


@check("SELECT user_id, min(ts) AS min_time, max(ts) AS max_time FROM events GROUP BY user_id")
def aggregate_by_user(spark, directory):
    return dw.aggregate_data(
        table(spark, directory, "events"), ["user_id"], ["ts", "ts"], [F.min, F.max],
        ["min_time", "max_time"],
    )


@check("""
    SELECT count(value) AS n, round(avg(value), 6) AS mean_value, max(ts) AS last_time FROM events
""")
def aggregate_all(spark, directory):
    whole = dw.aggregate_data(
        table(spark, directory, "events"), [], ["value", "value", "ts"],
        [F.count, F.avg, F.max], ["n", "mean_value", "last_time"],
    )
    return rounded(whole, "mean_value")


@check("""
    SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS n_errors,
           count(DISTINCT props) AS n_props
    FROM events GROUP BY user_id
""")
def aggregate_conditional(spark, directory):
    return dw.aggregate_data(
        table(spark, directory, "events"), ["user_id"], ["event_id", "event_type", "props"],
        [F.count, lambda kind: F.count_if(F.col(kind) == "error"), F.countDistinct],
        ["n", "n_errors", "n_props"],
    )


@check("""
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders ORDER BY o_orderpriority DESC
""")
def sort_one(spark, directory):
    orders = table(spark, directory, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return dw.sort_by_column(orders, "o_orderpriority", ascending=False)


@check("""
    SELECT user_id, event_type, ts FROM events ORDER BY user_id, event_type DESC, ts
""")
def sort_many(spark, directory):
    events = table(spark, directory, "events").select("user_id", "event_type", "ts")
    return dw.sort_by_columns(events, ["user_id", "event_type", "ts"], [True, False, True])


# --- rules ---------------------------------------------------------------------------------

@check("SELECT * FROM events WHERE event_type = 'error'")
def rule_pattern(spark, directory):
    return dw.pattern_based_rule(table(spark, directory, "events"), "event_type", "error")


@check("""
    SELECT user_id, count(*) AS sum_column_tmp FROM events GROUP BY user_id HAVING count(*) > 75
""")
def rule_threshold_count(spark, directory):
    return dw.threshold_based_rule(table(spark, directory, "events"), 75, "user_id")


@check("""
    SELECT o_custkey, round(sum(o_totalprice), 6) AS o_totalprice
    FROM orders GROUP BY o_custkey HAVING sum(o_totalprice) > 3000000
""")
def rule_threshold_sum(spark, directory):
    totals = dw.threshold_based_rule(
        table(spark, directory, "orders"), 3_000_000, "o_custkey", "o_totalprice"
    )
    return rounded(totals, "o_totalprice")


@check("SELECT * FROM lineitem WHERE l_quantity > 45")
def rule_threshold_ungrouped(spark, directory):
    return dw.threshold_based_rule(
        table(spark, directory, "lineitem"), 45, sum_column="l_quantity"
    )


@check("SELECT *, 1 AS sum_column_tmp FROM events")
def rule_threshold_rows(spark, directory):
    """Neither group nor sum: every row counts as one."""
    return dw.threshold_based_rule(table(spark, directory, "events"), 0)


@check("""
    SELECT user_id, event_type, count(*) AS count_column_tmp_total
    FROM events GROUP BY user_id, event_type HAVING count(*) > 18
""")
def rule_threshold_multi(spark, directory):
    return dw.threshold_based_rule_multiple_group_by(
        table(spark, directory, "events"), ["user_id", "event_type"], 18
    )


@check("""
    SELECT user_id, event_type, round(sum(value), 6) AS value_total
    FROM events GROUP BY user_id, event_type HAVING sum(value) > 1000
""")
def rule_threshold_multi_sum(spark, directory):
    totals = dw.threshold_based_rule_multiple_group_by(
        table(spark, directory, "events"), ["user_id", "event_type"], 1000, "value"
    )
    return rounded(totals, "value_total")


@check("""
    SELECT e.*, round(s.m, 6) AS "Mean", round(s.d, 6) AS stddev
    FROM events e CROSS JOIN (SELECT avg(value) AS m, stddev_samp(value) AS d FROM events) s
    WHERE abs(e.value - s.m) > 3 * s.d
""")
def rule_outlier_rows(spark, directory):
    found = dw.statistical_anomaly_detection(table(spark, directory, "events"), "value")
    return rounded(found, "Mean", "stddev")


@check("""
    WITH totals AS (
      SELECT user_id, count(user_id) AS no_events, sum(value) AS total FROM events GROUP BY user_id
    ), stats AS (SELECT avg(total) AS m, stddev_samp(total) AS d FROM totals)
    SELECT user_id, no_events, round(total, 6) AS value, round(m, 6) AS "Mean",
           round(d, 6) AS stddev
    FROM totals CROSS JOIN stats
    WHERE abs(total - m) > 2 * d AND no_events >= 10 AND total >= 1.2 * m
""")
def rule_outlier_groups(spark, directory):
    found = dw.statistical_anomaly_detection_group_by(
        table(spark, directory, "events"), "user_id", "value", no_minimum_window_events=10,
        current_window_is_multiple_of_mean=1.2, z_score_threshold=2.0,
    )
    return rounded(found, "value", "Mean", "stddev")


@check("""
    WITH totals AS (
      SELECT user_id, count(user_id) AS no_events FROM events GROUP BY user_id
    ), stats AS (SELECT avg(no_events) AS m, stddev_samp(no_events) AS d FROM totals)
    SELECT user_id, no_events, no_events AS sum_column_tmp, round(m, 6) AS "Mean",
           round(d, 6) AS stddev
    FROM totals CROSS JOIN stats
    WHERE abs(no_events - m) > 1.5 * d
""")
def rule_outlier_groups_count(spark, directory):
    found = dw.statistical_anomaly_detection_group_by(
        table(spark, directory, "events"), "user_id", current_window_is_multiple_of_mean=None,
        z_score_threshold=1.5,
    )
    return rounded(found, "Mean", "stddev")


@check("""
    WITH totals AS (
      SELECT user_id, ts, CAST(floor(epoch(ts)) AS BIGINT) AS second, sum(value) AS total
      FROM events GROUP BY user_id, ts
    ), averaged AS (
      SELECT *,
        avg(total) OVER (PARTITION BY user_id ORDER BY second
                         RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS hour_avg,
        avg(total) OVER (PARTITION BY user_id ORDER BY second
                         RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS day_avg
      FROM totals
    )
    SELECT user_id, min(ts) AS min_timestamp, max(ts) AS max_timestamp,
           round(arg_min(total, ts), 6) AS sum_count,
           round(arg_min(hour_avg, ts), 6) AS hour_avg,
           round(arg_min(day_avg, ts), 6) AS day_avg
    FROM averaged WHERE hour_avg > 3.0 * day_avg
    GROUP BY user_id
""")
def rule_trend(spark, directory):
    found = dw.trending_based_rule(
        table(spark, directory, "events"), "ts", "user_id", "value", ratio_threshold=3.0
    )
    return rounded(found, "sum_count", "hour_avg", "day_avg")


@check("""
    WITH averaged AS (
      SELECT o_custkey, o_orderdate, count(*) AS n,
        avg(count(*)) OVER (PARTITION BY o_custkey ORDER BY CAST(epoch(o_orderdate) AS BIGINT)
                            RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS hour_avg,
        avg(count(*)) OVER (PARTITION BY o_custkey ORDER BY CAST(epoch(o_orderdate) AS BIGINT)
                            RANGE BETWEEN 31536000 PRECEDING AND CURRENT ROW) AS day_avg
      FROM orders GROUP BY o_custkey, o_orderdate
    )
    SELECT o_custkey, min(o_orderdate) AS min_timestamp, max(o_orderdate) AS max_timestamp,
           arg_min(n, o_orderdate) AS sum_count, round(arg_min(hour_avg, o_orderdate), 6) AS hour_avg,
           round(arg_min(day_avg, o_orderdate), 6) AS day_avg
    FROM averaged WHERE hour_avg > 1.25 * day_avg
    GROUP BY o_custkey
""")
def rule_trend_count(spark, directory):
    """Weekly against yearly order counts, on the 1992-98 calendar."""
    found = dw.trending_based_rule(
        table(spark, directory, "orders"), "o_orderdate", "o_custkey",
        hour_range=-604_800, day_range=-31_536_000,
    )
    return rounded(found, "hour_avg", "day_avg")


def _window_sql(
    source: str, entity: str, ts: str, unit: str, as_of: str, z: float, least: int, multiple: float,
    volume: str = "count(*)",
) -> str:
    now = f"date_trunc('{unit}', TIMESTAMP '{as_of}')"
    return f"""
    WITH per_window AS (
      SELECT {entity}, date_trunc('{unit}', {ts}) AS bucket, {volume} AS n
      FROM {source} GROUP BY 1, 2
    ), split AS (
      SELECT {entity}, CASE WHEN bucket = {now} THEN n ELSE 0 END AS cur,
             CASE WHEN bucket < {now} THEN n ELSE 0 END AS past
      FROM per_window
    ), profile AS (
      SELECT {entity}, CAST(sum(cur) AS DOUBLE) AS cur, avg(past) AS m, stddev_samp(past) AS d,
             count(past) AS windows
      FROM split GROUP BY 1
    )
    SELECT {entity}, round(cur, 6) AS events_in_last_{unit},
           round(m, 6) AS events_before_last_{unit}_mean,
           round(d, 6) AS events_before_last_{unit}_std,
           windows AS no_{unit}_with_events, round((cur - m) / d, 6) AS z_score
    FROM profile
    WHERE d > 0 AND (cur - m) / d > {z} AND windows > {least} AND cur > {multiple} * m
    """


def _window_rounded(df: DataFrame, unit: str) -> DataFrame:
    current = f"events_in_last_{unit}"
    return rounded(
        df.withColumn(current, F.col(current).cast("double")),
        current, f"events_before_last_{unit}_mean", f"events_before_last_{unit}_std", "z_score",
    )


@check(_window_sql("events", "user_id", "ts", "day", "2024-01-30 12:00:00", 1.5, 3, 1.5))
def rule_own_history(spark, directory):
    found = dw.statistically_significant_window_by_std(
        table(spark, directory, "events"), "user_id", "ts", z_score_threshold=1.5,
        no_minimum_window_events=3, current_window_is_multiple_of_mean=1.5,
        as_of="2024-01-30 12:00:00",
    )
    return _window_rounded(found, "day")


@check(_window_sql("events", "user_id", "ts", "day", "2024-01-15 12:00:00", 2.0, 3, 1.5))
def rule_own_history_mid(spark, directory):
    """Half of the log lies after ``as_of``: later windows count as zero samples."""
    found = dw.statistically_significant_window_by_std(
        table(spark, directory, "events"), "user_id", "ts", z_score_threshold=2.0,
        no_minimum_window_events=3, current_window_is_multiple_of_mean=1.5,
        as_of="2024-01-15 12:00:00",
    )
    return _window_rounded(found, "day")


@check(_window_sql("events", "user_id", "ts", "week", "2024-01-15 12:00:00", 1.5, 0, 2.0))
def rule_own_history_week(spark, directory):
    found = dw.statistically_significant_window_by_std(
        table(spark, directory, "events"), "user_id", "ts", z_score_threshold=1.5, window="week",
        as_of="2024-01-15 12:00:00",
    )
    return _window_rounded(found, "week")


@check(_window_sql("events", "event_type", "ts", "hour", "2024-01-29 20:30:00", 1.0, 7, 1.2, "sum(value)"))
def rule_own_history_sum(spark, directory):
    """Value per hour and event type instead of a count of rows."""
    found = dw.statistically_significant_window_by_std(
        table(spark, directory, "events"), "event_type", "ts", z_score_threshold=1.0,
        count_column="value", window="hour", no_minimum_window_events=7,
        current_window_is_multiple_of_mean=1.2, as_of="2024-01-29 20:30:00",
    )
    return _window_rounded(found, "hour")


@check(_window_sql("events", "user_id", "ts", "day", "2024-01-30 12:00:00", 1.5, 3, 1.5))
def rule_own_history_from_totals(spark, directory):
    """The same rule over daily totals instead of the log."""
    totals = window_totals(table(spark, directory, "events"), "user_id", "ts")
    found = surges_in_totals(
        totals, "user_id", "ts", z_score_threshold=1.5, no_minimum_window_events=3,
        current_window_is_multiple_of_mean=1.5, as_of="2024-01-30 12:00:00",
    )
    return _window_rounded(found, "day")


@check(_window_sql("(SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-20') e",
                   "user_id", "ts", "day", "2024-01-30 12:00:00", 1.5, 3, 1.5))
def rule_own_history_lookback(spark, directory):
    """The history reaches back ten days; the bound is pushed to the scan."""
    found = dw.statistically_significant_window_by_std(
        table(spark, directory, "events"), "user_id", "ts", z_score_threshold=1.5,
        no_minimum_window_events=3, current_window_is_multiple_of_mean=1.5,
        as_of="2024-01-30 12:00:00", lookback=timedelta(days=10),
    )
    return _window_rounded(found, "day")
