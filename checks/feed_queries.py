"""Queries of the operators that take values as tables, number rows or keep state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

import duskwatch as dw
from checks.operator_queries import Query, table
from duskwatch.operators import moments
from duskwatch.operators.feeds import filter_column_by_pattern_table, filter_column_by_range_table
from duskwatch.operators.handoff import append_once
from duskwatch.operators.numbering import with_dense_ids
from duskwatch.operators.relational import with_constant
from duskwatch.sources.staging import shared_folder
from duskwatch.sources.tables import append, overwrite, read_path

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str):
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        ORACLES[query.__name__] = sql
        return query

    return register


@check("SELECT event_id, 1 AS unit FROM events")
def constant_column(spark, directory):
    events = table(spark, directory, "events").select("event_id")
    return with_constant(events, "unit", 1, "int")


@check("""
    SELECT event_id, tied, 5020 + row_number() OVER (ORDER BY tied NULLS FIRST, event_id) AS id
    FROM (SELECT event_id, CASE WHEN user_id % 3 > 0 THEN user_id ELSE 0 END AS tied FROM events)
""")
def dense_ids(spark, directory):
    """Consecutive ids in sort order, a third of the rows having one value of the first key."""
    tied = F.when(F.col("user_id") % 3 > 0, F.col("user_id")).otherwise(F.lit(0)).cast("long")
    events = table(spark, directory, "events").select("event_id", tied.alias("tied"))
    return with_dense_ids(events, "id", "tied", "event_id", start=5021)


_RANGES = """
    SELECT low, low + INTERVAL 1 SECOND * (17 + (o_orderkey * 7919) % 400) AS high FROM (
        SELECT o_orderkey, TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * ((o_orderkey * 104729) % 2592000) AS low
        FROM orders
    )
"""


@check(f"""
    SELECT * FROM events e WHERE EXISTS (
        SELECT 1 FROM ({_RANGES}) r WHERE e.ts BETWEEN r.low AND r.high)
""")
def filter_range_table(spark, directory):
    """Events within some of as many ranges as there are orders, most of which overlap."""
    key = F.col("o_orderkey").cast("long")
    second = F.expr("INTERVAL '1' SECOND")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    low = start + second * ((key * 104729) % 2592000)
    ranges = table(spark, directory, "orders").select(low.alias("low"), key.alias("key"))
    ranges = ranges.select("low", (F.col("low") + second * (17 + (F.col("key") * 7919) % 400)).alias("high"))
    return filter_column_by_range_table(table(spark, directory, "events"), "ts", ranges)


# Each customer of a segment is looked for by the end of their number, some patterns being free
# of any text, and a few being found in nothing
_PATTERNS = """
    SELECT CASE WHEN c_custkey % 50 = 0 THEN '^[0-9]+' || c_custkey || '$'
                WHEN c_custkey % 3 = 0 THEN 'Clerk#0+' || c_custkey || '$'
                WHEN c_custkey % 3 = 1 THEN '(Clerk|Agent)#[0-9]*' || (1000 + c_custkey) || '$'
                ELSE 'k#0000' || c_custkey || '$' END AS pattern
    FROM customer
"""


@check(f"""
    SELECT o_orderkey, value FROM (
        SELECT o_orderkey, 'Clerk#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS value FROM orders
    ) o WHERE EXISTS (SELECT 1 FROM ({_PATTERNS}) p WHERE regexp_matches(o.value, p.pattern))
""")
def filter_pattern_table(spark, directory):
    """Orders whose clerk some of as many patterns as there are customers is found in."""
    key = F.col("c_custkey")
    pattern = (
        F.when(key % 50 == 0, F.concat(F.lit("^[0-9]+"), key, F.lit("$")))
        .when(key % 3 == 0, F.concat(F.lit("Clerk#0+"), key, F.lit("$")))
        .when(key % 3 == 1, F.concat(F.lit("(Clerk|Agent)#[0-9]*"), key + 1000, F.lit("$")))
        .otherwise(F.concat(F.lit("k#0000"), key, F.lit("$")))
    )
    feed = table(spark, directory, "customer").select(pattern.alias("pattern"))
    clerk = F.concat(F.lit("Clerk#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    orders = table(spark, directory, "orders").select("o_orderkey", clerk.alias("value"))
    return filter_column_by_pattern_table(orders, "value", feed)


@check("""
    SELECT event_id, round(value + 1e9, 6) AS value, round(m, 4) AS mean, round(s, 4) AS stddev
    FROM (SELECT event_id, value, avg(value) OVER () + 1e9 AS m, stddev_samp(value) OVER () AS s FROM events)
    WHERE abs(value + 1e9 - m) > 2.5 * s
""")
def rule_outlier_states(spark, directory):
    """Outlier rows by statistics merged from stored states of days, far away from zero."""
    events = table(spark, directory, "events").select("event_id", "ts", (F.col("value") + 1e9).alias("value"))
    day = F.to_date("ts")
    path = f"{shared_folder(spark)}/moments-{uuid.uuid4().hex}"
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    overwrite(moments.moment_states(events.where(early), "value", [day.alias("day")], 1e9), path)
    append(moments.moment_states(events.where(~early), "value", [day.alias("day")], 1e9), path)
    found = moments.outliers_in_states(events, "value", read_path(spark, path), 2.5)
    return found.select(
        "event_id", F.round("value", 6).alias("value"),
        F.round("Mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"),
    )


@check("""
    SELECT user_id, CAST(day AS VARCHAR) AS day, count(*) AS errors FROM (
        SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'error'
    ) GROUP BY user_id, day HAVING count(*) > 1
""")
def handoff_once(spark, directory):
    """Busy users of each day, handed off twice with other ids and an extra day the second time."""
    errors = dw.filter_column_by_value(table(spark, directory, "events"), "event_type", "error")
    daily = dw.threshold_based_rule_multiple_group_by(
        errors.select("user_id", F.to_date("ts").alias("day")), threshold=1, groupby_columns=["user_id", "day"]
    ).withColumnRenamed("count_column_tmp_total", "errors")
    path = f"{shared_folder(spark)}/handoff-{uuid.uuid4().hex}"
    for number, rows in enumerate((daily.where("day < '2024-01-20'"), daily, daily)):
        append_once(with_constant(rows, "run", number), path, day_column="day", ignoring=["run"])
    return read_path(spark, path).select("user_id", F.col("day").cast("date").cast("string").alias("day"), "errors")


@check("""
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS o_orderpriority
    FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderstatus = 'O'
""")
def overwrite_merged_schema(spark, directory):
    """A table replaced with schema merging, then added to under other columns."""
    orders = table(spark, directory, "orders")
    path = f"{shared_folder(spark)}/merging-{uuid.uuid4().hex}"
    overwrite(orders.select("o_orderkey"), path)
    first = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")
    overwrite(first, path, merge_schema=True)
    append(orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_orderpriority"), path)
    return read_path(spark, path, merge_schema=True).select("o_orderkey", "o_orderstatus", "o_orderpriority")
