"""Queries of the operators that keep tables up to date, lay them out or follow them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.operator_queries import Query, _window_rounded, _window_sql, table
from duskwatch.operators.strongest import strongest_per_entity
from duskwatch.plans.history import merged_totals, surges_in_totals, window_totals
from duskwatch.sources.clustered import overwrite_clustered
from duskwatch.sources.portions import compact, read_portions, remove_covered, write_portion
from duskwatch.sources.staging import shared_folder
from duskwatch.sources.tables import append, overwrite, read_path
from duskwatch.sources.versions import read_versions
from duskwatch.streaming.tables import follow_path
from duskwatch.streaming.windows import (
    follow_closed_windows,
    follow_history,
    threshold_in_windows,
    windowed_totals,
)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str):
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        ORACLES[query.__name__] = sql
        return query

    return register


def fresh(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@check("""
    SELECT event_id, who, value, rank FROM (
        SELECT event_id, who, value, row_number() OVER (
            PARTITION BY who ORDER BY value DESC NULLS LAST, event_id DESC) AS rank
        FROM (SELECT event_id, value, CASE WHEN user_id % 3 > 0 THEN user_id ELSE 0 END AS who FROM events)
    ) WHERE rank <= 5
""")
def strongest_each(spark, directory):
    """The five greatest events of each user, a third of all events being one user's."""
    who = F.when(F.col("user_id") % 3 > 0, F.col("user_id")).otherwise(F.lit(0)).cast("long")
    events = table(spark, directory, "events").select("event_id", who.alias("who"), "value")
    return strongest_per_entity(events, "who", ["value", "event_id"], 5)


@check("""
    SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS price,
           CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day, CAST(NULL AS VARCHAR) AS status
    FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, o_totalprice, o_orderdate, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT o_orderkey, NULL, NULL, o_orderstatus FROM orders WHERE o_orderstatus = 'P'
""")
def versions_merged(spark, directory):
    """Three writes of one table under widening types and other columns, read as one."""
    orders = table(spark, directory, "orders")
    path = fresh(spark, "versions")
    old, new, short = (orders.where(F.col("o_orderstatus") == s) for s in "FOP")
    early = ["CAST(o_orderkey AS INT) AS id", "CAST(o_totalprice AS FLOAT) AS price", "CAST(o_orderdate AS DATE) AS day"]
    overwrite(old.selectExpr(*early), path, merge_schema=True)
    wide = ["CAST(o_orderkey AS BIGINT) AS id", "CAST(o_totalprice AS DOUBLE) AS price"]
    append(new.selectExpr(*wide, "CAST(o_orderdate AS TIMESTAMP_NTZ) AS day", "o_orderstatus AS status"), path)
    append(short.selectExpr("CAST(o_orderkey AS BIGINT) AS id", "o_orderstatus AS status"), path)
    return read_versions(spark, path)


@check("""
    SELECT event_id, user_id, ts, event_type, value FROM events
    WHERE user_id BETWEEN 20 AND 29 AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'
""")
def clustered_scan(spark, directory):
    """A range of users and of times from events laid out by both."""
    path = fresh(spark, "clustered")
    events = table(spark, directory, "events").select("event_id", "user_id", "ts", "event_type", "value")
    overwrite_clustered(events, path, ["user_id", "ts"])
    return read_path(spark, path).where(
        "user_id BETWEEN 20 AND 29 AND ts >= TIMESTAMP_NTZ'2024-01-10' AND ts < TIMESTAMP_NTZ'2024-01-20'"
    )


def _as_log(spark, events) -> str:
    path = fresh(spark, "log")
    overwrite(events, path)
    return path


@check("""
    SELECT event_type, date_trunc('hour', ts) AS window_start, count(*) AS rows, round(sum(value), 6) AS volume
    FROM events GROUP BY 1, 2
    HAVING sum(value) > 40
       AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR
""")
def stream_threshold_windows(spark, directory):
    """Event types whose value in an hour is high, followed as a stream; open hours are not given."""
    events = table(spark, directory, "events").select("event_type", "ts", "value")
    log = _as_log(spark, events)
    totals = windowed_totals(
        follow_path(spark, log, events.schema), "ts", ["event_type"], "1 hour", "2 hours", "value"
    )
    path = fresh(spark, "closed")
    follow_closed_windows(totals, path, fresh(spark, "marks")).awaitTermination()
    busy = threshold_in_windows(read_portions(spark, path), 40)
    return busy.select("event_type", "window_start", "rows", F.round("volume", 6).alias("volume"))


@check(_window_sql("events", "user_id", "ts", "day", "2024-01-30 12:00:00", 1.5, 3, 1.5))
def history_portions(spark, directory):
    """The own-history rule over totals followed in three batches, one repeated, then compacted."""
    events = table(spark, directory, "events").select("user_id", "ts", "event_id")
    log, path, marks = _as_log(spark, events.limit(0)), fresh(spark, "history"), fresh(spark, "marks")
    for number in range(3):
        new = events.where(F.col("event_id") % 3 == number)
        append(new, log)
        stream = follow_path(spark, log, events.schema)
        follow_history(stream, path, marks, "user_id", "ts").awaitTermination()
    write_portion(window_totals(new, "user_id", "ts"), path, 2)
    compact(spark, path, merged_totals)
    remove_covered(spark, path)
    found = surges_in_totals(
        read_portions(spark, path), "user_id", "ts", z_score_threshold=1.5, no_minimum_window_events=3,
        current_window_is_multiple_of_mean=1.5, as_of="2024-01-30 12:00:00",
    )
    return _window_rounded(found, "day")
