"""The ready-made detections, with events standing in for their logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.operator_queries import _window_rounded, _window_sql, rounded, table
from duskwatch.plans import use_cases

QUERIES = {}
ORACLES: dict[str, str] = {}

AS_OF = "2024-01-31 00:00:00"
LAST_DAY = "ts >= TIMESTAMP '2024-01-30 00:00:00'"


def check(sql: str):
    def register(query):
        QUERIES[query.__name__] = query
        ORACLES[query.__name__] = sql
        return query

    return register


_CATEGORY = """
    CASE WHEN event_type = 'error' THEN 'Malware' WHEN event_type = 'click' THEN 'Trojan'
         ELSE 'Business' END
"""


@check(f"""
    SELECT ts AS date, props AS ip_address, {_CATEGORY} AS url_category
    FROM events WHERE {LAST_DAY} AND event_type IN ('error', 'click')
""")
def usecase_malicious_requests(spark, directory):
    proxy = table(spark, directory, "events").selectExpr(
        "ts AS date", "props AS ip_address", f"{_CATEGORY} AS url_category"
    )
    return use_cases.malicious_requests(proxy, AS_OF)


@check(f"""
    SELECT event_type AS ip, count(*) AS sum_column_tmp FROM events WHERE {LAST_DAY}
    GROUP BY event_type HAVING count(*) > 60
""")
def usecase_busy_addresses(spark, directory):
    web = table(spark, directory, "events").selectExpr("ts AS timestamp", "event_type AS ip")
    return use_cases.busy_addresses(web, AS_OF, threshold=60)


@check(f"""
    WITH totals AS (
      SELECT user_id AS login_id, count(*) AS n FROM events
      WHERE {LAST_DAY} AND event_type IN ('error', 'signup') GROUP BY user_id
    ), stats AS (SELECT avg(n) AS m, stddev_samp(n) AS d FROM totals)
    SELECT login_id, n AS no_events, n AS sum_column_tmp, round(m, 6) AS "Mean", round(d, 6) AS stddev
    FROM totals CROSS JOIN stats WHERE abs(n - m) > 3 * d AND n >= 2 * m
""")
def usecase_anomalous_failed_logins(spark, directory):
    logins = table(spark, directory, "events").selectExpr(
        "user_id AS login_id", "ts AS _event_date",
        """CASE event_type WHEN 'error' THEN 'DENIED' WHEN 'signup' THEN 'BLOCKED'
                ELSE 'SUCCESS' END AS outcome""",
    )
    return rounded(use_cases.anomalous_failed_logins(logins, AS_OF), "Mean", "stddev")


_READS = "(SELECT user_id, ts AS date FROM events) AS reads"


@check(_window_sql(_READS, "user_id", "date", "day", "2024-01-22 20:00:00", 3.0, 7, 3.0))
def usecase_unusual_document_access(spark, directory):
    reads = table(spark, directory, "events").selectExpr("user_id", "ts AS date")
    found = use_cases.unusual_document_access(reads, "2024-01-22 20:00:00")
    return _window_rounded(found, "day")


_MAIL = """(SELECT concat('u', user_id, '@example.com') AS sender, ts AS date FROM events
            WHERE event_type IN ('purchase', 'view')) AS mail"""


@check(_window_sql(_MAIL, "sender", "date", "day", "2024-01-22 20:00:00", 3.0, 7, 3.0))
def usecase_unusual_mail_volume(spark, directory):
    mail = (
        table(spark, directory, "events")
        .where(F.col("event_type").isin("purchase", "view"))
        .selectExpr("concat('u', user_id, '@example.com') AS sender", "ts AS date")
    )
    return _window_rounded(use_cases.unusual_mail_volume(mail, "2024-01-22 20:00:00"), "day")
