"""Investigation and hand-off over logs derived from the shared tables.

Every log below is a projection of all rows of one kind of event: clicks are document reads,
purchases are sent mail and data-loss events, signups are logins, errors are antivirus events
and views are proxy requests.  A ``props`` value plays host and address, so hosts are shared
by many users and users have several.  Customers are staff, directory and identities.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

import duskwatch as dw
from checks.operator_queries import table
from duskwatch.operators import evidence, handoff
from duskwatch.operators.evidence import Tiers
from duskwatch.operators.rules import statistically_significant_window_by_std
from duskwatch.plans import response_chain
from duskwatch.plans.response_chain import SecurityTables, investigate
from duskwatch.sources.staging import stage

QUERIES = {}
ORACLES: dict[str, str] = {}

AS_OF = "2024-01-31 00:00:00"
BUSY = 59

# Tiers scaled to the volume of the shared tables.
DLP_TIERS: Tiers = (
    ("High", "dlp_high > 0 OR dlp_medium > 2 OR dlp_low > 5"),
    ("Medium", "dlp_medium > 1 OR dlp_low > 3"),
)
URL_TIERS: Tiers = (
    ("High", "url_hits > 12 AND url_domains > 1"),
    ("Medium", "(url_hits > 8 AND url_domains > 1) OR url_domains = 1"),
    ("Low", "TRUE"),
)

_LOGS = {
    "sharepoint": ("click", ["ts AS date", "user_id", "event_type AS action",
                             "props AS document_name"]),
    "email": ("purchase", ["ts AS date", "concat('u', user_id, '@example.com') AS sender"]),
    "user_logins": ("signup", ["ts AS date", "user_id", "props AS dest_hostname",
                               "props AS src_ip"]),
    "antivirus": ("error", [
        "ts AS time", "props AS hostname",
        """CASE WHEN value < 10 THEN 'MALWAREPROTECTION_MALWARE_DETECTED'
                WHEN value < 30 THEN 'MALWAREPROTECTION_MALWARE_ACTION_TAKEN'
                WHEN value > 220 THEN 'MALWAREPROTECTION_MALWARE_ACTION_FAILED'
                ELSE 'MALWAREPROTECTION_SCAN_STARTED' END AS event_type""",
    ]),
    "dlp": ("purchase", [
        "ts AS timestamp", "user_id AS `user`",
        "CASE WHEN value >= 100 THEN 'High' WHEN value >= 40 THEN 'Medium' ELSE 'Low' END AS risk",
        "CASE WHEN value >= 90 AND value < 200 THEN 'Blocked' ELSE 'Allowed' END AS action",
    ]),
    "url_filtering": ("view", [
        "ts AS date", "props AS ip_address",
        "CASE WHEN value >= 5 THEN user_id END AS domain",
        "CASE WHEN value < 45 THEN 'Malware' ELSE 'Business' END AS url_category",
    ]),
}


def _log(events: DataFrame, name: str) -> DataFrame:
    kind, columns = _LOGS[name]
    of_kind = events.where(F.col("event_type") == kind)
    return of_kind.withColumn("user_id", F.col("user_id").cast("string")).selectExpr(*columns)


def _log_sql(name: str) -> str:
    kind, columns = _LOGS[name]
    text = ", ".join(columns).replace("`", '"').replace("timestamp,", '"timestamp",')
    return (
        f"SELECT {text} FROM (SELECT * REPLACE (CAST(user_id AS VARCHAR) AS user_id) FROM events) e"
        f" WHERE event_type = '{kind}'"
    )


def _tables(spark: SparkSession, directory: str) -> SecurityTables:
    events, customers = table(spark, directory, "events"), table(spark, directory, "customer")
    solvent = customers.where("c_acctbal >= 0")
    return SecurityTables(
        **{name: _log(events, name) for name in _LOGS},
        workday=customers.selectExpr(
            "CAST(c_custkey AS STRING) AS employee", "c_mktsegment AS department", "c_name AS title"
        ),
        users=solvent.selectExpr("CAST(c_custkey AS STRING) AS Username", "c_name AS ID"),
        identity=solvent.selectExpr(
            "CAST(c_custkey AS STRING) AS user", "concat('u', c_custkey, '@example.com') AS email"
        ),
    )


def _flagged(spark: SparkSession, directory: str) -> DataFrame:
    busy = dw.threshold_based_rule(table(spark, directory, "events"), BUSY, "user_id")
    return stage(evidence.users_of(busy, "user_id"), "flagged")


def _footprint(tables: SecurityTables, flagged: DataFrame) -> DataFrame:
    return stage(evidence.entity_footprint(tables.user_logins, flagged, AS_OF), "footprint")


# Users without hosts have no antivirus counts.  The queries show zeros there: a nullable count
# changes type on its way into some data frames, and the message tells the cases apart.
_COUNTS = ["av_events", "av_detected", "av_cleaned", "av_failed"]
_COUNTS_SQL = ", ".join(f"coalesce({c}, 0) AS {c}" for c in _COUNTS)

_SCALED = (
    "WHEN dlp_high > 0 OR dlp_medium > 2 OR dlp_low > 5 THEN 'High'"
    " WHEN dlp_medium > 1 OR dlp_low > 3 THEN 'Medium'",
    "WHEN url_hits > 12 AND url_domains > 1 THEN 'High'"
    " WHEN (url_hits > 8 AND url_domains > 1) OR url_domains = 1 THEN 'Medium' ELSE 'Low'",
)
_SHIPPED = (
    "WHEN dlp_high > 0 OR dlp_medium > 10 OR dlp_low > 100 THEN 'High'"
    " WHEN dlp_medium > 5 OR dlp_low > 50 THEN 'Medium'",
    "WHEN url_hits > 100 AND url_domains > 1 THEN 'High'"
    " WHEN (url_hits > 50 AND url_domains > 1) OR url_domains = 1 THEN 'Medium' ELSE 'Low'",
)


def _investigation_sql(flagged: str, since: str, tiers: tuple[str, str]) -> str:
    """Findings about the users of ``flagged``, the last of the tables that ``flagged`` defines."""
    return f"""
    WITH {flagged}, user_logins AS ({_log_sql("user_logins")}), antivirus AS ({_log_sql("antivirus")}),
    dlp AS ({_log_sql("dlp")}), url_filtering AS ({_log_sql("url_filtering")}),
    footprint AS (
      SELECT DISTINCT user_id AS "user", dest_hostname, src_ip FROM user_logins
      WHERE date >= TIMESTAMP '{since}' AND user_id IN (SELECT "user" FROM flagged)
    ), hosts AS (SELECT DISTINCT "user", dest_hostname FROM footprint),
    addresses AS (SELECT DISTINCT "user", src_ip FROM footprint),
    av_counts AS (
      SELECT h."user", count(a.time) AS av_events,
        count(*) FILTER (WHERE event_type = 'MALWAREPROTECTION_MALWARE_DETECTED') AS av_detected,
        count(*) FILTER (WHERE event_type = 'MALWAREPROTECTION_MALWARE_ACTION_TAKEN') AS av_cleaned,
        count(*) FILTER (WHERE event_type = 'MALWAREPROTECTION_MALWARE_ACTION_FAILED') AS av_failed
      FROM hosts h LEFT JOIN antivirus a
        ON a.hostname = h.dest_hostname AND a.time >= TIMESTAMP '{since}'
      GROUP BY h."user"
    ), av AS (
      SELECT f."user", av_events, av_detected, av_cleaned, av_failed,
        CASE WHEN av_detected > 0 THEN
          CASE WHEN av_detected > 5 OR av_failed > 0 OR av_detected > av_cleaned THEN 'High'
               WHEN av_detected > 3 THEN 'Medium' ELSE 'Low' END END AS av_risk,
        CASE WHEN av_events IS NULL THEN 'no host known for this user'
             WHEN av_events = 0 THEN 'no antivirus activity on the user''s hosts'
             WHEN av_detected = 0 THEN 'antivirus activity without detections'
             ELSE concat(av_detected, ' detections, ', av_cleaned, ' cleaned, ', av_failed,
                         ' not cleaned') END AS av_message
      FROM flagged f LEFT JOIN av_counts c ON f."user" = c."user"
    ), dlp_counts AS (
      SELECT f."user", count(*) FILTER (WHERE risk = 'High') AS dlp_high,
        count(*) FILTER (WHERE risk = 'Medium') AS dlp_medium,
        count(*) FILTER (WHERE risk = 'Low') AS dlp_low
      FROM flagged f LEFT JOIN dlp d
        ON f."user" = d."user" AND d.action = 'Allowed' AND d."timestamp" >= TIMESTAMP '{since}'
      GROUP BY f."user"
    ), dlp_rated AS (
      SELECT *, CASE {tiers[0]} END AS dlp_risk,
        concat('let through: ', dlp_high, ' high, ', dlp_medium, ' medium, ', dlp_low, ' low')
          AS dlp_message
      FROM dlp_counts
    ), url_counts AS (
      SELECT f."user", count(u.ip_address) AS url_hits, count(DISTINCT u.domain)
          + max(CASE WHEN u.ip_address IS NOT NULL AND u.domain IS NULL THEN 1 ELSE 0 END) AS url_domains
      FROM flagged f LEFT JOIN addresses a ON f."user" = a."user"
      LEFT JOIN url_filtering u ON u.ip_address = a.src_ip AND u.url_category = 'Malware'
        AND u.date >= TIMESTAMP '{since}'
      GROUP BY f."user"
    ), url AS (
      SELECT *, CASE {tiers[1]} END AS url_risk,
        concat(url_hits, ' malware requests to ', url_domains, ' domains') AS url_message
      FROM url_counts
    ), profile AS (
      SELECT f."user", c.c_mktsegment AS department, c.c_name AS title
      FROM flagged f LEFT JOIN customer c ON f."user" = CAST(c.c_custkey AS VARCHAR)
    ), counted AS (
      SELECT p.*, av.* EXCLUDE ("user"), d.* EXCLUDE ("user"), url.* EXCLUDE ("user"),
        (CASE WHEN av_risk = 'High' THEN 1 ELSE 0 END)
        + (CASE WHEN dlp_risk = 'High' THEN 1 ELSE 0 END)
        + (CASE WHEN url_risk = 'High' THEN 1 ELSE 0 END) AS high_count
      FROM profile p JOIN av ON p."user" = av."user" JOIN dlp_rated d ON p."user" = d."user"
      JOIN url ON p."user" = url."user"
    ), findings AS (
      SELECT *, CASE WHEN high_count >= 2 THEN 'high' WHEN high_count = 1 THEN 'medium'
                     ELSE 'low' END AS severity,
        CASE WHEN high_count >= 2 THEN 'disable the account and quarantine its hosts'
             WHEN high_count = 1 THEN 'have an analyst contact the user'
             ELSE 'keep under observation' END AS recommendation
      FROM counted
    )
"""


_COMMON = _investigation_sql(
    f"""flagged AS (
      SELECT CAST(user_id AS VARCHAR) AS "user" FROM events GROUP BY user_id HAVING count(*) > {BUSY}
    )""",
    "2024-01-24", _SCALED,
)


def check(sql: str):
    def register(query):
        QUERIES[query.__name__] = query
        ORACLES[query.__name__] = sql
        return query

    return register


# --- evidence ------------------------------------------------------------------------------

@check(_COMMON + "SELECT * FROM footprint")
def evidence_footprint(spark, directory):
    logins = _tables(spark, directory).user_logins
    return evidence.entity_footprint(logins, _flagged(spark, directory), AS_OF)


@check(_COMMON + "SELECT * FROM profile")
def evidence_profile(spark, directory):
    return evidence.entity_profile(_flagged(spark, directory), _tables(spark, directory).workday)


@check(_COMMON + f"SELECT * REPLACE ({_COUNTS_SQL}) FROM av")
def evidence_antivirus(spark, directory):
    tables, flagged = _tables(spark, directory), _flagged(spark, directory)
    rated = evidence.antivirus_risk(flagged, _footprint(tables, flagged), tables.antivirus, AS_OF)
    return rated.fillna(0, _COUNTS)


@check(_COMMON + f"""
    SELECT * REPLACE (CASE WHEN av_detected > 0 THEN 'High' END AS av_risk, {_COUNTS_SQL}) FROM av
""")
def evidence_antivirus_as_written(spark, directory):
    tables, flagged = _tables(spark, directory), _flagged(spark, directory)
    return evidence.antivirus_risk(
        flagged, _footprint(tables, flagged), tables.antivirus, AS_OF, evidence.AV_TIERS_AS_WRITTEN
    ).fillna(0, _COUNTS)


@check(_COMMON + "SELECT * FROM dlp_rated")
def evidence_dlp(spark, directory):
    flagged = _flagged(spark, directory)
    return evidence.dlp_risk(flagged, _tables(spark, directory).dlp, AS_OF, DLP_TIERS)


@check(_COMMON + "SELECT * FROM url")
def evidence_url(spark, directory):
    tables, flagged = _tables(spark, directory), _flagged(spark, directory)
    return evidence.url_risk(
        flagged, _footprint(tables, flagged), tables.url_filtering, AS_OF, URL_TIERS
    )


# --- verdict -------------------------------------------------------------------------------

def _findings(spark: SparkSession, directory: str) -> DataFrame:
    tables, flagged = _tables(spark, directory), _flagged(spark, directory)
    return investigate(
        flagged, _footprint(tables, flagged), tables, AS_OF, dlp_tiers=DLP_TIERS, url_tiers=URL_TIERS
    )


@check(_COMMON + f"SELECT * REPLACE ({_COUNTS_SQL}) FROM findings")
def verdict_findings(spark, directory):
    return _findings(spark, directory).fillna(0, _COUNTS)


@check(_COMMON + """
    SELECT severity, count(*) AS users, CAST(coalesce(sum(av_detected), 0) AS BIGINT) AS detections
    FROM findings GROUP BY severity
""")
def verdict_severity_counts(spark, directory):
    return _findings(spark, directory).groupBy("severity").agg(
        F.count(F.lit(1)).alias("users"),
        F.coalesce(F.sum("av_detected"), F.lit(0)).alias("detections"),
    )


_ENTRIES = [
    "department", "title", "av_events", "av_detected", "av_cleaned", "av_failed", "av_risk",
    "av_message", "dlp_high", "dlp_medium", "dlp_low", "dlp_risk", "dlp_message", "url_hits",
    "url_domains", "url_risk", "url_message", "high_count", "severity", "recommendation",
]
_ENTRIES_SQL = ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'none') AS {c}" for c in _ENTRIES)


@check(_COMMON + f"""
    SELECT TIMESTAMP '2024-01-31' AS date, 'Suspicious user' AS investigation_name,
           'complete' AS status, concat(severity, ': ', recommendation) AS status_message,
           "user" AS entity, 'username' AS entity_type, {_ENTRIES_SQL}
    FROM findings
""")
def verdict_investigation_rows(spark, directory):
    rows = handoff.investigation_rows(_findings(spark, directory), AS_OF)
    entries = [F.coalesce(F.col("data")[c], F.lit("none")).alias(c) for c in _ENTRIES]
    return rows.select(
        F.col("date").cast("timestamp_ntz").alias("date"), "investigation_name", "status",
        "status_message", *[F.col("data")[c].alias(c) for c in ("entity", "entity_type")], *entries,
    )


# --- hand-off ------------------------------------------------------------------------------

# The shared log is even, so the rules look for milder surges than they do by default.
_SURGE = {
    "z_score_threshold": 1.5, "no_minimum_window_events": 3,
    "current_window_is_multiple_of_mean": 1.5,
}
_SURGE_DAY = "2024-01-30 12:00:00"


def _surge_sql(source: str, entity: str) -> str:
    return f"""
      SELECT {entity} AS entity, (cur - m) / d AS score, cur, m, d, days FROM (
        SELECT {entity}, CAST(sum(CASE WHEN day = DATE '2024-01-30' THEN n ELSE 0 END) AS BIGINT) AS cur,
               avg(CASE WHEN day < DATE '2024-01-30' THEN n ELSE 0 END) AS m,
               stddev_samp(CASE WHEN day < DATE '2024-01-30' THEN n ELSE 0 END) AS d,
               count(*) AS days
        FROM (SELECT {entity}, CAST(date AS DATE) AS day, count(*) AS n FROM {source} GROUP BY 1, 2) x
        GROUP BY 1) y
      WHERE d > 0 AND (cur - m) / d > 1.5 AND days > 3 AND cur > 1.5 * m
    """


def _alerts_sql(manual: str = "") -> str:
    return f"""
    sharepoint AS ({_log_sql("sharepoint")}), email AS ({_log_sql("email")}),
    identity AS (
      SELECT CAST(c_custkey AS VARCHAR) AS "user", concat('u', c_custkey, '@example.com') AS email,
             c_name AS directory_id
      FROM customer WHERE c_acctbal >= 0
    ), found AS (
      SELECT 'Unusual document access' AS rule_name, entity, 'user' AS entity_type, score, cur, m, d, days
      FROM ({_surge_sql("sharepoint", "user_id")}) a
      UNION ALL
      SELECT 'Unusual mail volume', entity, 'email', score, cur, m, d, days
      FROM ({_surge_sql("email", "sender")}) b
      {manual}
    ), detections AS (
      SELECT f.*, coalesce(i."user", f.entity) AS "user",
             f.entity_type = 'user' OR i."user" IS NOT NULL AS resolved
      FROM found f LEFT JOIN identity i ON f.entity_type = 'email' AND f.entity = i.email
    ), flagged AS (
      SELECT "user", string_agg(DISTINCT rule_name, ', ' ORDER BY rule_name) AS trigger_event,
             bool_or(resolved) AS resolved
      FROM detections GROUP BY "user"
    )
"""


_ALERTS = f"WITH {_alerts_sql()} "


def _detections(spark: SparkSession, directory: str) -> DataFrame:
    tables = _tables(spark, directory)
    surge = partial(
        statistically_significant_window_by_std, timestamp_column="date", as_of=_SURGE_DAY, **_SURGE
    )
    found = handoff.all_detections(
        handoff.as_detections(
            surge(tables.sharepoint, "user_id"), "Unusual document access", "user_id",
            score_column="z_score",
        ),
        handoff.as_detections(
            surge(tables.email, "sender"), "Unusual mail volume", "sender", "email", "z_score"
        ),
    )
    return handoff.resolve_users(found, tables.identity)


@check(_ALERTS + """
    SELECT rule_name, entity, entity_type, round(score, 6) AS score, "user", resolved,
           CAST(cur AS VARCHAR) AS surge
    FROM detections
""")
def handoff_detections(spark, directory):
    return _detections(spark, directory).select(
        "rule_name", "entity", "entity_type", F.round("score", 6).alias("score"), "user",
        "resolved", F.col("details")["events_in_last_day"].alias("surge"),
    )


@check(_ALERTS + """
    SELECT rule_name, entity, round(score, 6) AS score, "user" FROM detections
    ORDER BY score DESC, entity, rule_name LIMIT 3
""")
def handoff_strongest(spark, directory):
    top = handoff.strongest(_detections(spark, directory), 3)
    return top.select("rule_name", "entity", F.round("score", 6).alias("score"), "user")


@check(_ALERTS + "SELECT * FROM flagged")
def handoff_flagged_users(spark, directory):
    return handoff.flagged_users(_detections(spark, directory))


_DETAILS = ["events_in_last_day", "events_before_last_day_mean", "events_before_last_day_std",
            "no_day_with_events", "z_score"]


@check(_ALERTS + """
    SELECT TIMESTAMP '2024-01-31' AS date, rule_name AS alert_name,
           concat(rule_name, ': ', entity) AS alert_desc, 'Open' AS alert_status,
           'System' AS alert_source, 'none' AS alert_category, 'none' AS alert_subcategory,
           'none' AS tags, entity AS entity_id, entity_type, round(CAST(cur AS DOUBLE), 6) AS events_in_last_day,
           round(m, 6) AS events_before_last_day_mean, round(d, 6) AS events_before_last_day_std,
           CAST(days AS DOUBLE) AS no_day_with_events, round(score, 6) AS z_score
    FROM detections
""")
def handoff_alert_rows(spark, directory):
    rows = handoff.alert_rows(_detections(spark, directory), AS_OF)
    unknown = [
        F.coalesce(F.col(c).cast("string"), F.lit("none")).alias(c)
        for c in ("alert_category", "alert_subcategory", "tags")
    ]
    return rows.select(
        F.col("date").cast("timestamp_ntz").alias("date"), "alert_name", "alert_desc",
        "alert_status", "alert_source", *unknown, "entity_id", "entity_type",
        *[F.round(F.col("alert_details")[c].cast("double"), 6).alias(c) for c in _DETAILS],
    )


_DIRECTORY = """, directory AS (
      SELECT CAST(c_custkey AS VARCHAR) AS "user", c_name AS directory_id,
             concat('u', c_custkey, '@example.com') AS email
      FROM customer WHERE c_acctbal >= 0
    )
"""


def _judged(spark: SparkSession, directory: str) -> DataFrame:
    return stage(
        _findings(spark, directory).withColumn("trigger_event", F.lit("busy user")), "findings"
    )


@check(_COMMON + _DIRECTORY + """
    SELECT f."user", 'busy user' AS trigger_event, d.directory_id, 'Disable User' AS response_action
    FROM findings f LEFT JOIN directory d ON f."user" = d."user" WHERE severity = 'high'
""")
def handoff_response_actions(spark, directory):
    return handoff.response_actions(_judged(spark, directory), _tables(spark, directory).users)


@check(_COMMON + _DIRECTORY + """
    SELECT f."user", 'Disable User' AS response_action
    FROM findings f WHERE severity = 'high' AND f."user" NOT IN (SELECT "user" FROM directory)
""")
def handoff_rejected_actions(spark, directory):
    actions = handoff.response_actions(_judged(spark, directory), _tables(spark, directory).users)
    return handoff.rejected(actions).select("user", "response_action")


@check(_COMMON + _DIRECTORY + """
    SELECT f."user" AS "UserName", d.email AS "UserEmail", 'busy user' AS "TriggerEvent",
           'Disable User' AS "ResponseAction"
    FROM findings f JOIN directory d ON f."user" = d."user" WHERE severity = 'high'
""")
def handoff_response_rows(spark, directory):
    tables = _tables(spark, directory)
    actions = handoff.response_actions(_judged(spark, directory), tables.users)
    return handoff.response_rows(actions, tables.identity).drop("ID")


# --- the whole chain -----------------------------------------------------------------------

_MANUAL = ["17", "42", "nobody@example.com"]
_CHAIN = _alerts_sql(
    " ".join(f"UNION ALL SELECT 'Manual request', '{u}', 'user', NULL, NULL, NULL, NULL, NULL" for u in _MANUAL)
)


def _chain(spark: SparkSession, directory: str, **tiers: Tiers) -> response_chain.ChainResult:
    return response_chain.run(
        _tables(spark, directory), _SURGE_DAY, _MANUAL, limits=_SURGE, **tiers
    )


@check(f"WITH {_CHAIN}" + """
    SELECT rule_name, entity, entity_type, round(score, 6) AS score, "user", resolved FROM detections
""")
def chain_detections(spark, directory):
    """Both rules over their logs, and users named by an analyst."""
    found = response_chain.detect(_tables(spark, directory), _SURGE_DAY, _MANUAL, limits=_SURGE)
    return found.select(
        "rule_name", "entity", "entity_type", F.round("score", 6).alias("score"), "user", "resolved"
    )


_FOUND = f"""
    SELECT n.* REPLACE ({_COUNTS_SQL}), f.trigger_event, f.resolved
    FROM findings n JOIN flagged f ON n."user" = f."user"
"""


@check(_investigation_sql(_CHAIN, "2024-01-23 12:00:00", _SCALED) + _FOUND)
def chain_findings(spark, directory):
    result = _chain(spark, directory, dlp_tiers=DLP_TIERS, url_tiers=URL_TIERS)
    return result.findings.fillna(0, _COUNTS)


@check(_investigation_sql(_CHAIN, "2024-01-23 12:00:00", _SHIPPED) + _FOUND)
def chain_findings_shipped_tiers(spark, directory):
    return _chain(spark, directory).findings.fillna(0, _COUNTS)


@check(_investigation_sql(_CHAIN, "2024-01-23 12:00:00", _SCALED) + """
    SELECT n."user" AS "UserName", i.email AS "UserEmail", f.trigger_event AS "TriggerEvent",
           'Disable User' AS "ResponseAction"
    FROM findings n JOIN flagged f ON n."user" = f."user" JOIN identity i ON n."user" = i."user"
    WHERE severity = 'high'
""")
def chain_responses(spark, directory):
    result = _chain(spark, directory, dlp_tiers=DLP_TIERS, url_tiers=URL_TIERS)
    return result.responses.drop("ID")
