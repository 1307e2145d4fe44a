"""Evidence about flagged users, for all of them at once.

``flagged`` holds one row per ``user``.  For every log there are three functions: ``*_counts``
reduces the log to one row per user that has evidence, ``rate_*`` turns counts into a risk, and
``*_risk`` does both for each flagged user.

Logs are reduced to one row per user, host or address *before* they meet the flagged set, so
a noisy host is a single row by the time it is joined.  The semi-joins sit above those
reductions: when the flagged side is small enough to broadcast, Spark moves them below, and
the reduction then only sees rows that matter.

``day_column``, where given, names the column by which a log's folders are divided by day: folders
older than the look-back are then not opened.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from duskwatch.functions.clock import AsOf, in_days_since, wall_clock
from duskwatch.operators.filters import filter_by_relative_time
from duskwatch.operators.relational import spread_join
from duskwatch.sources import schemas

USER = "user"
LOOKBACK_DAYS = 7

Tiers = tuple[tuple[str, str], ...]

# Risk tiers as (tier, condition), tried in order; no match means no risk.
AV_TIERS: Tiers = (
    ("High", "av_detected > 5 OR av_failed > 0 OR av_detected > av_cleaned"),
    ("Medium", "av_detected > 3"),
    ("Low", "av_detected > 0"),
)
# The same rule with cleans and failures taken for one another: any detection is High.
AV_TIERS_AS_WRITTEN: Tiers = (
    ("High", "av_detected > 5 OR av_failed > 0 OR av_detected > av_failed"),
    ("Medium", "av_detected > 3"),
    ("Low", "av_detected > 0"),
)
DLP_TIERS: Tiers = (
    ("High", "dlp_high > 0 OR dlp_medium > 10 OR dlp_low > 100"),
    ("Medium", "dlp_medium > 5 OR dlp_low > 50"),
)
URL_TIERS: Tiers = (
    ("High", "url_hits > 100 AND url_domains > 1"),
    ("Medium", "(url_hits > 50 AND url_domains > 1) OR url_domains = 1"),
    ("Low", "TRUE"),
)


def tier_of(tiers: Tiers, only_if: str = "TRUE") -> str:
    """SQL for the first tier whose condition holds; null when none does or ``only_if`` fails."""
    cases = " ".join(f"WHEN ({only_if}) AND ({condition}) THEN '{tier}'" for tier, condition in tiers)
    return f"CASE {cases} END"


def users_of(df: DataFrame, column: str = USER) -> DataFrame:
    """Distinct non-null entities of a column, as ``user``."""
    return df.select(F.col(column).cast("string").alias(USER)).dropna().distinct()


def attach(flagged: DataFrame, per_user: DataFrame) -> DataFrame:
    """Every flagged user with their row of ``per_user``, or nulls."""
    return flagged.join(per_user, USER, "left")


def _recent(
    log: DataFrame, time_column: str, as_of: AsOf, day_column: str | None = None
) -> DataFrame:
    if day_column is not None:
        log = in_days_since(log, day_column, wall_clock(as_of) - F.lit(timedelta(days=LOOKBACK_DAYS)))
    return filter_by_relative_time(log, days=LOOKBACK_DAYS, time_column=time_column, as_of=as_of)


def _pairs(footprint: DataFrame, column: str, name: str) -> DataFrame:
    return footprint.selectExpr(f"`{USER}`", f"{column} AS {name}").distinct()


def _replaced(df: DataFrame, changed: Sequence[str], *expressions: str) -> DataFrame:
    """``df`` with the ``changed`` columns dropped and SQL ``expressions`` put at the end."""
    kept = [f"`{c}`" for c in df.columns if c not in changed]
    return df.selectExpr(*kept, *expressions)


# --- who and where -------------------------------------------------------------------------

def entity_footprint(
    logins: DataFrame, flagged: DataFrame, as_of: AsOf = None, day_column: str | None = None
) -> DataFrame:
    """Distinct (user, dest_hostname, src_ip) of the flagged users' recent logins."""
    seen = _recent(logins, "date", as_of, day_column).selectExpr(
        f"CAST(user_id AS STRING) AS `{USER}`", "dest_hostname", "src_ip"
    )
    return seen.distinct().join(flagged.select(USER), USER, "left_semi")


def staff_profiles(workday: DataFrame) -> DataFrame:
    """One post per employee: the smallest where there are several, or users would repeat.

    A post without department or title counts only where there is no fuller one.
    """
    posts = workday.groupBy(F.col("employee").cast("string").alias(USER)).agg(
        F.expr(
            "min(struct(department IS NULL, title IS NULL, department, title)) AS post"
        )
    )
    return posts.select(USER, "post.department", "post.title")


def entity_profile(flagged: DataFrame, workday: DataFrame) -> DataFrame:
    """Department and title of every flagged user; null for users unknown to HR."""
    return attach(flagged.select(USER), staff_profiles(workday))


# --- antivirus -----------------------------------------------------------------------------

AV_COUNTS = ("av_events", "av_detected", "av_cleaned", "av_failed")


def antivirus_counts(
    footprint: DataFrame, antivirus: DataFrame, as_of: AsOf = None, day_column: str | None = None
) -> DataFrame:
    """Antivirus events on each user's hosts, by outcome.  Users without hosts have no row."""
    hosts = _pairs(footprint, "dest_hostname", "hostname")
    per_host = (
        _recent(antivirus, "time", as_of, day_column)
        .groupBy("hostname")
        .agg(
            F.expr("count(1) AS av_events"),
            F.expr(f"count_if(event_type = '{schemas.MALWARE_DETECTED}') AS av_detected"),
            F.expr(f"count_if(event_type = '{schemas.MALWARE_ACTION_TAKEN}') AS av_cleaned"),
            F.expr(f"count_if(event_type = '{schemas.MALWARE_ACTION_FAILED}') AS av_failed"),
        )
        .join(hosts.select("hostname").distinct(), "hostname", "left_semi")
    )
    totals = [F.expr(f"coalesce(sum({c}), 0) AS {c}") for c in AV_COUNTS]
    return spread_join(hosts, per_host, "hostname", USER, "left").groupBy(USER).agg(*totals)


def rate_antivirus(counted: DataFrame, tiers: Tiers = AV_TIERS) -> DataFrame:
    """Add ``av_risk`` and ``av_message``; no detection, or no known host, is no risk."""
    return counted.selectExpr(
        "*",
        f"{tier_of(tiers, 'av_detected > 0')} AS av_risk",
        """CASE WHEN av_events IS NULL THEN 'no host known for this user'
                WHEN av_events = 0 THEN "no antivirus activity on the user's hosts"
                WHEN av_detected = 0 THEN 'antivirus activity without detections'
                ELSE concat(av_detected, ' detections, ', av_cleaned, ' cleaned, ',
                            av_failed, ' not cleaned') END AS av_message""",
    )


def antivirus_risk(
    flagged: DataFrame,
    footprint: DataFrame,
    antivirus: DataFrame,
    as_of: AsOf = None,
    tiers: Tiers = AV_TIERS,
) -> DataFrame:
    """Malware detected, cleaned and not cleaned on each flagged user's hosts, and the risk."""
    counts = antivirus_counts(footprint, antivirus, as_of)
    return rate_antivirus(attach(flagged.select(USER), counts), tiers)


# --- data loss -----------------------------------------------------------------------------

DLP_COUNTS = ("dlp_high", "dlp_medium", "dlp_low")


def dlp_counts(
    flagged: DataFrame, dlp: DataFrame, as_of: AsOf = None, day_column: str | None = None
) -> DataFrame:
    """Data-loss events that were let through, per user and severity."""
    return (
        _recent(dlp, "timestamp", as_of, day_column)
        .where(F.col("action") == schemas.DLP_ALLOWED)
        .groupBy(F.col(USER).cast("string").alias(USER))
        .agg(
            F.expr("count_if(risk = 'High') AS dlp_high"),
            F.expr("count_if(risk = 'Medium') AS dlp_medium"),
            F.expr("count_if(risk = 'Low') AS dlp_low"),
        )
        .join(flagged.select(USER), USER, "left_semi")
    )


def rate_dlp(counted: DataFrame, tiers: Tiers = DLP_TIERS) -> DataFrame:
    """Add ``dlp_risk`` and ``dlp_message``; missing counts become zero."""
    filled = _replaced(counted, DLP_COUNTS, *[f"coalesce({c}, 0L) AS {c}" for c in DLP_COUNTS])
    return filled.selectExpr(
        "*",
        f"{tier_of(tiers)} AS dlp_risk",
        "concat('let through: ', dlp_high, ' high, ', dlp_medium, ' medium, ', dlp_low, ' low')"
        " AS dlp_message",
    )


def dlp_risk(
    flagged: DataFrame, dlp: DataFrame, as_of: AsOf = None, tiers: Tiers = DLP_TIERS
) -> DataFrame:
    """Data-loss events of each flagged user that were let through, and the risk."""
    return rate_dlp(attach(flagged.select(USER), dlp_counts(flagged, dlp, as_of)), tiers)


# --- proxy ---------------------------------------------------------------------------------

URL_COUNTS = ("url_hits", "url_domains")


def url_counts(
    footprint: DataFrame, url_filtering: DataFrame, as_of: AsOf = None, day_column: str | None = None
) -> DataFrame:
    """Malware requests from each user's addresses, and their distinct domains.

    The domains behind a user's addresses are a union of sets.  Domains are numbered once, an
    address's set is a few bitmaps (one for each range of numbers that it touches), and a user's
    is the union of those of their addresses.  So a gateway with many domains is a few rows for
    each of its users, and never multiplied out.
    """
    addresses = _pairs(footprint, "src_ip", "ip_address").where("ip_address IS NOT NULL")
    per_domain = (
        _recent(url_filtering, "date", as_of, day_column)
        .where(F.col("url_category") == schemas.URL_MALWARE)
        .groupBy("ip_address", "domain")
        .agg(F.expr("count(1) AS hits"))
        .join(addresses.select("ip_address").distinct(), "ip_address", "left_semi")
    )
    # Numbers need be unique, and close together where bitmaps are to be full.  Domains are taken
    # with their counts and null among them: a filter on domains would move to the scan, and counts
    # that nobody asks for would go; either makes another shuffle and a second read of the log.
    numbers = (
        per_domain.groupBy("domain").agg(F.expr("sum(hits) AS hits")).where("hits > 0")
        .select("domain", (F.monotonically_increasing_id() + 1).alias("number"))
    )
    numbered = per_domain.join(numbers, "domain", "left").selectExpr(
        "ip_address",
        "hits",
        # null is a domain like any other here; real numbers are in buckets from 1 on
        "coalesce(bitmap_bucket_number(number), 0L) AS bucket",
        "coalesce(bitmap_bit_position(number), 0L) AS bit",
    )
    sets = numbered.groupBy("ip_address", "bucket").agg(
        F.expr("sum(hits) AS hits"), F.expr("bitmap_construct_agg(bit) AS domains")
    )
    return (
        spread_join(addresses, sets, "ip_address", USER)
        .groupBy(USER, "bucket")
        .agg(F.expr("sum(hits) AS hits"), F.expr("bitmap_count(bitmap_or_agg(domains)) AS domains"))
        .groupBy(USER)
        .agg(F.expr("sum(hits) AS url_hits"), F.expr("sum(domains) AS url_domains"))
    )


def rate_url(counted: DataFrame, tiers: Tiers = URL_TIERS) -> DataFrame:
    """Add ``url_risk`` and ``url_message``; missing counts become zero, which is still low."""
    filled = _replaced(counted, URL_COUNTS, *[f"coalesce({c}, 0L) AS {c}" for c in URL_COUNTS])
    return filled.selectExpr(
        "*",
        f"{tier_of(tiers)} AS url_risk",
        "concat(url_hits, ' malware requests to ', url_domains, ' domains') AS url_message",
    )


def url_risk(
    flagged: DataFrame,
    footprint: DataFrame,
    url_filtering: DataFrame,
    as_of: AsOf = None,
    tiers: Tiers = URL_TIERS,
) -> DataFrame:
    """Malware requests from each flagged user's addresses, their domains, and the risk."""
    counts = url_counts(footprint, url_filtering, as_of)
    return rate_url(attach(flagged.select(USER), counts), tiers)
