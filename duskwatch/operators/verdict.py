"""From three risks to one severity, and the findings as a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from duskwatch.operators.evidence import (
    AV_TIERS,
    DLP_TIERS,
    URL_TIERS,
    Tiers,
    attach,
    rate_antivirus,
    rate_dlp,
    rate_url,
    tier_of,
)

RISKS = ("av_risk", "dlp_risk", "url_risk")

# Severity by number of high risks.
SEVERITY_TIERS: Tiers = (
    ("high", "high_count >= 2"),
    ("medium", "high_count = 1"),
    ("low", "TRUE"),
)
RECOMMENDATIONS: Tiers = (
    ("disable the account and quarantine its hosts", "severity = 'high'"),
    ("have an analyst contact the user", "severity = 'medium'"),
    ("keep under observation", "TRUE"),
)


def fuse_severity(rated: DataFrame) -> DataFrame:
    """Add ``high_count``, ``severity`` and ``recommendation`` to a frame with the three risks."""
    high_count = " + ".join(f"if({risk} = 'High', 1, 0)" for risk in RISKS)
    return (
        rated.selectExpr("*", f"{high_count} AS high_count")
        .selectExpr("*", f"{tier_of(SEVERITY_TIERS)} AS severity")
        .selectExpr("*", f"{tier_of(RECOMMENDATIONS)} AS recommendation")
    )


def findings_table(
    flagged: DataFrame,
    *evidence: DataFrame,
    av_tiers: Tiers = AV_TIERS,
    dlp_tiers: Tiers = DLP_TIERS,
    url_tiers: Tiers = URL_TIERS,
) -> DataFrame:
    """One wide row per flagged user: profile, counts, risks, severity and recommendation.

    ``evidence`` are frames with at most one row per user, so no join here can repeat a user.
    """
    wide = reduce(attach, evidence, flagged)
    rated = rate_url(rate_dlp(rate_antivirus(wide, av_tiers), dlp_tiers), url_tiers)
    return fuse_severity(rated)
