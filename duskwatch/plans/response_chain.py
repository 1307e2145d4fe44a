"""Detection, investigation and response as one chain over every flagged user.

Stages meet in tables.  ``run`` writes the detections, the flagged users and their footprint
to the shared folder as it goes: they are small next to the logs, used several times, and once
written their true size lets later joins decide for themselves whether to broadcast them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import timedelta
from typing import Any

from pyspark.sql import DataFrame

from duskwatch.functions.clock import AsOf
from duskwatch.operators import evidence, handoff
from duskwatch.operators.verdict import findings_table
from duskwatch.plans.history import VOLUME
from duskwatch.plans.use_cases import unusual_document_access, unusual_mail_volume
from duskwatch.sources.staging import stage

# Names under which the two feeding rules report.
DOCUMENT_RULE = "Unusual document access"
MAIL_RULE = "Unusual mail volume"


@dataclass(frozen=True)
class SecurityTables:
    """The logs and dimensions the chain reads.

    ``identity(user, email)`` is optional; without it e-mail entities stay unresolved.
    ``document_totals`` and ``mail_totals`` are daily totals kept by ``plans.history``; the
    rules then read them instead of the whole sharepoint and e-mail logs.  ``day_column`` names
    the column by which logs are divided into folders; a log without it is read as it is.
    """

    sharepoint: DataFrame
    email: DataFrame
    user_logins: DataFrame
    workday: DataFrame
    antivirus: DataFrame
    dlp: DataFrame
    url_filtering: DataFrame
    users: DataFrame
    identity: DataFrame | None = None
    document_totals: DataFrame | None = None
    mail_totals: DataFrame | None = None
    day_column: str | None = None

    def day_of(self, log: DataFrame) -> str | None:
        return self.day_column if self.day_column in log.columns else None


@dataclass(frozen=True)
class ChainResult:
    """Frames of all stages.  Nothing here has been shown, counted or sent anywhere."""

    detections: DataFrame
    flagged: DataFrame
    footprint: DataFrame
    findings: DataFrame
    alerts: DataFrame
    investigations: DataFrame
    actions: DataFrame
    rejects: DataFrame
    responses: DataFrame


def detect(
    tables: SecurityTables,
    as_of: AsOf = None,
    manual_users: Iterable[str] = (),
    limits: Mapping[str, Any] | None = None,
    lookback: timedelta | None = None,
) -> DataFrame:
    """Detections of both rules and of analysts, with their users resolved.

    ``limits`` are options of the own-history rule in place of the shipped ones; ``lookback``
    bounds the history that is read.
    """

    def surges(rule: Callable[..., DataFrame], log: DataFrame, totals: DataFrame | None) -> DataFrame:
        source, options = log, dict(limits or {})
        if totals is not None:
            source, options["count_column"] = totals, VOLUME
        if lookback is not None:
            options |= {"lookback": lookback, "day_column": tables.day_of(source)}
        return rule(source, as_of, **options)

    found = [
        handoff.as_detections(
            surges(unusual_document_access, tables.sharepoint, tables.document_totals),
            DOCUMENT_RULE, "user_id", score_column="z_score",
        ),
        handoff.as_detections(
            surges(unusual_mail_volume, tables.email, tables.mail_totals),
            MAIL_RULE, "sender", "email", "z_score",
        ),
    ]
    named = list(manual_users)
    if named:
        found.append(handoff.manual_detections(tables.email.sparkSession, named))
    return handoff.resolve_users(handoff.all_detections(*found), tables.identity)


def investigate(
    flagged: DataFrame,
    footprint: DataFrame,
    tables: SecurityTables,
    as_of: AsOf = None,
    av_tiers: evidence.Tiers = evidence.AV_TIERS,
    dlp_tiers: evidence.Tiers = evidence.DLP_TIERS,
    url_tiers: evidence.Tiers = evidence.URL_TIERS,
) -> DataFrame:
    """Findings for every flagged user."""
    return findings_table(
        flagged,
        evidence.staff_profiles(tables.workday),
        evidence.antivirus_counts(footprint, tables.antivirus, as_of, tables.day_of(tables.antivirus)),
        evidence.dlp_counts(flagged, tables.dlp, as_of, tables.day_of(tables.dlp)),
        evidence.url_counts(footprint, tables.url_filtering, as_of, tables.day_of(tables.url_filtering)),
        av_tiers=av_tiers,
        dlp_tiers=dlp_tiers,
        url_tiers=url_tiers,
    )


def run(
    tables: SecurityTables,
    as_of: AsOf = None,
    manual_users: Iterable[str] = (),
    keep: Callable[[DataFrame, str], DataFrame] = stage,
    limits: Mapping[str, Any] | None = None,
    lookback: timedelta | None = None,
    **tiers: evidence.Tiers,
) -> ChainResult:
    """The whole chain.  ``keep`` cuts the plan between stages; identity keeps it one plan.

    ``limits`` and ``lookback`` go to ``detect``; ``av_tiers``, ``dlp_tiers`` and ``url_tiers``
    to ``investigate``.
    """
    detections = keep(detect(tables, as_of, manual_users, limits, lookback), "detections")
    flagged = keep(handoff.flagged_users(detections), "flagged")
    logins = tables.user_logins
    footprint = keep(
        evidence.entity_footprint(logins, flagged, as_of, tables.day_of(logins)), "footprint"
    )
    findings = keep(investigate(flagged, footprint, tables, as_of, **tiers), "findings")
    actions = handoff.response_actions(findings, tables.users)
    return ChainResult(
        detections=detections,
        flagged=flagged,
        footprint=footprint,
        findings=findings,
        alerts=handoff.alert_rows(detections, as_of),
        investigations=handoff.investigation_rows(findings, as_of),
        actions=handoff.executable(actions),
        rejects=handoff.rejected(actions),
        responses=handoff.response_rows(actions, tables.identity),
    )
