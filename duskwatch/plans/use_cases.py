"""Ready-made detections, from exact match to deviation from one's own history."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame

from duskwatch.functions.clock import AsOf
from duskwatch.operators.filters import filter_by_relative_time, filter_columns_by_values
from duskwatch.operators.rules import (
    statistical_anomaly_detection_group_by,
    statistically_significant_window_by_std,
    threshold_based_rule,
)
from duskwatch.sources.schemas import FAILED_LOGIN_OUTCOMES

# Parameters of the shipped detections.
MALICIOUS_CATEGORIES = ["Malware", "Trojan"]
BUSY_ADDRESS_REQUESTS = 100
HISTORY = {"no_minimum_window_events": 7, "current_window_is_multiple_of_mean": 3.0}


def malicious_requests(url_filtering: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Requests of the last day to malicious categories."""
    recent = filter_by_relative_time(url_filtering, days=1, time_column="date", as_of=as_of)
    return filter_columns_by_values(recent, {"url_category": MALICIOUS_CATEGORIES})


def busy_addresses(
    web_logs: DataFrame, as_of: AsOf = None, threshold: float = BUSY_ADDRESS_REQUESTS
) -> DataFrame:
    """Addresses with more than ``threshold`` requests in the last day."""
    recent = filter_by_relative_time(web_logs, days=1, time_column="timestamp", as_of=as_of)
    return threshold_based_rule(recent, threshold, groupby_column="ip")


def anomalous_failed_logins(ciam: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Accounts with far more refused logins in the last day than their peers."""
    recent = filter_by_relative_time(ciam, days=1, time_column="_event_date", as_of=as_of)
    refused = filter_columns_by_values(recent, {"outcome": FAILED_LOGIN_OUTCOMES})
    return statistical_anomaly_detection_group_by(refused, "login_id")


def unusual_document_access(
    sharepoint: DataFrame, as_of: AsOf = None, **options: Any
) -> DataFrame:
    """Users opening far more documents today than on their own earlier days.

    ``options`` of the own-history rule replace the shipped limits or add to them.
    """
    return statistically_significant_window_by_std(
        sharepoint, "user_id", timestamp_column="date", as_of=as_of, **(HISTORY | options)
    )


def unusual_mail_volume(email: DataFrame, as_of: AsOf = None, **options: Any) -> DataFrame:
    """Senders with far more mail today than on their own earlier days; options as above."""
    return statistically_significant_window_by_std(
        email, "sender", timestamp_column="date", as_of=as_of, **(HISTORY | options)
    )
