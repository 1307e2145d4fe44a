"""Declared schemas and vocabularies of the logs and the hand-off tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, B, D, TS = T.StringType(), T.LongType(), T.BooleanType(), T.DoubleType(), T.TimestampType()
MAP = T.MapType(S, S)


def _columns(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Table and column names and types.
ALERT = _columns(
    ID=L, date=TS, alert_name=S, alert_desc=S, alert_status=S, alert_source=S, alert_category=S,
    alert_subcategory=S, tags=S, entity_id=S, entity_type=S, alert_details=MAP,
)
INVESTIGATION = _columns(
    id=L, date=TS, investigation_name=S, status=S, status_message=S, data=MAP
)
RESPONSE = _columns(ID=L, UserName=S, UserEmail=S, TriggerEvent=S, ResponseAction=S)
USERS = _columns(Username=S, ID=S)
LOGS = {
    "url_filtering": _columns(date=TS, ip_address=S, domain=S, url_category=S, outcome=S),
    "web_logs": _columns(timestamp=TS, ip=S, user_agent=S, page=S, http_method=S, status_code=L),
    "customer_logins": _columns(date=TS, user_id=S, action=S, outcome=S),
    "sharepoint": _columns(date=TS, user_id=S, action=S, document_name=S, no_prints=L),
    "user_logins": _columns(date=TS, user_id=S, action=S, dest_hostname=S, src_ip=S, outcome=S),
    "workday": _columns(employee=S, department=S, title=S),
    "dlp": _columns(timestamp=TS, user=S, filename=S, event=S, risk=S, action=S),
    "antivirus": _columns(hostname=S, event_type=S, action=S, time=TS),
    "email": _columns(
        date=TS, sender=S, recipient=S, subject=S, message_body=S, signature=S, priority=S,
        read_receipt=B, format=S, thread_id=S, spam_score=D, status_flags=S,
    ),
    "ciam": _columns(login_id=S, _event_date=TS, outcome=S),
}

# Vocabulary of the antivirus, data-loss, proxy and login logs.
MALWARE_DETECTED = "MALWAREPROTECTION_MALWARE_DETECTED"
MALWARE_ACTION_TAKEN = "MALWAREPROTECTION_MALWARE_ACTION_TAKEN"
MALWARE_ACTION_FAILED = "MALWAREPROTECTION_MALWARE_ACTION_FAILED"
DLP_ALLOWED = "Allowed"
URL_MALWARE = "Malware"
BLOCKED_URL_CATEGORIES = ["Malware", "Adult/Mature", "Criminal Activity"]
FAILED_LOGIN_OUTCOMES = ["DENIED", "BLOCKED"]
