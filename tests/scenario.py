"""The planted scenario: fixed rows around a fixed instant, one story per entity."""

from datetime import datetime, timedelta

from duskwatch.plans.response_chain import SecurityTables
from duskwatch.sources import schemas
from duskwatch.sources.tables import local_rows

NOW = datetime(2024, 1, 31, 12)
DETECTED, CLEANED, FAILED = (
    schemas.MALWARE_DETECTED, schemas.MALWARE_ACTION_TAKEN, schemas.MALWARE_ACTION_FAILED
)


def ago(days=0, minutes=0):
    return NOW - timedelta(days=days, minutes=minutes)


def reads(user, per_day):
    return [
        (ago(day, n), user, "Document Accessed", f"file{n}.pdf", 1)
        for day, count in per_day.items()
        for n in range(count)
    ]


def mail(sender, per_day):
    rest = ("to@example.com", "s", "b", "g", "Low", False, "plain", "t", 0.1, "read")
    return [(ago(day, n), sender, *rest) for day, count in per_day.items() for n in range(count)]


SURGE = {0: 30} | {d: 1 + d % 2 for d in range(1, 15)}

SHAREPOINT = (
    reads("target", SURGE)
    + reads("medium", SURGE)
    + reads("ghost", SURGE)
    + reads("decoy", {d: 5 for d in range(15)})
    + reads("quiet", {d: 5 for d in range(1, 15)})
    + reads("newcomer", {0: 40})
)
EMAIL = (
    mail("mail@example.com", {0: 500} | {d: 1 + d % 2 for d in range(2, 16)})
    + mail("stranger@example.com", {0: 90} | {d: 1 + d % 2 for d in range(2, 16)})
    + mail("calm@example.com", {d: 3 for d in range(15)})
)


def login(user, host, ip, day=1):
    return (ago(day), user, "Login Attempt", host, ip, "Success")


USER_LOGINS = [
    login("target", "laptop-1", "10.0.0.1"),
    login("target", "laptop-1", "10.0.0.1", day=2),
    login("target", "web-1", "10.0.0.2"),
    login("target", "old-host", "10.9.9.9", day=8),  # too long ago to matter
    login("mail", "laptop-2", "10.0.0.3"),
    login("decoy", "laptop-1", "10.0.0.1"),
]
ANTIVIRUS = [("laptop-1", DETECTED, "Remove", ago(d)) for d in range(7)]
ANTIVIRUS += [("laptop-1", CLEANED, "Remove", ago(d)) for d in range(7)]
ANTIVIRUS += [("old-host", FAILED, "Remove", ago(1)), ("laptop-1", FAILED, "Remove", ago(9))]
ANTIVIRUS += [("laptop-2", "MALWAREPROTECTION_SCAN_STARTED", "No action", ago(1))]
DLP = [
    (ago(1), "target", "f", "zip", "High", "Allowed"),
    (ago(1), "target", "f", "zip", "Medium", "Blocked"),
    (ago(2), "medium", "f", "zip", "High", "Allowed"),
    (ago(9), "mail", "f", "zip", "High", "Allowed"),
    (ago(1), "mail", "f", "zip", "High", "Blocked"),
]
URL_FILTERING = [
    (ago(0, 5 * n), ip, f"bad{n % 2}.example", "Malware", "Blocked")
    for n in range(51)
    for ip in ("10.0.0.1", "10.0.0.2")
][:101]
URL_FILTERING += [(ago(1), "10.0.0.1", "shop.example", "Shopping", "Allowed")]
URL_FILTERING += [(ago(1), "10.0.0.3", "one.example", "Malware", "Blocked")]
URL_FILTERING += [(ago(9), "10.0.0.3", "two.example", "Malware", "Blocked")]
WORKDAY = [("target", "Accounting", "Manager"), ("mail", "Sales", "Agent"), ("mail", "Sales", "Boss")]
USERS = [("target", "guid-1"), ("target", "guid-1"), ("mail", "guid-2")]
IDENTITY = [("mail", "mail@example.com"), ("target", "target@example.com")]


def tables(spark, identity=True) -> SecurityTables:
    logs = {
        "sharepoint": SHAREPOINT, "email": EMAIL, "user_logins": USER_LOGINS, "antivirus": ANTIVIRUS,
        "dlp": DLP, "url_filtering": URL_FILTERING, "workday": WORKDAY,
    }
    return SecurityTables(
        **{name: local_rows(spark, rows, schemas.LOGS[name]) for name, rows in logs.items()},
        users=local_rows(spark, USERS, schemas.USERS),
        identity=local_rows(spark, IDENTITY, "user string, email string") if identity else None,
    )
