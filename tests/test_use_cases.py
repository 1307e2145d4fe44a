from duskwatch.plans import use_cases
from duskwatch.sources import schemas
from scenario import EMAIL, NOW, SHAREPOINT, ago


def frame(spark, name, data):
    return spark.createDataFrame(data, schemas.LOGS[name])


def test_malicious_requests(spark, rows):
    log = frame(spark, "url_filtering", [
        (ago(0, 5), "a", "d", "Malware", "Blocked"), (ago(0, 5), "b", "d", "Trojan", "Blocked"),
        (ago(0, 5), "c", "d", "Adult/Mature", "Blocked"), (ago(2), "d", "d", "Malware", "Blocked"),
    ])
    assert rows(use_cases.malicious_requests(log, NOW), "ip_address") == [("a",), ("b",)]


def test_busy_addresses(spark, rows):
    log = [(ago(0, n), "busy", "ua", "/p", "GET", 200) for n in range(101)]
    log += [(ago(0, n), "limit", "ua", "/p", "GET", 200) for n in range(100)]
    log += [(ago(2, n), "past", "ua", "/p", "GET", 200) for n in range(500)]
    assert rows(use_cases.busy_addresses(frame(spark, "web_logs", log), NOW)) == [("busy", 101)]


def test_anomalous_failed_logins(spark, rows):
    log = [("bad", ago(0, n % 30), "DENIED" if n % 5 else "BLOCKED") for n in range(700)]
    log += [("bad", ago(3), "DENIED")] * 50 + [("fine", ago(0, 9), "SUCCESS")] * 900
    log += [(f"peer{i:02}", ago(0, i), "BLOCKED") for i in range(24) for _ in range(1 + i % 3)]
    out = use_cases.anomalous_failed_logins(frame(spark, "ciam", log), NOW)
    assert rows(out, "login_id", "no_events") == [("bad", 700)]


def test_unusual_volumes(spark, rows):
    reads = use_cases.unusual_document_access(frame(spark, "sharepoint", SHAREPOINT), NOW)
    assert rows(reads, "user_id") == [("ghost",), ("medium",), ("target",)]
    mails = use_cases.unusual_mail_volume(frame(spark, "email", EMAIL), NOW)
    assert rows(mails, "sender", "events_in_last_day") == [
        ("mail@example.com", 500), ("stranger@example.com", 90)
    ]
