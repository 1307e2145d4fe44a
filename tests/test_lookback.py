"""Bounded histories, folders by day, and windows of zone-less times."""

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest

import duskwatch as dw
import scenario
from duskwatch.operators import evidence
from duskwatch.plans import response_chain
from duskwatch.plans.history import window_totals
from duskwatch.sources.tables import overwrite, read_path

EVENTS = "/root/testdata/sf0.001/events.parquet"
LIMITS = {"z_score_threshold": 1.0, "current_window_is_multiple_of_mean": 1.0, "as_of": "2024-01-30 12:00:00"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookback_over_the_whole_log_changes_nothing(spark, rows):
    events = spark.read.parquet(EVENTS)
    bounded = dw.statistically_significant_window_by_std(
        events, "user_id", "ts", lookback=timedelta(days=400), **LIMITS
    )
    unbounded = dw.statistically_significant_window_by_std(events, "user_id", "ts", **LIMITS)
    assert rows(bounded) == rows(unbounded) != []


def test_lookback_is_aligned_and_pushed(spark, rows):
    events = spark.read.parquet(EVENTS)
    bounded = dw.statistically_significant_window_by_std(
        events, "user_id", "ts", lookback=timedelta(days=9), **LIMITS
    )
    assert "GreaterThanOrEqual(ts,2024-01-21T00:00" in plan(bounded).replace("21 00:00", "21T00:00")
    cut = events.where("ts >= TIMESTAMP_NTZ '2024-01-21 00:00:00'")
    assert rows(bounded) == rows(dw.statistically_significant_window_by_std(cut, "user_id", "ts", **LIMITS))


def in_folders(spark, df, time_column, path):
    overwrite(df.withColumn("day", df[time_column].cast("date")), path, partition_by=["day"])
    return read_path(spark, path)


def test_chain_opens_recent_folders_only(spark, rows, tmp_path):
    plain = scenario.tables(spark)
    times = {"sharepoint": "date", "email": "date", "user_logins": "date", "antivirus": "time",
             "dlp": "timestamp", "url_filtering": "date"}
    logs = {
        name: in_folders(spark, getattr(plain, name), time, str(tmp_path / name))
        for name, time in times.items()
    }
    rest = {"workday": plain.workday, "users": plain.users, "identity": plain.identity}
    divided = response_chain.SecurityTables(**logs, **rest, day_column="day")
    kept = {"as_of": scenario.NOW, "keep": lambda df, name: df}
    lookback = timedelta(days=20)
    found = response_chain.run(divided, lookback=lookback, **kept)
    text = plan(found.findings)
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) >= len(times)
    assert all("PartitionFilters: [isnotnull(day" in line for line in scans)
    assert rows(found.findings) == rows(response_chain.run(plain, **kept).findings)


@pytest.mark.parametrize("kind", ["date", "string"])
def test_day_columns_keep_the_first_day(spark, kind):
    log = spark.createDataFrame(
        [("h", evidence.schemas.MALWARE_DETECTED, datetime(2024, 1, 24, 12), date(2024, 1, 24))],
        "hostname string, event_type string, time timestamp, day date",
    )
    log = log.withColumn("day", log.day.cast(kind))
    where = spark.createDataFrame([("u", "h", "a")], "user string, dest_hostname string, src_ip string")
    counts = evidence.antivirus_counts(where, log, scenario.NOW, "day").first()
    assert counts.av_detected == 1


def test_day_columns_of_other_types_are_refused(spark):
    log = spark.createDataFrame([(1, 20240131)], "a int, day int")
    with pytest.raises(ValueError, match="dates or their text"):
        evidence._recent(log, "a", scenario.NOW, "day")


def test_chain_over_stored_totals(spark, rows):
    plain = scenario.tables(spark)
    stored = {
        "document_totals": window_totals(plain.sharepoint, "user_id", "date"),
        "mail_totals": window_totals(plain.email, "sender", "date"),
    }
    with_totals = replace(plain, **stored)
    expected = rows(response_chain.detect(plain, scenario.NOW).drop("details"))
    assert rows(response_chain.detect(with_totals, scenario.NOW).drop("details")) == expected != []


def test_hours_stay_apart_when_clocks_go_forward(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        log = spark.sql(
            "SELECT 'a' AS who, t AS at FROM VALUES (TIMESTAMP_NTZ '2024-03-10 02:30:00'),"
            " (TIMESTAMP_NTZ '2024-03-10 03:30:00') AS v(t)"
        )
        totals = window_totals(log, "who", "at", "hour")
        assert totals.schema["at"].dataType.simpleString() == "timestamp_ntz"
        got = {(r["at"], r["volume"]) for r in totals.collect()}
        assert got == {(datetime(2024, 3, 10, 2), 1), (datetime(2024, 3, 10, 3), 1)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    "unit", ["year", "quarter", "month", "week", "day", "hour", "minute", "second", "millisecond", "microsecond"]
)
def test_zone_less_windows_equal_those_with_a_zone(spark, unit):
    log = spark.sql(
        "SELECT who, t FROM VALUES ('a', TIMESTAMP_NTZ '2024-02-29 23:59:59.987654'),"
        " ('b', TIMESTAMP_NTZ '1969-12-31 13:14:15.000001'), ('c', NULL) AS v(who, t)"
    )
    ours = window_totals(log, "who", "t", unit).selectExpr("who", "CAST(t AS STRING) AS t").collect()
    theirs = log.selectExpr("who", f"CAST(date_trunc('{unit}', CAST(t AS TIMESTAMP)) AS STRING) AS t").collect()
    assert sorted(ours, key=str) == sorted(theirs, key=str)
