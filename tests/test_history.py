from datetime import timedelta

import duskwatch as dw
from duskwatch.plans.history import surges_in_totals, window_totals
from duskwatch.sources import schemas
from duskwatch.sources.tables import append, overwrite, read_path
from scenario import NOW, SHAREPOINT

LIMITS = {"no_minimum_window_events": 7, "current_window_is_multiple_of_mean": 3.0, "as_of": NOW}


def test_totals_in_portions_equal_the_log(spark, rows, tmp_path):
    log = spark.createDataFrame(SHAREPOINT, schemas.LOGS["sharepoint"])
    path = str(tmp_path / "totals")
    split = NOW - timedelta(hours=12, minutes=-10)  # in the middle of a day
    old, new = log.where(f"date < '{split}'"), log.where(f"date >= '{split}'")
    overwrite(window_totals(old, "user_id", "date"), path)
    append(window_totals(new, "user_id", "date"), path)

    from_log = dw.statistically_significant_window_by_std(log, "user_id", "date", **LIMITS)
    from_totals = surges_in_totals(read_path(spark, path), "user_id", "date", **LIMITS)
    assert from_totals.columns == from_log.columns
    assert rows(from_totals) == rows(from_log)
    assert rows(from_log, "user_id") == [("ghost",), ("medium",), ("target",)]


def test_totals_of_a_column(spark, rows):
    log = spark.createDataFrame(SHAREPOINT, schemas.LOGS["sharepoint"])
    hourly = window_totals(log, "user_id", "date", "hour", "no_prints")
    direct = dw.statistically_significant_window_by_std(
        log, "user_id", "date", count_column="no_prints", window="hour", as_of=NOW
    )
    assert rows(surges_in_totals(hourly, "user_id", "date", window="hour", as_of=NOW)) == rows(direct)
