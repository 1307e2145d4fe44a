"""The own-history rule without re-reading the history.

The rule needs only the volume per entity and window.  Kept as a table, to which each run adds
the totals of the rows that are new, the history is read as a few numbers per entity instead of
as a log.  Totals of one window may come in several portions (late rows, several runs a day):
the rule adds them up.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, functions as F

from duskwatch.functions.clock import checked_unit, window_start
from duskwatch.functions.literals import column_type
from duskwatch.operators.rules import statistically_significant_window_by_std

VOLUME = "volume"


def window_totals(
    new_rows: DataFrame,
    comparative_column: str,
    timestamp_column: str = "_event_time",
    window: str = "day",
    count_column: str | None = None,
) -> DataFrame:
    """Volume per entity and window; the window's start keeps the name of the time column."""
    dtype = column_type(new_rows, timestamp_column)
    start = window_start(F.col(timestamp_column), dtype, checked_unit(window)).alias(timestamp_column)
    volume = F.count(F.lit(1)) if count_column is None else F.sum(count_column)
    return new_rows.groupBy(comparative_column, start).agg(volume.alias(VOLUME))


def merged_totals(totals: DataFrame) -> DataFrame:
    """Portions of the same entity and window as one row; what ``portions.compact`` needs."""
    by = [c for c in totals.columns if c != VOLUME]
    dtype = column_type(totals, VOLUME)
    return totals.groupBy(*by).agg(F.sum(VOLUME).cast(dtype).alias(VOLUME))


def surges_in_totals(
    totals: DataFrame, comparative_column: str, timestamp_column: str = "_event_time", **limits: Any
) -> DataFrame:
    """The own-history rule over such totals; same rows and options as over the log itself."""
    return statistically_significant_window_by_std(
        totals, comparative_column, timestamp_column, count_column=VOLUME, **limits
    )
