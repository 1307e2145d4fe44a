"""'Now' as an argument.

No rule reads a clock.  Each takes ``as_of`` and turns it into one column expression here;
leaving it out means the query's own start time, which Spark fixes once per query.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from duskwatch.functions.literals import column_type

AsOf = None | str | date | datetime | Column

# The units date_trunc understands; any other text yields null buckets.
WINDOW_UNITS = (
    "year", "yyyy", "yy", "quarter", "month", "mon", "mm", "week", "day", "dd",
    "hour", "minute", "second", "millisecond", "microsecond",
)


def wall_clock(as_of: AsOf) -> Column:
    """``as_of`` as a zone-less timestamp in the session time zone."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of.cast(T.TimestampNTZType())
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if not isinstance(as_of, datetime):
        as_of = datetime(as_of.year, as_of.month, as_of.day)
    text = F.lit(as_of.isoformat(sep=" "))
    if as_of.tzinfo is not None:
        text = text.cast(T.TimestampType())
    return text.cast(T.TimestampNTZType())


def in_type_of(moment: Column, dtype: T.DataType) -> Column:
    """A zone-less ``moment`` in the type of the column it is going to be compared with."""
    if isinstance(dtype, T.StringType):
        return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
    return moment.cast(dtype)


def cutoff(as_of: AsOf, back: timedelta, dtype: T.DataType) -> Column:
    """``as_of - back``, floored to the whole second."""
    floor = F.date_trunc("second", wall_clock(as_of) - F.lit(back))
    return in_type_of(floor.cast(T.TimestampNTZType()), dtype)


def checked_unit(window: str) -> str:
    if window.lower() not in WINDOW_UNITS:
        raise ValueError(f"unknown window unit {window!r}; expected one of {', '.join(WINDOW_UNITS)}")
    return window


def window_start(moment: Column, dtype: T.DataType, unit: str) -> Column:
    """Start of the window that ``moment`` lies in.

    Zone-less columns are cut without the session's zone and keep their type; in a zone with a
    clock change two of their hours would otherwise become one.
    """
    small = {
        "hour": F.make_dt_interval(mins=F.minute(moment), secs=F.extract(F.lit("SECOND"), moment)),
        "minute": F.make_dt_interval(secs=F.extract(F.lit("SECOND"), moment)),
        "second": F.make_dt_interval(secs=F.extract(F.lit("SECOND"), moment) % 1),
        "millisecond": F.make_dt_interval(secs=F.extract(F.lit("SECOND"), moment) % F.expr("0.001BD")),
    }
    name = unit.lower()
    if not isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return F.date_trunc(unit, moment)
    if name in ("day", "dd"):
        return moment.cast("date").cast(dtype)
    if name not in (*small, "microsecond"):
        return F.trunc(moment.cast("date"), unit).cast(dtype)
    if isinstance(dtype, T.DateType) or name == "microsecond":
        return moment
    return moment - small[name]


def in_days_since(df: DataFrame, day_column: str, moment: Column) -> DataFrame:
    """Rows of the days from ``moment``'s on, and of one day before.

    For a log whose folders are divided by ``day_column`` (a date, or text such as 2024-01-31),
    so that older folders are not opened; the exact test on the event time stays the caller's.
    The day of slack allows for days that were cut in another zone.
    """
    dtype, day = column_type(df, day_column), F.date_sub(moment.cast("date"), 1)
    if isinstance(dtype, T.StringType):
        day = F.date_format(day, "yyyy-MM-dd")
    elif not isinstance(dtype, T.DateType):
        raise ValueError(f"{day_column} must hold dates or their text, not {dtype.simpleString()}")
    return df.where(F.col(day_column) >= day)


def epoch_seconds(moment: Column, dtype: T.DataType) -> Column:
    """Whole seconds since the epoch; null for null."""
    if isinstance(dtype, T.NumericType):
        return moment.cast("bigint")
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_timestamp(moment)  # wall-clock seconds, whatever the session's zone
    return F.unix_seconds(moment.cast(T.TimestampType()))
