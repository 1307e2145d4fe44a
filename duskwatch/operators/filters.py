"""Row filters.

Each function builds one boolean expression over bare columns, so Spark can push it into
the scan.  A comparison with null is null, and null never passes a filter.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from duskwatch.functions.clock import AsOf, cutoff, in_type_of, wall_clock
from duskwatch.functions.literals import column_type
from duskwatch.functions.predicates import either, equals, every, one_of, text_matches, within

Predicate = Callable[[Column], Column]


# --- values and categories -------------------------------------------------------------

def filter_column_by_value(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Rows whose ``column`` equals ``value``; ``None`` equals nothing."""
    return df.where(equals(df, column, value))


def filter_columns_by_values(
    df: DataFrame, filters: Mapping[str, Any], is_and_operator: bool = True
) -> DataFrame:
    """One test per entry (a list means any of its members), all or any of which must hold."""
    if not filters:
        raise ValueError("filter_columns_by_values needs at least one column")
    tests = [one_of(df, name, wanted) for name, wanted in filters.items()]
    return df.where(every(tests) if is_and_operator else either(tests))


def filter_column_by_category(df: DataFrame, column: str, categories: Any) -> DataFrame:
    """Rows whose ``column`` is one of ``categories``; an empty list keeps nothing."""
    return df.where(one_of(df, column, categories))


def filter_columns_by_categories(df: DataFrame, filters: Mapping[str, Any]) -> DataFrame:
    """Every column must hold one of its categories; no entry keeps every row."""
    return df.where(every(one_of(df, name, wanted) for name, wanted in filters.items()))


# --- time --------------------------------------------------------------------------------

def filter_column_by_date_range(
    df: DataFrame, column: str, start_date: Any, end_date: Any
) -> DataFrame:
    """Rows with ``start_date <= column <= end_date``.

    On a timestamp column a plain date is its midnight, so an end date excludes the rest of
    that day.
    """
    return df.where(within(df, column, start_date, end_date))


def filter_columns_by_date_ranges(df: DataFrame, filters: Mapping[str, Any]) -> DataFrame:
    """Every column must lie in one of its ranges; a value is a pair or a list of pairs."""
    tests = []
    for name, ranges in filters.items():
        if len(ranges) == 0:
            raise ValueError(f"no date range given for column {name!r}")
        several = isinstance(ranges[0], Sequence) and not isinstance(ranges[0], str)
        pairs = [tuple(pair) for pair in ranges] if several else [tuple(ranges)]
        tests.append(either(within(df, name, low, high) for low, high in pairs))
    return df.where(every(tests))


def filter_by_time(
    df: DataFrame, start_time: Any, end_time: Any, time_column: str = "_event_time"
) -> DataFrame:
    """Rows with ``start_time <= time_column <= end_time``."""
    return df.where(within(df, time_column, start_time, end_time))


def filter_by_relative_time(
    df: DataFrame,
    weeks: float = 0,
    days: float = 0,
    hours: float = 0,
    minutes: float = 0,
    seconds: float = 0,
    microseconds: float = 0,
    milliseconds: float = 0,
    time_column: str = "_event_time",
    as_of: AsOf = None,
    upper_bound: bool = False,
) -> DataFrame:
    """Rows no older than the given span before ``as_of`` (default: query start).

    The lower bound is floored to the whole second.  Rows later than ``as_of`` pass unless
    ``upper_bound`` is set.
    """
    span = timedelta(
        weeks=weeks, days=days, hours=hours, minutes=minutes, seconds=seconds,
        microseconds=microseconds, milliseconds=milliseconds,
    )
    dtype = column_type(df, time_column)
    stamp = F.col(time_column)
    keep = stamp >= cutoff(as_of, span, dtype)
    if upper_bound:
        keep = keep & (stamp <= in_type_of(wall_clock(as_of), dtype))
    return df.where(keep)


# --- nulls -------------------------------------------------------------------------------

def _null_tests(columns: Sequence[str]) -> list[Column]:
    if not columns:
        raise ValueError("name at least one column to test for null")
    return [F.isnull(name) for name in columns]


def filter_rows_with_any_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where at least one of ``columns`` is null (NaN is not null)."""
    return df.where(either(_null_tests(columns)))


def filter_rows_with_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where all of ``columns`` are null."""
    return df.where(every(_null_tests(columns)))


# --- text patterns -------------------------------------------------------------------------

def filter_column_by_string_pattern(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose ``column`` contains a match of the regular expression."""
    return df.where(text_matches(column, pattern))


def filter_columns_by_string_pattern(
    df: DataFrame, filters: Mapping[str, str | Sequence[str]]
) -> DataFrame:
    """Every column must match one of its patterns."""
    return df.where(every(text_matches(name, patterns) for name, patterns in filters.items()))


# --- caller-supplied conditions ------------------------------------------------------------

def filter_column_by_multiple_conditions(
    df: DataFrame, condition1: Column, condition2: Column
) -> DataFrame:
    """Rows meeting both conditions."""
    return df.where(every((condition1, condition2)))


def filter_columns_by_multiple_conditions(
    df: DataFrame, conditions: Sequence[Column]
) -> DataFrame:
    """Rows meeting any of the conditions; none given keeps nothing."""
    return df.where(either(conditions))


def _expression(function: Predicate, column: str) -> Column:
    built = function(F.col(column))
    if not isinstance(built, Column):
        raise TypeError(
            f"the function for {column!r} must map a Column to a Column, not work row by row"
        )
    return built


def filter_column_by_custom_function(df: DataFrame, column: str, function: Predicate) -> DataFrame:
    """Rows passing a Column -> Column predicate."""
    return df.where(_expression(function, column))


def filter_columns_by_custom_function(
    df: DataFrame, filters: Mapping[str, Sequence[Predicate]]
) -> DataFrame:
    """Every column must pass one of its predicates."""
    return df.where(
        every(either(_expression(fn, name) for fn in functions) for name, functions in filters.items())
    )
