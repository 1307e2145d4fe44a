"""Boolean column builders: the vocabulary the filters and rules are written in."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from duskwatch.functions.literals import column_type, literal_of, typed_literal


def either(conditions: Iterable[Column]) -> Column:
    """OR over any number of conditions; nothing to choose from keeps no row."""
    return reduce(or_, conditions, F.lit(False))


def every(conditions: Iterable[Column]) -> Column:
    """AND over any number of conditions; no condition keeps every row."""
    return reduce(and_, conditions, F.lit(True))


def equals(df: DataFrame, column: str, value: Any) -> Column:
    return F.col(column) == typed_literal(df, column, value)


def one_of(df: DataFrame, column: str, values: Any) -> Column:
    """Membership test; a bare scalar counts as a one-element list."""
    members = values if isinstance(values, (list, tuple, set, frozenset)) else [values]
    dtype = column_type(df, column)
    return F.col(column).isin(*[literal_of(dtype, v, column) for v in members])


def within(df: DataFrame, column: str, low: Any, high: Any) -> Column:
    """Closed interval ``low <= column <= high``."""
    return F.col(column).between(typed_literal(df, column, low), typed_literal(df, column, high))


def text_matches(column: str, patterns: str | Iterable[str]) -> Column:
    """Unanchored, case-sensitive regex search for any of ``patterns``."""
    wanted = [patterns] if isinstance(patterns, str) else patterns
    return either(F.col(column).rlike(p) for p in wanted)
