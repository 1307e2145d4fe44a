"""Python values as column literals of the right type, and names as SQL text.

Spark 4 compares under ANSI rules: a string column against an integer raises on the
first non-numeric row, at run time, somewhere in the cluster.  Converting the *literal*
to the column's type instead fails early, on the driver, and leaves the column bare so
the comparison still reaches the file scan as a pushed filter.
"""

from __future__ import annotations

from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

_TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def quoted(name: str) -> str:
    """A column name as SQL text, whatever characters it contains."""
    return "`" + name.replace("`", "``") + "`"


def column_type(df: DataFrame, column: str) -> T.DataType:
    """Type of ``column`` as Spark resolves it (case-insensitive, nested paths allowed)."""
    return df.select(F.col(column)).schema[0].dataType


def typed_literal(df: DataFrame, column: str, value: Any) -> Column:
    """``value`` as a literal that can be compared with ``df[column]`` without casting it.

    Columns pass through, ``None`` becomes a null of the column's type.
    """
    if isinstance(value, Column):
        return value
    return literal_of(column_type(df, column), value, column)


def literal_of(dtype: T.DataType, value: Any, label: str = "column") -> Column:
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.StringType):
        return F.lit(_as_text(value))
    if isinstance(dtype, _TIME_TYPES) and isinstance(value, (str, date, datetime)):
        return _moment_literal(dtype, value)
    if isinstance(dtype, T.BooleanType) and not isinstance(value, bool):
        return F.lit(_as_bool(value, label))
    if isinstance(dtype, T.NumericType) and isinstance(value, str):
        return F.lit(_as_number(value, dtype, label))
    return F.lit(value)


def _as_text(value: Any) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    return str(value)


def _as_bool(value: Any, label: str) -> bool:
    known = {"true": True, "false": False, "1": True, "0": False}
    try:
        return known[str(value).strip().lower()]
    except KeyError:
        raise ValueError(f"{label} is boolean; cannot compare it with {value!r}") from None


def _as_number(value: str, dtype: T.DataType, label: str) -> int | float:
    for parse in (int, float):
        try:
            return parse(value)
        except ValueError:
            continue
    raise ValueError(f"{label} is {dtype.simpleString()}; cannot compare it with {value!r}")


def _moment_literal(dtype: T.DataType, value: str | date | datetime) -> Column:
    # Through text, so that naive values mean wall-clock time in the *session* zone, not in
    # the zone of whichever Python process built the plan.
    if isinstance(value, str):
        return F.lit(value).cast(dtype)
    text = F.lit(value.isoformat(sep=" ") if isinstance(value, datetime) else value.isoformat())
    if getattr(value, "tzinfo", None) is not None:
        return text.cast(T.TimestampType()).cast(dtype)
    return text.cast(dtype)
