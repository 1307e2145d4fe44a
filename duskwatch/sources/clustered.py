"""A layout in which several columns each narrow down what a scan opens.

Every column is cut into ranges of about equal numbers of rows, and the bits of the ranges'
numbers are interleaved into one key by which rows are written.  A file or row group then spans
little of each column, so its least and greatest values let a scan for an entity, or for a time,
skip most of the table; sorted by one column, only that one would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from duskwatch.functions.literals import column_type, quoted
from duskwatch.sources.tables import DEFAULT_FORMAT, overwrite

BITS = 8  # of a column's range number: 256 ranges
SAMPLE = 10_000  # rows drawn to cut the ranges; decides how even they are, never which rows there are
_RANGE, _KEY = "__range", "__cluster"
_ORDERED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _bounds(df: DataFrame, columns: Sequence[str]) -> list[Column | None]:
    """Of each column an array of the 255 values that cut it evenly; None if it has no value."""
    drawn = df.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    drawn = drawn.orderBy(F.rand(1)).limit(SAMPLE)

    def cuts(name: str) -> Column:
        values = F.sort_array(F.collect_list(name))
        shares = F.lit([i / (1 << BITS) for i in range(1, 1 << BITS)])
        at = F.transform(shares, lambda share: F.get(values, F.floor(F.size(values) * share).cast("int")))
        return at.cast("array<string>").alias(name)

    found = drawn.agg(*[cuts(f"c{i}") for i in range(len(columns))]).first()
    return [
        None if None in found[i] else F.lit(found[i]).cast(T.ArrayType(column_type(df, c)))
        for i, c in enumerate(columns)
    ]


def _range_number(value: Column, bounds: Column | None) -> Column:
    """How many of the sorted ``bounds`` the value reaches, by halving; nulls are in range 0."""
    if bounds is None:
        return F.lit(0)
    return F.aggregate(
        F.lit([1 << bit for bit in reversed(range(BITS))]),
        F.lit(0),
        lambda at, step: F.when(value >= F.get(bounds, at + step - 1), at + step).otherwise(at),
    )


def with_cluster_key(df: DataFrame, columns: Sequence[str], key: str = _KEY) -> DataFrame:
    """Add the interleaved key of ``columns``, the first one leading.

    Takes one pass to draw a sample; the driver sees 255 values a column.
    """
    if not columns or len(columns) * BITS > 62:
        raise ValueError(f"between 1 and {62 // BITS} columns can be interleaved")
    for c in columns:
        if not isinstance(column_type(df, c), _ORDERED):
            raise ValueError(f"{c} has no order to lay out by: {column_type(df, c).simpleString()}")
    one, helpers = F.lit(1).cast("long"), []
    for i, (c, bounds) in enumerate(zip(columns, _bounds(df, columns))):
        helpers.append(f"{_RANGE}{i}")
        df = df.withColumn(helpers[-1], _range_number(F.col(quoted(c)), bounds).cast("long"))
    woven = F.lit(0).cast("long")
    for bit in range(BITS):
        for i, number in enumerate(helpers):
            place = bit * len(helpers) + len(helpers) - 1 - i
            woven = woven.bitwiseOR(F.shiftleft(F.shiftright(number, bit).bitwiseAND(one), place))
    return df.withColumn(key, woven).drop(*helpers)


def overwrite_clustered(
    df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, fmt: str = DEFAULT_FORMAT
) -> None:
    """Replace the table at ``path`` with ``df`` laid out by ``columns``; rows are unchanged.

    ``files`` is the number of ranges to write (the session's shuffle partitions by default).
    """
    keyed = with_cluster_key(df, columns)
    dealt = keyed.repartitionByRange(files, _KEY) if files else keyed.repartitionByRange(_KEY)
    overwrite(dealt.sortWithinPartitions(_KEY, *[quoted(c) for c in columns]).drop(_KEY), path, fmt)
