"""Projection, sort, join and aggregation helpers."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from duskwatch.functions.literals import quoted

# Rows of one key that a task takes before the key is divided; changes cost only.
PART_ROWS = 500_000
PART = "__part"


def select_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Keep the named columns in the given order; a list is accepted, repeats are allowed."""
    return df.select(*columns)


def distinct_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations of the named columns."""
    return select_columns(df, *columns).distinct()


def derive_by_category(
    df: DataFrame, new_column: str, column: str, categories: Sequence[str], inside: str, outside: str
) -> DataFrame:
    """Add ``new_column``: ``inside`` where ``column`` is one of ``categories``, else ``outside``."""
    label = F.when(F.col(column).isin(*categories), F.lit(inside)).otherwise(F.lit(outside))
    return df.withColumn(new_column, label)


def with_constant(df: DataFrame, new_column: str, value: Any, kind: str | None = None) -> DataFrame:
    """Add a column that has ``value`` in every row, of type ``kind`` where one is named."""
    constant = F.lit(value)
    return df.withColumn(new_column, constant if kind is None else constant.cast(kind))


def with_surrogate_ids(
    df: DataFrame, id_column: str, *order_by: str | Column, start: int = 0
) -> DataFrame:
    """Number rows in sort order: unique and increasing, but with gaps between partitions.

    Gaps are the price of not funnelling every row through one task.
    """
    ordered = df.orderBy(*order_by, *_tie_breaker(df)) if order_by else df
    return ordered.withColumn(id_column, F.monotonically_increasing_id() + F.lit(start))


def sort_by_column(df: DataFrame, column_name: str, ascending: bool = True) -> DataFrame:
    """Sort by one column; nulls come first ascending and last descending."""
    return sort_by_columns(df, column_name, ascending)


def sort_by_columns(
    df: DataFrame,
    column_names: str | Sequence[str],
    ascending: bool | Sequence[bool] = True,
) -> DataFrame:
    """Sort by several columns, with one direction for all of them or one for each."""
    names = [column_names] if isinstance(column_names, str) else list(column_names)
    directions = [ascending] * len(names) if isinstance(ascending, bool) else list(ascending)
    if len(names) != len(directions):
        raise AssertionError(f"{len(names)} sort columns but {len(directions)} directions")
    keys = [F.asc(name) if up else F.desc(name) for name, up in zip(names, directions)]
    return df.orderBy(*keys, *_tie_breaker(df, names))


def _tie_breaker(df: DataFrame, keys: Sequence[str] = ()) -> list[Column]:
    # A sort cuts the data into ranges of the sort key, and rows that tie cannot be cut apart:
    # a value owning a third of the table would become one task.  Ties have no promised order,
    # so ordering them by a hash of the other columns gives the cut something to work with.
    known = {k.lower() for k in keys}
    names = [f.name for f in df.schema if _hashable(f.dataType) and f.name.lower() not in known]
    repeated = {n for n, count in Counter(c.lower() for c in df.columns).items() if count > 1}
    usable = [F.col(quoted(n)) for n in names if n.lower() not in repeated]
    return [F.xxhash64(*usable)] if usable else []


def _hashable(kind: T.DataType) -> bool:
    """Whether Spark can hash values of a type: no maps or variants, at any depth."""
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def join_tables(df1: DataFrame, df2: DataFrame, join_column: str | Sequence[str]) -> DataFrame:
    """Inner join on equally named column(s), which appear once in the result.

    No hint: Spark picks broadcast or sort-merge from table sizes and splits skewed keys at
    run time.
    """
    return df1.join(df2, on=join_column, how="inner")


def spread_join(
    split: DataFrame,
    copied: DataFrame,
    key: str,
    by: str,
    how: str = "inner",
    target: int = PART_ROWS,
) -> DataFrame:
    """Equi-join in which a hot ``key`` of ``split`` is worked on by several tasks.

    A key with more than ``target`` rows in ``split`` gets one part for each ``target`` of them:
    its rows are divided by a hash of ``by``, and its rows of ``copied`` (few, or one) repeated
    for each part.  All other keys have one part and nothing of theirs is repeated.  Adaptive
    execution divides skewed keys too, but only where both inputs come straight from a shuffle,
    which an aggregate on the join key does not.
    """
    k = quoted(key)
    sizes = split.groupBy(key).agg(F.expr("count(1) AS __rows"))
    hot = sizes.where(f"__rows > {target} AND {k} IS NOT NULL").selectExpr(
        k, f"CAST(ceil(__rows / {target}) AS INT) AS __parts"
    )
    # at most one hot key for each ``target`` rows, so this side is small by construction
    hot = F.broadcast(hot)
    divided = split.join(hot, key, "left").selectExpr(
        *[quoted(c) for c in split.columns],
        f"CAST(pmod(xxhash64({quoted(by)}), coalesce(__parts, 1)) AS INT) AS {PART}",
    )
    repeated = copied.join(hot, key, "left").selectExpr(
        *[quoted(c) for c in copied.columns],
        f"explode(sequence(0, coalesce(__parts, 1) - 1)) AS {PART}",
    )
    return divided.join(repeated, [key, PART], how).drop(PART)


def aggregate_data(
    df: DataFrame,
    group_by_columns: Sequence[str],
    aggregation_columns: Sequence[str],
    aggregation_functions: Sequence[Callable[[str], Column]],
    alias_names: Sequence[str],
) -> DataFrame:
    """One output per (function, column, alias) triple, for each group.

    An empty ``group_by_columns`` aggregates the whole frame.  The three lists must have the
    same length.
    """
    sizes = {len(aggregation_columns), len(aggregation_functions), len(alias_names)}
    if len(sizes) != 1:
        raise ValueError("aggregation columns, functions and aliases must have equal lengths")
    outputs = [
        aggregate(name).alias(alias)
        for name, aggregate, alias in zip(aggregation_columns, aggregation_functions, alias_names)
    ]
    return df.groupBy(*group_by_columns).agg(*outputs)
