"""Consecutive ids in sort order, without one task that sees all rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from duskwatch.operators.relational import _tie_breaker
from duskwatch.sources.staging import stage

_PLACE = "__place"
_WITHIN = (1 << 33) - 1  # bits that number the rows of a partition


def with_dense_ids(
    df: DataFrame, id_column: str, *order_by: str | Column, start: int = 0, folder: str | None = None
) -> DataFrame:
    """Number rows ``start``, ``start`` + 1, ... in sort order, nulls first; ties in any order.

    Two passes: a range sort, written with each row's partition and place in it, and then the
    number of rows of each partition, whose running sums are the offsets.  The driver holds one
    number for each partition.  Rows that tie are cut apart by a hash of the other columns, so a
    value that a third of the rows have is not one task.  This writes a table (see ``stage``) and
    therefore runs when called; ``with_surrogate_ids`` does not but leaves gaps.
    """
    if not order_by:
        raise ValueError("consecutive ids need an order")
    ordered = df.orderBy(*order_by, *_tie_breaker(df))
    placed = stage(ordered.withColumn(_PLACE, F.monotonically_increasing_id()), "ordered", folder)
    part = F.shiftright(F.col(_PLACE), 33)
    sizes = {r["part"]: r["count"] for r in placed.groupBy(part.alias("part")).count().collect()}
    numbers = sorted(sizes)
    before = dict(zip(numbers, accumulate([sizes[n] for n in numbers], initial=start)))
    offsets = F.create_map(*[F.lit(v) for n in numbers for v in (int(n), before[n])]) if numbers else None
    place = F.col(_PLACE).bitwiseAND(F.lit(_WITHIN))
    number = F.lit(start).cast("long") if offsets is None else (offsets[part.cast("int")] + place).cast("long")
    return placed.withColumn(id_column, number).drop(_PLACE)
