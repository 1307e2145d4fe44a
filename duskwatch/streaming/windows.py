"""Threshold rules on event time, and histories kept from a stream.

Both write what a batch gives as the portion of that batch's number (``sources/portions.py``), so
a batch that Spark repeats after a failure replaces itself.  A table of portions belongs to one
checkpoint: with another one, numbers would start again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from duskwatch.functions.literals import column_type
from duskwatch.plans.history import window_totals
from duskwatch.sources.portions import write_portion

START, END, ROWS, VOLUME = "window_start", "window_end", "rows", "volume"


def _instant(wall: Column) -> Column:
    """The moment at which clocks in UTC show a zone-less time; a watermark needs a moment."""
    micros = (F.extract(F.lit("SECOND"), wall) * 1_000_000).cast("bigint") % 1_000_000
    return F.timestamp_micros(F.unix_timestamp(wall) * 1_000_000 + micros)


def _wall(instant: Column) -> Column:
    """What clocks in UTC show at a moment."""
    seconds = (F.unix_micros(instant).cast("decimal(18,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def windowed_totals(
    log: DataFrame,
    timestamp_column: str,
    keys: Sequence[str],
    window: str = "1 hour",
    lateness: str = "10 minutes",
    sum_column: str | None = None,
) -> DataFrame:
    """(keys..., window_start, window_end, rows, volume) of event-time windows.

    On a stream in append mode a window is given once, when the greatest time seen is ``lateness``
    past its end; rows that come later still are left out (see ``late_rows``).  State is one row
    for each open window and key.  On a stored log it gives every window.  Rows without a time
    are in no window; zone-less times are cut as they stand, whatever the session's zone.
    """
    zone_less = isinstance(column_type(log, timestamp_column), T.TimestampNTZType)
    if zone_less:
        log = log.withColumn(timestamp_column, _instant(F.col(timestamp_column)))
    volume = F.count(F.lit(1)) if sum_column is None else F.sum(sum_column)
    marked = log.withWatermark(timestamp_column, lateness)
    totals = marked.groupBy(F.window(timestamp_column, window).alias("__window"), *keys).agg(
        F.count(F.lit(1)).alias(ROWS), volume.alias(VOLUME)
    )
    ends = {START: F.col("__window.start"), END: F.col("__window.end")}
    shown = [(_wall(end) if zone_less else end).alias(name) for name, end in ends.items()]
    return totals.select(*keys, *shown, ROWS, VOLUME)


def threshold_in_windows(totals: DataFrame, threshold: float) -> DataFrame:
    """Keys and windows whose volume is above ``threshold``."""
    return totals.where(F.col(VOLUME) > threshold)


def late_rows(
    closed: DataFrame,
    log: DataFrame,
    timestamp_column: str,
    keys: Sequence[str],
    window: str = "1 hour",
) -> DataFrame:
    """(keys..., window_start, late): rows of ``log`` that came after their window was ``closed``.

    Compares what the stream counted with the stored log, for windows up to the last closed one.
    """
    last = closed.agg(F.max(END)).scalar()
    there = windowed_totals(log, timestamp_column, keys, window).where(F.col(END) <= last)
    names = [*keys, START]
    counted = closed.select(*[F.col(c).alias(f"__{c}") for c in names], F.col(ROWS).alias("__rows"))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in names))
    late = F.col(ROWS) - F.coalesce("__rows", F.lit(0))
    return there.join(counted, same, "left").select(*names, late.alias("late")).where("late > 0")


def _follow(rows: DataFrame, write, checkpoint: str) -> StreamingQuery:
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(write).trigger(availableNow=True).start()


def follow_closed_windows(totals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add the closed windows of a streamed ``windowed_totals``, then stop; call again for more."""
    return _follow(totals, lambda rows, number: write_portion(rows, path, number), checkpoint)


def follow_history(
    log: DataFrame,
    path: str,
    checkpoint: str,
    comparative_column: str,
    timestamp_column: str = "_event_time",
    window: str = "day",
    count_column: str | None = None,
) -> StreamingQuery:
    """Add the new rows' totals to the history at ``path``, then stop; call again for more.

    ``surges_in_totals(read_portions(...))`` is the own-history rule over all that was followed.
    """

    def add(rows: DataFrame, number: int) -> None:
        totals = window_totals(rows, comparative_column, timestamp_column, window, count_column)
        write_portion(totals, path, number)

    return _follow(log, add, checkpoint)
