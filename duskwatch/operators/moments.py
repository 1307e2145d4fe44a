"""Counts, means and squared deviations that can be stored by day and merged.

A state is (n, origin, mean, m2): the mean as a distance from the origin, and the sum of squared
differences from the mean.  A double near 1e9 ends at its seventh decimal, and so would a mean
stored there; with an origin near the values it keeps all its digits.  Merging adds what the
means differ by, measured from one of them.  With states of past days stored, statistics of a
long log cost a few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def moment_states(
    df: DataFrame, column: str, by: Sequence[str | Column] = (), origin: float = 0.0
) -> DataFrame:
    """(by..., n, origin, mean, m2) of the non-null values of ``column``; n is 0 without any."""
    value = F.col(column).cast("double") - F.lit(float(origin))
    return df.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.lit(float(origin)).alias("origin"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("m2"),
    )


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of all rows with equal ``by`` (of all rows, if empty) as one state each.

    States of different origins merge too; the result has the least of them.
    """
    some = states.where("n > 0")
    base = F.min(F.struct("origin", "mean"))
    if by:
        # one row for each state of a group: days, not events
        base = base.over(Window.partitionBy(*by))
    else:
        base = some.agg(base).scalar()
    off = (F.col("mean") - F.col("__base.mean")) + (F.col("origin") - F.col("__base.origin"))
    shifted = some.withColumn("__base", base).withColumn("__off", off)
    sums = shifted.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.min("__base").alias("__base"),
        F.sum(F.col("n") * F.col("__off")).alias("__first"),
        F.sum(F.col("m2") + F.col("n") * F.col("__off") * F.col("__off")).alias("__second"),
    )
    off = F.col("__first") / F.col("n")
    return sums.select(
        *by, "n", F.col("__base.origin").alias("origin"), (F.col("__base.mean") + off).alias("mean"),
        F.greatest(F.col("__second") - F.col("n") * off * off, F.lit(0.0)).alias("m2"),
    )


def deviation(n: str = "n", m2: str = "m2") -> Column:
    """Sample standard deviation of a state; null for fewer than two values."""
    return F.when(F.col(n) > 1, F.sqrt(F.col(m2) / (F.col(n) - 1)))


def outliers_in_states(
    df: DataFrame, column: str, states: DataFrame, z_score_threshold: float = 3.0
) -> DataFrame:
    """Rows of ``df`` beyond the deviations that stored ``states`` tell.

    ``statistical_anomaly_detection`` with the statistics taken from states instead of from
    ``df`` itself: a day can be judged against a year without reading the year.
    """
    merged = merge_states(states).withColumn("deviation", deviation())
    stats = merged.agg(F.max(F.struct("origin", "mean", "deviation"))).scalar()
    origin, mean, spread = (stats.getField(name) for name in ("origin", "mean", "deviation"))
    away = F.abs(F.col(column) - origin - mean)
    found = df.where(away > spread * F.lit(float(z_score_threshold)))
    return found.withColumn("Mean", origin + mean).withColumn("stddev", spread)
