"""The n strongest rows of each entity, without sorting an entity's rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from duskwatch.sources.staging import stage

# Draws for each row asked for: with four the rows kept exceed n by about an eighth.
SPREAD = 4


def strongest_per_entity(
    df: DataFrame, entity: str, by: str | Sequence[str], n: int = 1, folder: str | None = None
) -> DataFrame:
    """The ``n`` rows of each ``entity`` that are greatest in ``by``, with their ``rank`` from 1.

    The columns of ``by`` are compared in turn, nulls last; ties go to the row that is greater in
    the other columns, in name order.  Equal rows count each, and a null entity is one entity.

    Two passes, no sort of an entity's rows.  The first deals rows to ``SPREAD`` x n buckets by
    their hash and takes the greatest of each: n distinct rows reach the n-th greatest of these
    maxima, so no row below it can be among the n.  The second keeps what reaches that bound, a
    little over n rows of each entity whatever its share of the log.  Both combine rows before
    they shuffle.  The bounds are written as a table (see ``stage``), so this runs when called.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    first = [by] if isinstance(by, str) else list(by)
    others = sorted(c for c in df.columns if c not in (entity, *first))
    row = F.struct(*first, *others)
    rows = df.select(F.col(entity).alias("entity"), row.alias("row"))

    bucket = F.pmod(F.xxhash64("row"), F.lit(SPREAD * n))
    best = rows.groupBy("entity", bucket.alias("bucket")).agg(F.max("row").alias("row"))
    # at most SPREAD x n rows an entity; get() is null for an entity that fills fewer than n
    falling = F.sort_array(F.collect_list("row"), asc=False)
    bounds = best.groupBy("entity").agg(F.get(falling, F.lit(n - 1)).alias("bound"))
    bounds = stage(bounds.where("bound IS NOT NULL").withColumnRenamed("entity", "of"), "bounds", folder)

    reaching = rows.join(bounds, F.col("entity").eqNullSafe(F.col("of")), "left").where(
        "bound IS NULL OR row >= bound"
    )
    distinct = reaching.groupBy("entity", "row").agg(F.least(F.count("*"), F.lit(n)).alias("copies"))
    kept = distinct.groupBy("entity").agg(
        F.sort_array(F.collect_list(F.struct("row", "copies")), asc=False).alias("rows")
    )
    each = F.flatten(F.transform("rows", lambda r: F.array_repeat(r["row"], r["copies"].cast("int"))))
    ranked = kept.select("entity", F.posexplode(F.slice(each, 1, n)).alias("place", "row"))
    values = {entity: F.col("entity"), **{c: F.col("row").getField(c) for c in (*first, *others)}}
    return ranked.select(
        *[values[c].alias(c) for c in df.columns], (F.col("place") + 1).alias("rank")
    )
