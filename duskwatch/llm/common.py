"""Helpers shared by the corpus operators.

Every operator reads the columns it is told to and ignores the rest, so extra columns of any
name do no harm.  Work on texts runs inside tasks over Arrow batches; a task holds one batch
of texts, never a partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS = 1000  # in a batch


def small_batches(spark: SparkSession) -> None:
    """Hand whole documents to Python in batches of ``TEXTS`` where the session does not say.

    Spark's own ten thousand is meant for rows of numbers; with long texts, and a batch held by
    the JVM, by Arrow and by Python each, it is most of what a worker takes.
    """
    if int(spark.conf.get(BATCH)) == 10_000:
        spark.conf.set(BATCH, str(TEXTS))


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def per_text(make: Callable[[], Callable], schema: str) -> Callable[[Column], Column]:
    """A function from a text column to a struct column of type ``schema``.

    ``make`` is called once per task; what it returns maps one text (or None) to the values
    of the struct.  The result is marked non-deterministic so that Spark evaluates it once,
    however often its fields are used.
    """
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = make()
        for texts in batches:
            yield pd.DataFrame([one(t) for t in texts.tolist()], columns=names)

    # annotations are strings here; Spark needs the types themselves
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, schema).asNondeterministic()


def with_results(df: DataFrame, result: Column, keep: list[str], fields: list[str]) -> DataFrame:
    """Columns ``keep`` of ``df`` and ``fields`` of the struct column ``result``."""
    held = [F.col(name).alias(f"kept_{i}") for i, name in enumerate(keep)]
    joined = df.select(*held, result.alias("result"))
    return joined.select(
        *[F.col(f"kept_{i}").alias(name) for i, name in enumerate(keep)],
        *[F.col("result")[name].alias(name) for name in fields],
    )
