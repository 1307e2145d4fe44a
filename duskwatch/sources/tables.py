"""Tables in and out, addressed by catalog name or by path."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DEFAULT_FORMAT = "parquet"


def get_table(table_name: str, spark: SparkSession | None = None) -> DataFrame:
    """Catalog table or view by name, in ``spark`` or else the active session."""
    return (spark or _active_session()).table(table_name)


def read_path(
    spark: SparkSession,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    schema: T.StructType | str | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Table stored at ``path``.

    ``merge_schema`` unions the columns of files written before and after a column was added.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.load(path)


def sql_over_path(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = ("*",),
    where: str | None = None,
    args: Mapping[str, Any] | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> DataFrame:
    """SQL straight over a stored table.

    Values belong in ``args``, referenced as ``:name`` in ``where``, so that no text taken
    from a log becomes part of the statement.
    """
    if not re.fullmatch(r"\w+", fmt) or "`" in path:
        raise ValueError("fmt must be a plain word and path must not contain a backtick")
    statement = f"SELECT {', '.join(columns)} FROM {fmt}.`{path}`"
    if where is not None:
        statement += f" WHERE {where}"
    return spark.sql(statement, args=dict(args or {}))


def local_rows(
    spark: SparkSession, rows: Iterable[Any], schema: T.StructType | str | Sequence[str] | None = None
) -> DataFrame:
    """Small frame from Python rows, with a declared, a named or an inferred schema."""
    return spark.createDataFrame(list(rows), schema=schema)


def overwrite(
    df: DataFrame,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    merge_schema: bool = False,
    partition_by: Sequence[str] = (),
) -> None:
    """Replace the table at ``path``; ``merge_schema`` lets the new rows bring new columns.

    With ``partition_by`` (a day column, say) later filters on it skip whole folders.  Rows are
    first brought together by that column, in portions of even size: a folder gets few files, and
    a day holding a third of the log still gets as many writers as it needs.
    """
    _write(df, path, "overwrite", fmt, merge_schema, partition_by)


def append(
    df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, partition_by: Sequence[str] = ()
) -> None:
    """Add rows to the table at ``path``; ``partition_by`` as for ``overwrite``."""
    _write(df, path, "append", fmt, False, partition_by)


def _write(
    df: DataFrame, path: str, mode: str, fmt: str, merge_schema: bool, partition_by: Sequence[str]
) -> None:
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if merge_schema:
        writer = writer.option("mergeSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def _active_session() -> SparkSession:
    session = SparkSession.getActiveSession()
    if session is None:
        raise RuntimeError("no active Spark session; pass one explicitly")
    return session
