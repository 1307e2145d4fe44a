"""Following a stored log, and keeping what a filter finds in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from duskwatch.sources.tables import DEFAULT_FORMAT


def follow_path(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = DEFAULT_FORMAT,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The table at ``path`` as a stream of its present and future files."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def append_found(
    found: DataFrame, path: str, checkpoint: str, fmt: str = DEFAULT_FORMAT
) -> StreamingQuery:
    """Append a filtered stream to the table at ``path``, process all there is, then stop.

    ``checkpoint`` remembers what was processed, so the next call only sees new files.
    """
    writer = found.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(path)
