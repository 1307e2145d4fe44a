"""Tables written in numbered portions, each of them exactly once.

A portion is a folder ``portion=<first>-<last>`` and counts once Spark has marked it complete.
Writing a number again replaces its folder, so a batch that was repeated after a failure leaves
one copy of its rows.  Compaction writes one portion over the numbers of several; from the moment
it is complete readers take it instead of those it covers, which can be removed at leisure.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from duskwatch.sources.tables import overwrite

_NAME = re.compile(r"portion=(\d+)-(\d+)")
_COMPLETE = "_SUCCESS"

Span = tuple[int, int]


def _folder(path: str, span: Span) -> str:
    return f"{path.rstrip('/')}/portion={span[0]}-{span[1]}"


def _open(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _complete(spark: SparkSession, path: str) -> list[Span]:
    top, files = _open(spark, path)
    if not files.exists(top):
        return []
    found = []
    for status in files.listStatus(top):
        name = _NAME.fullmatch(status.getPath().getName())
        if name and files.exists(_open(spark, f"{path.rstrip('/')}/{name[0]}/{_COMPLETE}")[0]):
            found.append((int(name[1]), int(name[2])))
    return sorted(found, key=lambda span: (span[0], -span[1]))


def current_portions(spark: SparkSession, path: str) -> list[Span]:
    """The complete portions that no wider one covers, in order."""
    kept: list[Span] = []
    for span in _complete(spark, path):
        if not kept or span[1] > kept[-1][1]:
            kept.append(span)
    return kept


def write_portion(df: DataFrame, path: str, number: int) -> bool:
    """Make ``df`` the portion ``number``; one writer at a time.

    A number that a compacted portion covers is not written again (False): its rows are there.
    """
    for first, last in current_portions(df.sparkSession, path):
        if first <= number <= last and first < last:
            return False
    overwrite(df, _folder(path, (number, number)))
    return True


def read_portions(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All rows of the current portions; ``schema`` is needed only where there are none yet."""
    spans = current_portions(spark, path)
    if not spans:
        if schema is None:
            raise ValueError(f"no complete portion in {path}, and no schema to read none with")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*[_folder(path, span) for span in spans])


def compact(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame]) -> Span | None:
    """Write ``merge`` of the leading portions as one, up to the first number that is missing.

    Gives its span, or None where there is nothing to unite.  Killed before it is complete, it
    has changed nothing; the folders it covers stay until ``remove_covered``.
    """
    spans = current_portions(spark, path)
    leading = spans[:1]
    for span in spans[1:]:
        if span[0] != leading[-1][1] + 1:
            break
        leading.append(span)
    if len(leading) < 2:
        return None
    whole = (leading[0][0], leading[-1][1])
    rows = spark.read.parquet(*[_folder(path, span) for span in leading])
    overwrite(merge(rows), _folder(path, whole))
    return whole


def remove_covered(spark: SparkSession, path: str) -> int:
    """Delete the complete portions that a wider one covers, once no reader uses them."""
    kept = set(current_portions(spark, path))
    covered = [span for span in _complete(spark, path) if span not in kept]
    for span in covered:
        folder, files = _open(spark, _folder(path, span))
        files.delete(folder, True)
    return len(covered)
