"""Reading a table whose columns changed their types between writes.

Every write has one schema, and Spark puts the write's identifier into the names of its files, so
one footer a write tells the versions.  Each version is read once with its own schema and cast to
the narrowest type that holds the values of all of them exactly.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from duskwatch.functions.literals import quoted
from duskwatch.sources.tables import DEFAULT_FORMAT

# The types that hold every value of a type, narrowest first.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"),
    "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz", "timestamp"),
}
DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}

_WRITE = re.compile(r"part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})")


def common_type(one: T.DataType, two: T.DataType, name: str = "column") -> T.DataType:
    """The narrowest type that holds the values of both exactly; ValueError where none does."""
    if one == two or isinstance(two, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return two
    if isinstance(one, T.StructType) and isinstance(two, T.StructType):
        return common_schema([one, two], name)
    if isinstance(one, T.ArrayType) and isinstance(two, T.ArrayType):
        return T.ArrayType(common_type(one.elementType, two.elementType, f"{name}[]"))
    if isinstance(one, T.MapType) and isinstance(two, T.MapType) and one.keyType == two.keyType:
        return T.MapType(one.keyType, common_type(one.valueType, two.valueType, f"{name}{{}}"))
    a, b = one.simpleString(), two.simpleString()
    for wider in (a, *WIDER.get(a, ())):
        if wider in (b, *WIDER.get(b, ())):
            return next(t for t in (one, two, T.DoubleType()) if t.simpleString() == wider)
    exact = [_as_decimal(t) for t in (one, two)]
    if isinstance(one, T.DecimalType) | isinstance(two, T.DecimalType) and all(exact):
        scale = max(d.scale for d in exact)
        digits = max(d.precision - d.scale for d in exact) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    raise ValueError(f"{name} was written as {a} and as {b}, which no type holds exactly")


def _as_decimal(dtype: T.DataType) -> T.DecimalType | None:
    if isinstance(dtype, T.DecimalType):
        return dtype
    digits = DIGITS.get(dtype.simpleString())
    return T.DecimalType(digits, 0) if digits else None


def common_schema(schemas: Iterable[T.StructType], name: str = "") -> T.StructType:
    """All columns of ``schemas`` in order of appearance, by name regardless of case."""
    merged: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema:
            key = field.name.lower()
            known = merged.get(key, T.StructField(field.name, T.NullType()))
            path = f"{name}.{known.name}" if name else known.name
            merged[key] = T.StructField(known.name, common_type(known.dataType, field.dataType, path))
    return T.StructType(list(merged.values()))


def _cast(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(want, T.StructType):
        built = F.struct(*_fields(have, want, value.getField))
        return F.when(value.isNotNull(), built)
    if isinstance(want, T.ArrayType) and not isinstance(have, T.NullType):
        return F.transform(value, lambda v: _cast(v, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and not isinstance(have, T.NullType):
        return F.transform_values(value, lambda _, v: _cast(v, have.valueType, want.valueType))
    return value.cast(want)


def _fields(have: T.StructType, want: T.StructType, get) -> list[Column]:
    known = {f.name.lower(): f for f in have}
    columns = []
    for field in want:
        old = known.get(field.name.lower())
        if old is None:
            value = F.lit(None).cast(field.dataType)
        elif _plain(old.dataType) == _plain(field.dataType):
            value = get(old.name)
        else:
            value = _cast(get(old.name), old.dataType, field.dataType)
        columns.append(value.alias(field.name))
    return columns


def _plain(dtype: T.DataType) -> str:
    return dtype.simpleString().lower()


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``; columns it lacks are null."""
    return df.select(*_fields(df.schema, schema, lambda name: F.col(quoted(name))))


def read_versions(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """The table at ``path``, written under several schemas, as one.

    The driver opens one footer for each write that is still in the table, not for each file.
    Types that no type can unite without losing digits (text and numbers, long and double)
    raise ValueError, naming the column.
    """
    writes: dict[str, list[str]] = defaultdict(list)
    for uri in spark.read.format(fmt).load(path).inputFiles():
        file = unquote(uri)
        write = _WRITE.match(file.rsplit("/", 1)[-1])
        writes[write[1] if write else file].append(file)

    def reader():
        return spark.read.format(fmt).option("basePath", path)

    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def described(files: list[str]) -> tuple[int, T.StructType]:
        first = hadoop.Path(files[0])
        written = first.getFileSystem(conf).getFileStatus(first).getModificationTime()
        return written, reader().load(files[0]).schema

    groups = [sorted(writes[key]) for key in sorted(writes)]
    with ThreadPoolExecutor(8) as threads:
        told = list(threads.map(described, groups))
    versions: dict[str, tuple[T.StructType, list[str]]] = {}
    # in order of writing, which is that of the columns
    for (_, schema), files in sorted(zip(told, groups), key=lambda pair: (pair[0][0], pair[1][0])):
        versions.setdefault(schema.json(), (schema, []))[1].extend(files)
    merged = common_schema(schema for schema, _ in versions.values())
    parts = [conformed(reader().schema(schema).load(files), merged) for schema, files in versions.values()]
    return reduce(DataFrame.unionByName, parts)
