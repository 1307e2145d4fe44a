"""The n strongest, typed versions, clustered layouts, portions and event-time windows."""

import glob
import random
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import duskwatch as dw
from duskwatch.operators.strongest import strongest_per_entity
from duskwatch.plans.history import merged_totals, surges_in_totals, window_totals
from duskwatch.sources import portions
from duskwatch.sources.clustered import overwrite_clustered, with_cluster_key
from duskwatch.sources.tables import append, overwrite, read_path
from duskwatch.sources.versions import common_schema, common_type, read_versions
from duskwatch.streaming.tables import follow_path
from duskwatch.streaming.windows import (
    follow_closed_windows,
    follow_history,
    late_rows,
    threshold_in_windows,
    windowed_totals,
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- the n strongest ------------------------------------------------------------------------

def strongest_by_loop(rows, n):
    """(entity, score, name): nulls are least; equal rows count each."""
    out, groups = [], {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)

    def order(row):
        return [(v is not None, v if v is not None else "" if i else 0) for i, v in enumerate(row[1:])]

    for members in groups.values():
        for rank, row in enumerate(sorted(members, key=order, reverse=True)[:n], 1):
            out.append((*row, rank))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 3, 40])
def test_strongest_equals_a_loop(spark, rows, n):
    draw = random.Random(n)
    data = [
        ("hot" if i % 3 == 0 else draw.choice([None, "a", "b", "c", f"e{i}"]),
         draw.choice([None, *range(15)]), draw.choice([None, "x", "y", f"n{i % 90}"]))
        for i in range(4000)
    ]
    data += [("same", 7, "z")] * 500  # one row, often: more of it than are asked for
    df = spark.createDataFrame(data, "who string, score int, name string").repartition(6)
    assert rows(strongest_per_entity(df, "who", "score", n)) == strongest_by_loop(data, n)


def test_strongest_sorts_no_log_and_handles_nothing(spark):
    df = spark.range(3000).selectExpr("id % 5 AS who", "id AS score", "id AS extra")
    found = strongest_per_entity(df, "who", "score", 2)
    assert "Window" not in plan(found) and found.columns == ["who", "score", "extra", "rank"]
    assert strongest_per_entity(df.limit(0), "who", "score", 2).count() == 0
    with pytest.raises(ValueError):
        strongest_per_entity(df, "who", "score", 0)


# --- versions ---------------------------------------------------------------------------------

def test_common_types(spark):
    t = T.DataType.fromDDL
    for one, two, both in [
        ("int", "bigint", "bigint"), ("float", "double", "double"), ("int", "float", "double"),
        ("tinyint", "float", "float"), ("date", "timestamp", "timestamp"),
        ("date", "timestamp_ntz", "timestamp_ntz"), ("decimal(5,2)", "int", "decimal(12,2)"),
        ("void", "string", "string"), ("array<int>", "array<bigint>", "array<bigint>"),
        ("map<string,date>", "map<string,timestamp>", "map<string,timestamp>"),
    ]:
        assert common_type(t(one), t(two)).simpleString() == both
        assert common_type(t(two), t(one)).simpleString() == both
    for one, two in [("bigint", "double"), ("string", "int"), ("timestamp", "timestamp_ntz"), ("int", "boolean")]:
        with pytest.raises(ValueError, match="column was written as"):
            common_type(t(one), t(two))
    merged = common_schema([t("struct<A:int,s:struct<x:int>>"), t("struct<a:bigint,s:struct<X:bigint,y:string>>")])
    assert merged.simpleString() == "struct<A:bigint,s:struct<x:bigint,y:string>>"


def test_versions_are_read_as_one(spark, rows, tmp_path):
    path = str(tmp_path / "a log")
    overwrite(spark.sql("SELECT 1 AS id, 1.5f AS v, DATE'2024-01-02' AS d, struct(1 AS x) AS s, array(1) AS l"), path, merge_schema=True)
    append(spark.sql("SELECT 2L AS id, 2.5D AS v, TIMESTAMP_NTZ'2024-01-03 04:00:00' AS d, struct(2L AS x, 'y' AS y) AS s"), path)
    append(spark.sql("SELECT 3L AS ID, CAST(NULL AS struct<x:int>) AS s, 'new' AS extra, array(3L) AS l"), path)
    append(spark.sql("SELECT 4 AS id, 1.5f AS v, DATE'2024-01-02' AS d, struct(1 AS x) AS s, array(1) AS l"), path)
    found = read_versions(spark, path)
    types = {n.lower(): t for n, t in found.dtypes}
    assert types == {"id": "bigint", "v": "double", "d": "timestamp_ntz", "s": "struct<x:bigint,y:string>",
                     "l": "array<bigint>", "extra": "string"}
    got = {r["id"]: (r["v"], r["d"], r["s"] and tuple(r["s"]), r["l"], r["extra"]) for r in found.collect()}
    assert got == {
        1: (1.5, datetime(2024, 1, 2), (1, None), [1], None),
        2: (2.5, datetime(2024, 1, 3, 4), (2, "y"), None, None),
        3: (None, None, None, [3], "new"),
        4: (1.5, datetime(2024, 1, 2), (1, None), [1], None),
    }
    assert plan(found).count("FileScan") == 3  # one read a version, not a write
    append(spark.sql("SELECT 'five' AS id"), path)
    with pytest.raises(ValueError, match="(?i)id was written as"):
        read_versions(spark, path)


def test_versions_keep_folders_and_filters(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite(spark.sql("SELECT id, CAST(id % 3 AS INT) AS part FROM range(30)"), path, partition_by=["part"])
    append(spark.sql("SELECT CAST(id AS INT) AS id, CAST(id % 3 AS INT) AS part FROM range(30, 60)"), path, partition_by=["part"])
    found = read_versions(spark, path).where("part = 1 AND id > 40")
    assert sorted(r["id"] for r in found.collect()) == [43, 46, 49, 52, 55, 58]
    assert "PartitionFilters: [isnotnull(part" in plan(found) and "GreaterThan(id,40)" in plan(found)


# --- layout -----------------------------------------------------------------------------------

def groups_met(path, **ranges):
    """(row groups whose least and greatest values meet all ranges, all row groups)."""
    met = total = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics
                       for c in range(meta.num_columns)}
            total += 1
            met += all(columns[n].min <= high and low <= columns[n].max for n, (low, high) in ranges.items())
    return met, total


def test_layout_narrows_entity_and_time(spark, rows, tmp_path):
    base = datetime(2024, 1, 1)
    draw = random.Random(5)
    data = [
        ("user-hot" if i % 3 == 0 else f"user-{draw.randrange(4000):05d}", base + timedelta(seconds=draw.randrange(2_592_000)), i)
        for i in range(30_000)
    ] + [(None, None, -1), ("", base, -2)]
    df = spark.createDataFrame(data, "who string, ts timestamp_ntz, n int").repartition(32)
    before, after = str(tmp_path / "before"), str(tmp_path / "after")
    overwrite(df, before)
    overwrite_clustered(df, after, ["who", "ts"], files=32)
    assert rows(read_path(spark, after)) == rows(df)
    for ranges in ({"who": ("user-01234",) * 2}, {"ts": (datetime(2024, 1, 9), datetime(2024, 1, 10))}):
        (met, total), (now, parts) = groups_met(before, **ranges), groups_met(after, **ranges)
        assert met == total == 32 and parts >= 28 and now <= parts / 3, (ranges, now, parts)


def test_layout_of_odd_tables(spark, rows, tmp_path):
    df = spark.createDataFrame([(None, None)] * 3, "a int, b date")
    overwrite_clustered(df, str(tmp_path / "nulls"), ["a", "b"])
    assert read_path(spark, str(tmp_path / "nulls")).count() == 3
    overwrite_clustered(df.limit(0), str(tmp_path / "none"), ["a"])
    assert read_path(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        with_cluster_key(spark.sql("SELECT map(1, 2) AS m"), ["m"])
    numbers = spark.range(4096).selectExpr("CAST(id AS DOUBLE) AS x")
    keys = [r[0] for r in with_cluster_key(numbers, ["x"], "k").orderBy("x").select("k").collect()]
    assert keys == sorted(keys) and len(set(keys)) > 200  # one column: its own order


# --- portions ---------------------------------------------------------------------------------

def test_portions_replace_themselves_and_compact(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    with pytest.raises(ValueError):
        portions.read_portions(spark, path)
    assert portions.read_portions(spark, path, "k int, volume bigint").count() == 0

    def part(*volumes):
        return spark.createDataFrame([(k, v) for k, v in enumerate(volumes)], "k int, volume bigint")

    for number, volumes in enumerate([(1, 2), (3,), (4, 5, 6)]):
        assert portions.write_portion(part(*volumes), path, number)
    assert portions.write_portion(part(3), path, 1)  # repeated
    portions.write_portion(part(100), path, 4)  # 3 is missing: not united over the gap
    (tmp_path / "p" / "portion=5-5").mkdir()  # killed before it was complete
    total = [(0, 108), (1, 7), (2, 6)]

    def totals():
        return rows(merged_totals(portions.read_portions(spark, path)))

    assert totals() == total
    assert portions.compact(spark, path, merged_totals) == (0, 2)
    assert portions.current_portions(spark, path) == [(0, 2), (4, 4)]
    assert totals() == total  # those it covers are still there
    assert not portions.write_portion(part(3), path, 1)
    assert portions.remove_covered(spark, path) == 3
    assert totals() == total and portions.compact(spark, path, merged_totals) is None


def test_history_survives_a_batch_that_dies(spark, rows, tmp_path, monkeypatch):
    log, path, marks = (str(tmp_path / n) for n in ("log", "history", "marks"))
    draw = random.Random(2)
    data = [(f"u{draw.randrange(4)}", datetime(2024, 1, 1) + timedelta(hours=draw.randrange(700))) for _ in range(900)]
    data += [("u1", datetime(2024, 1, 30, 1))] * 60
    events = spark.createDataFrame(data, "who string, t timestamp")
    overwrite(events.repartition(3), log)

    from duskwatch.streaming import windows

    real, died = windows.write_portion, []

    def dies_once(rows_, where, number):
        real(rows_, where, number)
        if number == 1 and not died:
            died.append(number)
            raise RuntimeError("killed after writing, before the batch was committed")

    monkeypatch.setattr(windows, "write_portion", dies_once)

    def follow():
        stream = follow_path(spark, log, events.schema, files_per_batch=1)
        return follow_history(stream, path, marks, "who", "t").awaitTermination()

    with pytest.raises(Exception, match="killed"):
        follow()
    follow()
    assert died and portions.current_portions(spark, path) == [(0, 0), (1, 1), (2, 2)]
    limits = {"as_of": "2024-01-30 12:00:00", "z_score_threshold": 2.0}
    expected = rows(dw.statistically_significant_window_by_std(events, "who", "t", **limits))
    assert expected and rows(surges_in_totals(portions.read_portions(spark, path), "who", "t", **limits)) == expected
    portions.compact(spark, path, merged_totals)
    assert rows(surges_in_totals(portions.read_portions(spark, path), "who", "t", **limits)) == expected
    assert rows(merged_totals(portions.read_portions(spark, path))) == rows(window_totals(events, "who", "t"))


# --- event time -------------------------------------------------------------------------------

NOON = datetime(2024, 3, 30, 12)
SCHEMA = "who string, t {}, v int"


def feed(spark, schema, chunks, tmp_path, lateness):
    """Follow ``chunks`` one by one, each call restarting from the checkpoint; (closed, log)."""
    log, path, marks = (str(tmp_path / n) for n in ("log", "closed", "marks"))
    for chunk in chunks:
        append(spark.createDataFrame(chunk, schema).coalesce(1), log)
        stream = follow_path(spark, log, T.StructType.fromDDL(schema))
        totals = windowed_totals(stream, "t", ["who"], "1 hour", lateness, "v")
        follow_closed_windows(totals, path, marks).awaitTermination()
    return portions.read_portions(spark, path), read_path(spark, log)


def events_in_chunks():
    draw = random.Random(9)
    rows = [(draw.choice(["a", "b", None]), NOON + timedelta(seconds=draw.randrange(30_000)), draw.randrange(9))
            for _ in range(600)]
    rows.sort(key=lambda r: r[1])
    return [rows[i : i + 200] for i in (0, 200, 400)]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 2, 0)])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_closed_windows_equal_the_batch_rule_in_any_order(spark, rows, tmp_path, order, kind):
    chunks = events_in_chunks()
    end = [("a", NOON + timedelta(hours=40), 1), ("a", None, 1)]  # closes all that was before
    closed, log = feed(spark, SCHEMA.format(kind), [*(chunks[i] for i in order), end], tmp_path, "20 hours")
    batch = windowed_totals(log, "t", ["who"], "1 hour", sum_column="v")
    batch = batch.where(F.col("window_end") <= F.lit(NOON + timedelta(hours=20)).cast(kind))
    assert rows(closed) == rows(batch) and closed.count() > 20
    assert rows(threshold_in_windows(closed, 100)) == rows(batch.where("volume > 100"))
    assert late_rows(closed, log, "t", ["who"]).count() == 0


def test_late_rows_are_counted(spark, rows, tmp_path):
    chunks = [
        [("a", NOON, 1), ("b", NOON + timedelta(hours=5), 1)],
        [("a", NOON + timedelta(minutes=1), 1), ("a", NOON + timedelta(minutes=2), 1), (None, NOON, 1),
         ("b", NOON + timedelta(hours=9), 1)],
    ]
    closed, log = feed(spark, SCHEMA.format("timestamp"), chunks, tmp_path, "10 minutes")
    assert rows(closed, "who", "rows") == [("a", 1), ("b", 1)]
    assert rows(late_rows(closed, log, "t", ["who"]), "who", "late") == [("a", 2), (None, 1)]


def test_zone_less_windows_ignore_the_zone(spark, rows):
    """The clock change of the zone lies in the data; the day is the wall's."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        log = spark.createDataFrame(
            [("a", datetime(2024, 3, 31, h, 30, 0, 250_000), 1) for h in range(24)], SCHEMA.format("timestamp_ntz")
        )
        day = windowed_totals(log, "t", ["who"], "1 day")
        assert rows(day, "window_start", "rows") == [(datetime(2024, 3, 31), 24)]
        hours = windowed_totals(log, "t", ["who"])
        assert sorted(rows(hours, "window_start")) == [(datetime(2024, 3, 31, h),) for h in range(24)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
