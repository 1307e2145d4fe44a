"""Values as tables, consecutive ids, stored moments and hand-offs written once."""

import random
import re
import statistics
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from duskwatch.operators import moments
from duskwatch.operators.feeds import (
    filter_column_by_pattern_table,
    filter_column_by_range_table,
    matched_values,
    required_texts,
    united_ranges,
)
from duskwatch.operators.handoff import append_once
from duskwatch.operators.numbering import with_dense_ids
from duskwatch.operators.relational import with_constant
from duskwatch.sources.tables import read_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_constant_has_the_named_type(spark):
    df = with_constant(spark.range(3), "unit", 1, "short")
    assert dict(df.dtypes)["unit"] == "smallint" and {r["unit"] for r in df.collect()} == {1}
    assert dict(with_constant(spark.range(1), "unit", "x").dtypes)["unit"] == "string"


def test_dense_ids_are_row_numbers(spark):
    draw = random.Random(1)
    rows = [(0 if i % 3 == 0 else draw.randrange(50), i) for i in range(5000)] + [(None, 5000), (None, 5001)]
    df = spark.createDataFrame(rows, "k int, i int").repartition(7)
    got = [(r["k"], r["i"], r["id"]) for r in with_dense_ids(df, "id", "k", "i", start=10).collect()]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted(got, key=lambda r: r[2]) == [(k, i, n) for n, (k, i) in enumerate(ordered, 10)]
    tied = with_dense_ids(df, "id", "k")
    assert sorted(r["id"] for r in tied.collect()) == list(range(len(rows)))
    by_id = sorted((r["id"], -1 if r["k"] is None else r["k"]) for r in tied.collect())
    assert [k for _, k in by_id] == sorted(k for _, k in by_id)
    assert "SinglePartition" not in plan(with_dense_ids(df, "id", "k"))
    assert with_dense_ids(df.limit(0), "id", "k").count() == 0
    with pytest.raises(ValueError):
        with_dense_ids(df, "id")


BASE = datetime(2024, 1, 1)


@pytest.mark.parametrize("kind", ["int", "double", "timestamp", "timestamp_ntz", "date"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_range_table_keeps_what_any_range_holds(spark, kind, seed):
    draw = random.Random(seed)
    make = {
        "int": lambda x: x,
        "double": lambda x: x / 7,
        "date": lambda x: date(2024, 1, 1) + timedelta(days=x),
    }.get(kind, lambda x: BASE + timedelta(seconds=x, microseconds=x % 3))
    values = [draw.randrange(10_000) for _ in range(400)] + [5] * 200
    ranges = []
    for _ in range(60):
        low = draw.randrange(10_000)
        ranges.append((low, low + draw.choice((-5, 0, 3, 40, 400))))
    ranges += [ranges[0], (5, 5), (100, 9_000) if seed == 3 else (9_999, 10_020)]
    rows = [(i, make(v)) for i, v in enumerate(values)] + [(9999, None)]
    df = spark.createDataFrame(rows, f"i int, low {kind}")  # a column that the ranges have too
    table = spark.createDataFrame([(make(a), make(b)) for a, b in ranges] + [(None, make(3)), (make(3), None)], f"low {kind}, high {kind}")
    got = filter_column_by_range_table(df, "low", table)
    assert sorted(r["i"] for r in got.collect()) == [i for i, v in enumerate(values) if any(a <= v <= b for a, b in ranges)]
    assert got.columns == df.columns and "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    assert filter_column_by_range_table(df, "low", table.limit(0)).count() == 0
    assert filter_column_by_range_table(df.limit(0), "low", table).count() == 0


def test_united_ranges_do_not_overlap(spark):
    ranges = spark.createDataFrame([(i, i + 30) for i in range(0, 1000, 7)] * 3 + [(5000, 5001), (0, 990)], "low int, high int")
    found = [(r["low_at"], r["high_at"]) for r in united_ranges(ranges).orderBy("low_at").collect()]
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))
    assert len(found) < 300
    one = united_ranges(spark.createDataFrame([(7, 7)] * 5, "low int, high int")).collect()
    assert [(r["low"], r["high"]) for r in one] == [(7, 7)]
    with pytest.raises(ValueError):
        united_ranges(spark.createDataFrame([("a", "b")], "low string, high string"))


@pytest.mark.parametrize(
    "pattern, texts",
    [
        ("evil\\.example", ["evil", "example"]),
        ("abc+d", ["abc"]),
        ("abcd?ef", ["abc"]),
        ("abcd*", ["abc"]),
        ("abcd{2}efg", ["abc", "efg"]),
        ("abc|def", []),
        ("(abc|def)ghi", ["ghi"]),
        ("(abc(x|y))?ghi[^a-z]jkl", ["ghi", "jkl"]),
        ("(?i)abc", []),
        ("abc(?=def)ghi", ["abc", "ghi"]),
        ("\\Qa.c\\Eabc", []),
        ("[]abc]def", ["def"]),
        ("[a[bc]]def", ["def"]),
        ("^abc.def$", ["abc", "def"]),
        ("ab", []),
        ("", []),
        ("\\d+abcd\\w*", ["abcd"]),
        ("abc\\", []),
    ],
)
def test_required_texts(spark, pattern, texts):
    df = spark.createDataFrame([(pattern,)], "p string")
    assert df.select(required_texts(F.col("p"))).first()[0] == texts


def test_pattern_table_is_the_or_of_its_patterns(spark):
    draw = random.Random(4)
    parts = ["abc", "bcd", "x+", "y?", "[ab]c", "(ab|cd)", ".", "\\d", "z*", "é1é", "^", "$", "a{2}", "(?:ca)", "|", "\\.", "(?i)AB"]
    patterns = ["".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(150)]
    patterns = [p for p in patterns if p.strip("|^$") and not p.endswith("^*")]
    texts = ["".join(draw.choices("abcdxyzé1.A", k=draw.randint(0, 12))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None), (901, texts[0])]
    df = spark.createDataFrame(rows, "i int, value string")
    for some in (patterns[:40], patterns[40:], [p for p in patterns if "|" not in p and "*" not in p][:25], []):
        feed = spark.createDataFrame([(p,) for p in some] + [(None,)], "pattern string")
        either = F.lit(False)
        for p in some:
            either = either | F.col("value").rlike(p)
        want = sorted(r["i"] for r in df.where(either).collect())
        got = filter_column_by_pattern_table(df, "value", feed)
        assert sorted(r["i"] for r in got.collect()) == want
    assert matched_values(df.limit(0), "value", feed).count() == 0


@pytest.fixture
def unsent(spark):
    """Joins as on tables that are too large to be sent to all tasks."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def shuffled_rows(df):
    """Rows that the plan of a collected frame has dealt out, without those of subqueries."""

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind.startswith("Reused"):
            return 0
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().get("shuffleRecordsWritten").get().value() if kind == "ShuffleExchangeExec" else 0
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


def found_in(patterns, texts):
    return sorted(t for t in set(texts) if any(re.search(p, t) for p in patterns))


def test_patterns_meet_only_values_with_their_whole_text(spark, unsent):
    draw = random.Random(6)
    texts = ["".join(draw.choices("ab", k=16)) for _ in range(600)]  # any three letters are in most of them
    patterns = [t[2:16] + "$" for t in texts[:200]] + ["".join(draw.choices("ab", k=14)) + "$" for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    feed = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    got = matched_values(df, "value", feed)
    assert sorted(r["value"] for r in got.collect()) == found_in(patterns, texts)
    assert shuffled_rows(got) < 25_000  # 510,992 with all pairs


def test_patterns_that_share_their_only_text_are_not_listed_by_value(spark, unsent):
    texts = [f"Clerk#{n:06d}" for n in range(1500)]
    patterns = [f"Clerk#0*{n}$" for n in range(1, 100)] + [f"Clerk#0+{n}[05]?$" for n in range(1, 100)]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    feed = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    got = matched_values(df, "value", feed)
    assert sorted(r["value"] for r in got.collect()) == found_in(patterns, texts)
    assert shuffled_rows(got) < 50_000  # 615,155 with all pairs


def test_values_of_any_length_meet_their_patterns(spark):
    draw = random.Random(7)
    texts = ["".join(draw.choices("abcdeé ", k=k)) for k in (0, 1, 2, 3, 5, 15, 16, 17, 255, 256, 257, 271, 272, 600, 1200) * 4]
    parts = [t[i : i + k] for t in texts if len(t) > 200 for i in range(0, len(t), 97) for k in (3, 4, 7, 11, 16, 20)]
    patterns = [p for p in parts if len(p) > 2] + ["é" * 9 + f"x{n}?" for n in range(40)] + ["^$"]
    df = spark.createDataFrame([(t,) for t in texts + ["é" * 9] + ["a" * 600 + "é" * 9]], "value string")
    for some in (patterns, patterns[4:5]):
        feed = spark.createDataFrame([(p,) for p in some], "pattern string")
        got = sorted(r["value"] for r in matched_values(df, "value", feed).collect())
        assert got == found_in(some, texts + ["é" * 9, "a" * 600 + "é" * 9])


def test_patterns_follow_the_collation(spark):
    df = spark.createDataFrame([("xxABCDEFG",), ("abcdefg",), ("zz",)], "value string")
    feed = spark.createDataFrame([("abcd",), ("def[gh]",)], "pattern string")
    df, feed = (d.select(F.collate(d.columns[0], "UTF8_LCASE").alias(d.columns[0])) for d in (df, feed))
    assert sorted(r["value"] for r in matched_values(df, "value", feed).collect()) == ["abcdefg", "xxABCDEFG"]


def test_malformed_patterns_fail_whatever_they_meet(spark):
    df = spark.createDataFrame([("abcx",)], "value string")
    for pattern in ("*abcdefgh", "abc(", "abc[", "abcdefg{"):
        with pytest.raises(Exception):
            matched_values(df, "value", spark.createDataFrame([(pattern,)], "pattern string")).collect()


def test_merged_moments_are_those_of_all_values(spark):
    draw = random.Random(5)
    rows = [(i % 3, i % 11, 1e9 + draw.gauss(0, 2) + i % 11) for i in range(3000)] + [(7, 0, None), (8, 1, 1e9)]
    df = spark.createDataFrame(rows, "g int, day int, v double")
    states = moments.moment_states(df, "v", ["g", "day"], origin=1e9)
    by_hand = {}
    for g, _, v in rows:
        by_hand.setdefault(g, []).extend([] if v is None else [v - 1e9])
    merged = moments.merge_states(states, ["g"]).withColumn("s", moments.deviation()).collect()
    assert {r["g"] for r in merged} == {0, 1, 2, 8}
    for r in merged:
        values = by_hand[r["g"]]
        assert r["n"] == len(values) and abs(r["mean"] - statistics.fmean(values)) < 1e-9
        assert r["s"] is None if r["n"] < 2 else abs(r["s"] - statistics.stdev(values)) < 1e-9
    whole = [v for values in by_hand.values() for v in values]
    other = moments.moment_states(df.where("day > 5"), "v", ["day"], origin=999_999_000.0)  # mixed origins
    mixed = moments.moment_states(df.where("day <= 5"), "v", ["day"], origin=1e9).union(other)
    for one in (moments.merge_states(moments.merge_states(states, ["g"])), moments.merge_states(mixed)):
        got = one.withColumn("s", moments.deviation()).first()
        assert abs(got["origin"] + got["mean"] - 1e9 - statistics.fmean(whole)) < 1e-6
        assert abs(got["s"] - statistics.stdev(whole)) < 1e-9
    mean, spread = 1e9 + statistics.fmean(whole), statistics.stdev(whole)
    limit = F.abs(F.col("v") - mean) > spread * 2
    assert moments.outliers_in_states(df, "v", states, 2.0).count() == df.where(limit).count() > 0
    assert moments.outliers_in_states(df, "v", states.limit(0), 2.0).count() == 0


def test_handing_off_twice_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "alerts")
    rows = [(i, date(2024, 1, 1 + i % 3), f"u{i // 2}", {"b": "1", "a": str(i // 2)}) for i in range(12)]
    df = spark.createDataFrame(rows, "ID long, day date, entity string, details map<string,string>")
    append_once(df, path, day_column="day", ignoring=["ID"])
    first = sorted((r["entity"], str(r["day"])) for r in read_path(spark, path).collect())
    assert first == sorted({(r[2], str(r[1])) for r in rows})
    turned = df.select("details", "entity", "day", (F.col("ID") + 100).alias("ID")).withColumn(
        "details", F.map_from_entries(F.reverse(F.map_entries("details")))
    )
    append_once(turned, path, day_column="day", ignoring=["ID"])
    assert read_path(spark, path).count() == len(first)
    more = spark.createDataFrame([(1, date(2024, 1, 1), "u0", {"a": "9"}), (2, date(2024, 2, 1), None, None)], df.schema)
    append_once(more.union(more), path, day_column="day", ignoring=["ID"])
    assert read_path(spark, path).count() == len(first) + 2
