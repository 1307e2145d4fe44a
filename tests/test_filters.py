from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import duskwatch as dw

NOW = "2024-01-31 12:00:00"


@pytest.fixture
def pets(spark):
    return spark.createDataFrame(
        [(1, "cat", 1.0), (2, "dog", 2.0), (3, "catfish", None), (4, None, 4.0), (5, None, None)],
        "id int, kind string, weight double",
    )


def ids(df):
    return sorted(r.id for r in df.collect())


def test_value(pets):
    assert ids(dw.filter_column_by_value(pets, "kind", "cat")) == [1]
    assert ids(dw.filter_column_by_value(pets, "kind", None)) == []
    assert ids(dw.filter_column_by_value(pets, "ID", 2)) == [2]


def test_value_of_another_type(pets):
    assert ids(dw.filter_column_by_value(pets, "id", "2")) == [2]
    assert ids(dw.filter_column_by_value(pets, "kind", 7)) == []
    assert ids(dw.filter_column_by_value(pets, "id", 2.5)) == []
    with pytest.raises(ValueError, match="id is int"):
        dw.filter_column_by_value(pets, "id", "two")


def test_values(pets):
    assert ids(dw.filter_columns_by_values(pets, {"kind": ["cat", "dog"], "weight": 2.0})) == [2]
    either = dw.filter_columns_by_values(
        pets, {"kind": ["cat", "dog"], "weight": 4.0}, is_and_operator=False
    )
    assert ids(either) == [1, 2, 4]  # null in one test does not veto the other
    assert ids(dw.filter_columns_by_values(pets, {"kind": []})) == []
    with pytest.raises(ValueError):
        dw.filter_columns_by_values(pets, {})


def test_category(pets):
    assert ids(dw.filter_column_by_category(pets, "kind", ["cat", "dog"])) == [1, 2]
    assert ids(dw.filter_column_by_category(pets, "kind", "dog")) == [2]
    assert ids(dw.filter_column_by_category(pets, "kind", [])) == []
    assert ids(dw.filter_columns_by_categories(pets, {"kind": "cat", "id": [1, 2]})) == [1]
    assert ids(dw.filter_columns_by_categories(pets, {})) == [1, 2, 3, 4, 5]


@pytest.fixture
def times(spark):
    stamps = [
        "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-02 00:00:01", "2024-01-31 11:59:59",
        "2024-01-31 12:00:00", "2024-02-01 00:00:00", None,
    ]
    return spark.createDataFrame(list(enumerate(stamps)), "id int, s string").selectExpr(
        "id", "s", "CAST(s AS timestamp) AS t", "CAST(s AS timestamp_ntz) AS n", "CAST(s AS date) AS d"
    )


@pytest.mark.parametrize("column", ["t", "n"])
def test_date_range_is_closed_and_ends_at_midnight(times, column):
    assert ids(dw.filter_column_by_date_range(times, column, "2024-01-01", "2024-01-02")) == [0, 1]
    assert ids(dw.filter_by_time(times, "2024-01-31 12:00:00", "2024-02-01", column)) == [4, 5]
    bounds = (datetime(2024, 1, 2), datetime(2024, 1, 2, 0, 0, 1))
    assert ids(dw.filter_column_by_date_range(times, column, *bounds)) == [1, 2]


def test_date_range_on_dates(times):
    assert ids(dw.filter_column_by_date_range(times, "d", "2024-01-01", "2024-01-02")) == [0, 1, 2]
    assert ids(dw.filter_column_by_date_range(times, "d", date(2024, 1, 31), date(2024, 1, 31))) == [3, 4]


def test_date_ranges(times):
    one = dw.filter_columns_by_date_ranges(times, {"t": ("2024-01-01", "2024-01-02")})
    many = dw.filter_columns_by_date_ranges(
        times, {"t": [("2024-01-01", "2024-01-01"), ("2024-02-01", "2024-02-02")], "id": [(0, 4)]}
    )
    assert ids(one) == [0, 1]
    assert ids(many) == [0]
    with pytest.raises(ValueError):
        dw.filter_columns_by_date_ranges(times, {"t": []})


@pytest.mark.parametrize("column", ["t", "n", "s"])
def test_relative_time(times, column):
    recent = dw.filter_by_relative_time(times, seconds=1, time_column=column, as_of=NOW)
    assert ids(recent) == [3, 4, 5]  # later rows pass
    assert ids(dw.filter_by_relative_time(times, time_column=column, as_of=NOW)) == [4, 5]
    bounded = dw.filter_by_relative_time(
        times, weeks=4, days=2, hours=12, time_column=column, as_of=NOW, upper_bound=True
    )
    assert ids(bounded) == [0, 1, 2, 3, 4]


def test_relative_time_floors_to_the_second(times):
    late = datetime(2024, 1, 31, 12, 0, 0, 900_000)
    assert ids(dw.filter_by_relative_time(times, milliseconds=1, time_column="t", as_of=late)) == [4, 5]


def test_relative_time_defaults_to_the_clock(spark):
    now = datetime.now(UTC)
    df = spark.createDataFrame(
        [(1, now - timedelta(minutes=30)), (2, now - timedelta(days=2))], "id int, _event_time timestamp"
    )
    assert ids(dw.filter_by_relative_time(df, hours=30)) == [1]


def test_as_of_with_a_zone(times):
    assert ids(dw.filter_by_relative_time(times, time_column="n", as_of="2024-01-31T13:00:00+01:00")) == [4, 5]


def test_nulls(pets):
    assert ids(dw.filter_rows_with_any_null(pets, ["kind", "weight"])) == [3, 4, 5]
    assert ids(dw.filter_rows_with_all_null(pets, ["kind", "weight"])) == [5]
    with pytest.raises(ValueError):
        dw.filter_rows_with_any_null(pets, [])


def test_nan_is_not_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None)], "id int, v double")
    assert ids(dw.filter_rows_with_any_null(df, ["v"])) == [2]


def test_patterns(pets):
    assert ids(dw.filter_column_by_string_pattern(pets, "kind", "at")) == [1, 3]
    assert ids(dw.filter_column_by_string_pattern(pets, "kind", "AT")) == []
    assert ids(dw.filter_columns_by_string_pattern(pets, {"kind": ["^d", "h$"]})) == [2, 3]
    assert ids(dw.filter_columns_by_string_pattern(pets, {"kind": "^cat$"})) == [1]
    assert ids(dw.filter_columns_by_string_pattern(pets, {"kind": []})) == []


def test_conditions(pets):
    heavy, cat = F.col("weight") > 1, F.col("kind") == "cat"
    assert ids(dw.filter_column_by_multiple_conditions(pets, heavy, F.col("kind") == "dog")) == [2]
    assert ids(dw.filter_columns_by_multiple_conditions(pets, [heavy, cat])) == [1, 2, 4]
    assert ids(dw.filter_columns_by_multiple_conditions(pets, [])) == []


def test_custom_functions(pets):
    assert ids(dw.filter_column_by_custom_function(pets, "weight", lambda w: w >= 2)) == [2, 4]
    assert ids(dw.filter_columns_by_custom_function(
        pets, {"weight": [lambda w: w > 3, lambda w: w < 2], "id": [lambda i: i > 1]}
    )) == [4]
    with pytest.raises(TypeError):
        dw.filter_column_by_custom_function(pets, "weight", lambda w: True)


def test_filters_stack(pets):
    assert ids(pets.transform(dw.filter_column_by_value, "kind", "cat")) == [1]
