import pytest

from duskwatch import filter_by_relative_time, get_table
from duskwatch.sources import schemas, staging, tables


def test_table_by_name(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert get_table("three", spark).count() == 3
    assert get_table("three").count() == 3


def test_overwrite_append_and_read(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.range(3), path)
    tables.append(spark.range(2), path)
    assert tables.read_path(spark, path).count() == 5
    tables.overwrite(spark.range(1), path)
    assert tables.read_path(spark, path).count() == 1


def test_overwrite_may_bring_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.range(3), path)
    wider = spark.range(2).selectExpr("id", "id * 2 AS twice")
    tables.overwrite(wider, path, merge_schema=True)
    assert tables.read_path(spark, path, merge_schema=True).columns == ["id", "twice"]


def test_appended_columns_are_merged_on_read(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.range(3), path)
    tables.append(spark.range(2).selectExpr("id", "id * 2 AS twice"), path)
    merged = tables.read_path(spark, path, merge_schema=True)
    assert merged.where("twice IS NULL").count() == 3


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_formats(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    tables.overwrite(spark.range(4), path, fmt=fmt)
    assert tables.read_path(spark, path, fmt=fmt, schema="id bigint").count() == 4


def test_partitioned_write_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.range(10).selectExpr("id", "id % 2 AS day"), path, partition_by=["day"])
    plan = tables.read_path(spark, path).where("day = 1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_relative_time_on_the_day_column_skips_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    log = spark.range(90).selectExpr(
        "timestamp'2024-01-01 06:00:00' + make_dt_interval(CAST(id AS INT)) AS t", "id"
    )
    tables.overwrite(log.selectExpr("*", "CAST(t AS DATE) AS day"), path, partition_by=["day"])
    recent = tables.read_path(spark, path)
    for column in ("day", "t"):
        recent = filter_by_relative_time(recent, days=7, time_column=column, as_of="2024-03-31 12:00:00")
    plan = recent._jdf.queryExecution().toString()
    assert "(day#" in plan and ">= 2024-03-24)" in plan.split("PartitionFilters: [")[1]
    assert recent.count() == 6  # days 25 to 30; the 24th at six lies before the 24th at noon


def test_partitioned_write_makes_few_files_and_splits_hot_ones(spark, tmp_path):
    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "id", "IF(id % 3 = 0, 0, id % 9) AS day", "sha2(CAST(id AS STRING), 256) AS text"
    )
    few = str(tmp_path / "few")
    tables.overwrite(rows, few, partition_by=["day"])
    assert len(tables.read_path(spark, few).inputFiles()) <= 9  # not 8 tasks x 9 days

    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        split = str(tmp_path / "split")
        tables.overwrite(rows, split, partition_by=["day"])
        assert len(tables.read_path(spark, split).where("day = 0").inputFiles()) > 1
        assert tables.read_path(spark, split).count() == 60_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_sql_over_path_binds_values(spark, tmp_path):
    path = str(tmp_path / "users")
    directory = tables.local_rows(spark, [("o'neil", "g-1"), ("x' OR '1'='1", "g-2")], schemas.USERS)
    tables.overwrite(directory, path)
    assert tables.sql_over_path(spark, path).count() == 2

    def lookup(name):
        found = tables.sql_over_path(spark, path, ["ID"], "Username = :name", {"name": name})
        return [r.ID for r in found.collect()]

    assert lookup("o'neil") == ["g-1"]
    assert lookup("x' OR '1'='1") == ["g-2"]
    with pytest.raises(ValueError):
        tables.sql_over_path(spark, "p` WHERE true --")


def test_stage_keeps_rows_and_schema(spark):
    df = spark.range(5).selectExpr("id", "map('a', CAST(id AS STRING)) AS m")
    staged = staging.stage(df, "five")
    assert staged.schema.simpleString() == df.schema.simpleString()
    assert staged.count() == 5
    assert all(staging.shared_folder(spark) in f for f in staged.inputFiles())
