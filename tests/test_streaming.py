import duskwatch as dw
from duskwatch.sources import schemas
from duskwatch.sources.tables import append, overwrite, read_path
from duskwatch.streaming.tables import append_found, follow_path
from scenario import URL_FILTERING, ago

SCHEMA = schemas.LOGS["url_filtering"]


def test_filters_run_on_a_stream_and_resume(spark, tmp_path):
    log, found, marks = (str(tmp_path / name) for name in ("log", "found", "marks"))
    overwrite(spark.createDataFrame(URL_FILTERING, SCHEMA), log)

    def catch_up():
        stream = follow_path(spark, log, SCHEMA)
        bad = stream.transform(dw.filter_column_by_value, "url_category", "Malware")
        append_found(bad, found, marks).awaitTermination(120)
        return read_path(spark, found).count()

    expected = sum(r[3] == "Malware" for r in URL_FILTERING)
    assert catch_up() == expected
    append(spark.createDataFrame([(ago(0), "ip", "d", "Malware", "Blocked")], SCHEMA), log)
    assert catch_up() == expected + 1


def test_threshold_rule_runs_on_a_stream(spark, rows, tmp_path):
    log = str(tmp_path / "log")
    overwrite(spark.createDataFrame(URL_FILTERING, SCHEMA).repartition(3), log)
    busy = dw.threshold_based_rule(follow_path(spark, log, SCHEMA, files_per_batch=1), 50, "ip_address")
    query = (
        busy.writeStream.format("memory").queryName("busy").outputMode("complete")
        .trigger(availableNow=True).start()
    )
    assert query.awaitTermination(120)
    batch = dw.threshold_based_rule(spark.createDataFrame(URL_FILTERING, SCHEMA), 50, "ip_address")
    assert rows(spark.table("busy")) == rows(batch)
