"""Inputs off the happy path: key types, null posts, shared addresses, sorting, staging."""

import random

import pytest
from pyspark.sql import functions as F

import duskwatch as dw
from duskwatch.operators import evidence, handoff
from duskwatch.sources import staging

AS_OF = "2024-01-31 12:00:00"


def test_numeric_user_ids_meet_users_that_are_no_numbers(spark, rows):
    flagged = spark.createDataFrame([("7",), ("jane@x",)], "user string")
    logins = spark.sql(
        "SELECT 7L AS user_id, TIMESTAMP '2024-01-31 10:00:00' AS date, 'h' AS dest_hostname, 'a' AS src_ip"
    )
    assert rows(evidence.entity_footprint(logins, flagged, AS_OF)) == [("7", "h", "a")]
    dlp = spark.sql(
        "SELECT 7L AS user, TIMESTAMP '2024-01-31 10:00:00' AS timestamp, 'High' AS risk, 'Allowed' AS action"
    )
    assert rows(evidence.dlp_counts(flagged, dlp, AS_OF)) == [("7", 1, 0, 0)]
    staff = spark.sql("SELECT 7L AS employee, 'Fin' AS department, 'Mgr' AS title")
    assert rows(evidence.entity_profile(flagged, staff)) == [("7", "Fin", "Mgr"), ("jane@x", None, None)]
    findings = flagged.withColumn("severity", F.lit("high")).withColumn("trigger_event", F.lit("r"))
    users = spark.sql("SELECT 7L AS Username, 'guid' AS ID")
    got = handoff.response_actions(findings, users)
    assert rows(got, "user", "directory_id") == [("7", "guid"), ("jane@x", None)]


def test_a_null_post_gives_way(spark, rows):
    posts = [("a", None, None), ("a", "Fin", "Mgr"), ("b", None, None)]
    staff = spark.createDataFrame(posts, "employee string, department string, title string")
    assert rows(evidence.staff_profiles(staff)) == [("a", "Fin", "Mgr"), ("b", None, None)]


def test_domains_behind_shared_and_own_addresses(spark, rows):
    draw = random.Random(3)
    held = {(f"u{u}", f"gate{draw.randrange(3)}") for u in range(40) for _ in range(2)}
    held |= {(f"u{u}", f"own{u}") for u in range(0, 40, 2)} | {("u1", None)}
    hits = [(draw.choice(["gate0", "gate1", f"own{draw.randrange(40)}"]), draw.choice(["d1", "d2", "d3", None]))
            for _ in range(400)]
    footprint = spark.createDataFrame([(u, "h", a) for u, a in held], "user string, dest_hostname string, src_ip string")
    log = spark.createDataFrame(hits, "ip_address string, domain string").withColumns(
        {"url_category": F.lit("Malware"), "date": F.lit("2024-01-31 10:00:00").cast("timestamp_ntz")}
    )
    expected = []
    for user in {u for u, _ in held}:
        seen = [d for a, d in hits if (user, a) in held]
        if seen:
            expected.append((user, len(seen), len(set(seen))))
    assert rows(evidence.url_counts(footprint, log, AS_OF)) == sorted(expected, key=repr)


def test_users_of_a_gateway_do_not_multiply_its_domains(spark):
    """The rows joined grow with users plus domains, not with their product."""
    made = []
    for size in (20, 200):
        footprint = spark.range(size).selectExpr(
            "CAST(id AS STRING) AS user", "'h' AS dest_hostname",
            "explode(array('gate', 'gate2', concat('own', id))) AS src_ip",
        )
        log = spark.range(size).selectExpr(
            "'gate' AS ip_address", "concat('d', id) AS domain", "'Malware' AS url_category",
            "TIMESTAMP_NTZ '2024-01-31 10:00:00' AS date",
        )
        counts = evidence.url_counts(footprint, log, AS_OF)
        assert counts.count() == size and counts.where(f"url_domains != {size}").count() == 0
        counts.collect()
        plan = counts._jdf.queryExecution().executedPlan()
        made.append(_most_rows(plan))
    assert made[1] <= 20 * made[0]


def _most_rows(plan) -> int:
    metric = plan.metrics().get("numOutputRows")
    own = metric.get().value() if metric.isDefined() else 0
    below = plan.children()
    nodes = [below.apply(i) for i in range(below.size())]
    if hasattr(plan, "executedPlan") and plan.nodeName() == "AdaptiveSparkPlan":
        nodes.append(plan.executedPlan())
    if "QueryStage" in plan.nodeName():
        nodes.append(plan.plan())
    return max([own, *map(_most_rows, nodes)])


def test_ranges_may_come_as_lists(spark):
    days = spark.sql("SELECT DATE '2024-01-01' + INTERVAL 1 DAY * CAST(id AS INT) AS day FROM range(10)")
    several = {"day": [["2024-01-01", "2024-01-02"], ["2024-01-05", "2024-01-05"]]}
    assert dw.filter_columns_by_date_ranges(days, several).count() == 3
    assert dw.filter_columns_by_date_ranges(days, {"day": ["2024-01-01", "2024-01-02"]}).count() == 2


def test_sorting_survives_variants(spark):
    df = spark.sql("SELECT id, parse_json('{}') AS v, struct(map(1, id) AS m) AS s FROM range(3)")
    assert [r.id for r in dw.sort_by_column(df, "id", ascending=False).collect()] == [2, 1, 0]


def test_no_shared_folder_is_an_error_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session())


def test_staged_tables_can_go_to_a_folder_and_be_removed(spark, tmp_path):
    staged = staging.stage(spark.range(3), "three", folder=str(tmp_path))
    assert staged.count() == 3
    assert staging.clear_staged(spark, str(tmp_path))
    assert list(tmp_path.iterdir()) == []
