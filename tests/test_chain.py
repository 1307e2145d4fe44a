import pytest

import scenario
from duskwatch.operators import handoff
from duskwatch.plans import response_chain
from duskwatch.sources import schemas


@pytest.fixture(scope="module")
def result(spark):
    return response_chain.run(scenario.tables(spark), as_of=scenario.NOW, manual_users=["asked"])


def test_detections(result):
    got = {(r.rule_name, r.entity, r.user, r.resolved) for r in result.detections.collect()}
    assert got == {
        ("Unusual document access", "target", "target", True),
        ("Unusual document access", "medium", "medium", True),
        ("Unusual document access", "ghost", "ghost", True),
        ("Unusual mail volume", "mail@example.com", "mail", True),
        ("Unusual mail volume", "stranger@example.com", "stranger@example.com", False),
        ("Manual request", "asked", "asked", True),
    }


def test_detections_carry_their_evidence(result):
    row = result.detections.where("entity = 'target'").first()
    assert row.details["events_in_last_day"] == "30"
    assert row.score == pytest.approx(float(row.details["z_score"]))


def test_findings(result):
    got = {
        r.user: (r.av_risk, r.dlp_risk, r.url_risk, r.severity) for r in result.findings.collect()
    }
    assert got == {
        "target": ("High", "High", "High", "high"),
        "medium": (None, "High", "Low", "medium"),
        "mail": (None, None, "Medium", "low"),
        "ghost": (None, None, "Low", "low"),
        "stranger@example.com": (None, None, "Low", "low"),
        "asked": (None, None, "Low", "low"),
    }


def test_target_in_detail(result):
    row = result.findings.where("user = 'target'").first()
    assert (row.department, row.title) == ("Accounting", "Manager")
    assert (row.av_events, row.av_detected, row.av_cleaned, row.av_failed) == (14, 7, 7, 0)
    assert (row.dlp_high, row.dlp_medium, row.dlp_low) == (1, 0, 0)
    assert (row.url_hits, row.url_domains) == (101, 2)
    assert row.trigger_event == "Unusual document access"
    assert row.high_count == 3


def test_messages(result):
    messages = {r.user: r.av_message for r in result.findings.collect()}
    assert messages["ghost"] == "no host known for this user"
    assert messages["mail"] == "antivirus activity without detections"
    assert messages["target"] == "7 detections, 7 cleaned, 0 not cleaned"


def test_ambiguous_staff_rows_do_not_repeat_users(result):
    assert result.findings.where("user = 'mail'").count() == 1


def test_only_high_severity_is_acted_on(result):
    assert [tuple(r) for r in result.actions.collect()] == [
        ("target", "Unusual document access", "guid-1", "Disable User")
    ]
    assert result.rejects.count() == 0
    response = result.responses.collect()
    assert [tuple(r)[1:] for r in response] == [
        ("target", "target@example.com", "Unusual document access", "Disable User")
    ]


def test_handoff_tables_have_the_declared_schemas(result):
    for frame, schema in [
        (result.alerts, schemas.ALERT), (result.investigations, schemas.INVESTIGATION),
        (result.responses, schemas.RESPONSE),
    ]:
        assert frame.schema.simpleString() == schema.simpleString()
    assert result.alerts.count() == 6
    assert len({r.ID for r in result.alerts.collect()}) == 6
    data = result.investigations.where("data['entity'] = 'target'").first()
    assert data.data["severity"] == "high" and data.status == "complete"
    assert data.date == scenario.NOW


def test_one_plan_gives_the_same_findings(spark, result):
    lazy = response_chain.run(
        scenario.tables(spark), as_of=scenario.NOW, manual_users=["asked"], keep=lambda df, name: df
    )
    key = lambda r: r.user
    assert sorted(lazy.findings.collect(), key=key) == sorted(result.findings.collect(), key=key)


def test_without_identities_mail_stays_unresolved(spark):
    found = response_chain.detect(scenario.tables(spark, identity=False), as_of=scenario.NOW)
    assert {r.user: r.resolved for r in found.where("entity_type = 'email'").collect()} == {
        "mail@example.com": False, "stranger@example.com": False,
    }


def test_unknown_accounts_are_rejected(spark):
    findings = spark.createDataFrame(
        [("target", "t", "high"), ("nobody", "t", "high"), ("mail", "t", "medium")],
        "user string, trigger_event string, severity string",
    )
    users = spark.createDataFrame([("target", "guid-1")], "Username string, ID string")
    actions = handoff.response_actions(findings, users)
    assert [r.user for r in handoff.rejected(actions).collect()] == ["nobody"]
    assert [r.user for r in handoff.executable(actions).collect()] == ["target"]
    rows = handoff.response_rows(actions).collect()
    assert [(r.UserName, r.UserEmail) for r in rows] == [("target", None)]


def test_a_user_alerted_twice_is_investigated_once(spark):
    rows = [("B rule", "u", "user", 1.0, {}), ("A rule", "u", "user", 2.0, {}), ("A rule", "u", "user", 3.0, {})]
    found = spark.createDataFrame(rows, handoff._DETECTIONS)
    flagged = handoff.flagged_users(handoff.resolve_users(found)).collect()
    assert [tuple(r) for r in flagged] == [("u", "A rule, B rule", True)]
