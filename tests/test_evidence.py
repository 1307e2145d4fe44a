import pytest
from pyspark.sql import functions as F

from duskwatch.operators import evidence, verdict
from scenario import CLEANED, DETECTED, FAILED, NOW, ago

from duskwatch.sources import schemas


def frame(spark, name, data):
    return spark.createDataFrame(data, schemas.LOGS[name])


def flagged(spark, *users):
    return spark.createDataFrame([(u,) for u in users], "user string")


def places(spark, *triples):
    return spark.createDataFrame(list(triples), "user string, dest_hostname string, src_ip string")


# --- antivirus: boundaries ---------------------------------------------------------------------

def av_risk(spark, detected, cleaned, failed, tiers=evidence.AV_TIERS):
    log = [("h", DETECTED, "x", ago(1))] * detected
    log += [("h", CLEANED, "x", ago(1))] * cleaned + [("h", FAILED, "x", ago(1))] * failed
    log += [("h", "MALWAREPROTECTION_SCAN_STARTED", "x", ago(1))]
    out = evidence.antivirus_risk(
        flagged(spark, "u"), places(spark, ("u", "h", "1")), frame(spark, "antivirus", log), NOW, tiers
    )
    return out.first().av_risk


@pytest.mark.parametrize(
    ("detected", "cleaned", "failed", "risk"),
    [
        (0, 0, 0, None), (0, 2, 1, None), (1, 1, 0, "Low"), (3, 3, 0, "Low"), (4, 4, 0, "Medium"),
        (5, 5, 0, "Medium"), (6, 6, 0, "High"), (2, 2, 1, "High"), (2, 1, 0, "High"), (5, 9, 0, "Medium"),
    ],
)
def test_av_tiers(spark, detected, cleaned, failed, risk):
    assert av_risk(spark, detected, cleaned, failed) == risk


@pytest.mark.parametrize("counts", [(1, 1, 0), (3, 3, 0), (5, 9, 0), (1, 0, 1)])
def test_av_tiers_as_written_are_always_high(spark, counts):
    assert av_risk(spark, *counts, tiers=evidence.AV_TIERS_AS_WRITTEN) == "High"
    assert av_risk(spark, 0, 3, 3, tiers=evidence.AV_TIERS_AS_WRITTEN) is None


def test_hosts_count_once_however_often_they_were_used(spark):
    where = places(spark, ("u", "h", "1"), ("u", "h", "2"), ("v", "h", "1"), ("w", None, "3"))
    log = frame(spark, "antivirus", [("h", DETECTED, "x", ago(1)), (None, DETECTED, "x", ago(1))])
    out = evidence.antivirus_risk(flagged(spark, "u", "v", "w", "x"), where, log, NOW)
    assert {r.user: r.av_detected for r in out.collect()} == {"u": 1, "v": 1, "w": 0, "x": None}


# --- data loss: boundaries ---------------------------------------------------------------------

@pytest.mark.parametrize(
    ("high", "medium", "low", "risk"),
    [
        (0, 0, 0, None), (1, 0, 0, "High"), (0, 5, 50, None), (0, 6, 0, "Medium"), (0, 10, 0, "Medium"),
        (0, 11, 0, "High"), (0, 0, 51, "Medium"), (0, 0, 100, "Medium"), (0, 0, 101, "High"),
    ],
)
def test_dlp_tiers(spark, high, medium, low, risk):
    kinds = ["High"] * high + ["Medium"] * medium + ["Low"] * low
    log = [(ago(1), "u", "f", "e", kind, "Allowed") for kind in kinds]
    log += [(ago(1), "u", "f", "e", "High", "Blocked"), (ago(8), "u", "f", "e", "High", "Allowed")]
    log += [(ago(1), "other", "f", "e", "High", "Allowed")]
    row = evidence.dlp_risk(flagged(spark, "u"), frame(spark, "dlp", log), NOW).collect()
    assert [(r.dlp_risk, r.dlp_high, r.dlp_medium, r.dlp_low) for r in row] == [(risk, high, medium, low)]


# --- proxy: boundaries ---------------------------------------------------------------------------

def url_rows(hits, domains, ip="1"):
    return [(ago(1), ip, f"d{n % domains}", "Malware", "Blocked") for n in range(hits)]


@pytest.mark.parametrize(
    ("hits", "domains", "risk"),
    [
        (0, 1, "Low"), (1, 1, "Medium"), (101, 1, "Medium"), (50, 2, "Low"), (51, 2, "Medium"),
        (100, 2, "Medium"), (101, 2, "High"),
    ],
)
def test_url_tiers(spark, hits, domains, risk):
    log = frame(spark, "url_filtering", url_rows(hits, domains) + url_rows(200, 3, "other"))
    out = evidence.url_risk(flagged(spark, "u"), places(spark, ("u", "h", "1")), log, NOW).first()
    assert (out.url_hits, out.url_domains, out.url_risk) == (hits, min(hits, domains), risk)


def test_domains_are_united_over_addresses(spark):
    rows = url_rows(4, 2, "a") + url_rows(6, 3, "b")
    rows += [(ago(1), "a", None, "Malware", "Blocked"), (ago(1), "b", None, "Malware", "Blocked")]
    rows += [(ago(1), "a", "d9", "Business", "Allowed"), (ago(8), "b", "d8", "Malware", "Blocked")]
    where = places(
        spark, ("one", "h", "a"), ("both", "h", "a"), ("both", "h", "b"), ("both", "g", "b"),
        ("idle", "h", "c"), ("also", "h", "a"), ("also", "h", "c"), ("gap", "h", None), ("gap", "h", "b"),
    )
    out = evidence.url_risk(
        flagged(spark, "one", "both", "idle", "also", "gap", "none"), where,
        frame(spark, "url_filtering", rows), NOW,
    )
    # requests without a domain count as one domain of their own
    assert {r.user: (r.url_hits, r.url_domains) for r in out.collect()} == {
        "one": (5, 3), "both": (12, 4), "idle": (0, 0), "also": (5, 3), "gap": (7, 4), "none": (0, 0),
    }


def test_proxy_evidence_equals_its_definition(spark, rows):
    log = spark.range(3000).selectExpr(
        "timestamp'2024-01-30' AS date", "IF(id % 3 = 0, 'gateway', CONCAT('ip', id % 17)) AS ip_address",
        "IF(id % 29 = 0, NULL, CONCAT('d', pmod(xxhash64(id), 40))) AS domain",
        "IF(id % 5 = 0, 'Business', 'Malware') AS url_category",
    )
    where = spark.range(200).selectExpr(
        "CONCAT('u', id % 90) AS user", "'h' AS dest_hostname",
        "IF(id % 2 = 0, 'gateway', CONCAT('ip', id % 23)) AS src_ip",
    )
    pairs = where.selectExpr("user", "src_ip AS ip_address").distinct()
    plain = (
        pairs.join(log.where("url_category = 'Malware'"), "ip_address").groupBy("user")
        .agg(F.count(F.lit(1)), F.countDistinct(F.coalesce("domain", F.lit("?"))))
    )
    got = evidence.url_counts(where, log, NOW)
    assert rows(got) == rows(plain) and got.count() > 40


# --- footprint and verdict -------------------------------------------------------------------------

def test_footprint(spark, rows):
    logins = frame(spark, "user_logins", [
        (ago(1), "u", "x", "h1", "1", "Success"), (ago(2), "u", "x", "h1", "1", "Failure"),
        (ago(7), "u", "x", "h2", "2", "Failure"), (ago(7, 1), "u", "x", "h3", "3", "Success"),
        (ago(-1), "u", "x", "h4", "4", "Success"), (ago(1), "v", "x", "h1", "1", "Success"),
    ])
    out = evidence.entity_footprint(logins, flagged(spark, "u"), NOW)
    assert rows(out) == [("u", "h1", "1"), ("u", "h2", "2"), ("u", "h4", "4")]


@pytest.mark.parametrize(
    ("risks", "severity"),
    [
        (("High", "High", "High"), "high"), (("High", None, "High"), "high"),
        (("Medium", "High", "Low"), "medium"), ((None, None, "High"), "medium"),
        (("Medium", "Medium", "Medium"), "low"), ((None, None, None), "low"),
    ],
)
def test_severity(spark, risks, severity):
    df = spark.createDataFrame([risks], "av_risk string, dlp_risk string, url_risk string")
    assert verdict.fuse_severity(df).first().severity == severity


def test_users_of(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "id int")
    assert rows(evidence.users_of(df, "id")) == [("1",), ("2",)]
