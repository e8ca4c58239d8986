"""Decision rules, request and response contracts, deployment log."""

import json

import pytest
from pyspark.sql import functions as F

from scorelake.functions import decision as rules
from scorelake.functions.scalars import bin_label, clip
from scorelake.operators import registry, validate
from scorelake.plans import credit
from scorelake.plans.scoring import read_requests
from scorelake.sources import logs, tables


def decided(spark, ps):
    return rules.decide(spark.createDataFrame([(p,) for p in ps], "p double")).collect()


def test_decision_thresholds(spark):
    ps = [0.80, 0.70, 0.69, 0.50, 0.45, 0.44, 0.10, 0.00]
    assert [r.decision for r in decided(spark, ps)] == ["reject"] * 2 + ["manual_review"] * 3 + ["approve"] * 3


def test_bands(spark):
    df = spark.createDataFrame([(s,) for s in (800, 750, 710, 620, 500, 300)], "s int")
    got = [r[0] for r in df.select(rules.risk_band(F.col("s"))).collect()]
    assert got == ["Excellent", "Excellent", "Good", "Fair", "Poor", "Very Poor"]


@pytest.mark.parametrize(
    "p, score, band, decision",
    [
        (0.8559, 379, "Very Poor", "reject"), (0.0979, 796, "Excellent", "approve"), (0.674, 479, "Poor", "manual_review"),
        (0.0381, 829, "Excellent", "approve"), (0.0811, 805, "Excellent", "approve"), (0.2057, 737, "Good", "approve"),
        (0.9974, 301, "Very Poor", "reject"), (0.0, 850, "Excellent", "approve"), (1.0, 300, "Very Poor", "reject"),
    ],
)
def test_known_scores(spark, p, score, band, decision):
    row = decided(spark, [p])[0]
    assert (row.credit_score, row.risk_band, row.decision) == (score, band, decision)


def test_score_falls_with_probability_and_keeps_null(spark):
    rows = decided(spark, [i / 20 for i in range(21)])
    scores = [r.credit_score for r in rows]
    assert scores == sorted(scores, reverse=True) and min(scores) >= 300 and max(scores) <= 850
    empty = decided(spark, [None])[0]
    assert empty.credit_score is None and empty.risk_band is None and empty.decision is None


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(1.0,), (None,), (9.0,)], "x double")
    assert [r[0] for r in df.select(clip(F.col("x"), 2.0, 5.0)).collect()] == [2.0, None, 5.0]


def test_bin_label():
    assert bin_label(float("-inf"), 3.14159) == "(-inf, 3.14]"
    assert bin_label(1234567.0, float("inf")) == "(1.23e+06, +inf]"


PAYLOAD = {
    "NUMBER_OF_LOANS": 3, "NUMBER_OF_CREDIT_CARDS": 2, "ENQUIRIES_3M": 5, "ENQUIRIES_6M": 7,
    "OUTSTANDING_BAL_LOAN_CURRENT": 1000000, "OUTSTANDING_BAL_ALL_CURRENT": 1000200, "NUM_NEW_LOAN_TAKEN_3M": 1,
    "NUM_NEW_LOAN_TAKEN_6M": 2, "NUMBER_OF_RELATIONSHIP_BANK": 3, "CREDIT_CARD_NUMBER_OF_LATE_PAYMENT": 0,
}


def test_requests(spark):
    bodies = [
        json.dumps(PAYLOAD), "{}", json.dumps({"NUMBER_OF_LOANS": -999, "ENQUIRIES_3M": 99999}),
        json.dumps({"UNKNOWN_FIELD": 99}), json.dumps({"NUMBER_OF_LOANS": "many"}), "not json",
        json.dumps({"NUMBER_OF_LOANS": "2.5", "ENQUIRIES_3M": True, "ENQUIRIES_6M": "NaN", "ENQUIRIES_9M": "1d"}),
    ]
    raw = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    good, bad = read_requests(raw, "body", credit.FIELDS)
    ok = {r.id: r for r in good.collect()}
    assert set(ok) == {0, 1, 2, 3}
    assert ok[0].NUMBER_OF_LOANS == 3.0 and ok[0].missing_rate == pytest.approx(112 / 122)
    assert ok[1].missing_rate == 1.0 and ok[3].extras == {"UNKNOWN_FIELD": "99"}
    assert ok[3].missing_rate == pytest.approx(122 / 123)
    reasons = {r.id: r.errors for r in bad.collect()}
    assert reasons == {4: ["NUMBER_OF_LOANS"], 5: ["body"], 6: ["ENQUIRIES_9M"]}
    lenient = validate.parse_requests(raw.filter("id = 6"), "body", ["NUMBER_OF_LOANS", "ENQUIRIES_3M", "ENQUIRIES_6M"]).first()
    assert (lenient.NUMBER_OF_LOANS, lenient.ENQUIRIES_3M, lenient.ENQUIRIES_6M, lenient.errors) == (2.5, 1.0, None, [])


def test_filter_on_errors_does_not_repeat_parsing(spark):
    raw = spark.createDataFrame([(1, "{}")], "id int, body string")
    good, _ = read_requests(raw, "body", credit.FIELDS)
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize(
    "change, rule",
    [({}, None), ({"default_probability": 1.5}, "default_probability"), ({"credit_score": 200}, "credit_score"),
     ({"risk_band": "Amazing"}, "risk_band"), ({"decision": "maybe"}, "decision"), ({"decision": None}, "decision")],
)
def test_response_rules(spark, change, rule):
    row = {"default_probability": 0.5, "credit_score": 600, "risk_band": "Fair", "decision": "manual_review", **change}
    df = spark.createDataFrame([row], "default_probability double, credit_score int, risk_band string, decision string")
    good, bad = validate.quarantine(validate.check(df, validate.response_rules()))
    if rule is None:
        assert good.count() == 1 and bad.count() == 0
    else:
        assert good.count() == 0 and bad.first().failed == [rule]


def test_promote_and_rollback(spark, tmp_path):
    path = str(tmp_path / "deployments")
    logs.append(logs.deployment_event(spark, "promote", "other", None, "1", "ops", event_id=1), path)
    with pytest.raises(LookupError):
        registry.rollback(spark, path, "champion")
    assert registry.promote(spark, path, "5", by="ops") is None
    with pytest.raises(LookupError):
        registry.rollback(spark, path, "champion")
    assert registry.promote(spark, path, "8", by="ops") == "5"
    assert registry.rollback(spark, path, "champion", "worse", "ops") == "5"
    assert registry.rollback(spark, path, "champion") == "5"
    state = {r.alias: r.version for r in registry.alias_state(logs.read_log(spark, path)).collect()}
    assert state == {"champion": "5", "other": "1"}
    newest = registry.history(logs.read_log(spark, path)).first()
    assert (newest.event_type, newest.from_version, newest.to_version) == ("rollback", "8", "5")
    assert registry.history(logs.read_log(spark, path)).count() == 5


def test_versions_sort_as_numbers(spark):
    df = spark.createDataFrame([("9",), ("10",), ("2",)], "version string")
    assert [r.version for r in registry.versions_newest_first(df).collect()] == ["10", "9", "2"]


def test_content_version_of_file_and_folder(spark, tmp_path):
    import hashlib

    one = tmp_path / "one.csv"
    one.write_bytes(b"a,b\n1,2\n")
    assert tables.content_version(spark, str(one)) == hashlib.sha256(one.read_bytes()).hexdigest()[:8]
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "x").write_bytes(b"x")
    (folder / "y").write_bytes(b"y")
    before = tables.content_version(spark, str(folder))
    (folder / "y").write_bytes(b"z")
    assert tables.content_version(spark, str(folder)) != before
    with pytest.raises(Exception):
        tables.content_version(spark, str(tmp_path / "absent"))


def test_nan_is_missing(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("customer_id,A,label\n1,NaN,0\n2,,1\n3,4.5,0\n")
    df = tables.scan_csv(spark, str(path), tables.applicant_schema(["A"]))
    assert [r.A for r in df.orderBy("customer_id").collect()] == [None, None, 4.5]
