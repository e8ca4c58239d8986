"""Drift and monitoring runs."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorelake.operators import drift
from scorelake.plans.monitoring import MonitorInput, gauges, production_rows, run_monitor, scored_reference
from scorelake.sources import logs, runs


@pytest.fixture(scope="module")
def periods(spark):
    rng = np.random.default_rng(7)
    n = 2100
    x = rng.normal(size=n)
    p = 1 / (1 + np.exp(-x))
    pdf = pd.DataFrame({
        "event_id": np.arange(n), "p": p, "y": (rng.random(n) < p).astype(int), "a": x, "b": x + rng.normal(0, 0.1, n),
        "c": rng.normal(size=n), "d": rng.integers(0, 3, n).astype(float), "e": np.arange(n) * 37 % 100 / 7.0,
    })
    pdf["ts"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(pdf.event_id, unit="min")
    df = spark.createDataFrame(pdf)
    return pdf, df.filter("event_id < 1400"), df.filter("event_id >= 1400")


def test_ks_and_wasserstein_against_numpy(periods):
    pdf, ref, prod = periods
    moved = prod.withColumn("c", F.col("c") + 0.5)
    pairs = drift.two_sample(ref, moved, ["a", "c"])
    r, q = pdf[:1400], pdf[1400:].assign(c=lambda d: d.c + 0.5)
    ks = {x.feature: x for x in drift.ks_test(pairs, rows_per_bucket=150).collect()}
    area = {x.feature: x.distance for x in drift.wasserstein(pairs, rows_per_bucket=150).collect()}
    for c in ("a", "c"):
        grid = np.sort(np.concatenate([r[c], q[c]]))
        f1 = np.searchsorted(np.sort(r[c]), grid, side="right") / len(r)
        f2 = np.searchsorted(np.sort(q[c]), grid, side="right") / len(q)
        assert ks[c].statistic == pytest.approx(np.abs(f1 - f2).max())
        want = np.sum(np.abs(f1 - f2)[:-1] * np.diff(grid)) / r[c].std(ddof=0)
        assert area[c] == pytest.approx(want)
    assert ks["c"].p_value < 1e-6 < 0.01 < ks["a"].p_value


def test_chi_square_tail():
    assert drift._gamma_q(0.5, 3.841458820694124 / 2) == pytest.approx(0.05, abs=1e-9)
    assert drift._gamma_q(5.0, 18.307038053275146 / 2) == pytest.approx(0.05, abs=1e-9)
    assert drift._gamma_q(1.0, 2.0) == pytest.approx(math.exp(-2.0))


def test_same_data_does_not_drift(periods):
    _, ref, _ = periods
    same = drift.univariate_drift(ref, ref.withColumn("chunk_id", F.lit(0)), ["a", "c", "d"])
    assert all(r.value == pytest.approx(0, abs=1e-9) and not r.alert for r in same.collect())


@pytest.mark.parametrize("large, tests", [(1000, {"Wasserstein distance (normed)", "Jensen-Shannon distance"}), (10**6, {"K-S p_value", "chi-square p_value"})])
def test_report_finds_the_moved_columns(periods, large, tests):
    _, ref, prod = periods
    moved = prod.withColumn("a", F.col("a") * 1.5 + 1).withColumn("d", F.least("d", F.lit(1.0)))
    report = drift.drift_report(ref, moved, ["a", "e", "d"], large=large)
    rows = {r.feature: r for r in report.collect()}
    assert {r.stattest for r in rows.values()} == tests
    assert rows["a"].drift_detected and rows["d"].drift_detected and not rows["e"].drift_detected
    one = drift.drift_summary(report).first()
    assert (one.n_drifted, one.n_checked) == (2, 3) and one.features["a"].drift_detected


def test_columns_without_values_are_reported(periods):
    _, ref, prod = periods
    holes = [d.withColumn("never", F.lit(None).cast("double")) for d in (ref, prod)]
    rows = {r.feature: r for r in drift.drift_report(*holes, ["a", "never"]).collect()}
    assert rows["never"].drift_score is None and rows["never"].drift_detected is None and rows["a"].drift_score is not None
    one = drift.drift_summary(drift.drift_report(*holes, ["never"])).first()
    assert (one.n_drifted, one.n_checked) == (0, 1)
    by = drift.univariate_drift(holes[0], holes[1].withColumn("chunk_id", F.lit(0)), ["a", "never"]).collect()
    assert {(r.feature, r.value is None, r.alert) for r in by if r.feature == "never"} == {("never", True, False)} and len(by) == 2


def test_tests_do_not_change_with_size(periods):
    _, ref, prod = periods
    names = [{r.feature: r.stattest for r in drift.drift_report(r_, prod, ["a", "d"]).collect()} for r_ in (ref, ref.limit(200))]
    assert names[0] == names[1]


def test_reconstruction_error_against_numpy(periods):
    pdf, ref, prod = periods
    fitted = drift.fit_reconstruction(ref, ["a", "b", "c"])
    got = fitted.error(prod.select("event_id", "a", "b", "c")).orderBy("event_id").toPandas()["error"].to_numpy()
    x, z = pdf[:1400][["a", "b", "c"]].to_numpy(), None
    mean, std = x.mean(axis=0), x.std(axis=0, ddof=1)
    _, s, vt = np.linalg.svd((x - mean) / std, full_matrices=False)
    k = int(np.argmax(np.cumsum(s**2) / np.sum(s**2) >= 0.65)) + 1
    z = (pdf[1400:][["a", "b", "c"]].to_numpy() - mean) / std
    np.testing.assert_allclose(got, np.linalg.norm(z - z @ vt[:k].T @ vt[:k], axis=1), atol=1e-7)


def test_monitor_run(spark, periods, tmp_path):
    _, ref, prod = periods
    moved = prod.withColumn("c", F.col("c") + 2)
    row = run_monitor(MonitorInput(ref, moved, ["a", "b", "c", "d", "absent"]))
    one = row.first()
    assert (one.production_rows, one.chunk_size) == (700, 100)
    assert one.cbpe_ok and one.univariate_ok and one.multivariate_ok
    assert 0.6 < one.cbpe_estimated_auc < 0.9 and one.reconstruction_error > 1
    assert "c" in one.drifted_features and one.drifted_features_count == len(one.drifted_features)
    runs.write_summary(row, str(tmp_path / "summary"))
    assert spark.read.json(str(tmp_path / "summary")).first().production_rows == 700
    assert {g.metric for g in gauges(row).collect()} == {
        "cbpe_estimated_auc", "cbpe_estimated_f1", "drifted_features_count", "production_rows",
    }


def test_too_few_rows_do_not_run(periods):
    _, ref, prod = periods
    assert run_monitor(MonitorInput(ref, prod.limit(49), ["a", "b"])) is None


def test_a_failed_part_leaves_the_others(periods):
    _, ref, prod = periods
    one = run_monitor(MonitorInput(ref.drop("y"), prod, ["a", "b"])).first()
    assert not one.cbpe_ok and one.cbpe_estimated_auc is None
    assert one.univariate_ok and not one.multivariate_ok and one.reconstruction_error is None


def test_unnested_production_rows(spark):
    log = spark.createDataFrame(
        [(1, 0.5, '{"a": 1, "b": null}'), (2, 0.1, '{"b": 2.5}')], "id int, default_probability double, features string"
    )
    rows = {r.id: r for r in production_rows(log).collect()}
    assert (rows[1].a, rows[1].b, rows[1].y_pred) == (1.0, None, 1) and (rows[2].a, rows[2].b, rows[2].y_pred) == (None, 2.5, 0)


def test_reference_is_built_once_per_model(spark, periods, tmp_path):
    _, ref, _ = periods
    calls = []

    def score():
        calls.append(1)
        return ref.withColumnRenamed("y", "label")

    for version in ("v1", "v1", "v2"):
        out = scored_reference(spark, str(tmp_path), version, score)
    assert len(calls) == 2 and out.filter("y_pred <> cast(y_pred_proba >= 0.45 as int)").count() == 0


def test_logs_of_different_age_read_together(spark, tmp_path):
    path = str(tmp_path / "log")
    logs.append(spark.createDataFrame([(1, 0.5)], "id int, default_probability double"), path)
    logs.append(spark.createDataFrame([(2, 0.6, "t")], "id int, default_probability double, trace_id string"), path)
    assert {r.id: r.trace_id for r in logs.read_log(spark, path).collect()} == {1: None, 2: "t"}
