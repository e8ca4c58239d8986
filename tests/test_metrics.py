import numpy as np
import pandas as pd
import pytest

from scorelake.operators import cbpe, metrics as mx


def curve(spark, y, p, **kw):
    return mx.score_curve(spark.createDataFrame(pd.DataFrame({"y": y, "p": p})), **kw)


@pytest.fixture(scope="module")
def sample():
    rng = np.random.RandomState(0)
    y = rng.randint(0, 2, 200)
    return y, np.clip(y * 0.6 + rng.rand(200) * 0.4, 0, 1)


def pair_auc(y, p):
    d = p[y == 1][:, None] - p[y == 0][None, :]
    return (np.sum(d > 0) + np.sum(d == 0) / 2) / d.size


def test_all_metrics_against_numpy(spark, sample):
    rng = np.random.RandomState(3)
    y, p = rng.randint(0, 2, 500), np.round(rng.rand(500), 2)
    row = mx.all_metrics(curve(spark, y, p, rows_per_bucket=10)).first()
    assert row.auc == pytest.approx(pair_auc(y, p), abs=1e-12)
    assert row.gini == pytest.approx(2 * row.auc - 1)
    cuts = np.unique(p)
    tp = np.array([np.sum((p >= t) & (y == 1)) for t in cuts])
    fp = np.array([np.sum((p >= t) & (y == 0)) for t in cuts])
    assert row.ks == pytest.approx(max(tp / y.sum() - fp / (1 - y).sum()))
    prec, rec = tp / (tp + fp), tp / y.sum()
    f1 = 2 * prec * rec / np.maximum(prec + rec, 1e-300)
    best = int(np.argmax(f1))
    assert (row.threshold, row.tp, row.fp) == (cuts[best], tp[best], fp[best])
    assert row.precision == pytest.approx(prec[best]) and row.recall == pytest.approx(rec[best])
    r, q = np.append(rec, 0), np.append(prec, 1)
    assert row.pr_auc == pytest.approx(np.sum((r[:-1] - r[1:]) * (q[:-1] + q[1:]) / 2))


def test_ranges_and_counts(spark, sample):
    row = mx.all_metrics(curve(spark, *sample)).first()
    assert -1 <= row.gini <= 1 and 0 <= row.ks <= 1 and 0 <= row.pr_auc <= 1 and 0 <= row.threshold <= 1
    assert row.tp + row.tn + row.fp + row.fn == 200
    assert set(row.asDict()) == {
        "auc", "gini", "ks", "pr_auc", "precision", "recall", "threshold", "tp", "tn", "fp", "fn",
    }


def test_perfect_model(spark):
    row = mx.all_metrics(curve(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])).first()
    assert row.auc == 1.0 and row.gini == 1.0


def test_top_score_tie_starts_at_precision_one(spark):
    assert mx.pr_auc(curve(spark, [0, 1, 1, 0], [0.9, 0.9, 0.1, 0.1])).first().pr_auc == pytest.approx(0.625)


def test_one_class_has_no_auc(spark):
    assert mx.roc_auc(curve(spark, [1, 1], [0.2, 0.4])).first().auc is None


def test_threshold_above_every_score(spark):
    row = mx.all_metrics(curve(spark, [0, 1], [0.2, 0.4]), threshold=0.9).first()
    assert (row.tp, row.fp, row.fn, row.tn, row.precision) == (0, 0, 1, 1, 0.0)


def test_expected_metrics_match_brute_force(spark):
    rng = np.random.RandomState(5)
    p = np.round(rng.rand(300), 2)
    df = spark.createDataFrame(pd.DataFrame({"p": p, "chunk_id": np.arange(300) // 150}))
    got = {r.chunk_id: r for r in cbpe.estimate(df).collect()}
    for c in (0, 1):
        q = p[np.arange(300) // 150 == c]
        w = q[:, None] * (1 - q[None, :])
        d = q[:, None] - q[None, :]
        # Every pair counts, also a row with itself: a fractional row is part positive, part negative.
        auc = np.sum(w * ((d > 0) + (d == 0) / 2)) / (q.sum() * (1 - q).sum())
        assert got[c].roc_auc == pytest.approx(auc)
        hit = q >= 0.45
        tp, fp, fn = q[hit].sum(), (1 - q[hit]).sum(), q[~hit].sum()
        assert got[c].f1 == pytest.approx(2 * tp / (2 * tp + fp + fn))


def test_calibration_kept_only_if_it_helps(spark):
    rng = np.random.RandomState(6)
    n = 4000
    p = rng.rand(n)
    good = pd.DataFrame({"id": np.arange(n), "p": p, "y": (rng.rand(n) < p).astype(int)})
    bad = good.assign(y=(rng.rand(n) < p**3).astype(int))
    model = cbpe.calibration_if_useful(spark.createDataFrame(bad), "id")
    assert model is not None
    fixed = cbpe.calibrate(spark.createDataFrame(bad), model)
    assert cbpe.calibration_error(fixed) < 0.02 < cbpe.calibration_error(spark.createDataFrame(bad))
    assert fixed.columns == list(bad.columns)
    assert cbpe.calibrate(fixed, None) is fixed


def test_limits_are_clamped_and_missing_values_do_not_alert(spark):
    ref = spark.createDataFrame([(0, 0.9, 0.5), (1, 0.99, 0.7)], "chunk_id int, roc_auc double, f1 double")
    bounds = cbpe.limits(ref)
    assert bounds["roc_auc"][1] == 1.0 and bounds["f1"] == pytest.approx((0.3, 0.9))
    now = spark.createDataFrame([(0, None, 0.1)], "chunk_id int, roc_auc double, f1 double")
    alerts = {r.metric: r.alert for r in cbpe.with_alerts(now, bounds).collect()}
    assert alerts == {"roc_auc": False, "f1": True}
