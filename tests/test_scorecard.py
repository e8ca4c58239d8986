import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorelake.operators import binning as bn
from scorelake.operators.scorecard import Scorecard, factor_and_offset, fit_scorecard, points


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(42)
    n = 1200
    pdf = pd.DataFrame({
        "id": np.arange(n), "loans": rng.integers(1, 20, n).astype(float), "cards": rng.integers(0, 5, n).astype(float),
        "part": rng.normal(0, 1, n), "noise": rng.normal(0, 1, n),
    })
    risk = 1 / (1 + np.exp(-(pdf.part * 1.2 + 0.15 * (pdf.loans - 10) - 1)))
    pdf["label"] = (rng.random(n) < risk).astype(int)
    pdf.loc[rng.random(n) < 0.1, "part"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("part", F.nanvl("part", F.lit(None)))
    return pdf, df


BINS = {"loans": 5, "cards": 3, "part": 8}


@pytest.fixture(scope="module")
def fitted(sample):
    _, df = sample
    return bn.fit_binning(df, bn.fit_edges(df, BINS, ["loans", "part"]))


def numpy_tree(x, y, leaves):
    """Best-first entropy tree on one column."""
    x = x.astype(np.float32).astype(float)

    def h(v):
        p = v.mean()
        return 0.0 if p in (0, 1) else -len(v) * (p * math.log2(p) + (1 - p) * math.log2(1 - p))

    def best(mask):
        values = np.unique(x[mask])
        found = None
        for a, b in zip(values, values[1:]):
            t = a / 2 + b / 2
            left, right = mask & (x <= t), mask & (x > t)
            gain = h(y[mask]) - h(y[left]) - h(y[right])
            if found is None or gain > found[0] + 1e-12:
                found = (gain, t, left, right)
        return found

    todo, cuts = [best(np.ones(len(x), bool))], []
    while len(cuts) + 1 < leaves:
        todo = [t for t in todo if t and t[0] > 1e-9]
        if not todo:
            break
        i = max(range(len(todo)), key=lambda i: todo[i][0])
        _, t, left, right = todo.pop(i)
        cuts.append(t)
        todo += [best(left), best(right)]
    return sorted(cuts)


@pytest.mark.parametrize("rows_per_bucket", [10**6, 60])
def test_entropy_edges_match_a_tree(sample, rows_per_bucket):
    pdf, df = sample
    want = {"loans": 5, "cards": 3, "part": 4}
    got = bn.entropy_edges(df, want, rows_per_bucket=rows_per_bucket)
    for c, n in want.items():
        ok = ~np.isnan(pdf[c].to_numpy())
        np.testing.assert_allclose(got[c], numpy_tree(pdf[c].to_numpy()[ok], pdf.label.to_numpy()[ok], n))


def test_constant_column_is_one_bin(spark):
    df = spark.createDataFrame([(i, 3.0, i % 2) for i in range(200)], "id int, x double, label int")
    assert bn.entropy_edges(df, {"x": 4}) == {"x": []}
    assert bn.equal_frequency_edges(df, {"x": 4}) == {"x": []}
    fit = bn.fit_binning(df, {"x": []})
    assert fit.woe == {"x": [0.0]} and fit.iv == {"x": 0.0}


def test_equal_frequency_edges_match_pandas(sample):
    pdf, df = sample
    got = bn.equal_frequency_edges(df, {"part": 8, "loans": 5}, min_obs=80)
    for c, q in (("part", 8), ("loans", 5)):
        x = pdf[c].dropna().to_numpy()
        _, edges = pd.qcut(x, q, retbins=True, duplicates="drop")
        edges[0], edges[-1] = -np.inf, np.inf
        n = np.array([np.sum((x >= a) & (x < b)) for a, b in zip(edges, edges[1:])])
        keep = np.flatnonzero(n >= 80)
        want = sorted({e for e in edges[keep + 1] if np.isfinite(e)})
        np.testing.assert_allclose(got[c], want)


@pytest.mark.parametrize("min_obs", [30, 80, 500])
def test_sparse_bins_join_the_right_neighbour(spark, min_obs):
    x = np.array([1.0] * 100 + [2.0] * 40 + [3.0] * 40 + [4.0] * 100 + [5.0] * 20)
    df = spark.createDataFrame([(v, 0) for v in x.tolist()], "x double, label int")
    _, edges = pd.qcut(x, 15, retbins=True, duplicates="drop")
    edges[0], edges[-1] = -np.inf, np.inf
    n = np.array([np.sum((x >= a) & (x < b)) for a, b in zip(edges, edges[1:])])
    want = sorted({e for e in edges[np.flatnonzero(n >= min_obs) + 1] if np.isfinite(e)})
    np.testing.assert_allclose(bn.equal_frequency_edges(df, {"x": 15}, min_obs=min_obs)["x"], want)


def test_evidence(sample, fitted):
    pdf, df = sample
    assert all(math.isfinite(w) for ws in fitted.woe.values() for w in ws)
    assert all(v >= 0 for v in fitted.iv.values())
    ends = [-np.inf, *fitted.edges["part"], np.inf]
    part = pdf.dropna(subset=["part"])
    b = pd.cut(part.part, ends, labels=False)
    bad, obs = part.label.groupby(b).sum(), part.label.groupby(b).size()
    want = np.log(((obs - bad) / (obs - bad).sum()) / (bad / bad.sum()))
    np.testing.assert_allclose(fitted.woe["part"], want)
    coded = bn.encode(df, fitted, ["part", "loans"])
    assert coded.filter("part is null and part_WOE <> 0").count() == 0
    assert coded.filter("part_WOE is null or loans_WOE is null").count() == 0
    row = coded.filter("id = 0").first()
    assert row.loans_WOE == pytest.approx(fitted.woe["loans"][int(np.searchsorted(fitted.edges["loans"], row.loans))])


def test_pure_bins(spark):
    rows = [(1.0, 0)] * 10 + [(2.0, 1)] * 10
    df = spark.createDataFrame(rows, "x double, label int")
    table = {r.bin: r for r in bn.woe_table(bn.bin_counts(df, {"x": [1.5]})).collect()}
    assert table[0].n_bad == 1 and table[0].pct_bad == pytest.approx(1 / 11)
    assert table[1].woe == 0.0 and table[1].iv == 0.0


def test_points_formula(spark):
    factor, offset = factor_and_offset()
    assert offset == pytest.approx(500.0)
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "w double")
    zero = [r[0] for r in df.select(points(0.0, 0.0, F.col("w"), 18)).collect()]
    np.testing.assert_allclose(zero, 500 / 18)
    rising = [r[0] for r in df.select(points(-1.0, 0.2, F.col("w"), 18)).collect()]
    assert rising == sorted(rising) and all(math.isfinite(v) for v in rising)


@pytest.fixture(scope="module")
def card(sample):
    _, df = sample
    return fit_scorecard(df, {**BINS, "noise": 4, "absent": 3}, ["loans", "part"], "id", fingerprint="abc",
                         regularisation=(0.1, 1.0), penalties=("l2",))


def test_fitted_scorecard(sample, card):
    pdf, df = sample
    assert set(card.features) >= {"loans", "part"} and "absent" not in card.features
    out = card.score(df).toPandas()
    logit = np.log(out.p / (1 - out.p))
    np.testing.assert_allclose(out.scorecard_score, 500 - 72.13475204444817 * logit, atol=1e-6)
    for row in out.head(50).itertuples():
        parts = [e["score_contribution"] for e in row.scorecard_breakdown]
        assert sum(parts) == pytest.approx(row.scorecard_score, abs=0.005 * len(parts) + 1e-9)
        assert parts == sorted(parts, key=lambda v: -abs(v))
        missing = [e for e in row.scorecard_breakdown if e["feature"] == "part" and e["raw_value"] is None]
        assert all(e["bin"] == "unknown" and e["woe"] == 0.0 for e in missing)
    y, p = pdf.label.to_numpy(), out.sort_values("id").p.to_numpy()
    assert p[y == 1].mean() > p[y == 0].mean()


def test_known_score():
    assert 500 - 72.1348 * math.log(0.8559 / (1 - 0.8559)) == pytest.approx(371.48, abs=0.05)


def test_scorecard_survives_saving(spark, sample, card, tmp_path):
    _, df = sample
    card.save(spark, str(tmp_path / "card"))
    again = Scorecard.load(spark, str(tmp_path / "card"))
    assert again == card
    assert card.score(df).drop("scorecard_breakdown").exceptAll(again.score(df).drop("scorecard_breakdown")).count() == 0


def test_scorecard_refuses_other_features(sample, card):
    with pytest.raises(ValueError):
        card.score(sample[1], fingerprint="other")


def test_strength_names(spark):
    df = spark.createDataFrame([(v,) for v in (0.01, 0.02, 0.1, 0.2, 0.5, 1.2)], "iv double")
    got = [r[0] for r in df.select(bn.iv_strength(F.col("iv"))).collect()]
    assert got == ["useless", "weak", "weak", "medium", "strong", "suspicious"]
