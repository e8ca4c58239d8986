"""Second-order boosting against a plain version that compares all splits by loops."""

import math
import pickle

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml import PipelineModel

from scorelake.operators import boosting as bo
from scorelake.operators.models import positive_probability, train_boosted

COLS = ["a", "b", "c"]


def table(spark, n=400, holes=True):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(n):
        a, b, c = rng.normal(), float(rng.integers(0, 5)), rng.uniform()
        y = int(a + (b > 2) + rng.normal() * 0.5 > 1)
        rows.append((i, None if holes and i % 7 == 0 else a, float("nan") if holes and i % 11 == 0 else b, c, y))
    rows.append((n, 1.0, 1.0, 1.0, None))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label int")


def plain_fit(rows, cuts, cfg, weight, base):
    """Trees as nested tuples, and margins, from lists of (values, label); all rows and columns in use."""
    margin = [base] * len(rows)
    quant = lambda v: round(v * bo.UNIT)
    score = lambda g, h: (g / bo.UNIT) ** 2 / (h / bo.UNIT + cfg.penalty)
    goes = lambda x, cut, left: left if x is None or math.isnan(x) else x <= cut

    def node(own, depth, gh):
        g, h = (sum(gh[i][k] for i in own) for k in (0, 1))
        best = None
        if depth:
            for f, own_cuts in enumerate(cuts):
                for cut in own_cuts:
                    for left in (False, True):
                        inside = [i for i in own if goes(rows[i][0][f], cut, left)]
                        gl, hl = (sum(gh[i][k] for i in inside) for k in (0, 1))
                        if hl >= cfg.min_weight * bo.UNIT and h - hl >= cfg.min_weight * bo.UNIT:
                            gain = score(gl, hl) + score(g - gl, h - hl) - score(g, h)
                            if gain > cfg.min_gain and (best is None or gain > best[0] + 1e-9):
                                best = gain, f, cut, left, inside
        if best is None:
            return -cfg.rate * (g / bo.UNIT) / (h / bo.UNIT + cfg.penalty)
        _, f, cut, left, inside = best
        rest = [i for i in own if i not in set(inside)]
        return f, cut, left, node(inside, depth - 1, gh), node(rest, depth - 1, gh)

    def value(tree, x):
        while isinstance(tree, tuple):
            f, cut, left, yes, no = tree
            tree = yes if goes(x[f], cut, left) else no
        return tree

    for _ in range(cfg.trees):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        w = [weight if y else 1.0 for _, y in rows]
        tree = node(list(range(len(rows))), cfg.depth, [(quant(w[i] * (p[i] - rows[i][1])), quant(w[i] * p[i] * (1 - p[i]))) for i in range(len(rows))])
        margin = [m + value(tree, x) for m, (x, _) in zip(margin, rows)]
    return margin


@pytest.mark.parametrize("refresh", [1, 10])
def test_equals_plain_version(spark, monkeypatch, refresh):
    monkeypatch.setattr(bo, "REFRESH", refresh)
    monkeypatch.setattr(bo, "BLOCK_ROWS", 37)
    df = table(spark, 150).repartition(3)
    cfg = bo.BoostConfig(trees=3, depth=3, rows=1.0, columns=1.0)
    cuts = [[-1.0, 0.0, 0.5, 1.0], [0.0, 1.0, 2.0, 3.0], [0.25, 0.5]]
    model = bo.fit_boosting(df, COLS, "label", "id", cfg, cuts)
    rows = [([r.a, r.b, r.c], r.label) for r in df.where("label is not null").collect()]
    pos = sum(y for _, y in rows)
    weight = float(max((len(rows) - pos) // pos, 1))
    want = plain_fit(rows, cuts, cfg, weight, math.log(weight * pos / (len(rows) - pos)))
    got = bo.BoostingModel(model).transform(df.where("label is not null")).collect()
    assert [r.probability[1] for r in got] == pytest.approx([1 / (1 + math.exp(-m)) for m in want], abs=1e-9)


def test_same_trees_however_rows_are_dealt(spark):
    df = table(spark)
    cfg = bo.BoostConfig(trees=4, depth=4)
    fits = [bo.fit_boosting(d, COLS, "label", "id", cfg).to_state() for d in (df.coalesce(1), df.repartition(5, "c"))]
    assert fits[0] == fits[1] and len(fits[0]["trees"]) == 4
    assert any(f >= 0 for f in fits[0]["trees"][3][0])


def test_learns_and_survives_saving(spark, tmp_path):
    df = table(spark, 1500).where("label is not null").cache()
    model = train_boosted(df.where("id % 3 > 0"), COLS, "id", trees=20, depth=3)
    model.save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    test = df.where("id % 3 = 0")
    scored = positive_probability(model, test).collect()
    assert [r.p for r in positive_probability(again, test).collect()] == [r.p for r in scored]
    hit = sum((r.p > 0.5) == (r.label == 1) for r in scored) / len(scored)
    assert hit > 0.8


def test_each_tree_sees_a_share_of_the_rows():
    u = np.random.default_rng(1).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    one, two = bo.sampled(u, 0.8, 5), bo.sampled(u, 0.8, 6)
    assert abs(one.mean() - 0.8) < 0.02 and abs((one & two).mean() - 0.64) < 0.02
    assert bo.sampled(u, 1.0, 5).all()


def test_needs_both_classes(spark):
    with pytest.raises(ValueError, match="both classes"):
        bo.fit_boosting(spark.createDataFrame([(1, 1.0, 1), (2, 2.0, 1)], "id long, a double, label int"), ["a"], "label", "id")


def test_driver_gets_splits_not_histograms(spark, monkeypatch):
    """What comes to the driver at each level is a row for each column and node, however many tasks there are."""
    sent, collect = [], RDD.collect

    def watched(rdd):
        rows = collect(rdd)
        sent.append(len(pickle.dumps(rows)))
        return rows

    df = table(spark).repartition(30)
    cfg = bo.BoostConfig(trees=2, depth=3, rows=1.0, columns=1.0)
    cuts = [[-0.5, 0.0, 0.7], [1.0, 2.0, 3.0], [0.25, 0.5, 0.75]]
    monkeypatch.setattr(bo, "compact", lambda rows, n: rows)
    monkeypatch.setattr(RDD, "collect", watched)
    many = bo.fit_boosting(df, COLS, "label", "id", cfg, cuts)
    monkeypatch.undo()
    assert sent and max(sent) < 10_000
    assert many == bo.fit_boosting(df.coalesce(1), COLS, "label", "id", cfg, cuts)
