"""Logistic regressions side by side: coefficients against Spark's own fit, folds, one class, number of jobs."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from scorelake.operators import logistic, models

COLS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 2))
    y = rng.random(600) < 1 / (1 + np.exp(1.0 - 1.5 * x[:, 0]))
    data = [(i, float(a), float(b), float(round(a + 0.01 * b, 1)), 3.0, int(v)) for i, ((a, b), v) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id long, a double, b double, c double, d double, label int").repartition(3).cache()


def packed(rows):
    data = VectorAssembler(inputCols=COLS, outputCol="_x").transform(rows.withColumn("fold", (F.col("id") % 3).cast("int")))
    return data, logistic.pack_blocks(data, "_x", "label", "fold", len(COLS))


@pytest.mark.parametrize("l1, l2", [(0.02, 0.0), (0.0, 0.02), (1e-5, 0.0), (0.0, 1e-6), (5.0, 0.0)])
def test_nothing_better_nearby(rows, l1, l2):
    """The gradient of the mean loss is held by the penalty, on the rows of every fit."""
    data, blocks = packed(rows)
    fits = [logistic.Fit(l1, l2, fold) for fold in (None, 0, 1, 2)]
    found = logistic.fit_all(blocks, fits, len(COLS))
    table = data.select(*COLS, "label", "fold").toPandas()
    for fit in fits:
        own = table[table["fold"] != (-1 if fit.without is None else fit.without)]
        x, y, weights, free = own[COLS].to_numpy(), own["label"].to_numpy(), found[fit][:-1], found[fit][-1]
        error = 1 / (1 + np.exp(-(x @ weights + free))) - y
        slope = x.T @ error / len(y) + l2 * weights
        assert error.mean() == pytest.approx(0.0, abs=1e-8)
        assert np.abs(np.where(weights != 0, slope + l1 * np.sign(weights), 0)).max() < 1e-8
        assert np.abs(np.where(weights == 0, slope, 0)).max() <= l1 + 1e-8
        assert weights[3] == pytest.approx(0.0, abs=1e-6)  # a constant, which the intercept stands for
        assert (weights == 0).all() or l1 < 5


@pytest.mark.parametrize("l1, l2", [(0.02, 0.0), (0.0, 0.02)])
def test_against_spark(rows, l1, l2):
    data, blocks = packed(rows)
    weights = logistic.fit_all(blocks, [fit := logistic.Fit(l1, l2)], len(COLS))[fit]
    model = LogisticRegression(featuresCol="_x", regParam=l1 + l2, elasticNetParam=float(l1 > 0), standardization=False).fit(data)
    assert np.allclose(weights, [*model.coefficients, model.intercept], atol=5e-3)


def test_one_class(rows):
    _, blocks = packed(rows.withColumn("label", F.lit(1)))
    found = logistic.fit_all(blocks, [fit := logistic.Fit(0.1, 0.0)], len(COLS))[fit]
    assert found.tolist() == [0.0] * 4 + [math.inf]


def test_grid_needs_few_jobs(spark, rows):
    spark.sparkContext.setJobGroup("grid", "grid")
    try:
        best = models.grid_search(rows, ["a", "b"], "id")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("grid")
    finally:
        spark.sparkContext.setJobGroup("other", "other")
    assert len(jobs) < 200  # the last fit is one by itself; 40 of them and 40 evaluations were far more
    assert best.cv_gini > 0.4 and best.penalty in ("l1", "l2") and len(best.coefficients) == 2


def test_grid_refuses_other_labels(rows):
    with pytest.raises(ValueError, match="0 or 1"):
        models.grid_search(rows.withColumn("label", F.col("label") + 1), COLS, "id")
