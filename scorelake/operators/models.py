"""Probability models on prepared features, grid search and model comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from scorelake.functions.decision import decision
from scorelake.operators import logistic
from scorelake.operators.boosting import BoostConfig, BoostingModel, fit_boosting
from scorelake.operators.metrics import all_metrics, roc_auc, score_curve
from scorelake.operators.prep import ZScaler, with_balanced_weight
from scorelake.operators.smote import smote
from scorelake.operators.split import stratified_folds
from scorelake.session import compact, stage


def positive_probability(model: PipelineModel, df: DataFrame, out: str = "p") -> DataFrame:
    """Probability of the last class; helper columns do not leak."""
    scored = model.transform(df)
    return scored.select(*df.columns, F.element_at(vector_to_array("probability"), -1).alias(out))


def logistic_model(
    cols: Sequence[str], label: str, total_weight: float, c: float = 1.0, penalty: str = "l2",
    weight: str | None = None, max_iter: int = 100,
) -> Pipeline:
    """Logistic regression minimising C * weighted loss + penalty on unscaled columns."""
    lr = LogisticRegression(
        featuresCol="_x", labelCol=label, maxIter=max_iter, regParam=1.0 / (c * total_weight),
        elasticNetParam={"l1": 1.0, "l2": 0.0}[penalty], standardization=False,
    )
    if weight:
        lr.setWeightCol(weight)
    return Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="_x"), lr])


def train_challenger(
    train: DataFrame, cols: Sequence[str], row_id: str, label: str = "label", c: float = 0.01, k: int = 5, seed: int = 42
) -> PipelineModel:
    """Oversample, scale, balanced L2 logistic regression. The scaler stays inside the model."""
    grown = stage(smote(train, cols, row_id, label, k, seed), "smote")
    keep = [x for x in grown.columns if x not in set(cols)]
    scaler = ZScaler(keep).fit(grown)
    weighted = with_balanced_weight(scaler.transform(grown), label)
    n = grown.count()
    fit = logistic_model(cols, label, n, c, weight="_w", max_iter=5000).fit(compact(weighted, n))
    return PipelineModel([scaler, *fit.stages])


def train_boosted(
    train: DataFrame, cols: Sequence[str], row_id: str, label: str = "label", trees: int = 150, depth: int = 6, seed: int = 42
) -> PipelineModel:
    """Boosted trees; positives weigh the whole-number class ratio."""
    fitted = fit_boosting(train, cols, label, row_id, BoostConfig(trees=trees, depth=depth, seed=seed))
    return PipelineModel([BoostingModel(fitted)])


def train_fallback(train: DataFrame, cols: Sequence[str], row_id: str, label: str = "label") -> PipelineModel:
    """Light boosted trees on raw (median-filled) columns."""
    return train_boosted(train, cols, row_id, label, trees=50, depth=4)


@dataclass
class GridResult:
    c: float
    penalty: str
    cv_gini: float
    coefficients: list[float]
    intercept: float


def grid_search(
    df: DataFrame,
    cols: Sequence[str],
    row_id: str,
    label: str = "label",
    regularisation: Sequence[float] = (0.01, 0.1, 1.0, 10.0),
    penalties: Sequence[str] = ("l1", "l2"),
    folds: int = 5,
    seed: int = 42,
) -> GridResult:
    """Best of C x penalty by mean AUC over stratified folds, refitted on all rows.

    The fits of all folds share their passes over the rows.
    """
    folded = stratified_folds(df, row_id, label, folds, seed)
    data = stage(VectorAssembler(inputCols=list(cols), outputCol="_x").transform(folded).select("_x", label, "fold"), "grid")
    # One row a fold and label.
    sizes = data.groupBy("fold", label).count().collect()
    if {r[label] for r in sizes} - {0, 1}:
        raise ValueError("labels must be 0 or 1")
    if len({r.fold for r in sizes}) < folds:
        raise ValueError("a fold is empty")
    n = sum(r["count"] for r in sizes)
    data = compact(data, n)
    blocks, width = logistic.pack_blocks(data, "_x", label, "fold", len(cols)), len(cols)
    combos = [(c, pen) for c in regularisation for pen in penalties]

    def wanted(c: float, pen: str, without: int) -> logistic.Fit:
        weight = 1.0 / (c * n * (folds - 1) / folds)
        return logistic.Fit(*{"l1": (weight, 0.0), "l2": (0.0, weight)}[pen], without)

    grid = {i: [wanted(c, pen, i) for c, pen in combos] for i in range(folds)}
    fitted = logistic.fit_all(blocks, [fit for fits in grid.values() for fit in fits], width)
    scored = logistic.margins(data, "_x", label, "fold", {i: [fitted[fit] for fit in fits] for i, fits in grid.items()})
    found = roc_auc(score_curve(scored, "score", "label", by=["combo", "fold"]), ["combo", "fold"])
    # One row a combination and fold.
    auc = {(r.combo, r.fold): r.auc for r in found.collect()}
    # Of one class only: nothing above 0 without positives, nothing below 1 without negatives.
    positive = {r.fold for r in sizes if r[label] == 1}
    auc = {k: float(k[1] in positive) if v is None else v for k, v in auc.items()}
    means = [sum(auc[(i, f)] for f in range(folds)) / folds for i in range(len(combos))]
    best = max(range(len(combos)), key=lambda i: (means[i], -i))
    c, pen = combos[best]
    blocks.unpersist()
    lr = LogisticRegression(
        featuresCol="_x", labelCol=label, maxIter=1000, standardization=False, regParam=1.0 / (c * n),
        elasticNetParam={"l1": 1.0, "l2": 0.0}[pen],
    )
    final = lr.fit(data)
    return GridResult(c, pen, float(2 * means[best] - 1), [float(x) for x in final.coefficients], float(final.intercept))


def compare_models(scored: Mapping[str, DataFrame], label: str = "label") -> DataFrame:
    """One row of metrics per model, for scored tables with ``p`` and a label."""
    out = None
    for name, df in scored.items():
        row = all_metrics(score_curve(df, "p", label)).select(F.lit(name).alias("model"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def probability_shift(a: Column, b: Column) -> list[Column]:
    """Difference of two models on the same rows, and whether the decision changes."""
    return [F.abs(a - b).alias("abs_diff"), (decision(a) != decision(b)).alias("flipped")]
