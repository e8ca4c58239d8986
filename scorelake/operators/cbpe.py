"""Performance without labels, estimated from calibrated probabilities.

Estimates are only as good as the calibration: a probability must mean what it says.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from scorelake.functions.decision import REVIEW_FROM
from scorelake.operators.metrics import auc_expr, score_curve
from scorelake.operators.split import hash60

LIMIT_SIGMAS = 3.0


def fit_calibration(ref: DataFrame, p: str = "p", y: str = "y") -> IsotonicRegressionModel:
    """Isotonic map from score to observed rate, fitted on one weighted row per distinct score."""
    hist = ref.groupBy(F.col(p).alias("_f")).agg(
        F.avg(F.col(y).cast("double")).alias("_y"), F.count("*").cast("double").alias("_w")
    )
    return IsotonicRegression(featuresCol="_f", labelCol="_y", weightCol="_w", predictionCol="_c").fit(hist)


def calibrate(df: DataFrame, model: IsotonicRegressionModel | None, p: str = "p") -> DataFrame:
    """Replace ``p`` by its calibrated value; without a model nothing changes."""
    if model is None:
        return df
    mapped = model.transform(df.withColumn("_f", F.col(p)))
    return mapped.withColumn(p, F.col("_c")).drop("_f", "_c")


def calibration_error(df: DataFrame, p: str = "p", y: str = "y", bins: int = 10) -> float:
    """Mean absolute gap of predicted and observed rate over equal-width score bins."""
    bin_ = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1))
    per_bin = df.groupBy(bin_.alias("b")).agg(
        F.abs(F.sum(p) - F.sum(F.col(y).cast("double"))).alias("gap"), F.count("*").alias("n")
    )
    row = per_bin.agg(F.sum("gap").alias("gap"), F.sum("n").alias("n")).first()
    return row.gap / row.n if row.n else 0.0


def calibration_if_useful(
    ref: DataFrame, row_id: str, p: str = "p", y: str = "y", seed: int = 42
) -> IsotonicRegressionModel | None:
    """A calibration fitted on half of the reference, kept only if it helps on the other half."""
    keyed = ref.withColumn("_half", hash60(seed, row_id) % 2)
    fit, held = keyed.filter("_half = 0"), keyed.filter("_half = 1")
    model = fit_calibration(fit, p, y)
    better = calibration_error(calibrate(held, model, p), p, y) < calibration_error(held, p, y)
    return fit_calibration(ref, p, y) if better else None


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return F.coalesce(F.try_divide(2.0 * tp, 2.0 * tp + fp + fn), F.lit(0.0))


def estimate(
    prod: DataFrame, chunk: str = "chunk_id", p: str = "p", raw: str | None = None, threshold: float = REVIEW_FROM
) -> DataFrame:
    """Expected AUC and F1 per chunk. Predictions come from ``raw`` (default ``p``), chances from ``p``."""
    predicted = F.col(raw or p) >= F.lit(threshold)
    chance = F.col(p)
    tp = F.sum(F.when(predicted, chance).otherwise(0.0))
    fp = F.sum(F.when(predicted, 1.0 - chance).otherwise(0.0))
    fn = F.sum(F.when(predicted, 0.0).otherwise(chance))
    f1 = prod.groupBy(chunk).agg(_f1(tp, fp, fn).alias("f1"), F.count("*").alias("n_rows"))
    auc = score_curve(prod, p, by=[chunk], expected=True).groupBy(chunk).agg(auc_expr().alias("roc_auc"))
    return f1.join(auc, chunk, "left").select(chunk, "n_rows", "roc_auc", "f1")


def realized(
    ref: DataFrame, chunk: str = "chunk_id", p: str = "p", y: str = "y", threshold: float = REVIEW_FROM
) -> DataFrame:
    """AUC and F1 per labelled chunk."""
    hit, pos = F.col(p) >= F.lit(threshold), F.col(y) == 1
    f1 = ref.groupBy(chunk).agg(
        _f1(F.count_if(hit & pos), F.count_if(hit & ~pos), F.count_if(~hit & pos)).alias("f1"),
        F.count("*").alias("n_rows"),
    )
    auc = score_curve(ref, p, y, by=[chunk]).groupBy(chunk).agg(auc_expr().alias("roc_auc"))
    return f1.join(auc, chunk, "left").select(chunk, "n_rows", "roc_auc", "f1")


def limits(
    chunks: DataFrame, metrics: Sequence[str] = ("roc_auc", "f1"), sigmas: float = LIMIT_SIGMAS,
    low: float | None = 0.0, high: float | None = 1.0,
) -> dict[str, tuple[float | None, float | None]]:
    """Mean plus and minus ``sigmas`` standard deviations of each metric over the reference chunks."""
    row = chunks.agg(
        *[F.avg(m).alias(f"m_{m}") for m in metrics], *[F.stddev_pop(m).alias(f"s_{m}") for m in metrics]
    ).first()
    out = {}
    for m in metrics:
        mean, spread = row[f"m_{m}"], row[f"s_{m}"]
        if mean is None:
            out[m] = (None, None)
            continue
        a, b = mean - sigmas * spread, mean + sigmas * spread
        out[m] = (a if low is None else max(low, a), b if high is None else min(high, b))
    return out


def with_alerts(chunks: DataFrame, bounds: dict[str, tuple[float | None, float | None]], chunk: str = "chunk_id") -> DataFrame:
    """Long ``(chunk, metric, value, lower, upper, alert)``; a missing value does not alert."""
    long = chunks.select(chunk, *[F.col(m).cast("double").alias(m) for m in bounds]).unpivot(
        [chunk], list(bounds), "metric", "value"
    )
    lower = upper = F.lit(None).cast("double")
    for m, (a, b) in bounds.items():
        here = F.col("metric") == m
        lower, upper = F.when(here, F.lit(a)).otherwise(lower), F.when(here, F.lit(b)).otherwise(upper)
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return long.select("*", lower.cast("double").alias("lower"), upper.cast("double").alias("upper")).withColumn(
        "alert", F.coalesce(outside, F.lit(False))
    )
