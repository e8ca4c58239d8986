"""Ranking and threshold metrics from one score histogram, optionally per group.

Labels may be fractional (expected positives), which is what label-free estimation needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from scorelake.operators.prefix import ROWS_PER_BUCKET, running_totals


def score_histogram(df: DataFrame, score: str, positive: Column, negative: Column, by: Sequence[str] = ()):
    """One row per distinct score: positives and negatives, summed before the shuffle."""
    return (
        df.filter(F.col(score).isNotNull())
        .select(*by, F.col(score).alias("score"), positive.alias("_p"), negative.alias("_n"))
        .groupBy(*by, "score")
        .agg(F.sum("_p").alias("pos"), F.sum("_n").alias("neg"))
    )


def score_curve(
    df: DataFrame,
    score: str = "p",
    label: str = "y",
    by: Sequence[str] = (),
    expected: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Counts at every distinct threshold ``score >= t``: tp, fp, and the same one step stricter.

    With ``expected`` the score itself stands in for the label.
    """
    if expected:
        positive, negative = F.col(score), F.lit(1.0) - F.col(score)
    else:
        positive = (F.col(label) == 1).cast("bigint")
        negative = (F.col(label) == 0).cast("bigint")
    hist = score_histogram(df, score, positive, negative, by)
    cum = running_totals(hist, "score", ["pos", "neg"], by=by, rows_per_bucket=rows_per_bucket)
    above_pos = F.col("tot_pos") - F.col("cum_pos")
    above_neg = F.col("tot_neg") - F.col("cum_neg")
    return cum.select(
        *by,
        "score",
        "pos",
        "neg",
        above_pos.alias("tp_above"),
        above_neg.alias("fp_above"),
        (above_pos + F.col("pos")).alias("tp"),
        (above_neg + F.col("neg")).alias("fp"),
        F.col("tot_pos").alias("P"),
        F.col("tot_neg").alias("N"),
    )


def _d(name: str) -> Column:
    return F.col(name).cast("double")


def _ratio(num: Column, den: Column, empty: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(num, den), F.lit(empty))


def _precision() -> Column:
    return _ratio(_d("tp"), _d("tp") + _d("fp"))


def _recall() -> Column:
    return _ratio(_d("tp"), _d("P"))


def f1_score() -> Column:
    p, r = _precision(), _recall()
    return _ratio(2.0 * p * r, p + r)


def auc_expr() -> Column:
    """Concordant share of (negative, positive) pairs, ties half; null without both classes."""
    pairs = _d("neg") * (_d("tp_above") + _d("pos") / 2.0)
    return F.try_divide(F.sum(pairs), F.max(_d("P")) * F.max(_d("N")))


def ks_expr() -> Column:
    return F.max(F.try_divide(_d("tp"), _d("P")) - F.try_divide(_d("fp"), _d("N")))


def pr_auc_expr() -> Column:
    """Trapezoids over (recall, precision), starting from recall 0 at precision 1."""
    before = _ratio(_d("tp_above"), _d("tp_above") + _d("fp_above"), 1.0)
    width = F.try_divide(_d("pos"), _d("P"))
    return F.least(F.sum(width * (_precision() + before) / 2.0), F.lit(1.0))  # rounding may pass 1


def roc_auc(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return curve.groupBy(*by).agg(auc_expr().alias("auc"))


def gini(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return curve.groupBy(*by).agg((2.0 * auc_expr() - 1.0).alias("gini"))


def ks(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return curve.groupBy(*by).agg(ks_expr().alias("ks"))


def pr_auc(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return curve.groupBy(*by).agg(pr_auc_expr().alias("pr_auc"))


def best_threshold(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Threshold with the largest F1; the lowest one on ties."""
    order = F.struct(f1_score(), -F.col("score"))
    return curve.groupBy(*by).agg(
        F.max_by(F.col("score"), order).alias("threshold"), F.max(f1_score()).alias("f1")
    )


def all_metrics(curve: DataFrame, threshold: float | None = None, by: Sequence[str] = ()) -> DataFrame:
    """AUC, Gini, KS, PR-AUC and the confusion matrix at ``threshold`` (default: best F1)."""
    point = F.struct("score", "tp", "fp")
    if threshold is None:
        chosen = F.max_by(point, F.struct(f1_score(), -F.col("score")))
    else:
        chosen = F.min(F.when(F.col("score") >= F.lit(threshold), point))
    agg = curve.groupBy(*by).agg(
        auc_expr().alias("auc"),
        ks_expr().alias("ks"),
        pr_auc_expr().alias("pr_auc"),
        chosen.alias("_at"),
        F.max("P").alias("P"),
        F.max("N").alias("N"),
    )
    tp, fp = F.coalesce(F.col("_at.tp"), F.lit(0)), F.coalesce(F.col("_at.fp"), F.lit(0))
    limit = F.col("_at.score") if threshold is None else F.lit(float(threshold))
    return agg.select(
        *by,
        "auc",
        (2.0 * F.col("auc") - 1.0).alias("gini"),
        "ks",
        "pr_auc",
        _ratio(tp.cast("double"), (tp + fp).cast("double")).alias("precision"),
        _ratio(tp.cast("double"), _d("P")).alias("recall"),
        limit.alias("threshold"),
        tp.alias("tp"),
        (F.col("N") - fp).alias("tn"),
        fp.alias("fp"),
        (F.col("P") - tp).alias("fn"),
    )


def confusion_at(df: DataFrame, threshold: float, score: str = "p", label: str = "y", by: Sequence[str] = ()):
    """Confusion counts for ``score >= threshold`` in one aggregate, no ordering needed."""
    hit = F.col(score) >= F.lit(threshold)
    pos, neg = F.col(label) == 1, F.col(label) == 0
    return df.filter(F.col(score).isNotNull()).groupBy(*by).agg(
        F.count_if(neg & ~hit).alias("tn"),
        F.count_if(neg & hit).alias("fp"),
        F.count_if(pos & ~hit).alias("fn"),
        F.count_if(pos & hit).alias("tp"),
    )
