"""Business rules: probability to credit score, risk band, decision and verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Score range, band floors and decision thresholds.
SCORE_TOP = 850
SCORE_FLOOR = 300
BANDS = [(750, "Excellent"), (670, "Good"), (580, "Fair"), (440, "Poor")]
LOWEST_BAND = "Very Poor"
REJECT_FROM = 0.70
REVIEW_FROM = 0.45


def credit_score(p: Column) -> Column:
    """Linear score, rounded half to even: 850 at p = 0 down to 300 at p = 1."""
    return F.rint(F.lit(float(SCORE_TOP)) - p * F.lit(float(SCORE_TOP - SCORE_FLOOR))).cast("int")


def risk_band(score: Column) -> Column:
    band = F.when(score >= BANDS[0][0], BANDS[0][1])
    for floor, name in BANDS[1:]:
        band = band.when(score >= floor, name)
    return F.when(score.isNotNull(), band.otherwise(LOWEST_BAND))


def decision(p: Column) -> Column:
    """Rule on the unrounded probability."""
    rule = F.when(p >= REJECT_FROM, "reject").when(p >= REVIEW_FROM, "manual_review")
    return F.when(p.isNotNull(), rule.otherwise("approve"))


def flagged(p: Column, threshold: float = REVIEW_FROM) -> Column:
    return (p >= F.lit(threshold)).cast("int")


def verdict(label: Column, decided: Column) -> Column:
    """Decision against outcome: caught, miss, cleared or over_cautious."""
    risky = decided.isin("reject", "manual_review")
    return (
        F.when((label == 1) & risky, "caught")
        .when((label == 1) & ~risky, "miss")
        .when((label == 0) & ~risky, "cleared")
        .when((label == 0) & risky, "over_cautious")
    )


def gauge(score: Column) -> Column:
    """Position of a score on the 300..850 scale, 0 to 1."""
    return (score - F.lit(SCORE_FLOOR)).cast("double") / F.lit(float(SCORE_TOP - SCORE_FLOOR))


def decide(df: DataFrame, p: str = "p") -> DataFrame:
    """Add default_probability (4 decimals), credit_score, risk_band and decision."""
    prob = F.col(p)
    return df.select(
        "*",
        F.round(prob, 4).alias("default_probability"),
        credit_score(prob).alias("credit_score"),
        risk_band(credit_score(prob)).alias("risk_band"),
        decision(prob).alias("decision"),
    )
