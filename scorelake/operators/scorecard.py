"""Scorecard: evidence-coded logistic model, points, and per-row explanation."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, functions as F

from scorelake.functions.scalars import logistic
from scorelake.operators.binning import MIN_IV, Binning, encode, fit_binning, fit_edges
from scorelake.operators.models import GridResult, grid_search

# Points to double the odds, base odds and the score at base odds.
PDO = -50.0
ODDS = 1 / 4
BASE_SCORE = 600.0


def factor_and_offset(pdo: float = PDO, odds: float = ODDS, base: float = BASE_SCORE) -> tuple[float, float]:
    factor = pdo / math.log(2)
    return factor, base - factor * math.log(odds)


def points(
    beta: float, alpha: float, woe: Column, n: int,
    pdo: float = PDO, odds: float = ODDS, base: float = BASE_SCORE,
) -> Column:
    """Score points of one feature; ``n`` features share intercept and offset equally."""
    factor, offset = factor_and_offset(pdo, odds, base)
    return (F.lit(beta) * woe + F.lit(alpha / n)) * F.lit(factor) + F.lit(offset / n)


@dataclass
class Scorecard:
    binning: Binning
    features: list[str]
    beta: list[float]
    alpha: float
    fingerprint: str | None = None
    grid: dict | None = None

    def _total(self, terms: Sequence[Column]) -> Column:
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out

    def _check(self, fingerprint: str | None) -> None:
        if self.fingerprint is not None and fingerprint is not None and fingerprint != self.fingerprint:
            raise ValueError("scorecard was fitted on another feature pipeline")

    def _woe(self, f: str) -> Column:
        return F.col(f + "_WOE")

    def probability(self) -> Column:
        """Default probability from evidence columns."""
        return logistic(
            F.lit(self.alpha) + self._total([F.lit(b) * self._woe(f) for f, b in zip(self.features, self.beta)])
        )

    def _points(self) -> list[Column]:
        n = len(self.features)
        return [points(b, self.alpha, self._woe(f), n) for f, b in zip(self.features, self.beta)]

    def total_score(self) -> Column:
        return self._total(self._points())

    def breakdown(self) -> Column:
        """Per feature: value, bin, evidence, points, information value; largest effect first."""
        entries = []
        for i, (f, pts) in enumerate(zip(self.features, self._points())):
            entry = F.struct(
                F.lit(f).alias("feature"),
                F.round(F.col(f), 4).alias("raw_value"),
                self.binning.label_of(f).alias("bin"),
                F.round(self._woe(f), 4).alias("woe"),
                F.round(pts, 2).alias("score_contribution"),
                F.lit(round(self.binning.iv.get(f, 0.0), 4)).alias("iv"),
            )
            entries.append(F.struct((-F.abs(F.round(pts, 2))).alias("size"), F.lit(i).alias("i"), entry.alias("e")))
        return F.transform(F.array_sort(F.array(*entries)), lambda s: s["e"])

    def score(self, df: DataFrame, explain: bool = True, fingerprint: str | None = None) -> DataFrame:
        """Add ``p``, ``scorecard_score`` and ``scorecard_breakdown`` in one pass over the rows."""
        self._check(fingerprint)
        coded = encode(df, self.binning, self.features)
        extra = [self.breakdown().alias("scorecard_breakdown")] if explain else []
        return coded.select(
            *df.columns, self.probability().alias("p"), self.total_score().alias("scorecard_score"), *extra
        )

    def iv_rows(self) -> list[tuple[str, float]]:
        return sorted(self.binning.iv.items(), key=lambda kv: (-kv[1], kv[0]))

    def to_json(self) -> str:
        return json.dumps({**asdict(self), "binning": self.binning.to_json()})

    @staticmethod
    def from_json(text: str) -> "Scorecard":
        state = json.loads(text)
        return Scorecard(**{**state, "binning": Binning.from_json(state["binning"])})

    def save(self, spark, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "state string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark, path: str) -> "Scorecard":
        return Scorecard.from_json(spark.read.text(path, wholetext=True).first()[0].strip())


def fit_scorecard(
    df: DataFrame,
    bins: Mapping[str, int],
    equal_frequency: Sequence[str],
    row_id: str,
    label: str = "label",
    min_iv: float = MIN_IV,
    min_obs: int = 80,
    fingerprint: str | None = None,
    regularisation: Sequence[float] = (0.01, 0.1, 1.0, 10.0),
    penalties: Sequence[str] = ("l1", "l2"),
) -> Scorecard:
    """Bins, information value filter, evidence coding, grid-searched logistic model."""
    available = {c: n for c, n in bins.items() if c in df.columns}
    edges = fit_edges(df, available, equal_frequency, label, min_obs)
    binning = fit_binning(df, edges, label)
    active = binning.active(min_iv)
    if not active:
        raise ValueError("no feature reaches the information value floor")
    coded = encode(df.select(row_id, label, *active), binning, active)
    result: GridResult = grid_search(
        coded.select(row_id, label, *[f + "_WOE" for f in active]), [f + "_WOE" for f in active], row_id, label,
        regularisation, penalties,
    )
    return Scorecard(
        binning, active, result.coefficients, result.intercept, fingerprint,
        {"C": result.c, "penalty": result.penalty, "cv_gini": result.cv_gini},
    )
