"""Column expressions shared by the operators. Everything here stays inside codegen."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def nan_to_null(col: Column) -> Column:
    """Missing is one concept here: NaN becomes null."""
    return F.when(~F.isnan(col), col)


def clip(col: Column, lo: float | None, hi: float | None) -> Column:
    """``min(max(col, lo), hi)``; null stays null although greatest/least skip nulls."""
    out = col
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(col.isNotNull(), out)


def clip_flag(col: Column, lo: float, hi: float) -> Column:
    """Which bound a value was moved to: ``minimum``, ``maximum`` or null."""
    return F.when(col > F.lit(hi), F.lit("maximum")).when(col < F.lit(lo), F.lit("minimum"))


def logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def logit(p: Column) -> Column:
    return F.ln(p / (F.lit(1.0) - p))


def log_ratio(num: Column, den: Column) -> Column:
    """``ln(num / den)`` with every infinite or undefined result mapped to 0."""
    ratio = F.try_divide(num, den)
    return F.coalesce(F.when(ratio > 0, F.ln(ratio)), F.lit(0.0))


def step(col: Column, edges: Sequence[float], values: Sequence[Column]) -> Column:
    """Value of the right-closed interval of ``col``: ``values[i]`` for edges[i-1] < col <= edges[i].

    A balanced tree of conditions, so a lookup costs log2(n) comparisons and no shuffle.
    """
    if len(values) != len(edges) + 1:
        raise ValueError("need one value more than edges")

    def pick(lo: int, hi: int) -> Column:
        if lo == hi:
            return values[lo]
        mid = (lo + hi) // 2
        return F.when(col <= F.lit(edges[mid]), pick(lo, mid)).otherwise(pick(mid + 1, hi))

    return F.when(col.isNotNull(), pick(0, len(edges)))


def bin_index(col: Column, edges: Sequence[float]) -> Column:
    """0-based right-closed interval number between the finite inner ``edges``; null for null."""
    return step(col, list(edges), [F.lit(i) for i in range(len(edges) + 1)])


def bin_label(lo: float, hi: float) -> str:
    """``(lo, hi]`` with three significant digits and spelled-out infinite ends."""

    def fmt(x: float) -> str:
        if math.isinf(x):
            return "+inf" if x > 0 else "-inf"
        return f"{x:.3g}"

    return f"({fmt(lo)}, {fmt(hi)}]"


def null_fraction(cols: Sequence[Column]) -> Column:
    """Share of null entries among ``cols``; an empty list counts as one field."""
    total = F.lit(0)
    for c in cols:
        total = total + c.isNull().cast("int")
    return total.cast("double") / F.lit(float(max(len(cols), 1)))
