"""Exact column quantiles (linear interpolation) for many columns at once.

Small tables are ranked whole. Large ones take two narrow passes: a sketch brackets each
wanted rank, then only values inside a bracket are shuffled while everything outside is
reduced to counts on the map side. A rank that misses its bracket is searched in full.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from scorelake.operators.prefix import ROWS_PER_BUCKET, running_totals
from scorelake.session import stage

SMALL_CELLS = 20_000_000
SKETCH_ACCURACY = 10_000


def _merge(intervals: list[tuple[float, float]]) -> list[tuple[float, float]]:
    merged: list[tuple[float, float]] = []
    for lo, hi in sorted(intervals):
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], hi))
        else:
            merged.append((lo, hi))
    return merged


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    accuracy: int | None = None,
    small_cells: int = SMALL_CELLS,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> dict[str, list[float | None]]:
    """``{column: [quantile for each prob]}``; nulls ignored, all-null columns give None.

    With ``accuracy`` the answer is the sketch itself (one pass, approximate).
    """
    cols, probs = list(cols), list(probs)
    if accuracy is not None:
        row = df.agg(
            *[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(c) for c in cols]
        ).first()
        return {c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in cols}

    # One narrow pass: counts, and the bracket around each wanted rank from a sketch.
    eps = 2.0 / SKETCH_ACCURACY
    around = [p for q in probs for p in (max(0.0, q - eps), min(1.0, q + eps))]
    row = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in cols],
        *[F.percentile_approx(F.col(c).cast("double"), around, SKETCH_ACCURACY).alias(f"q_{c}") for c in cols],
    ).first()
    counts = {c: row[f"n_{c}"] for c in cols}
    brackets: dict[str, list[tuple[float, float]]] = {}
    if sum(counts.values()) > small_cells:
        for c in cols:
            cut = row[f"q_{c}"]
            if cut is not None:
                brackets[c] = _merge(list(zip(cut[0::2], cut[1::2])))
    return _select(df, [c for c in cols if counts[c]], probs, counts, brackets, rows_per_bucket) | {
        c: [None] * len(probs) for c in cols if not counts[c]
    }


def _select(df, cols, probs, counts, brackets, rows_per_bucket):
    if not cols:
        return {}
    spark = df.sparkSession
    entries = []
    for c in cols:
        value = F.col(c).cast("double")
        if c in brackets:
            # Segment 2i+1 is the closed bracket i; even segments are the gaps between.
            seg = F.lit(0)
            inside = F.lit(False)
            for i, (lo, hi) in enumerate(brackets[c]):
                hit = (value >= lo) & (value <= hi)
                seg = F.when(value > hi, 2 * i + 2).when(hit, 2 * i + 1).otherwise(seg)
                inside = inside | hit
        else:
            seg, inside = F.lit(1), F.lit(True)
        entries.append(
            F.struct(
                F.lit(c).alias("feature"),
                seg.alias("seg"),
                F.when(inside, value).alias("v"),
                value.isNotNull().alias("ok"),
            )
        )
    long = df.select(F.inline(F.array(*entries))).filter("ok")
    hist = stage(long.groupBy("feature", "seg", "v").agg(F.count("*").alias("n")), "quantiles")

    sizes: dict[str, dict[int, int]] = {c: {} for c in cols}
    if brackets:
        for row in hist.groupBy("feature", "seg").agg(F.sum("n").alias("n")).collect():
            sizes[row.feature][row.seg] = row.n
    else:
        sizes = {c: {1: counts[c]} for c in cols}

    targets: list[tuple[str, int, int, int]] = []
    missed: list[str] = []
    for c in cols:
        for q in probs:
            h = (counts[c] - 1) * q
            for rank in {math.floor(h), math.ceil(h)}:
                left = rank + 1
                for seg in sorted(sizes[c]):
                    if left <= sizes[c][seg]:
                        break
                    left -= sizes[c][seg]
                if seg % 2 == 0:
                    missed.append(c)
                targets.append((c, seg, left, rank))
    targets = [t for t in dict.fromkeys(targets) if t[0] not in set(missed)]

    at: dict[tuple[str, int], float] = {}
    if targets:
        want = spark.createDataFrame(targets, "feature string, seg int, r bigint, pos bigint")
        cum = running_totals(
            hist.filter("v is not null"), "v", ["n"], by=["feature", "seg"],
            rows_per_bucket=rows_per_bucket, staged=True,
        )
        # `want` holds two rows per column and probability, so broadcasting it is bounded.
        hits = cum.join(F.broadcast(want), ["feature", "seg"]).filter(
            (F.col("cum_n") >= F.col("r")) & (F.col("cum_n") - F.col("n") < F.col("r"))
        )
        for row in hits.select("feature", "pos", "v").collect():
            at[(row.feature, row.pos)] = row.v

    out: dict[str, list[float | None]] = {}
    for c in cols:
        if c in missed:
            continue
        vals = []
        for q in probs:
            h = (counts[c] - 1) * q
            lo, hi = at[(c, math.floor(h))], at[(c, math.ceil(h))]
            vals.append(lo + (hi - lo) * (h - math.floor(h)))
        out[c] = vals
    if missed:
        out |= _select(df, list(dict.fromkeys(missed)), probs, counts, {}, rows_per_bucket)
    return out
