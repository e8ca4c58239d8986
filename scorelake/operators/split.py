"""Seeded stratified splits and folds that are exact in size and repeatable.

Rows are ordered by a hash of their key. Only the boundary rows are looked up, so a split
is a comparison per row and moves no wide data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from scorelake.operators.ranks import not_after, rows_at_ranks


def hash60(seed: int, *parts: str) -> Column:
    """60-bit non-negative integer from the MD5 of ``seed|part|...``."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def test_counts(sizes: dict[int, int], test_size: float) -> dict[int, int]:
    """Test rows per label: floor of the proportional share, the rest to the largest remainders."""
    n = sum(sizes.values())
    total = math.ceil(test_size * n)
    share = {l: total * s / n for l, s in sizes.items()}
    out = {l: math.floor(v) for l, v in share.items()}
    order = sorted(sizes, key=lambda l: (-(share[l] - out[l]), l))
    for l in order[: total - sum(out.values())]:
        out[l] += 1
    return out


def _sizes(df: DataFrame, label: str) -> dict[int, int]:
    """Rows of each label; a row without one has no stratum."""
    sizes = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    if None in sizes:
        raise ValueError(f"{sizes[None]} rows have no {label}: drop or label them before a stratified split")
    return sizes


def stratified_split(
    df: DataFrame, row_id: str, label: str = "label", test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``split`` (train or test) with the label share kept in both."""
    sizes = _sizes(df, label)
    counts = test_counts(sizes, test_size)
    keyed = df.withColumn("_h", hash60(seed, row_id))
    bounds = rows_at_ranks(keyed, "_h", row_id, {l: [c] for l, c in counts.items() if c}, label, sizes)
    in_test = F.lit(False)
    for (l, _), bound in bounds.items():
        in_test = in_test | ((F.col(label) == F.lit(l)) & not_after("_h", row_id, bound))
    return keyed.withColumn("split", F.when(in_test, "test").otherwise("train")).drop("_h")


def stratified_folds(
    df: DataFrame, row_id: str, label: str = "label", folds: int = 5, seed: int = 42
) -> DataFrame:
    """Add ``fold`` in 0..folds-1, each with the same label share to within one row."""
    sizes = _sizes(df, label)
    ranks = {l: [n * i // folds for i in range(1, folds) if n * i // folds] for l, n in sizes.items()}
    keyed = df.withColumn("_h", hash60(seed, row_id))
    bounds = rows_at_ranks(keyed, "_h", row_id, ranks, label, sizes)
    fold = F.lit(0)
    for l, rs in ranks.items():
        passed = F.lit(0)
        for r in rs:
            passed = passed + (~not_after("_h", row_id, bounds[(l, r)])).cast("int")
        fold = F.when(F.col(label) == F.lit(l), passed).otherwise(fold)
    return keyed.withColumn("fold", fold.cast("int")).drop("_h")
