"""Exact selection by rank: which row is the r-th of its group in a total order.

Selecting the boundary row and comparing every row with it replaces a row_number over the
whole group: the wide table is never sorted or shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from scorelake.operators.prefix import ROWS_PER_BUCKET, running_totals
from scorelake.session import stage

SMALL_ROWS = 20_000_000
SKETCH_ACCURACY = 10_000
SKETCH_SLACK = 2.0 / SKETCH_ACCURACY

Bound = tuple[Any, Any]


def _any(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _segments(narrow: DataFrame, known: Mapping[Any, Sequence[int]], sizes: Mapping[Any, int]) -> dict[Any, list]:
    """Per group, disjoint key ranges that hold the wanted ranks, from one sketch pass."""
    probs = {
        g: [min(1.0, max(0.0, r / sizes[g] + d)) for r in rs for d in (-SKETCH_SLACK, SKETCH_SLACK)]
        for g, rs in known.items()
    }
    row = narrow.agg(
        *[
            F.percentile_approx(F.when(F.col("_g") == F.lit(g), F.col("_k")), ps, SKETCH_ACCURACY).alias(str(i))
            for i, (g, ps) in enumerate(probs.items())
        ]
    ).first()
    out = {}
    for i, g in enumerate(probs):
        merged: list[list] = []
        for lo, hi in sorted(zip(row[i][0::2], row[i][1::2])):
            if merged and lo <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], hi)
            else:
                merged.append([lo, hi])
        out[g] = merged
    return out


def rows_at_ranks(
    df: DataFrame,
    key: str,
    tie: str,
    ranks: Mapping[Any, Sequence[int]],
    by: str | None = None,
    sizes: Mapping[Any, int] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    small_rows: float = SMALL_ROWS,
) -> dict[tuple[Any, int], Bound]:
    """``{(group, rank): (key, tie)}`` for 1-based ranks in the order (``key``, ``tie``).

    ``ranks`` maps a value of ``by`` (None without groups) to the wanted ranks, ``sizes`` to
    the rows of the group if known. ``key`` is numeric, ``tie`` a unique numeric row id. On
    more than ``small_rows`` rows a sketch brackets the ranks and only keys inside a bracket
    are shuffled; the others are counted on the map side. The result is as small as ``ranks``.
    """
    wanted = {g: sorted(set(rs)) for g, rs in ranks.items() if rs}
    if not wanted:
        return {}
    group = F.col(by) if by else F.lit(0)
    narrow = df.select(group.alias("_g"), F.col(key).alias("_k"), F.col(tie).alias("_t"))
    known = {0: wanted[None]} if by is None else wanted
    if sizes is None:
        n = {r._g: r["count"] for r in narrow.groupBy("_g").count().collect()}
    else:
        n = {0: sizes[None]} if by is None else dict(sizes)
    known = {g: [r for r in rs if r <= n.get(g, 0)] for g, rs in known.items()}
    known = {g: rs for g, rs in known.items() if rs}
    if not known:
        return {}
    brackets = _segments(narrow, known, n) if sum(n.values()) > small_rows else {}

    # Segment 2i+1 is the closed bracket i of a group; even segments are the gaps between.
    seg, inside = F.lit(1), F.lit(True)
    for g, ranges in brackets.items():
        mine, within = F.lit(0), F.lit(False)
        for i, (lo, hi) in enumerate(ranges):
            hit = F.col("_k").between(F.lit(lo), F.lit(hi))
            mine = F.when(F.col("_k") > F.lit(hi), 2 * i + 2).when(hit, 2 * i + 1).otherwise(mine)
            within = within | hit
        seg = F.when(F.col("_g") == F.lit(g), mine).otherwise(seg)
        inside = F.when(F.col("_g") == F.lit(g), within).otherwise(inside)
    marked = narrow.filter(F.col("_g").isin(list(known))).select(
        "_g", seg.alias("_s"), F.when(inside, F.col("_k")).alias("_k"), "_t"
    )
    hist = stage(
        marked.groupBy("_g", "_s", "_k").agg(
            F.count("*").alias("_n"), F.min("_t").alias("_lo"), F.max("_t").alias("_hi")
        ),
        "ranks",
    )
    before: dict[tuple[Any, int], int] = {(g, 1): 0 for g in known}
    if brackets:
        per = {(r._g, r._s): r.n for r in hist.groupBy("_g", "_s").agg(F.sum("_n").alias("n")).collect()}
        for g in known:
            passed = 0
            for i in range(2 * len(brackets[g]) + 1):
                before[(g, i)] = passed
                passed += per.get((g, i), 0)
    cum = running_totals(
        hist.filter("_k is not null"), "_k", ["_n"], by=["_g", "_s"], rows_per_bucket=rows_per_bucket, staged=True
    )
    start = F.col("cum__n") - F.col("_n")
    hit = [
        (F.col("_g") == F.lit(g)) & (F.col("_s") == s) & (F.col("cum__n") >= r - b) & (start < r - b)
        for (g, s), b in before.items()
        if s % 2
        for r in known[g]
    ]
    found: dict[tuple[Any, int], Bound] = {}
    open_ties: dict[tuple[Any, Any], list[tuple[int, int]]] = {}
    for row in cum.filter(_any(hit)).collect():
        first = before[(row._g, row._s)] + row.cum__n - row._n
        for r in known[row._g]:
            if not first < r <= first + row._n:
                continue
            if r == first + 1:
                found[(row._g, r)] = (row._k, row._lo)
            elif r == first + row._n:
                found[(row._g, r)] = (row._k, row._hi)
            else:
                open_ties.setdefault((row._g, row._k), []).append((r, r - first))

    # A rank inside a run of equal keys: select again by the row id among those rows only.
    for (g, k), inner in open_ties.items():
        same = narrow.filter((F.col("_g") == F.lit(g)) & (F.col("_k") == F.lit(k)))
        again = rows_at_ranks(
            same, "_t", "_t", {None: [i for _, i in inner]}, rows_per_bucket=rows_per_bucket, small_rows=small_rows
        )
        for r, i in inner:
            found[(g, r)] = (k, again[(None, i)][1])
    # A rank that missed its bracket is searched in the whole group.
    missed = {g: [r for r in rs if (g, r) not in found] for g, rs in known.items()}
    if brackets and any(missed.values()):
        found |= rows_at_ranks(
            narrow, "_k", "_t", missed, "_g", n, rows_per_bucket=rows_per_bucket, small_rows=float("inf")
        )
    if by is None:
        return {(None, r): v for (_, r), v in found.items()}
    return found


def not_after(key: str, tie: str, bound: Bound) -> Column:
    """Row comes at or before ``bound`` in the order (``key``, ``tie``)."""
    k, t = bound
    return (F.col(key) < F.lit(k)) | ((F.col(key) == F.lit(k)) & (F.col(tie) <= F.lit(t)))


def nth_in_group(df: DataFrame, by: str, value: Any, row_id: str, index: int) -> DataFrame:
    """The row at 0-based position ``index`` among rows with ``by == value``, ordered by ``row_id``."""
    subset = df.filter(F.col(by) == F.lit(value))
    bound = rows_at_ranks(subset, row_id, row_id, {None: [index + 1]})
    if not bound:
        return subset.limit(0)
    key, _ = bound[(None, index + 1)]
    return subset.filter(F.col(row_id) == F.lit(key))
