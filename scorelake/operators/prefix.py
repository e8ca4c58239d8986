"""Running totals over a global order without sending the order through one task.

Values are first grouped, so ties and hot values are one row each. Cut points (literals in
the plan, hence the same on every retry) split the value range into buckets of about equal
row counts; bucket totals give each bucket its offset, and a window sums inside a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scorelake.functions.scalars import bin_index
from scorelake.session import stage

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 2048


def cut_points(hist: DataFrame, order: str, rows_per_bucket: int) -> list[float]:
    """Inner cut points for ``order``; empty if the table fits one bucket. One job, bounded result."""
    n = hist.count()
    buckets = min(MAX_BUCKETS, math.ceil(n / rows_per_bucket))
    if buckets <= 1:
        return []
    probs = [i / buckets for i in range(1, buckets)]
    row = hist.agg(F.percentile_approx(order, probs, 10 * MAX_BUCKETS).alias("q")).first()
    return sorted(set(row.q))


def running_totals(
    hist: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    with_next: bool = False,
    staged: bool = False,
) -> DataFrame:
    """Add ``cum_<c>`` (inclusive, ascending ``order``) and ``tot_<c>`` for each column in ``sums``.

    ``hist`` holds one row per (``by``, ``order``), all non-null. ``with_next`` adds
    ``next_<order>``, the following value inside the ``by`` group.
    """
    by = list(by)
    if not staged:
        hist = stage(hist, "hist")
    cuts = cut_points(hist, order, rows_per_bucket)
    group = [F.col(c) for c in by] or [F.lit(1)]

    if not cuts:
        whole = Window.partitionBy(*group)
        ordered = whole.orderBy(order)
        upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cols: list[Column] = [F.sum(c).over(upto).alias(f"cum_{c}") for c in sums]
        if with_next:
            cols.append(F.lead(order).over(ordered).alias(f"next_{order}"))
        return hist.select("*", *cols, *[F.sum(c).over(whole).alias(f"tot_{c}") for c in sums])

    marked = hist.withColumn("_bucket", bin_index(F.col(order), cuts))
    totals = marked.groupBy(*by, "_bucket").agg(
        *[F.sum(c).alias(f"_b_{c}") for c in sums], F.min(order).alias("_first")
    )
    # At most MAX_BUCKETS rows per group from here on.
    whole = Window.partitionBy(*group)
    ordered = whole.orderBy("_bucket")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(f"_b_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *[F.sum(f"_b_{c}").over(whole).alias(f"tot_{c}") for c in sums],
        F.lead("_first").over(ordered).alias("_next_first"),
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = [F.sum(c).over(upto).alias(f"cum_{c}") for c in sums]
    if with_next:
        cols.append(F.lead(order).over(inside).alias("_next_in"))
    joined = marked.select("*", *cols).join(offsets, [*by, "_bucket"])
    out = joined.select(
        *hist.columns,
        *[(F.col(f"cum_{c}") + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in sums],
        *([F.coalesce("_next_in", "_next_first").alias(f"next_{order}")] if with_next else []),
        *[F.col(f"tot_{c}") for c in sums],
    )
    return out
