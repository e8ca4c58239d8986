"""Row-count chunks of a log in time order."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from scorelake.functions.scalars import bin_index
from scorelake.operators.prefix import MAX_BUCKETS, ROWS_PER_BUCKET
from scorelake.operators.ranks import not_after, rows_at_ranks

MIN_ROWS = 50
LITERAL_CHUNKS = 128
#: Rows without a time come before all others, on either path.
NO_TIME = -(1 << 63)


def micros(df: DataFrame, ts: str) -> Column:
    """Timestamp column as epoch microseconds, whatever the session time zone."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")
    return F.unix_micros(ts)


def default_chunk_size(n: int) -> int:
    """About seven chunks, never below the minimum row count."""
    return max(MIN_ROWS, n // 7)


def chunk_count(n: int, size: int, incomplete: str = "append") -> int:
    if incomplete == "append":
        return max(1, n // size)
    if incomplete == "keep":
        return max(1, math.ceil(n / size))
    raise ValueError("incomplete is 'append' or 'keep'")


def assign_chunks(
    df: DataFrame,
    ts: str,
    row_id: str,
    size: int | None = None,
    incomplete: str = "append",
    n: int | None = None,
) -> DataFrame:
    """Add ``chunk_id``: runs of ``size`` rows in (``ts``, ``row_id``) order.

    A short last chunk joins the one before (``append``) or stands alone (``keep``). Rows without a time are the first.
    Many chunks are found by position instead of by their boundary rows; both give the same chunks.
    """
    n = df.count() if n is None else n
    size = size or default_chunk_size(n)
    chunks = chunk_count(n, size, incomplete)
    keyed = df.withColumn("_us", F.coalesce(micros(df, ts), F.lit(NO_TIME)))
    if chunks > LITERAL_CHUNKS:
        indexed = row_index(keyed, "_us", row_id)
        return indexed.withColumn(
            "chunk_id", F.least(F.expr(f"_idx div {size}"), F.lit(chunks - 1)).cast("int")
        ).drop("_us", "_idx")
    bounds = rows_at_ranks(
        keyed, "_us", row_id, {None: [size * i for i in range(1, chunks)]}, sizes={None: n}
    )
    ordered = [bounds[k] for k in sorted(bounds, key=lambda k: k[1])]

    def pick(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(not_after("_us", row_id, ordered[mid]), pick(lo, mid)).otherwise(pick(mid + 1, hi))

    return keyed.withColumn("chunk_id", pick(0, len(ordered))).drop("_us")


def row_index(df: DataFrame, key: str, tie: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``_idx``, the 0-based position in the order (``key``, ``tie``), both integers.

    A key value holding more than one bucket of rows gets buckets of its own, split by ``tie``. Null keys come first.
    """
    given = key
    df, key = df.withColumn("_k", F.coalesce(F.col(given), F.lit(NO_TIME))), "_k"
    n = df.count()
    buckets = min(MAX_BUCKETS, math.ceil(n / rows_per_bucket))
    cuts: list[int] = []
    ties: list[int] = []
    heavy: list[int] = []
    if buckets > 1:
        probs = [i / buckets for i in range(1, buckets)]
        row = df.agg(
            F.percentile_approx(key, probs, 10 * MAX_BUCKETS).alias("k"),
            F.percentile_approx(tie, probs, 10 * MAX_BUCKETS).alias("t"),
        ).first()
        heavy = sorted({a for a, b in zip(row.k, row.k[1:]) if a == b})
        cuts = sorted(set(row.k) | {v - 1 for v in heavy})
        ties = sorted(set(row.t))
    marked = df.withColumn("_b", bin_index(F.col(key), cuts) if cuts else F.lit(0))
    sub = F.lit(0)
    if heavy:
        sub = F.when(F.col(key).isin(heavy), bin_index(F.col(tie), ties)).otherwise(F.lit(0))
    marked = marked.withColumn("_s", sub)
    # One row per bucket: bounded by MAX_BUCKETS squared, far less without heavy keys.
    before = Window.partitionBy(F.lit(1)).orderBy("_b", "_s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = marked.groupBy("_b", "_s").agg(F.count("*").alias("_n")).select(
        "_b", "_s", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o")
    )
    inside = Window.partitionBy("_b", "_s").orderBy(key, tie)
    return (
        marked.withColumn("_r", F.row_number().over(inside))
        .join(offsets, ["_b", "_s"])
        .withColumn("_idx", F.col("_r") - 1 + F.col("_o"))
        .drop("_b", "_s", "_r", "_o", "_k")
    )
