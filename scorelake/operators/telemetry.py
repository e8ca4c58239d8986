"""Counters, bucket histograms, windowed rates, alert rules, liveness and rate limits over event logs.

The windowed functions are plain DataFrame operations, so they also run on streams that carry
a watermark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from scorelake.operators.chunks import micros
from scorelake.session import ship_by_value, stage

ship_by_value(__name__)


def bucket_aggs(value: str, bounds: Sequence[float]) -> list[Column]:
    """Cumulative bucket counts as an array (last entry: all), plus sum and count."""
    v = F.col(value)
    present = v.isNotNull()
    return [
        F.array(*[F.count_if(v <= F.lit(b)) for b in bounds], F.count_if(present)).alias("cum"),
        F.sum(v).alias("sum"),
        F.count(v).alias("count"),
    ]


def bucket_rows(hist: DataFrame, bounds: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Array of cumulative counts to ``(keys, le, cum)`` rows; the last ``le`` is infinity."""
    les = F.array(*[F.lit(float(b)) for b in bounds], F.lit(float("inf")))
    return hist.select(*keys, F.explode(F.arrays_zip(les.alias("le"), F.col("cum").alias("cum"))).alias("b")).select(
        *keys, F.col("b.le").alias("le"), F.col("b.cum").alias("cum")
    )


def histogram(df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*bucket_aggs(value, bounds))


def histogram_quantile(q: float, cum: Column, bounds: Sequence[float]) -> Column:
    """Quantile from cumulative counts, linear inside the bucket.

    The lowest bucket starts at 0 unless its bound is not positive, which is then the answer;
    beyond the last finite bound the answer is that bound. Null without observations.
    """
    total = F.element_at(cum, -1).cast("double")
    rank = F.lit(float(q)) * total
    answer = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        hi = float(bounds[i])
        lo = 0.0 if i == 0 else float(bounds[i - 1])
        here = cum[i].cast("double")
        before = F.lit(0.0) if i == 0 else cum[i - 1].cast("double")
        if i == 0 and hi <= 0:
            inside = F.lit(hi)
        else:
            inside = F.lit(lo) + F.lit(hi - lo) * F.coalesce(F.try_divide(rank - before, here - before), F.lit(0.0))
        answer = F.when(here >= rank, inside).otherwise(answer)
    return F.when(total > 0, answer)


def _window(ts: str, width: str, slide: str | None) -> Column:
    return F.window(ts, width, slide) if slide else F.window(ts, width)


def windowed(
    df: DataFrame, ts: str, width: str, aggs: Sequence[Column], slide: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Aggregates per (window, by) with the window bounds as columns."""
    out = df.groupBy(_window(ts, width, slide).alias("w"), *by).agg(*aggs)
    return out.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *out.columns[1:]
    )


def rate(
    df: DataFrame, ts: str, width: str, seconds: float, per: float = 1.0, slide: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Events per ``per`` seconds in windows ``seconds`` long."""
    return windowed(df, ts, width, [(F.count("*") / F.lit(seconds / per)).alias("rate")], slide, by)


def quantile_series(
    df: DataFrame, ts: str, value: str, bounds: Sequence[float], probs: Sequence[float], width: str,
    slide: str | None = None,
) -> DataFrame:
    """Histogram quantiles per window as ``q<percent>`` columns."""
    hist = windowed(df, ts, width, bucket_aggs(value, bounds), slide)
    return hist.select(
        "window_start", "window_end",
        *[histogram_quantile(q, F.col("cum"), bounds).alias(f"q{round(q * 100)}") for q in probs],
    )


def bucket_of(value: Column, bounds: Sequence[float]) -> Column:
    """Upper bound of the bucket a value falls into."""
    out = F.lit(float("inf"))
    for b in reversed(list(bounds)):
        out = F.when(value <= F.lit(float(b)), F.lit(float(b))).otherwise(out)
    return F.when(value.isNotNull(), out)


def heatmap(df: DataFrame, ts: str, value: str, bounds: Sequence[float], width: str) -> DataFrame:
    """Rows per (window, bucket)."""
    return windowed(
        df.withColumn("le", bucket_of(F.col(value), bounds)), ts, width, [F.count("*").alias("n")], by=["le"]
    )


def shares(df: DataFrame, by: str) -> DataFrame:
    """Count and share of each value of a low-cardinality column."""
    counts = df.groupBy(by).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def _epoch_us(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("_us", micros(df, ts))


def held_alerts(
    series: DataFrame, step_s: int, hold_s: int, condition: Column, at: str = "window_start", rule: str = "rule"
) -> DataFrame:
    """Runs of consecutive evaluation steps where ``condition`` holds for at least ``hold_s``.

    A step without data ends a run. One row per evaluation step and rule goes in, so the size
    of a rule is its timeline, not its events.
    """
    step = F.floor(F.col("_us") / F.lit(step_s * 1_000_000)).cast("bigint")
    true = _epoch_us(series, at).filter(condition).withColumn("_i", step)
    order = Window.partitionBy(rule).orderBy("_i")
    runs = true.withColumn("_run", F.col("_i") - F.row_number().over(order)).groupBy(rule, "_run").agg(
        F.min("_i").alias("first"), F.max("_i").alias("last")
    )
    span = (F.col("last") - F.col("first")) * F.lit(step_s)
    moment = lambda i: F.timestamp_seconds(i * F.lit(step_s))
    return runs.filter(span >= hold_s).select(
        rule,
        moment(F.col("first")).alias("pending_since"),
        (F.timestamp_seconds(F.col("first") * F.lit(step_s) + F.lit(hold_s))).alias("firing_since"),
        moment(F.col("last")).alias("last_true"),
    )


def rule_alerts(df: DataFrame, ts: str, rules: Sequence[tuple], step_s: int) -> DataFrame:
    """Held alerts of ``(rule, measure, of what, window minutes, threshold, hold seconds)`` over an event log.

    Measures are the ``rate`` a second and the ``increase`` of the events of a condition, and a histogram ``quantile`` of
    ``(value, bounds, q)``. They are taken each step over the window that ends there; without events a rule does not hold.
    """
    out = []
    for rule, measure, what, minutes, threshold, hold_s in rules:
        width, slide = f"{minutes} minutes", f"{step_s} seconds"
        if measure == "quantile":
            value, bounds, q = what
            hist = windowed(df, ts, width, bucket_aggs(value, bounds), slide)
            series = hist.withColumn("v", histogram_quantile(q, F.col("cum"), bounds))
        else:
            per = minutes * 60.0 if measure == "rate" else 1.0
            series = windowed(df.filter(what), ts, width, [(F.count("*") / F.lit(per)).alias("v")], slide)
        series = series.select("window_end", "v", F.lit(rule).alias("rule"))
        out.append(held_alerts(series, step_s, hold_s, F.col("v") > F.lit(float(threshold)), "window_end"))
    return reduce(DataFrame.unionByName, out)


def silent_gaps(df: DataFrame, by: str, ts: str, limit_s: float, segment_s: int = 86_400) -> DataFrame:
    """Pauses longer than ``limit_s`` between consecutive events of a source.

    Events are ordered inside (source, time segment); only segment ends meet across segments,
    so a source with most of the events is not one task.
    """
    instants = _epoch_us(df.select(by, ts), ts).select(by, "_us").distinct()
    marked = instants.withColumn("_seg", F.floor(F.col("_us") / F.lit(segment_s * 1_000_000)))
    inside = Window.partitionBy(by, "_seg").orderBy("_us")
    local = marked.withColumn("_next", F.lead("_us").over(inside)).filter("_next is not null")
    ends = marked.groupBy(by, "_seg").agg(F.min("_us").alias("_first"), F.max("_us").alias("_us"))
    across = ends.withColumn("_next", F.lead("_first").over(Window.partitionBy(by).orderBy("_seg")))
    pairs = local.select(by, "_us", "_next").unionByName(
        across.filter("_next is not null").select(by, "_us", "_next")
    )
    gap = (F.col("_next") - F.col("_us")) / F.lit(1_000_000.0)
    return pairs.filter(gap > limit_s).select(by, F.col("_us").alias("from_us"), F.col("_next").alias("to_us"), gap.alias("gap_s"))


# ---- rate limit ------------------------------------------------------------------------------


def _opened(us: np.ndarray, first: int, width: int) -> np.ndarray:
    """Positions of the events that open a window, starting at position ``first``."""
    out = []
    i = first
    while i < len(us):
        out.append(i)
        i = int(np.searchsorted(us, us[i] + width))
    return np.array(out, dtype=int)


def rate_limit(
    df: DataFrame, key: str, ts: str, row_id: str, limit: int = 100, window_s: int = 60, segment_s: int | None = None
) -> DataFrame:
    """Add ``window_us`` (start of the caller's window) and ``allowed``.

    A window opens at a caller's first event and lasts ``window_s``; the next one opens at the
    first event after it. The first ``limit`` events of a window are allowed.

    Which event opens a window depends on all earlier ones. Timelines are therefore cut into
    segments: each maps every window that could reach into it to the window that leaves it,
    the segments of a caller are chained through these small maps, and windows are then laid
    out per segment. Only distinct instants take part, so bursts at one instant stay small.
    Events without a caller share the limit of one caller of their own.
    """
    width = window_s * 1_000_000
    seg_us = max(segment_s or 60 * window_s, window_s) * 1_000_000
    # The caller as text that is never null, so that joins keep events without one.
    caller = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    rows = _epoch_us(df, ts).withColumn("_key", caller).withColumn("_seg", F.floor(F.col("_us") / F.lit(seg_us)).cast("bigint"))
    segments = stage(
        rows.groupBy("_key", "_seg").agg(F.sort_array(F.collect_set("_us")).alias("us")), "segments"
    )
    def exits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ent, ext = [], []
            for seg, us in zip(pdf["_seg"], pdf["us"]):
                us = np.asarray(us)
                jump = np.searchsorted(us, us + width)
                last = np.arange(len(us))
                while (move := jump[last] < len(us)).any():
                    last = np.where(move, jump[last], last)
                n = int(np.searchsorted(us, seg * seg_us + width)) + 1
                ent.append(us[:n])
                ext.append(us[last[:n]])
            yield pd.DataFrame({"_key": pdf["_key"], "_seg": pdf["_seg"], "ent": ent, "ext": ext})

    maps = segments.mapInPandas(exits, "_key string, _seg bigint, ent array<bigint>, ext array<bigint>")

    # A caller has one entry per active segment here: bounded by elapsed time, not by events.
    callers = maps.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_seg", "ent", "ext"))).alias("s")).select(
        "_key", F.col("s._seg").alias("segs"), F.col("s.ent").alias("ent"), F.col("s.ext").alias("ext")
    )

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ends = []
            for ent, ext in zip(pdf["ent"], pdf["ext"]):
                mine, end = [], -(2**62)
                for e, x in zip(ent, ext):
                    mine.append(end)
                    i = int(np.searchsorted(np.asarray(e), end))
                    if i < len(e):
                        end = int(x[i]) + width
                ends.append(mine)
            yield pd.DataFrame({"_key": pdf["_key"], "segs": pdf["segs"], "ends": ends})

    entry = callers.mapInPandas(chain, "_key string, segs array<bigint>, ends array<bigint>").select(
        "_key", F.explode(F.arrays_zip("segs", "ends")).alias("e")
    ).select("_key", F.col("e.segs").alias("_seg"), F.col("e.ends").alias("_end"))

    def layout(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            starts = []
            for us, end in zip(pdf["us"], pdf["_end"]):
                us = np.asarray(us)
                opened = us[_opened(us, int(np.searchsorted(us, end)), width)]
                starts.append(np.concatenate([[end - width], opened]))
            yield pd.DataFrame({"_key": pdf["_key"], "_seg": pdf["_seg"], "starts": starts})

    laid = segments.join(entry, ["_key", "_seg"]).mapInPandas(
        layout, "_key string, _seg bigint, starts array<bigint>"
    )
    placed = rows.join(laid, ["_key", "_seg"]).withColumn(
        "window_us", F.array_max(F.filter("starts", lambda s: s <= F.col("_us")))
    ).drop("starts", "_seg")
    # Only the first `limit` rows of a window survive each task, so a hot window stays small.
    order = Window.partitionBy("_key", "window_us").orderBy("_us", row_id)
    first = placed.select("_key", "window_us", "_us", row_id).withColumn("_rn", F.row_number().over(order)).filter(
        F.col("_rn") <= limit
    )
    last = first.groupBy("_key", "window_us").agg(F.max(F.struct(F.col("_us").alias("u"), F.col(row_id).alias("r"))).alias("_last"))
    inside = (F.col("_us") < F.col("_last.u")) | ((F.col("_us") == F.col("_last.u")) & (F.col(row_id) <= F.col("_last.r")))
    return placed.join(last, ["_key", "window_us"]).withColumn("allowed", inside).drop("_us", "_last", "_key")


def trace_ids(df: DataFrame, *parts: str, out: str = "trace_id") -> DataFrame:
    """Trace id from the request key: the same on every replay, unlike a random one."""
    digest = F.sha2(F.concat_ws("|", *[F.col(p).cast("string") for p in parts]), 256)
    cuts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return df.withColumn(out, F.concat_ws("-", *cuts))


def duplicate_ids(df: DataFrame, col: str = "trace_id") -> DataFrame:
    """Ids that occur more than once; empty when all are unique."""
    return df.groupBy(col).agg(F.count("*").alias("n")).filter("n > 1")
