"""Telemetry over logs, and streams that must agree with the same work on tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorelake.operators import telemetry as tm
from scorelake.streaming import limits
from scorelake.streaming.scoring import append_stream, unique_traces, with_event_time


def brute_limit(pdf, limit, width_us):
    out = {}
    for _, mine in pdf.sort_values(["key", "us", "id"]).groupby("key"):
        start, n = -(2**62), 0
        for row in mine.itertuples():
            if row.us >= start + width_us:
                start, n = row.us, 0
            n += 1
            out[row.id] = (start, n <= limit)
    return out


@pytest.fixture(scope="module")
def calls(spark):
    """One caller makes more than a third of all calls, many at the same instant."""
    rng = np.random.default_rng(8)
    n = 4000
    key = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 30, n))
    us = 1_700_000_000_000_000 + rng.integers(0, 4000, n) * 1_000_000
    us = np.where(rng.random(n) < 0.1, 1_700_000_300_000_000, us)
    pdf = pd.DataFrame({"id": np.arange(n), "key": key, "us": us})
    return pdf, spark.createDataFrame(pdf).withColumn("ts", F.timestamp_micros("us"))


@pytest.mark.parametrize("limit, window_s, segment_s", [(3, 60, 60), (5, 60, 600), (1, 7, 7), (100, 500, None)])
def test_rate_limit_equals_brute_force(calls, limit, window_s, segment_s):
    pdf, df = calls
    got = tm.rate_limit(df, "key", "ts", "id", limit, window_s, segment_s)
    assert {r.id: (r.window_us, r.allowed) for r in got.collect()} == brute_limit(pdf, limit, window_s * 1_000_000)


def test_hundred_of_120_calls_pass(spark):
    df = spark.range(120).select("id", F.lit(1).alias("key"), F.timestamp_millis(1_700_000_000_000 + F.col("id") * 233).alias("ts"))
    got = tm.rate_limit(df, "key", "ts", "id").filter("not allowed")
    assert got.count() == 20 and got.agg(F.min("id")).first()[0] == 100


def drain(stream, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)


def test_streamed_rate_limit_equals_table(spark, calls, tmp_path):
    pdf, df = calls
    path = str(tmp_path / "calls")
    for part in range(3):  # files arrive in time order
        cut = pdf.us.quantile([part / 3, (part + 1) / 3]).to_numpy()
        rows = df.filter((F.col("us") >= int(cut[0])) & (F.col("us") < int(cut[1]) + (part == 2)))
        rows.select("id", "key", "us").coalesce(1).write.mode("append").parquet(path)
    limits.use_state_store(spark)
    stream = spark.readStream.schema("id bigint, key bigint, us bigint").option("maxFilesPerTrigger", 1).option(
        "latestFirst", "false"
    ).parquet(path)
    got = {r.id: (r.window_us, r.allowed) for r in drain(limits.limit_stream(stream, 3, 60), "limited").collect()}
    assert got == brute_limit(pdf, 3, 60_000_000)


STEPS = [("r", i, v) for i, v in enumerate([1, 1, 1, 0, 1, 1, 1, 1, 1])] + [("s", 0, 1), ("s", 2, 1), ("s", 3, 1)]


def test_alert_needs_to_hold(spark, tmp_path):
    series = spark.createDataFrame(STEPS, "rule string, i int, v int").withColumn(
        "window_start", F.timestamp_seconds(1_700_000_040 + F.col("i") * 60)
    )
    got = tm.held_alerts(series, 60, 120, F.col("v") == 1).orderBy("pending_since").collect()
    spans = [(r.rule, (r.firing_since - r.pending_since).seconds, (r.last_true - r.pending_since).seconds) for r in got]
    assert spans == [("r", 120, 120), ("r", 120, 240)]

    path = str(tmp_path / "steps")
    rows = series.select("rule", F.unix_micros("window_start").alias("us"), (F.col("v") == 1).alias("true"), "i")
    for i in range(9):
        rows.filter(F.col("i") == i).drop("i").coalesce(1).write.mode("append").parquet(path)
    limits.use_state_store(spark)
    stream = spark.readStream.schema("rule string, us bigint, `true` boolean").option("maxFilesPerTrigger", 2).parquet(path)
    fired = drain(limits.hold_stream(stream, 60, 120), "fired").collect()
    firing = sorted((r.rule, r.pending_us, r.firing_us) for r in fired)
    us = lambda t: int(t.timestamp() * 1_000_000)
    assert firing == sorted((r.rule, us(r.pending_since), us(r.firing_since)) for r in got)


def test_silent_source_is_reported(spark):
    limits.use_state_store(spark)
    beats = spark.readStream.format("rate").option("rowsPerSecond", 1).load().filter("value = 0").select(F.lit("api").alias("source"))
    q = limits.silence_stream(beats, 1).writeStream.format("memory").queryName("silent").outputMode("update").trigger(
        processingTime="500 milliseconds"
    ).start()
    try:
        for _ in range(60):
            if spark.table("silent").count():
                break
            q.awaitTermination(1)
        assert [r.source for r in spark.table("silent").collect()] == ["api"]
    finally:
        q.stop()


def test_silent_gaps(spark):
    times = [("a", 0), ("a", 30), ("a", 100), ("a", 90_000), ("b", 5)]
    df = spark.createDataFrame(times, "source string, s int").withColumn("ts", F.timestamp_seconds("s"))
    got = [(r.source, r.from_us // 10**6, r.to_us // 10**6) for r in tm.silent_gaps(df, "source", "ts", 60).orderBy("from_us").collect()]
    assert got == [("a", 30, 100), ("a", 100, 90_000)]


def test_histogram_quantile_rules(spark):
    bounds = [0.1, 0.2, 0.5]
    df = spark.createDataFrame([(v,) for v in [0.05] * 2 + [0.15] * 6 + [0.4, 9.0]], "x double")
    row = tm.histogram(df, "x", bounds).select(
        *[tm.histogram_quantile(q, F.col("cum"), bounds).alias(f"q{int(q * 100)}") for q in (0.1, 0.5, 0.8, 0.99)]
    ).first()
    assert row.q10 == pytest.approx(0.05) and row.q50 == pytest.approx(0.1 + 0.1 * 3 / 6)
    assert row.q80 == pytest.approx(0.2) and row.q99 == 0.5
    empty = tm.histogram(df.filter("x > 100"), "x", bounds).select(tm.histogram_quantile(0.5, F.col("cum"), bounds)).first()
    assert empty[0] is None
    zero = spark.createDataFrame([(0.0,)], "x double")
    assert tm.histogram(zero, "x", [0.0, 1.0]).select(tm.histogram_quantile(0.5, F.col("cum"), [0.0, 1.0])).first()[0] == 0.0


def test_windows_on_a_stream_equal_windows_on_the_table(spark, calls, tmp_path):
    _, df = calls
    path = str(tmp_path / "calls")
    df.select("id", "key", "ts").repartition(3).write.parquet(path)
    table = tm.rate(df, "ts", "1 minute", 60, 60)
    stream = with_event_time(spark.readStream.schema("id bigint, key bigint, ts timestamp").parquet(path), "ts", "2 hours")
    got = drain(tm.rate(stream, "ts", "1 minute", 60, 60), "rates", "complete")
    assert got.exceptAll(table).count() == 0 and got.count() == table.count()


def test_replayed_traces_are_dropped(spark, calls, tmp_path):
    _, df = calls
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    traced = tm.trace_ids(df, "id", "ts").select("id", "ts", "trace_id")
    assert tm.duplicate_ids(traced).count() == 0
    traced.write.parquet(path)
    traced.filter("id < 500").write.mode("append").parquet(path)
    stream = spark.readStream.schema(traced.schema).parquet(path)
    append_stream(unique_traces(stream, "ts", "2 hours"), out, state, once=True).awaitTermination()
    assert spark.read.parquet(out).count() == traced.count()
