"""Streaming requests through the same scoring path as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from scorelake.plans.scoring import Scorer, read_requests, score_rows
from scorelake.sources.logs import audit_rows


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event-time column as a timestamp with a watermark; later rows are dropped from windows."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def request_stream(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None, files_per_trigger: int = 100
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def score_stream(
    raw: DataFrame,
    body: str,
    fields: Sequence[str],
    scorer: Scorer,
    model_version: str,
    trace_key: Sequence[str],
    alias: str = "unknown",
    medians: Mapping[str, float | None] | None = None,
) -> DataFrame:
    """Prediction-log rows of well-formed requests; stateless, so any batch size gives the same rows."""
    good, _ = read_requests(raw, body, fields)
    scored = score_rows(good, scorer, model_version, trace_key, alias, medians)
    return audit_rows(scored, list(fields), carry=[c for c in trace_key if c != "ts"])


def refused_stream(raw: DataFrame, body: str, fields: Sequence[str]) -> DataFrame:
    """Requests that ``score_stream`` leaves out, with their ``errors``, for a quarantine table next to its output."""
    _, refused = read_requests(raw, body, fields)
    return refused.select(*raw.columns, "errors")


def unique_traces(scored: DataFrame, ts: str, delay: str, trace: str = "trace_id") -> DataFrame:
    """Drop replays of a trace id seen within ``delay``."""
    return with_event_time(scored, ts, delay).dropDuplicatesWithinWatermark([trace])


def append_stream(df: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Exactly-once append to Parquet; ``once`` drains what is there and stops."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
