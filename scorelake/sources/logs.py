"""Prediction log and deployment log: row builders, append sinks and scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("trace_id", T.StringType()),
        T.StructField("features", T.StringType()),
        T.StructField("default_probability", T.DoubleType()),
        T.StructField("credit_score", T.IntegerType()),
        T.StructField("risk_band", T.StringType()),
        T.StructField("decision", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("scorecard_score", T.DoubleType()),
    ]
)

DEPLOYMENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("alias", T.StringType()),
        T.StructField("from_version", T.StringType()),
        T.StructField("to_version", T.StringType()),
        T.StructField("triggered_by", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)


def features_json(cols: Sequence[str]) -> Column:
    """All fields as one JSON object; null fields stay in it as null."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def audit_rows(scored: DataFrame, features: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Log rows of a scored table; log columns it lacks become null."""
    have = set(scored.columns)
    cols = []
    for f in PREDICTION_SCHEMA:
        if f.name == "features":
            cols.append(features_json(features).alias("features"))
        elif f.name in have:
            cols.append(F.col(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return scored.select(*carry, *cols)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Log table whose files may have different columns; absent ones read as null."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The four columns monitoring needs, oldest first."""
    log = read_log(spark, path)
    return log.select("ts", "default_probability", "decision", "features").orderBy("ts")


def prediction_by_trace(log: DataFrame, trace_id: str) -> DataFrame:
    """Point lookup; file statistics skip most row groups of a log sorted by trace id."""
    return log.filter(F.col("trace_id") == F.lit(trace_id))


def deployment_event(
    spark: SparkSession,
    event_type: str,
    alias: str,
    from_version: str | None,
    to_version: str,
    triggered_by: str = "api",
    reason: str | None = None,
    model_name: str = "credit_score_model",
    event_id: int | None = None,
) -> DataFrame:
    """One deployment event stamped with the current time."""
    value = {
        "id": event_id,
        "event_type": event_type,
        "model_name": model_name,
        "alias": alias,
        "from_version": from_version,
        "to_version": to_version,
        "triggered_by": triggered_by,
        "reason": reason,
    }
    return spark.range(1).select(
        *[
            (F.current_timestamp() if f.name == "ts" else F.lit(value[f.name]).cast(f.dataType)).alias(f.name)
            for f in DEPLOYMENT_SCHEMA
        ]
    )
