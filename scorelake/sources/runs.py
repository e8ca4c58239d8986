"""Run tracking: metrics and parameters as long rows, summaries as JSON, latest-value reads."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

PARAM_SCHEMA = "run_id string, param string, value string"


def param_rows(spark: SparkSession, run_id: str, params: Mapping[str, object]) -> DataFrame:
    return spark.createDataFrame([(run_id, k, str(v)) for k, v in params.items()], PARAM_SCHEMA)


def melt_metrics(df: DataFrame, keys: list[str]) -> DataFrame:
    """Wide metric columns to long ``(keys, metric, value)`` rows."""
    metrics = [c for c in df.columns if c not in keys]
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in metrics]).unpivot(
        keys, metrics, "metric", "value"
    )


def latest(metrics: DataFrame, order: str = "run_ts", by: str = "metric") -> DataFrame:
    """Newest non-null value of each metric."""
    return (
        metrics.filter(F.col("value").isNotNull())
        .groupBy(by)
        .agg(F.max_by("value", order).alias("value"), F.max(order).alias(order))
    )


def stale(metrics: DataFrame, now: datetime, days: int = 7, order: str = "run_ts") -> DataFrame:
    """Whether the newest run is older than ``days`` before ``now``."""
    return metrics.agg(F.max(order).alias("last_run")).select(
        "last_run", (F.col("last_run") < F.lit(now) - F.make_dt_interval(F.lit(days))).alias("stale")
    )


def write_summary(summary: DataFrame, path: str) -> None:
    """Nested one-row summary as JSON."""
    summary.write.mode("overwrite").json(path)
