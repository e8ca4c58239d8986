"""Monitoring runs: scored reference, performance estimate, drift, one summary row."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from scorelake.functions.decision import REVIEW_FROM, flagged
from scorelake.operators import cbpe, chunks, drift, reshape
from scorelake.operators.validate import common_columns, well_filled
from scorelake.session import stage
from scorelake.sources.tables import resume_stage

log = logging.getLogger(__name__)

MIN_FILL = 0.30
MIN_UNIVARIATE = 2
MIN_MULTIVARIATE = 4

SUMMARY_SCHEMA = (
    "run_ts timestamp, production_rows bigint, chunk_size bigint, cbpe_estimated_auc double, "
    "cbpe_estimated_f1 double, cbpe_n_alerts int, cbpe_ok boolean, drifted_features_count int, "
    "drifted_features array<string>, univariate_ok boolean, reconstruction_error double, multivariate_ok boolean"
)


def scored_reference(
    spark: SparkSession,
    root: str,
    model_version: str,
    score: Callable[[], DataFrame],
    label: str = "label",
    threshold: float = REVIEW_FROM,
) -> DataFrame:
    """Labelled, scored reference rows, built once per model version."""

    def build() -> DataFrame:
        scored = score()
        return scored.select(
            *[c for c in scored.columns if c not in (label, "p")],
            F.col("p").alias("y_pred_proba"),
            flagged(F.col("p"), threshold).alias("y_pred"),
            F.col(label).cast("int").alias("y_true"),
        )

    return resume_stage(spark, root, "reference", {"model": model_version}, build)


def production_rows(predictions: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Prediction log to flat rows: features unnested, probability and flag added."""
    flat = reshape.unnest_json(predictions, "features", fields)
    p = F.col("default_probability").cast("double")
    return flat.withColumn("p", p).withColumn("y_pred", flagged(p))


@dataclass
class MonitorInput:
    """Reference and production with time, unique integer row id and probability; reference has labels."""

    reference: DataFrame
    production: DataFrame
    features: Sequence[str]
    ts: str = "ts"
    row_id: str = "event_id"
    p: str = "p"
    y: str = "y"


def performance(data: MonitorInput, size: int, calibrate: bool = True) -> tuple[DataFrame, DataFrame]:
    """Estimated metrics per production chunk, and the same as long rows with limits and alerts."""
    ref = chunks.assign_chunks(data.reference, data.ts, data.row_id, size)
    bounds = cbpe.limits(cbpe.realized(ref, p=data.p, y=data.y))
    model = cbpe.calibration_if_useful(data.reference, data.row_id, data.p, data.y) if calibrate else None
    prod = data.production.withColumn("_raw", F.col(data.p))
    estimated = stage(cbpe.estimate(cbpe.calibrate(prod, model, data.p), p=data.p, raw="_raw"), "cbpe")
    return estimated, cbpe.with_alerts(estimated, bounds)


def _part(name: str, run: Callable[[], dict[str, Any]], empty: dict[str, Any]) -> dict[str, Any]:
    """A failed part of a run leaves nulls and ``ok = false``; the other parts still run."""
    try:
        return {**run(), f"{name}_ok": True}
    except Exception:
        log.exception("%s failed", name)
        return {**empty, f"{name}_ok": False}


def run_monitor(data: MonitorInput, run_ts: datetime | None = None, calibrate: bool = True) -> DataFrame | None:
    """One summary row, or None when production has fewer rows than one chunk needs."""
    spark = data.production.sparkSession
    n = data.production.count()
    if n < chunks.MIN_ROWS:
        log.warning("%d production rows, need %d", n, chunks.MIN_ROWS)
        return None
    size = chunks.default_chunk_size(n)
    chunked = stage(chunks.assign_chunks(data.production, data.ts, data.row_id, size, n=n), "chunked")
    data = MonitorInput(data.reference, chunked, data.features, data.ts, data.row_id, data.p, data.y)

    def estimated() -> dict[str, Any]:
        per_chunk, alerts = performance(data, size, calibrate)
        value = {
            m: drift.latest_value(per_chunk.withColumnRenamed(m, "value")).first().value for m in ("roc_auc", "f1")
        }
        n_alerts = drift.count_alerts(alerts.filter("metric = 'roc_auc'")).first().n_alerts
        return {"cbpe_estimated_auc": value["roc_auc"], "cbpe_estimated_f1": value["f1"], "cbpe_n_alerts": int(n_alerts)}

    shared = common_columns(data.features, data.reference, data.production)
    filled = well_filled(chunked, shared, MIN_FILL) if shared else []

    def univariate() -> dict[str, Any]:
        if len(filled) < MIN_UNIVARIATE:
            raise ValueError(f"{len(filled)} features are filled well enough")
        found = drift.drifted_features(drift.univariate_drift(data.reference, chunked, filled)).first()
        return {"drifted_features": found.drifted_features, "drifted_features_count": len(found.drifted_features)}

    def multivariate() -> dict[str, Any]:
        if len(filled) < MIN_MULTIVARIATE:
            raise ValueError(f"{len(filled)} features are filled well enough")
        error = drift.latest_value(drift.multivariate_drift(data.reference, chunked, filled)).first()
        return {"reconstruction_error": error.value}

    summary: dict[str, Any] = {
        "run_ts": run_ts or datetime.now(timezone.utc), "production_rows": n, "chunk_size": size,
        **_part("cbpe", estimated, {"cbpe_estimated_auc": None, "cbpe_estimated_f1": None, "cbpe_n_alerts": None}),
        **_part("univariate", univariate, {"drifted_features": None, "drifted_features_count": None}),
        **_part("multivariate", multivariate, {"reconstruction_error": None}),
    }
    names = [f.strip().split(" ")[0] for f in SUMMARY_SCHEMA.split(",")]
    return spark.createDataFrame([tuple(summary[c] for c in names)], SUMMARY_SCHEMA)


def gauges(summary: DataFrame) -> DataFrame:
    """Run gauges as long rows; a missing value stays null."""
    names = ["cbpe_estimated_auc", "cbpe_estimated_f1", "drifted_features_count", "production_rows"]
    wide = summary.select("run_ts", *[F.col(c).cast("double").alias(c) for c in names])
    return wide.unpivot(["run_ts"], names, "metric", "value")
