"""Deployment event log and model versions as tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from scorelake.operators.chunks import row_index
from scorelake.operators.prefix import running_totals
from scorelake.operators.split import hash60
from scorelake.sources.logs import append, deployment_event, read_log


def alias_state(log: DataFrame) -> DataFrame:
    """Version each alias points to: ``to_version`` of its last event."""
    return log.groupBy("alias").agg(
        F.max_by("to_version", F.struct("ts", "id")).alias("version"), F.max("ts").alias("since")
    )


def rollback_target(log: DataFrame) -> DataFrame:
    """Per alias, where a rollback would go: the ``from_version`` of its newest promotion.

    Only promotions count, so a second rollback in a row has the same target. No row where
    there is nothing to go back to.
    """
    newest = log.filter(F.col("event_type") == "promote").groupBy("alias").agg(
        F.max_by(F.struct("from_version", "to_version"), F.struct("ts", "id")).alias("e")
    )
    return newest.select(
        "alias", F.col("e.from_version").alias("target_version"), F.col("e.to_version").alias("current_version")
    ).filter(F.col("target_version").isNotNull())


def history(log: DataFrame, limit: int = 10) -> DataFrame:
    """Newest events first."""
    return log.orderBy(F.col("ts").desc(), F.col("id").desc()).limit(limit)


def versions_newest_first(versions: DataFrame) -> DataFrame:
    """Ordered by the version as a number, not as text."""
    return versions.orderBy(F.col("version").cast("bigint").desc())


def version_places(versions: DataFrame) -> DataFrame:
    """``version`` and its ``place``, the newest first, without sorting all versions in one task."""
    keyed = versions.withColumn("_v", -F.col("version").cast("bigint"))
    return row_index(keyed, "_v", "_v").select("version", (F.col("_idx") + 1).alias("place"))


def version_for_runs(runs: DataFrame, versions: DataFrame) -> DataFrame:
    """Version registered for each run; the newest one if a run was registered more than once."""
    newest = versions.groupBy("run_id").agg(F.max_by("version", F.col("version").cast("bigint")).alias("version"))
    return runs.join(newest, "run_id").select("run_id", "version")


def next_id(log: DataFrame) -> int:
    return (log.agg(F.max("id").alias("m")).first().m or 0) + 1


def promote(spark, path: str, version: str, alias: str = "champion", by: str = "unknown") -> str | None:
    """Point ``alias`` at ``version`` and log it; returns the version it replaced. Single writer."""
    log = read_log(spark, path)
    row = alias_state(log.filter(F.col("alias") == alias)).first()
    previous = row.version if row else None
    append(
        deployment_event(spark, "promote", alias, previous, str(version), by, event_id=next_id(log)), path
    )
    return previous


def rollback(spark, path: str, alias: str = "champion", reason: str = "manual rollback", by: str = "unknown") -> str:
    """Point ``alias`` back to where its newest promotion came from and log it. Single writer."""
    log = read_log(spark, path)
    row = rollback_target(log.filter(F.col("alias") == alias)).first()
    if row is None:
        raise LookupError(f"no previous version of alias {alias!r}")
    append(
        deployment_event(
            spark, "rollback", alias, row.current_version, row.target_version, by, reason, event_id=next_id(log)
        ),
        path,
    )
    return row.target_version


def assign_aliases(
    runs: DataFrame, versions: DataFrame, roles: Mapping[str, str], role: str = "model_type"
) -> DataFrame:
    """Alias events for freshly trained runs: ``roles`` maps a model type to its alias."""
    found = version_for_runs(runs, versions).join(runs, "run_id")
    alias = F.create_map(*[F.lit(x) for kv in roles.items() for x in kv])[F.col(role)]
    return found.withColumn("alias", alias).filter("alias is not null").select(
        "run_id", "alias", F.col("version").alias("to_version"), F.lit("promote").alias("event_type")
    )


def register_runs(runs: DataFrame, versions: DataFrame, model: str = "model_name") -> DataFrame:
    """Next version numbers for new runs of each model, in the order of a run id hash. Single writer.

    Numbers come from running totals, so a model with most of the runs is not one task.
    """
    current = versions.groupBy(model).agg(F.max(F.col("version").cast("bigint")).alias("_top"))
    keyed = runs.withColumn("_h", hash60(0, "run_id"))
    order = running_totals(keyed.groupBy(model, "_h").agg(F.count("*").alias("_n")), "_h", ["_n"], by=[model])
    start = order.select(model, "_h", (F.col("cum__n") - F.col("_n")).alias("_before"))
    same = Window.partitionBy(model, "_h").orderBy("run_id")  # runs whose hashes collide
    start = start.select(F.col(model).alias("_model"), F.col("_h").alias("_hash"), "_before")
    placed = keyed.join(start, F.col(model).eqNullSafe(F.col("_model")) & (F.col("_h") == F.col("_hash")))
    placed = placed.drop("_model", "_hash").withColumn("_rn", F.row_number().over(same))
    top = current.withColumnRenamed(model, "_model")
    return placed.join(top, F.col(model).eqNullSafe(F.col("_model")), "left").select(
        model, "run_id", (F.coalesce("_top", F.lit(0)) + F.col("_before") + F.col("_rn")).alias("version")
    )
