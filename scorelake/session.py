"""Session defaults and the shared staging area used to cut lineage."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

STAGING_CONF = "spark.checkpoint.dir"


def get_spark(app: str = "scorelake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on; extra settings as keyword ``{"spark.x": "y"}``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir`` as the cluster sets it.

    Where it is unset, a folder of the session's warehouse, which a cluster shares as well. Each application has a
    folder of its own there; ``clear_staging`` removes it.
    """
    configured = spark.conf.get(STAGING_CONF, None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging"
    return f"{configured.rstrip('/')}/{spark.sparkContext.applicationId}"


def clear_staging(spark: SparkSession) -> None:
    """Delete what this application has staged. DataFrames that read it can't be used after that."""
    path = spark._jvm.org.apache.hadoop.fs.Path(staging_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage_path(spark: SparkSession, label: str = "stage") -> str:
    return f"{staging_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the staging area and read it back.

    Cuts the lineage and gives every later pass the same rows, whichever executors die.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the staged tables that ``df`` reads, which nothing reads after that; other files stay."""
    spark = df.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(staging_dir(spark)).toUri().getPath()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.toUri().getPath().startswith(f"{root}/"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def compact(df: DataFrame, rows: int, rows_per_task: int = 50_000) -> DataFrame:
    """Fewer, fuller partitions for iterative fits on small tables; large tables stay as they are."""
    return df.coalesce(max(1, -(-rows // rows_per_task)))


def ship_by_value(module_name: str) -> None:
    """Send functions of a module inside the task, so executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
