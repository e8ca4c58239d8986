"""Table scans, content versions, split tables and resumable stages."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from scorelake.functions.scalars import nan_to_null
from scorelake.sources import hashing

#: Larger files are hashed range by range.
WHOLE_BYTES = 256 << 20


def clean_missing(df: DataFrame) -> DataFrame:
    """NaN to null in every float and double column."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select(
        *[nan_to_null(F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`") for c in df.columns]
    )


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with header and a given schema (no inference pass); NaN read as missing."""
    return clean_missing(spark.read.schema(schema).csv(path, header=True, nanValue="NaN"))


def applicant_schema(features: Sequence[str], row_id: str = "customer_id") -> T.StructType:
    """Row key, nullable double features and an integer label."""
    return T.StructType(
        [T.StructField(row_id, T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in features]
        + [T.StructField("label", T.IntegerType())]
    )


def file_hashes(spark: SparkSession, path: str, whole: int = WHOLE_BYTES) -> DataFrame:
    """SHA-256 of the bytes of each file under ``path``.

    A file of more than ``whole`` bytes is hashed range by range, so no task reads or holds all of it.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # One row a large file; this reads no contents.
    large = files.filter(F.col("length") > whole).select("path", "length").collect() if hashing.resumable() else []
    if not large:
        return files.select("path", F.sha2("content", 256).alias("sha256"))
    with ThreadPoolExecutor(min(len(large), spark.sparkContext.defaultParallelism)) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(lambda f: hashing.sha256_by_ranges(spark, f.path, f.length)), large))
    made = [(f.path, h) for f, h in zip(large, found) if h is not None]
    changed = [f.path for f, h in zip(large, found) if h is None]
    rest = files.filter((F.col("length") <= whole) | F.col("path").isin(changed)).select("path", F.sha2("content", 256).alias("sha256"))
    return rest.unionByName(spark.createDataFrame(made, rest.schema))


def content_version(spark: SparkSession, path: str) -> str:
    """First 8 hex digits of the SHA-256 of a file, or of the sorted file hashes of a folder.

    Folder hashes are folded by their first three digits, so the last step sees 4,096 rows at most.
    """
    hashes = file_hashes(spark, path).select("sha256")
    folded = hashes.groupBy(F.substring("sha256", 1, 3).alias("head")).agg(
        F.count("*").alias("n"),
        F.min("sha256").alias("only"),
        F.sha2(F.concat_ws("", F.sort_array(F.collect_list("sha256"))), 256).alias("fold"),
    )
    row = folded.agg(
        F.sum("n").alias("n"),
        F.min("only").alias("only"),
        F.sha2(F.concat_ws("", F.sort_array(F.collect_list("fold"))), 256).alias("fold"),
    ).first()
    if not row.n:
        raise FileNotFoundError(path)
    return (row.only if row.n == 1 else row.fold)[:8]


def save_splits(split: DataFrame, out_dir: str, label: str = "label") -> None:
    """Write train and test rows partitioned by split, and train features as the reference set."""
    split.write.mode("overwrite").partitionBy("split").parquet(f"{out_dir}/splits")
    reference_rows(split, label).write.mode("overwrite").parquet(f"{out_dir}/reference")


def reference_rows(split: DataFrame, label: str = "label") -> DataFrame:
    return split.filter(F.col("split") == "train").drop(label, "split")


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has ended well; any other failure to look is raised."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def resume_stage(
    spark: SparkSession,
    root: str,
    name: str,
    key: Mapping[str, str],
    build: Callable[[], DataFrame],
) -> DataFrame:
    """Stage output keyed by its inputs: read it if a finished one exists, else build and write it."""
    tag = ",".join(f"{k}={key[k]}" for k in sorted(key))
    path = f"{root.rstrip('/')}/{name}/{tag}"
    if not finished(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def align_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring an older table to ``schema``: absent columns become typed nulls, extras are kept."""
    have = set(df.columns)
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in have]
    ordered = [f.name for f in schema]
    wide = df.select("*", *added)
    return wide.select(*ordered, *[c for c in df.columns if c not in ordered])
