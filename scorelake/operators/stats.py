"""Descriptive statistics of splits and logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def split_stats(split: DataFrame, label: str = "label") -> DataFrame:
    """Rows and default rate per split."""
    return split.groupBy("split").agg(
        F.count("*").alias("n_rows"), F.avg(F.col(label).cast("double")).alias("default_rate")
    )


def missing_by_column(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null count and share per column: one aggregate, then one row per column."""
    row = df.agg(
        F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    )
    return row.unpivot("n_rows", list(cols), "feature", "n_missing").select(
        "feature", "n_missing", F.try_divide("n_missing", "n_rows").alias("missing_rate")
    )


def missing_rate(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean over columns of the null share."""
    return missing_by_column(df, cols).agg(F.avg("missing_rate").alias("missing_rate"))


def missing_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Whole-table missing cells, and columns and rows with any of them."""
    holes = sum((F.col(c).isNull().cast("bigint") for c in cols[1:]), F.col(cols[0]).isNull().cast("bigint"))
    return df.select(holes.alias("h"), *[F.col(c).isNull().alias(c) for c in cols]).agg(
        F.sum("h").alias("n_missing"),
        F.count_if(F.col("h") > 0).alias("rows_with_missing"),
        sum((F.max(c).cast("bigint") for c in cols[1:]), F.max(cols[0]).cast("bigint")).alias("cols_with_missing"),
        F.try_divide(F.sum("h"), F.count("*") * F.lit(len(cols))).alias("missing_rate"),
    )


def class_ratio(label: Column) -> Column:
    """Whole-number ratio of negatives to positives, rounded down."""
    return F.floor(F.try_divide(F.count_if(label == 0), F.count_if(label == 1)))


def label_summary(df: DataFrame, label: str, ts: str) -> DataFrame:
    return df.agg(
        F.count_if(F.col(label) == 1).alias("n_default"),
        F.count_if(F.col(label) == 0).alias("n_good"),
        F.avg(F.col(label).cast("double")).alias("base_rate"),
        F.to_date(F.min(ts)).alias("first_day"),
        F.to_date(F.max(ts)).alias("last_day"),
    )
