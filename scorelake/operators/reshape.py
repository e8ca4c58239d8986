"""JSON and wide/long conversions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def json_keys(df: DataFrame, col: str) -> list[str]:
    """Distinct top-level keys of a JSON column, sorted: the feature names, not the rows."""
    keys = df.select(F.explode(F.expr(f"json_object_keys(`{col}`)")).alias("k")).distinct()
    return sorted(r.k for r in keys.collect())


def unnest_json(df: DataFrame, col: str, fields: Sequence[str] | None = None) -> DataFrame:
    """JSON object column to flat double columns; an absent key is null."""
    fields = list(fields) if fields is not None else json_keys(df, col)
    schema = ", ".join(f"`{f}` double" for f in fields)
    rest = [c for c in df.columns if c != col]
    # As a generator the parsing happens once, whatever later filters refer to.
    return df.select(*rest, F.inline(F.array(F.from_json(F.col(col), schema))))


def sparse_map(cols: Sequence[str]) -> Column:
    """Non-null fields of a row as a map of doubles."""
    full = F.map_from_arrays(
        F.array(*[F.lit(c) for c in cols]), F.array(*[F.col(c).cast("double") for c in cols])
    )
    return F.map_filter(full, lambda _, v: v.isNotNull())


def to_long(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``(keys, feature, value)`` rows of the chosen columns, as doubles."""
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(list(keys), list(cols), "feature", "value")
