"""Column selection by fill and variation, request contract, response rules, quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from scorelake.functions.scalars import nan_to_null

BAND_NAMES = ["Very Poor", "Poor", "Fair", "Good", "Excellent"]
DECISION_NAMES = ["approve", "manual_review", "reject"]


def common_columns(wanted: Sequence[str], *tables: DataFrame) -> list[str]:
    """Columns of ``wanted`` that every table has, in the order of ``wanted``."""
    return [c for c in wanted if all(c in t.columns for t in tables)]


def fill_rates(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Non-null share of every column, one pass."""
    row = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in cols]).first()
    return {c: row[c] or 0.0 for c in cols}


def well_filled(df: DataFrame, cols: Sequence[str], at_least: float = 0.30) -> list[str]:
    rates = fill_rates(df, cols)
    return [c for c in cols if rates[c] >= at_least]


def varying_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns with more than one distinct non-null value, one pass."""
    row = df.agg(*[(F.min(c) < F.max(c)).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]]


def drop_constant(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    kept = set(varying_columns(df, cols))
    return df.select(*[c for c in df.columns if c not in set(cols) or c in kept])


def _number(text: Column) -> Column:
    """JSON scalar text to double; booleans count as 0 and 1, Java type suffixes are not numbers."""
    lower = F.lower(F.trim(text))
    return (
        F.when(lower == "true", F.lit(1.0))
        .when(lower == "false", F.lit(0.0))
        .when(~lower.rlike("[0-9.][df]$"), text.try_cast("double"))
    )


def parse_requests(df: DataFrame, body: str, fields: Sequence[str]) -> DataFrame:
    """JSON bodies to typed optional fields, plus ``extras`` and ``errors``.

    Absent and null fields are null. Unknown keys are kept as text in ``extras``. ``errors``
    lists the fields whose value is not a number; an unreadable body is the error ``body``.
    """
    names = F.array(*[F.lit(f) for f in fields])
    # Generators keep later filters from being inlined into, and so repeating, the parsing.
    parsed = df.select("*", F.explode(F.array(F.from_json(F.col(body), "map<string,string>"))).alias("_m"))
    cells = []
    for i, f in enumerate(fields):
        raw = F.col("_m").getItem(f)
        cells += [_number(raw).alias(f), raw.isNotNull().alias(f"_sent{i}")]
    typed = parsed.select(*df.columns, "_m", F.inline(F.array(F.struct(*cells))))
    bad = [F.when(F.col(f"_sent{i}") & F.col(f).isNull(), F.lit(f)) for i, f in enumerate(fields)]
    errors = F.when(F.col("_m").isNull(), F.array(F.lit("body"))).otherwise(F.array_compact(F.array(*bad)))
    extras = F.map_filter("_m", lambda k, _: ~F.array_contains(names, k))
    return typed.select(
        *df.columns, *[nan_to_null(F.col(f)).alias(f) for f in fields], extras.alias("extras"), errors.alias("errors")
    )


def response_rules() -> dict[str, Column]:
    """What a scored row must satisfy."""
    return {
        "default_probability": F.col("default_probability").between(0.0, 1.0),
        "credit_score": F.col("credit_score").between(300, 850),
        "risk_band": F.col("risk_band").isin(BAND_NAMES),
        "decision": F.col("decision").isin(DECISION_NAMES),
    }


def check(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``failed``: names of the rules a row breaks (a null result breaks the rule)."""
    names = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return df.withColumn("failed", F.array_compact(F.array(*names)))


def quarantine(checked: DataFrame, errors: str = "failed") -> tuple[DataFrame, DataFrame]:
    """(good rows without the error column, bad rows with it)."""
    empty = F.size(errors) == 0
    return checked.filter(empty).drop(errors), checked.filter(~empty)
