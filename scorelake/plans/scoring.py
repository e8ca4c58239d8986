"""One scoring path for tables and streams: requests in, decided and traceable rows out."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from scorelake.functions.decision import decide
from scorelake.functions.scalars import null_fraction
from scorelake.operators.registry import alias_state
from scorelake.operators.telemetry import trace_ids
from scorelake.operators.validate import parse_requests

Scorer = Callable[[DataFrame], DataFrame]


def fill(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    """Missing features take the given values; features without one stay missing."""
    return df.select(
        *[
            F.coalesce(F.col(c), F.lit(values[c])).alias(c) if values.get(c) is not None else F.col(c)
            for c in df.columns
        ]
    )


def read_requests(raw: DataFrame, body: str, fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(well-formed requests with their missing fraction, refused ones with the reasons)."""
    parsed = parse_requests(raw, body, fields)
    ok = F.size("errors") == 0
    n_fields = F.lit(len(fields)) + F.size("extras")
    missing = null_fraction([F.col(f) for f in fields]) * F.lit(float(max(len(fields), 1)))
    good = parsed.filter(ok).drop("errors").withColumn("missing_rate", missing / F.greatest(n_fields, F.lit(1)))
    return good, parsed.filter(~ok)


def score_rows(
    rows: DataFrame,
    scorer: Scorer,
    model_version: str,
    trace_key: Sequence[str],
    alias: str = "unknown",
    medians: Mapping[str, float | None] | None = None,
) -> DataFrame:
    """Impute (optional), score, decide and stamp. ``scorer`` adds ``p`` and may add scorecard columns."""
    ready = fill(rows, medians) if medians else rows
    scored = decide(scorer(ready))
    for name, kind in (("scorecard_score", "double"), ("scorecard_breakdown", None)):
        if name not in scored.columns and kind:
            scored = scored.withColumn(name, F.lit(None).cast(kind))
    stamped = scored.withColumn("model_version", F.lit(model_version)).withColumn("model_alias", F.lit(alias))
    return trace_ids(stamped, *trace_key)


def score_by_alias(
    rows: DataFrame,
    alias_col: str,
    deployments: DataFrame,
    scorers: Mapping[str, Scorer],
    trace_key: Sequence[str],
    fallback: tuple[str, Scorer] | None = None,
) -> DataFrame:
    """Score each row with the version its alias points to.

    An alias that is null or unknown, or whose version is not available, uses ``fallback`` (a version name and its
    scorer); without one that is an error. There is one branch per version in use, so at most one per scorer, whatever
    aliases the rows ask for. Without rows the result is empty.
    """
    current = {r.alias: r.version for r in alias_state(deployments).collect() if r.alias is not None and r.version in scorers}
    served = F.create_map(*[F.lit(x) for kv in current.items() for x in kv])[F.col(alias_col)] if current else F.lit(None).cast("string")
    known = rows.withColumn("_version", served)
    if fallback is None and (lost := known.filter("_version is null").select(alias_col).first()) is not None:
        raise RuntimeError(f"no model for alias {lost[0]!r}")
    branches = [(F.col("_version") == v, v, scorers[v]) for v in sorted(set(current.values()))]
    if fallback is not None:
        branches.append((F.col("_version").isNull(), *fallback))
    out = None
    for chosen, name, scorer in branches:
        part = score_rows(known.filter(chosen).drop("_version"), scorer, name, trace_key)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise RuntimeError("no model is deployed")
    return out.withColumn("model_alias", F.coalesce(F.col(alias_col), F.lit("unknown")))
