"""Scans, sinks, projections, filters, validation, joins and plain aggregates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from scorelake.functions import decision as rules, scalars
from scorelake.operators import chunks, ranks, reshape, split, stats, validate
from scorelake.operators.quantiles import quantiles
from scorelake.plans import fixtures as fx
from scorelake.plans.catalog import query
from scorelake.session import stage_path
from scorelake.sources import logs, runs, tables

FEATURES = f"WITH {fx.FEATURES_CTE}"
SCORED = f"WITH {fx.SCORED_CTE}"
DEPLOYMENTS = f"WITH {fx.DEPLOYMENTS_CTE}"

HASH_SQL = "('0x' || substr(md5('42|' || customer_id), 1, 15))::BIGINT"
SPLIT_CTE = f"""{FEATURES},
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {HASH_SQL}, customer_id) AS rn,
  count(*) OVER (PARTITION BY label) AS nl, count(*) OVER () AS n FROM features),
sizes AS (SELECT DISTINCT label, ceil(0.2 * n) * nl / n AS share, ceil(0.2 * n) AS total FROM ranked),
quota AS (SELECT label, floor(share) + (CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, label)
    <= total - sum(floor(share)) OVER () THEN 1 ELSE 0 END) AS n_test FROM sizes),
split AS (SELECT ranked.*, CASE WHEN rn <= n_test THEN 'test' ELSE 'train' END AS split
  FROM ranked JOIN quota USING (label))"""


def _union(select, names):
    return " UNION ALL ".join(select(n) for n in names)


# ---- A: scans, sinks, versions ---------------------------------------------------------------


@query("a1_scan_csv", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def a1(spark, sf):
    path = stage_path(spark, "csv")
    fx.table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment").write.csv(path, header=True)
    return tables.scan_csv(spark, path, "c_custkey bigint, c_acctbal double, c_mktsegment string")


@query("a2_content_version")
def a2(spark, sf):
    names = ["customer", "orders", "lineitem", "events"]
    hashes = [tables.file_hashes(spark, f"{sf}/{n}.parquet").withColumn("name", F.lit(n)) for n in names]
    out = hashes[0]
    for h in hashes[1:]:
        out = out.unionByName(h)
    return out.select("name", F.substring("sha256", 1, 8).alias("version"))


@query(
    "a3_save_splits",
    f"{SPLIT_CTE} SELECT split, count(*) AS n_rows, sum(label)::BIGINT AS n_default FROM split GROUP BY 1",
)
def a3(spark, sf):
    path = stage_path(spark, "splits")
    tables.save_splits(split.stratified_split(fx.features(spark, sf), "customer_id"), path)
    saved = spark.read.parquet(f"{path}/splits")
    return saved.groupBy("split").agg(F.count("*").alias("n_rows"), F.sum("label").alias("n_default"))


@query("a5_scan_predictions", f"{SCORED} SELECT ts, p AS default_probability, props AS features FROM scored")
def a5(spark, sf):
    path = stage_path(spark, "predictions")
    log = fx.scored(spark, sf).select(
        "ts", F.col("p").alias("default_probability"), rules.decision(F.col("p")).alias("decision"),
        F.col("props").alias("features"), F.lit("v1").alias("model_version"),
    )
    logs.append(log, path)
    return logs.read_predictions(spark, path).drop("decision")


@query(
    "a6_audit_rows",
    f"""{SCORED} SELECT event_id, round(p, 4) AS default_probability, round_even(850 - p * 550, 0)::INTEGER AS credit_score,
    to_json({{'k': k::INTEGER, 'user_id': user_id, 'gap': CASE WHEN event_type <> 'error' THEN event_id END}})::VARCHAR AS features
    FROM scored""",
)
def a6(spark, sf):
    scored = rules.decide(fx.scored(spark, sf)).withColumn("k", F.col("k").cast("int"))
    scored = scored.withColumn("gap", F.when(F.col("event_type") != "error", F.col("event_id")))
    scored = scored.withColumn("ts", F.col("ts").cast("timestamp"))
    path = stage_path(spark, "audit")
    logs.append(logs.audit_rows(scored, ["k", "user_id", "gap"], carry=["event_id"]), path)
    return logs.read_log(spark, path).select("event_id", "default_probability", "credit_score", "features")


@query(
    "a7_append_deployment_event",
    f"""{DEPLOYMENTS} SELECT event_type, alias, count(*) AS n FROM (
      SELECT event_type, alias FROM deployments UNION ALL SELECT 'promote', 'champion') GROUP BY ALL""",
)
def a7(spark, sf):
    path = stage_path(spark, "deployments")
    log = tables.align_columns(
        fx.deployments(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")), logs.DEPLOYMENT_SCHEMA
    )
    logs.append(log, path)
    logs.append(logs.deployment_event(spark, "promote", "champion", "1", "3", "ops", "better"), path)
    return logs.read_log(spark, path).groupBy("event_type", "alias").agg(F.count("*").alias("n"))


@query(
    "a8_write_summary",
    f"{SCORED} SELECT sum(y)::BIGINT AS n_default, (count(*) - sum(y))::BIGINT AS n_good FROM scored",
)
def a8(spark, sf):
    path = stage_path(spark, "summary")
    runs.write_summary(stats.label_summary(fx.scored(spark, sf), "y", "ts"), path)
    return spark.read.schema("n_default bigint, n_good bigint").json(path)


@query(
    "a10_schema_evolution",
    "SELECT event_id, CASE WHEN event_id % 2 = 1 THEN 't' || event_id END AS trace_id FROM events",
)
def a10(spark, sf):
    path = stage_path(spark, "evolving")
    events = fx.table(spark, sf, "events").select("event_id", "ts")
    odd = F.col("event_id") % 2 == 1
    logs.append(events.filter(~odd), path)
    logs.append(events.filter(odd).withColumn("trace_id", F.concat(F.lit("t"), F.col("event_id"))), path)
    return logs.read_log(spark, path).select("event_id", "trace_id")


@query(
    "a12_run_metrics",
    f"""{SPLIT_CTE} SELECT split, 'default_rate' AS metric, round(avg(label), 6) AS value FROM split GROUP BY 1
    UNION ALL SELECT split, 'n_rows', count(*)::DOUBLE FROM split GROUP BY 1""",
)
def a12(spark, sf):
    path = stage_path(spark, "runs")
    per_split = stats.split_stats(split.stratified_split(fx.features(spark, sf), "customer_id"))
    long = runs.melt_metrics(per_split, ["split"]).withColumn("value", F.round("value", 6))
    logs.append(long.select(F.lit("run-1").alias("run_id"), "split", "metric", "value"), path)
    return spark.read.parquet(path).drop("run_id")


@query("a13_resume_stage", f"{FEATURES} SELECT customer_id, ORD_CNT_12M, label FROM features")
def a13(spark, sf):
    root = stage_path(spark, "stages")
    inputs = ("customer", "orders", "lineitem", "events")
    key = {**{t: tables.content_version(spark, f"{sf}/{t}.parquet") for t in inputs}, "seed": "42"}

    def built():
        return fx.features(spark, sf).select("customer_id", "ORD_CNT_12M", "label")

    def refused():
        raise AssertionError("stage was built twice")

    tables.resume_stage(spark, root, "features", key, built)
    return tables.resume_stage(spark, root, "features", key, refused)


# ---- B: projections, filters, validation -----------------------------------------------------


@query("b1_drop_if_exists", "SELECT * EXCLUDE (c_name) FROM customer")
def b1(spark, sf):
    return fx.table(spark, sf, "customer").drop("c_name", "not_there")


@query("b2_features_and_label", f"{FEATURES} SELECT customer_id, {', '.join(fx.FEATURES)}, label FROM features")
def b2(spark, sf):
    df = fx.features(spark, sf)
    x_cols = [c for c in df.columns if c not in ("customer_id", "label")]
    return df.select("customer_id", *x_cols, "label")


@query("b3_unnest_json", f"{SCORED} SELECT event_id, k, NULL::DOUBLE AS absent FROM scored")
def b3(spark, sf):
    df = fx.table(spark, sf, "events").select("event_id", "props")
    found = reshape.json_keys(df, "props")
    return reshape.unnest_json(df, "props", [*found, "absent"])


@query("b4_threshold", f"{SCORED} SELECT event_id, (p >= 0.45)::INTEGER AS y_pred FROM scored")
def b4(spark, sf):
    return fx.scored(spark, sf).select("event_id", rules.flagged(F.col("p")).alias("y_pred"))


@query("b5_common_columns", "SELECT user_id AS id, value FROM events")
def b5(spark, sf):
    a = fx.table(spark, sf, "events").withColumnRenamed("user_id", "id")
    b = fx.table(spark, sf, "events").select("value", F.col("user_id").alias("id"))
    return a.select(*validate.common_columns(["id", "absent", "value"], a, b))


@query(
    "b6_fill_rate_filter",
    FEATURES + " SELECT feature, round(fill_rate, 6) AS fill_rate FROM ("
    + _union(lambda c: f"SELECT '{c}' AS feature, avg(({c} IS NOT NULL)::INTEGER) AS fill_rate FROM features", fx.FEATURES)
    + ") WHERE fill_rate >= 0.30",
)
def b6(spark, sf):
    df = fx.features(spark, sf)
    kept = validate.well_filled(df, fx.FEATURES)
    filled = stats.missing_by_column(df, kept)
    return filled.select("feature", F.round(1 - F.col("missing_rate"), 6).alias("fill_rate"))


@query(
    "b7_request_contract",
    f"""{SCORED} SELECT event_id, k, value AS amount, CASE WHEN event_type = 'view' THEN 1.0 END AS mixed,
    '1' AS extra, (event_type = 'error')::INTEGER AS n_errors FROM scored""",
)
def b7(spark, sf):
    mixed = (
        F.when(F.col("event_type") == "error", '"abc"').when(F.col("event_type") == "view", "true").otherwise("null")
    )
    body = F.concat(
        F.lit('{"k":'), F.get_json_object("props", "$.k"), F.lit(',"amount":"'), F.col("value").cast("string"),
        F.lit('","mixed":'), mixed, F.lit(',"extra":1}'),
    )
    raw = fx.table(spark, sf, "events").select("event_id", body.alias("body"))
    parsed = validate.parse_requests(raw, "body", ["k", "amount", "mixed", "never_sent"])
    return parsed.select(
        "event_id", "k", "amount", "mixed", F.col("extras")["extra"].alias("extra"), F.size("errors").alias("n_errors")
    )


@query(
    "b8_response_rules",
    """SELECT event_id, concat_ws(',',
      CASE WHEN NOT (value / 400 BETWEEN 0 AND 1) THEN 'default_probability' END,
      CASE WHEN NOT ((value * 2)::DECIMAL(18,0)::INTEGER BETWEEN 300 AND 850) THEN 'credit_score' END,
      CASE WHEN event_type IN ('click', 'view') THEN 'decision' END) AS failed FROM events
      WHERE value / 400 > 1 OR NOT ((value * 2)::DECIMAL(18,0)::INTEGER BETWEEN 300 AND 850) OR event_type IN ('click', 'view')""",
)
def b8(spark, sf):
    df = fx.table(spark, sf, "events").select(
        "event_id",
        (F.col("value") / 400).alias("default_probability"),
        F.round(F.col("value") * 2).cast("int").alias("credit_score"),
        F.lit("Good").alias("risk_band"),
        F.when(F.col("event_type").isin("click", "view"), "maybe").otherwise("approve").alias("decision"),
    )
    _, bad = validate.quarantine(validate.check(df, validate.response_rules()))
    return bad.select("event_id", F.array_join("failed", ",").alias("failed"))


@query(
    "b9_clip_with_flag",
    """SELECT event_id, greatest(5.0, least(200.0, value)) AS clipped,
    CASE WHEN value > 200 THEN 'maximum' WHEN value < 5 THEN 'minimum' END AS bound FROM events""",
)
def b9(spark, sf):
    v = F.col("value")
    return fx.table(spark, sf, "events").select(
        "event_id", scalars.clip(v, 5.0, 200.0).alias("clipped"), scalars.clip_flag(v, 5.0, 200.0).alias("bound")
    )


@query(
    "b10_sparse_payload",
    FEATURES + " SELECT customer_id, "
    + " + ".join(f"({c} IS NOT NULL)::INTEGER" for c in fx.FEATURES) + " AS n_sent, ORD_AVG_12M AS sent_avg FROM features",
)
def b10(spark, sf):
    payload = fx.features(spark, sf).select("customer_id", reshape.sparse_map(fx.FEATURES).alias("payload"))
    return payload.select(
        "customer_id", F.size("payload").alias("n_sent"), F.col("payload")["ORD_AVG_12M"].alias("sent_avg")
    )


PREVIEW = ["ORD_CNT_3M", "ORD_AVG_3M", "LI_QTY_12M", "EVT_CNT_view"]


@query(
    "b11_preview_long",
    FEATURES + " " + _union(lambda c: f"SELECT customer_id, '{c}' AS feature, {c} AS value FROM features", PREVIEW),
)
def b11(spark, sf):
    return reshape.to_long(fx.features(spark, sf), ["customer_id"], PREVIEW)


@query(
    "b12_nth_in_label",
    f"""{FEATURES} SELECT customer_id, label, ORD_CNT_12M FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY customer_id) AS rn FROM features)
    WHERE label = 1 AND rn = 18""",
)
def b12(spark, sf):
    return ranks.nth_in_group(fx.features(spark, sf), "label", 1, "customer_id", 17).select(
        "customer_id", "label", "ORD_CNT_12M"
    )


@query("b13_drop_constant", f"{FEATURES} SELECT customer_id, ORD_CNT_12M, EVT_CNT_view FROM features")
def b13(spark, sf):
    df = fx.features(spark, sf).select("customer_id", "ORD_CNT_12M", "EVT_CNT_view")
    df = df.withColumn("same", F.lit(3.0)).withColumn("empty", F.lit(None).cast("double"))
    return validate.drop_constant(df, ["ORD_CNT_12M", "same", "EVT_CNT_view", "empty"])


# ---- C: joins --------------------------------------------------------------------------------


@query("c3_concat_by_key", f"{FEATURES} SELECT customer_id, ORD_CNT_12M, EVT_CNT_view, label FROM features")
def c3(spark, sf):
    df = fx.features(spark, sf)
    return df.select("customer_id", "ORD_CNT_12M", "EVT_CNT_view").join(df.select("customer_id", "label"), "customer_id")


@query(
    "c4_version_for_run",
    "SELECT c_custkey AS run_id, max(o_orderkey) AS version FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1",
)
def c4(spark, sf):
    from scorelake.operators.registry import version_for_runs

    versions = fx.table(spark, sf, "orders").select(F.col("o_custkey").alias("run_id"), F.col("o_orderkey").alias("version"))
    return version_for_runs(fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("run_id")), versions)


VERDICT_SQL = """CASE WHEN y = 1 AND p >= 0.45 THEN 'caught' WHEN y = 1 THEN 'miss'
  WHEN p < 0.45 THEN 'cleared' ELSE 'over_cautious' END"""


@query("c6_decision_vs_truth", f"{SCORED} SELECT event_id, {VERDICT_SQL} AS verdict FROM scored")
def c6(spark, sf):
    df = fx.scored(spark, sf)
    truth = df.select("event_id", "y")
    decided = df.select("event_id", rules.decision(F.col("p")).alias("decision"))
    return decided.join(truth, "event_id").select(
        "event_id", rules.verdict(F.col("y"), F.col("decision")).alias("verdict")
    )


# ---- D: aggregates ---------------------------------------------------------------------------


@query(
    "d1_split_stats",
    f"{SPLIT_CTE} SELECT split, count(*) AS n_rows, round(avg(label), 6) AS default_rate FROM split GROUP BY 1",
)
def d1(spark, sf):
    out = stats.split_stats(split.stratified_split(fx.features(spark, sf), "customer_id"))
    return out.withColumn("default_rate", F.round("default_rate", 6))


WITH_LABEL = [*fx.FEATURES, "label"]


@query(
    "d2_missing_rate",
    FEATURES + " SELECT round(avg(r), 6) AS missing_rate FROM ("
    + _union(lambda c: f"SELECT avg(({c} IS NULL)::INTEGER) AS r FROM features", WITH_LABEL) + ")",
)
def d2(spark, sf):
    return stats.missing_rate(fx.features(spark, sf), WITH_LABEL).select(F.round("missing_rate", 6).alias("missing_rate"))


@query(
    "d4_confusion_matrix",
    f"""{SCORED} SELECT count(*) FILTER (WHERE y = 0 AND p < 0.45) AS tn, count(*) FILTER (WHERE y = 0 AND p >= 0.45) AS fp,
    count(*) FILTER (WHERE y = 1 AND p < 0.45) AS fn, count(*) FILTER (WHERE y = 1 AND p >= 0.45) AS tp FROM scored""",
)
def d4(spark, sf):
    from scorelake.operators.metrics import confusion_at

    return confusion_at(fx.scored(spark, sf), rules.REVIEW_FROM)


@query(
    "d5_class_ratio",
    f"""{FEATURES} SELECT (count(*) FILTER (WHERE label = 0) // count(*) FILTER (WHERE label = 1))::BIGINT AS ratio FROM features""",
)
def d5(spark, sf):
    return fx.features(spark, sf).agg(stats.class_ratio(F.col("label")).alias("ratio"))


@query(
    "d6_row_missing_fraction",
    FEATURES + " SELECT customer_id, round(("
    + " + ".join(f"({c} IS NULL)::INTEGER" for c in fx.FEATURES) + f") / {len(fx.FEATURES)}.0, 6) AS missing FROM features",
)
def d6(spark, sf):
    frac = scalars.null_fraction([F.col(c) for c in fx.FEATURES])
    return fx.features(spark, sf).select("customer_id", F.round(frac, 6).alias("missing"))


DECISION_SQL = "CASE WHEN p >= 0.70 THEN 'reject' WHEN p >= 0.45 THEN 'manual_review' ELSE 'approve' END"


@query("d7_count_by_decision", f"{SCORED} SELECT {DECISION_SQL} AS decision, count(*) AS n FROM scored GROUP BY 1")
def d7(spark, sf):
    return fx.scored(spark, sf).groupBy(rules.decision(F.col("p")).alias("decision")).agg(F.count("*").alias("n"))


@query(
    "d8_count_by_endpoint_status",
    f"WITH {fx.REQUESTS_CTE} SELECT endpoint, status, count(*) AS n FROM requests GROUP BY ALL",
)
def d8(spark, sf):
    return fx.requests(spark, sf).groupBy("endpoint", "status").agg(F.count("*").alias("n"))


@query(
    "d10_label_summary",
    f"""{SCORED} SELECT count(*) FILTER (WHERE y = 1) AS n_default, count(*) FILTER (WHERE y = 0) AS n_good,
    round(avg(y), 6) AS base_rate, min(ts)::DATE AS first_day, max(ts)::DATE AS last_day FROM scored""",
)
def d10(spark, sf):
    out = stats.label_summary(fx.scored(spark, sf), "y", "ts")
    return out.withColumn("base_rate", F.round("base_rate", 6))


@query(
    "d11_missing_by_column",
    FEATURES + " " + _union(
        lambda c: f"""SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS n_missing,
        round(avg(({c} IS NULL)::INTEGER), 6) AS missing_rate FROM features""", fx.FEATURES),
)
def d11(spark, sf):
    out = stats.missing_by_column(fx.features(spark, sf), fx.FEATURES)
    return out.withColumn("missing_rate", F.round("missing_rate", 6))


@query(
    "d11_missing_summary",
    FEATURES + ", holes AS (SELECT " + " + ".join(f"({c} IS NULL)::INTEGER" for c in fx.FEATURES) + " AS h, "
    + ", ".join(f"({c} IS NULL)::INTEGER AS {c}" for c in fx.FEATURES) + " FROM features) "
    + "SELECT sum(h)::BIGINT AS n_missing, count(*) FILTER (WHERE h > 0) AS rows_with_missing, ("
    + " + ".join(f"max({c})" for c in fx.FEATURES) + f")::BIGINT AS cols_with_missing, round(sum(h) / (count(*) * {len(fx.FEATURES)}.0), 6) AS missing_rate FROM holes",
)
def d11b(spark, sf):
    out = stats.missing_summary(fx.features(spark, sf), fx.FEATURES)
    return out.withColumn("missing_rate", F.round("missing_rate", 6))


@query(
    "d12_column_quantiles",
    FEATURES + " " + _union(
        lambda c: f"""SELECT '{c}' AS feature, round(quantile_cont({c}, 0.05), 6) AS q05,
        round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.95), 6) AS q95 FROM features""", fx.FEATURES),
)
def d12(spark, sf):
    found = quantiles(fx.features(spark, sf), fx.FEATURES, [0.05, 0.5, 0.95])
    rows = [(c, *[None if v is None else round(v, 6) for v in qs]) for c, qs in found.items()]
    return spark.createDataFrame(rows, "feature string, q05 double, q50 double, q95 double")


# ---- E1 and J1 live on the same selection primitive ------------------------------------------


@query("e1_stratified_split", f"{SPLIT_CTE} SELECT customer_id, label, split FROM split")
def e1(spark, sf):
    return split.stratified_split(fx.features(spark, sf), "customer_id").select("customer_id", "label", "split")


@query(
    "e1_stratified_folds",
    f"""{FEATURES}, ranked AS (SELECT customer_id, label,
      row_number() OVER (PARTITION BY label ORDER BY {HASH_SQL}, customer_id) AS rn,
      count(*) OVER (PARTITION BY label) AS n FROM features)
    SELECT customer_id, label, ((rn > n * 1 // 5)::INTEGER + (rn > n * 2 // 5)::INTEGER
      + (rn > n * 3 // 5)::INTEGER + (rn > n * 4 // 5)::INTEGER) AS fold FROM ranked""",
)
def e1_folds(spark, sf):
    return split.stratified_folds(fx.features(spark, sf), "customer_id").select("customer_id", "label", "fold")


CHUNKED_SQL = """chunked AS (SELECT *, least((row_number() OVER (ORDER BY ts, event_id) - 1)
    // greatest(50, count(*) OVER () // 7), 6)::INTEGER AS chunk_id FROM production)"""
PRODUCTION_CHUNKS = f"{SCORED}, {fx.PERIODS_CTE}, {CHUNKED_SQL}"


@query("j1_row_count_chunks", f"{PRODUCTION_CHUNKS} SELECT event_id, chunk_id FROM chunked")
def j1(spark, sf):
    _, production = fx.reference_and_production(fx.scored(spark, sf))
    return chunks.assign_chunks(production, "ts", "event_id").select("event_id", "chunk_id")


@query(
    "j1_many_chunks",
    """SELECT event_id, least((row_number() OVER (ORDER BY ts, event_id) - 1) // 60, greatest(count(*) OVER () // 60, 1) - 1)::INTEGER
    AS chunk_id FROM events""",
)
def j1_many(spark, sf):
    return chunks.assign_chunks(fx.table(spark, sf, "events"), "ts", "event_id", size=60).select("event_id", "chunk_id")


HOLED_EVENTS = "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS ts FROM events"


def _null_times_sql(size):
    return f"""SELECT event_id, least((row_number() OVER (ORDER BY ts NULLS FIRST, event_id) - 1) // {size},
      greatest(count(*) OVER () // {size}, 1) - 1)::INTEGER AS chunk_id FROM ({HOLED_EVENTS})"""


def _null_times(spark, sf, size):
    holed = fx.table(spark, sf, "events").withColumn("ts", F.when(F.col("event_id") % 7 != 0, F.col("ts")))
    return chunks.assign_chunks(holed, "ts", "event_id", size=size).select("event_id", "chunk_id")


@query("j1_null_times", _null_times_sql(700))
def j1_null_times(spark, sf):
    """Rows without a time are the first, whether chunks are cut at boundary rows ..."""
    return _null_times(spark, sf, 700)


@query("j1_null_times_many", _null_times_sql(5))
def j1_null_times_many(spark, sf):
    """... or found by position."""
    return _null_times(spark, sf, 5)


def last_run_rows(spark, sf):
    """Monitor gauges of one run per month, from the scored log."""
    daily = fx.scored(spark, sf).groupBy(F.trunc("ts", "week").alias("run_ts")).agg(
        F.count("*").cast("double").alias("production_rows"), F.avg("p").alias("mean_probability")
    )
    return runs.melt_metrics(daily, ["run_ts"])


@query(
    "j14_latest_gauges",
    f"""{SCORED}, daily AS (SELECT date_trunc('week', ts)::DATE AS run_ts, count(*)::DOUBLE AS production_rows,
      avg(p) AS mean_probability FROM scored GROUP BY 1)
    SELECT 'production_rows' AS metric, arg_max(production_rows, run_ts) AS value, max(run_ts) AS run_ts FROM daily
    UNION ALL SELECT 'mean_probability', round(arg_max(mean_probability, run_ts), 6), max(run_ts) FROM daily""",
)
def j14(spark, sf):
    return runs.latest(last_run_rows(spark, sf)).withColumn("value", F.round("value", 6))


@query(
    "j15_stale_run",
    f"""{SCORED} SELECT max(date_trunc('week', ts)::DATE) AS last_run,
      max(date_trunc('week', ts)::DATE) < TIMESTAMP '2024-02-20' - INTERVAL 7 DAY AS stale FROM scored""",
)
def j15(spark, sf):
    return runs.stale(last_run_rows(spark, sf), datetime(2024, 2, 20))
