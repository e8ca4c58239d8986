"""Monitoring, drift, telemetry and deployment log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelake.operators import cbpe, chunks, drift, registry, telemetry as tm
from scorelake.plans import credit, fixtures as fx
from scorelake.plans.catalog import query
from scorelake.plans.monitoring import MonitorInput, gauges, performance, production_rows, run_monitor
from scorelake.session import stage, stage_path
from scorelake.sources import logs, tables

SCORED = f"WITH {fx.SCORED_CTE}, {fx.PERIODS_CTE}"
REQUESTS = f"WITH {fx.REQUESTS_CTE}"
DEPLOYMENTS = f"WITH {fx.DEPLOYMENTS_CTE}"


def _chunked_sql(table: str, name: str) -> str:
    return f"""{name} AS (SELECT *, least((row_number() OVER (ORDER BY ts, event_id) - 1)
      // s.size, greatest(count(*) OVER () // s.size, 1) - 1)::INTEGER AS chunk_id FROM {table}
      CROSS JOIN (SELECT greatest(50, count(*) // 7) AS size FROM production) s)"""


CHUNKS = f"{SCORED}, {_chunked_sql('production', 'prod')}, {_chunked_sql('reference', 'ref')}"
DRIFT_COLS = ["value", "k", "user_id", "p"]
# Production with one column moved, so that drift is there to be found.
SHIFTED = "shifted AS (SELECT * REPLACE (value * 1.5 AS value) FROM prod)"


def _periods(spark, sf):
    return fx.reference_and_production(fx.scored(spark, sf))


def _chunked(df, size):
    return chunks.assign_chunks(df, "ts", "event_id", size)


def _prod(spark, sf, shift=False):
    ref, prod = _periods(spark, sf)
    prod = _chunked(prod, chunks.default_chunk_size(prod.count()))
    if shift:
        prod = prod.withColumn("value", F.col("value") * 1.5)
    return ref, prod


def _round(df, *cols, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---- J: performance estimate -----------------------------------------------------------------


def _auc_by_chunk(table, pos, neg):
    return f"""(SELECT chunk_id, sum(neg * (cp - pos + pos / 2)) / (max(tp) * max(tn)) AS roc_auc FROM (
      SELECT *, sum(pos) OVER (PARTITION BY chunk_id ORDER BY p DESC) AS cp, sum(pos) OVER (PARTITION BY chunk_id) AS tp,
      sum(neg) OVER (PARTITION BY chunk_id) AS tn FROM (
      SELECT chunk_id, p, sum({pos})::DOUBLE AS pos, sum({neg})::DOUBLE AS neg FROM {table} GROUP BY ALL)) GROUP BY 1)"""


F1_EXPECTED = """(SELECT chunk_id, count(*) AS n_rows, 2 * sum(CASE WHEN p >= 0.45 THEN p ELSE 0 END) /
  (2 * sum(CASE WHEN p >= 0.45 THEN p ELSE 0 END) + sum(CASE WHEN p >= 0.45 THEN 1 - p ELSE 0 END)
   + sum(CASE WHEN p >= 0.45 THEN 0 ELSE p END)) AS f1 FROM prod GROUP BY 1)"""
F1_REALIZED = """(SELECT chunk_id, count(*) AS n_rows, 2.0 * count(*) FILTER (WHERE p >= 0.45 AND y = 1) /
  (2.0 * count(*) FILTER (WHERE p >= 0.45 AND y = 1) + count(*) FILTER (WHERE p >= 0.45 AND y = 0)
   + count(*) FILTER (WHERE p < 0.45 AND y = 1)) AS f1 FROM ref GROUP BY 1)"""
ESTIMATED = f"estimated AS (SELECT * FROM {F1_EXPECTED} JOIN {_auc_by_chunk('prod', 'p', '1 - p')} USING (chunk_id))"
REALIZED = f"realized AS (SELECT * FROM {F1_REALIZED} JOIN {_auc_by_chunk('ref', 'y', '1 - y')} USING (chunk_id))"


@query(
    "j2_cbpe_estimate",
    f"{CHUNKS}, {ESTIMATED} SELECT chunk_id, n_rows, round(roc_auc, 6) AS roc_auc, round(f1, 6) AS f1 FROM estimated",
)
def j2(spark, sf):
    _, prod = _prod(spark, sf)
    return _round(cbpe.estimate(prod), "roc_auc", "f1")


@query("j2_cbpe_calibrated")
def j2_calibrated(spark, sf):
    ref, prod = _prod(spark, sf)
    model = cbpe.fit_calibration(ref)
    prod = prod.withColumn("raw", F.col("p"))
    return _round(cbpe.estimate(cbpe.calibrate(prod, model), raw="raw"), "roc_auc", "f1")


ALERTS = f"""{CHUNKS}, {ESTIMATED}, {REALIZED},
  bounds AS (SELECT greatest(0, avg(roc_auc) - 3 * stddev_pop(roc_auc)) AS la, least(1, avg(roc_auc) + 3 * stddev_pop(roc_auc)) AS ua,
    greatest(0, avg(f1) - 3 * stddev_pop(f1)) AS lf, least(1, avg(f1) + 3 * stddev_pop(f1)) AS uf FROM realized),
  alerts AS (SELECT chunk_id, 'roc_auc' AS metric, roc_auc AS value, la AS lower, ua AS upper FROM estimated, bounds
    UNION ALL SELECT chunk_id, 'f1', f1, lf, uf FROM estimated, bounds)"""


@query(
    "j3_limits_and_alerts",
    f"""{ALERTS} SELECT chunk_id, metric, round(value, 6) AS value, round(lower, 6) AS lower, round(upper, 6) AS upper,
    value < lower OR value > upper AS alert FROM alerts""",
)
def j3(spark, sf):
    ref, prod = _periods(spark, sf)
    n = prod.count()
    prod = _chunked(prod, chunks.default_chunk_size(n))
    data = MonitorInput(ref, prod, DRIFT_COLS)
    _, alerts = performance(data, chunks.default_chunk_size(n), calibrate=False)
    return _round(alerts, "value", "lower", "upper")


@query(
    "j3_realized_reference",
    f"{CHUNKS}, {REALIZED} SELECT chunk_id, n_rows, round(roc_auc, 6) AS roc_auc, round(f1, 6) AS f1 FROM realized",
)
def j3_realized(spark, sf):
    ref, prod = _periods(spark, sf)
    ref = _chunked(ref, chunks.default_chunk_size(prod.count()))
    return _round(cbpe.realized(ref), "roc_auc", "f1")


# ---- J, C5: drift ----------------------------------------------------------------------------


def _binned(table: str, name: str, keys: str = "") -> str:
    parts = " UNION ALL ".join(
        f"""SELECT {keys}'{c}' AS feature, least(9, greatest(0, (CASE WHEN {c} <= e.lo + e.w THEN 0
        {' '.join(f'WHEN {c} <= e.lo + e.w * {i} THEN {i - 1}' for i in range(2, 10))} ELSE 9 END)))::INTEGER AS bin
        FROM {table}, (SELECT min({c}) AS lo, (max({c}) - min({c})) / 10 AS w FROM reference) e WHERE {c} IS NOT NULL"""
        for c in DRIFT_COLS)
    return f"{name} AS (SELECT {keys}feature, bin, count(*) AS n FROM ({parts}) GROUP BY ALL)"


JS_SQL = """js AS (SELECT chunk_id, feature, sqrt(greatest(0, sum(
    CASE WHEN p > 0 THEN 0.5 * p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN 0.5 * q * log2(2 * q / (p + q)) ELSE 0 END))) AS value
  FROM (SELECT c.chunk_id, c.feature, b.bin, coalesce(r.n, 0) / c.tr AS p, coalesce(q.n, 0) / c.tq AS q FROM
    (SELECT chunk_id, feature, sum(n) AS tq, (SELECT sum(n) FROM rb WHERE rb.feature = qb.feature) AS tr FROM qb GROUP BY ALL) c
    CROSS JOIN range(10) b(bin) LEFT JOIN rb r ON r.feature = c.feature AND r.bin = b.bin
    LEFT JOIN qb q ON q.feature = c.feature AND q.bin = b.bin AND q.chunk_id = c.chunk_id) GROUP BY ALL)"""
JS = f"{CHUNKS}, {SHIFTED}, {_binned('reference', 'rb')}, {_binned('shifted', 'qb', 'chunk_id, ')}, {JS_SQL}"


@query(
    "c5_compare_bins",
    f"""{CHUNKS}, {SHIFTED}, {_binned('reference', 'rb')}, {_binned('shifted', 'qb')}
    SELECT coalesce(rb.feature, qb.feature) AS feature, coalesce(rb.bin, qb.bin) AS bin, coalesce(rb.n, 0) AS n_ref,
    coalesce(qb.n, 0) AS n_prod FROM rb FULL JOIN qb ON rb.feature = qb.feature AND rb.bin = qb.bin""",
)
def c5(spark, sf):
    ref, prod = _periods(spark, sf)
    prod = prod.withColumn("value", F.col("value") * 1.5)
    edges = drift.equal_width_edges(ref, DRIFT_COLS)
    return drift.compare_bins(drift.bin_counts(ref, edges), drift.bin_counts(prod, edges))


def _univariate(spark, sf):
    ref, prod = _prod(spark, sf, shift=True)
    return drift.univariate_drift(ref, prod, DRIFT_COLS)


@query("j4_univariate_drift", f"{JS} SELECT chunk_id, feature, round(value, 6) AS value, value > 0.1 AS alert FROM js")
def j4(spark, sf):
    return _round(_univariate(spark, sf), "value")


@query("j10_latest_value", f"{JS} SELECT feature, round(arg_max(value, chunk_id), 6) AS value FROM js GROUP BY 1")
def j10(spark, sf):
    return _round(drift.latest_value(_univariate(spark, sf), by=["feature"]), "value")


@query(
    "j11_alert_counts",
    f"{JS} SELECT feature, count(*) FILTER (WHERE value > 0.1) AS n_alerts, bool_or(value > 0.1) AS any_alert FROM js GROUP BY 1",
)
def j11(spark, sf):
    return drift.count_alerts(_univariate(spark, sf), by=["feature"])


@query(
    "j12_drifted_features",
    f"{JS} SELECT coalesce(string_agg(DISTINCT feature, ',' ORDER BY feature), '') AS drifted FROM js WHERE value > 0.1",
)
def j12(spark, sf):
    return drift.drifted_features(_univariate(spark, sf)).select(F.array_join("drifted_features", ",").alias("drifted"))


def _pairs_sql(cols) -> str:
    def side(table, c, r, p):
        return f"SELECT '{c}' AS feature, {c}::DOUBLE AS value, {r} AS r, {p} AS q FROM {table} WHERE {c} IS NOT NULL"

    both = " UNION ALL ".join(side("reference", c, 1, 0) + " UNION ALL " + side("shifted", c, 0, 1) for c in cols)
    return f"""pairs AS (SELECT feature, value, sum(r)::BIGINT AS n_ref, sum(q)::BIGINT AS n_prod FROM ({both}) GROUP BY ALL),
    cum AS (SELECT *, sum(n_ref) OVER o AS cr, sum(n_prod) OVER o AS cq, sum(n_ref) OVER w AS tr, sum(n_prod) OVER w AS tq,
      lead(value) OVER o AS nxt FROM pairs WINDOW o AS (PARTITION BY feature ORDER BY value), w AS (PARTITION BY feature))"""


DISCRETE = ["etype"]
TESTS = f"{CHUNKS}, {SHIFTED}, {_pairs_sql(DRIFT_COLS)}"
ETYPE_SQL = "CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END"


def _two_sample(spark, sf):
    ref, prod = _periods(spark, sf)
    return drift.two_sample(ref, prod.withColumn("value", F.col("value") * 1.5), DRIFT_COLS)


@query(
    "j5_ks_test",
    f"""{TESTS}, d AS (SELECT feature, max(abs(cr / tr - cq / tq)) AS statistic, max(tr)::DOUBLE AS n, max(tq)::DOUBLE AS m FROM cum GROUP BY 1),
    l AS (SELECT *, statistic * sqrt(n * m / (n + m)) AS lam FROM d)
    SELECT feature, round(statistic, 6) AS statistic, round(CASE WHEN lam < 0.2 THEN 1 ELSE greatest(0, least(1,
      (SELECT sum((CASE WHEN i % 2 = 1 THEN 2 ELSE -2 END) * exp(-2.0 * i * i * lam * lam)) FROM range(1, 101) t(i)))) END, 6) AS p_value FROM l""",
)
def j5(spark, sf):
    return _round(drift.ks_test(_two_sample(spark, sf)), "statistic", "p_value")


def _etype(df):
    kinds = {t: i for i, t in enumerate(fx.EVENT_TYPES)}
    code = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])[F.col("event_type")]
    return df.withColumn("etype", code.cast("double"))


@query(
    "j6_chi2_test",
    f"""{SCORED}, counts AS (SELECT {ETYPE_SQL} AS v, count(*) FILTER (WHERE ts < TIMESTAMP '{fx.SPLIT_DATE}') AS a,
      count(*) FILTER (WHERE ts >= TIMESTAMP '{fx.SPLIT_DATE}') AS b FROM scored GROUP BY 1),
    t AS (SELECT *, sum(a) OVER () AS ta, sum(b) OVER () AS tb FROM counts),
    e AS (SELECT *, (a + b) * ta / (ta + tb) AS ea, (a + b) * tb / (ta + tb) AS eb FROM t)
    SELECT 'etype' AS feature, round(sum((a - ea) * (a - ea) / ea + (b - eb) * (b - eb) / eb), 6) AS statistic, (count(*) - 1)::INTEGER AS dof FROM e""",
)
def j6(spark, sf):
    ref, prod = _periods(spark, sf)
    out = drift.chi2_test(drift.two_sample(_etype(ref), _etype(prod), ["etype"]))
    return _round(out.drop("p_value"), "statistic")


@query(
    "j7_wasserstein",
    f"""{TESTS}, s AS (SELECT feature, sqrt(sum(n_ref * (value - m) * (value - m)) / sum(n_ref)) AS sd FROM pairs
      JOIN (SELECT feature, sum(n_ref * value) / sum(n_ref) AS m FROM pairs GROUP BY 1) USING (feature) GROUP BY 1)
    SELECT feature, round(coalesce(sum(abs(cr / tr - cq / tq) * (nxt - value)), 0) / greatest(max(sd), 0.001), 6) AS distance
    FROM cum JOIN s USING (feature) GROUP BY 1""",
)
def j7(spark, sf):
    return _round(drift.wasserstein(stage(_two_sample(spark, sf), "pairs")), "distance")


@query(
    "j8_fixed_tests",
    f"""{TESTS}, s AS (SELECT feature, sqrt(sum(n_ref * (value - m) * (value - m)) / sum(n_ref)) AS sd, sum(n_ref) AS n,
        count(*) FILTER (WHERE n_ref > 0) AS n_values FROM pairs
      JOIN (SELECT feature, sum(n_ref * value) / sum(n_ref) AS m FROM pairs GROUP BY 1) USING (feature) GROUP BY 1),
    w AS (SELECT feature, coalesce(sum(abs(cr / tr - cq / tq) * (nxt - value)), 0) / greatest(max(sd), 0.001) AS distance,
      max(abs(cr / tr - cq / tq)) AS ks, max(tr)::DOUBLE AS r, max(tq)::DOUBLE AS q, max(n) AS n FROM cum JOIN s USING (feature) GROUP BY 1),
    l AS (SELECT *, ks * sqrt(r * q / (r + q)) AS lam FROM w),
    pv AS (SELECT *, CASE WHEN lam < 0.2 THEN 1 ELSE greatest(0, least(1,
      (SELECT sum((CASE WHEN i % 2 = 1 THEN 2 ELSE -2 END) * exp(-2.0 * i * i * lam * lam)) FROM range(1, 101) t(i)))) END AS pval FROM l)
    SELECT feature, distance >= 0.1 AS drift_detected, round(distance, 4) AS drift_score, 'Wasserstein distance (normed)' AS stattest FROM w
    UNION ALL SELECT 'never', NULL, NULL, 'Wasserstein distance (normed)'""",
)
def j8_fixed(spark, sf):
    """Tests that don't depend on the number of rows; a column without values keeps its row."""
    ref, prod = (d.withColumn("never", F.lit(None).cast("double")) for d in _periods(spark, sf))
    return drift.drift_report(ref, prod.withColumn("value", F.col("value") * 1.5), [*DRIFT_COLS, "never"], tests="wasserstein")


@query(
    "j8_drift_report",
    f"""{TESTS}, s AS (SELECT feature, sqrt(sum(n_ref * (value - m) * (value - m)) / sum(n_ref)) AS sd, sum(n_ref) AS n,
        count(*) FILTER (WHERE n_ref > 0) AS n_values FROM pairs
      JOIN (SELECT feature, sum(n_ref * value) / sum(n_ref) AS m FROM pairs GROUP BY 1) USING (feature) GROUP BY 1),
    w AS (SELECT feature, coalesce(sum(abs(cr / tr - cq / tq) * (nxt - value)), 0) / greatest(max(sd), 0.001) AS distance,
      max(abs(cr / tr - cq / tq)) AS ks, max(tr)::DOUBLE AS r, max(tq)::DOUBLE AS q, max(n) AS n FROM cum JOIN s USING (feature) GROUP BY 1),
    l AS (SELECT *, ks * sqrt(r * q / (r + q)) AS lam FROM w),
    pv AS (SELECT *, CASE WHEN lam < 0.2 THEN 1 ELSE greatest(0, least(1,
      (SELECT sum((CASE WHEN i % 2 = 1 THEN 2 ELSE -2 END) * exp(-2.0 * i * i * lam * lam)) FROM range(1, 101) t(i)))) END AS pval FROM l)
    SELECT feature, CASE WHEN n > 1000 THEN distance >= 0.1 ELSE pval < 0.05 END AS drift_detected,
    round(CASE WHEN n > 1000 THEN distance ELSE pval END, 4) AS drift_score,
    CASE WHEN n > 1000 THEN 'Wasserstein distance (normed)' ELSE 'K-S p_value' END AS stattest FROM pv""",
)
def j8(spark, sf):
    ref, prod = _periods(spark, sf)
    return drift.drift_report(ref, prod.withColumn("value", F.col("value") * 1.5), DRIFT_COLS, large=1000)


@query("j8_drift_summary")
def j8_summary(spark, sf):
    ref, prod = _periods(spark, sf)
    shifted = prod.withColumn("value", F.col("value") * 1.5)
    report = drift.drift_report(_etype(ref), _etype(shifted), [*DRIFT_COLS, "etype"])
    return drift.drift_summary(report)


@query("j9_multivariate_drift")
def j9(spark, sf):
    ref, prod = _prod(spark, sf, shift=True)
    return _round(drift.multivariate_drift(ref, prod, DRIFT_COLS), "value")


def _monitor(spark, sf):
    ref, prod = _periods(spark, sf)
    log = prod.select(
        "event_id", "ts", F.col("p").alias("default_probability"),
        F.to_json(F.struct("k", "value", "user_id", F.col("p").alias("score"))).alias("features"),
    )
    flat = production_rows(log)
    reference = ref.withColumn("score", F.col("p"))
    return run_monitor(MonitorInput(reference, flat, ["k", "value", "user_id", "score"]))


@query("j13_monitor_run")
def j13(spark, sf):
    return _monitor(spark, sf).drop("run_ts")


@query("j14_run_gauges")
def j14_gauges(spark, sf):
    return gauges(_monitor(spark, sf)).drop("run_ts")


# ---- D9, K: telemetry ------------------------------------------------------------------------


def _buckets_sql(value, bounds):
    cums = ", ".join(f"count(*) FILTER (WHERE {value} <= {b}) AS c{i}" for i, b in enumerate(bounds))
    les = " UNION ALL ".join(f"SELECT {float(b)!r}::DOUBLE AS le, c{i} AS cum FROM h" for i, b in enumerate(bounds))
    return f"{REQUESTS}, h AS (SELECT {cums}, count({value}) AS c_all FROM requests) {les} UNION ALL SELECT 'inf'::DOUBLE, c_all FROM h"


def _buckets(column, bounds):
    def run(spark, sf):
        return tm.bucket_rows(tm.histogram(fx.requests(spark, sf), column, bounds), bounds)

    return run


for _name, _column, _bounds in (
    ("latency", "latency", credit.LATENCY_BOUNDS),
    ("probability", "p", credit.PROBABILITY_BOUNDS),
    ("missing", "missing_rate", credit.MISSING_BOUNDS),
):
    query(f"d9_histogram_{_name}", _buckets_sql(_column, _bounds))(_buckets(_column, _bounds))


def _ts(df, *cols):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c) for c in df.columns])


@query(
    "k2_request_rate",
    f"""{REQUESTS} SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, endpoint, count(*) / (60.0 / 60.0) AS rate FROM requests GROUP BY ALL""",
)
def k2(spark, sf):
    out = tm.rate(fx.requests(spark, sf), "ts", "1 minute", 60, 60, by=["endpoint"])
    return out.drop("window_end")


def _sliding(table, width_min, slide_min):
    n = width_min // slide_min
    return f"""(SELECT *, time_bucket(INTERVAL {slide_min} MINUTE, ts) - to_minutes({slide_min} * o) AS ws FROM {table}, range({n}) r(o))"""


@query(
    "k4_error_rate",
    f"{REQUESTS} SELECT ws AS window_start, round(count(*) / 300.0, 6) AS rate FROM {_sliding('requests', 5, 1)} WHERE status = 500 GROUP BY 1",
)
def k4(spark, sf):
    errors = fx.requests(spark, sf).filter("status = 500")
    return _round(tm.rate(errors, "ts", "5 minutes", 300, slide="1 minute").drop("window_end"), "rate")


def _quantile_sql(value, bounds, probs, hours, digits=6):
    edges = [0.0, *bounds]
    cums = ", ".join(f"count(*) FILTER (WHERE {value} <= {b}) AS c{i + 1}" for i, b in enumerate(bounds))

    def q(p):
        cases = []
        for i, b in enumerate(bounds):
            before = f"c{i}" if i else "0"
            inside = f"{b}" if i == 0 and b <= 0 else f"{edges[i]} + {b - edges[i]!r} * coalesce(({p} * n - {before}) / nullif(c{i + 1} - {before}, 0), 0)"
            cases.append(f"WHEN c{i + 1} >= {p} * n THEN {inside}")
        return f"round(CASE {' '.join(cases)} ELSE {bounds[-1]} END, {digits}) AS q{round(p * 100)}"

    return f"""{REQUESTS}, h AS (SELECT time_bucket(INTERVAL {hours} HOUR, ts) AS window_start, {cums}, count({value}) AS n FROM requests GROUP BY 1)
    SELECT window_start, {', '.join(q(p) for p in probs)} FROM h"""


@query("k3_histogram_quantile", _quantile_sql("latency", credit.LATENCY_BOUNDS, [0.5, 0.95], 6, 9))
def k3(spark, sf):
    out = tm.quantile_series(fx.requests(spark, sf), "ts", "latency", credit.LATENCY_BOUNDS, [0.5, 0.95], "6 hours")
    return _round(out.drop("window_end"), "q50", "q95", digits=9)


@query("k3_missing_rate_quantile", _quantile_sql("missing_rate", credit.MISSING_BOUNDS, [0.5, 0.9], 6))
def k3_missing(spark, sf):
    out = tm.quantile_series(fx.requests(spark, sf), "ts", "missing_rate", credit.MISSING_BOUNDS, [0.5, 0.9], "6 hours")
    return _round(out.drop("window_end"), "q50", "q90")


_LE_SQL = "CASE " + " ".join(f"WHEN p <= {b} THEN {b}::DOUBLE" for b in credit.PROBABILITY_BOUNDS) + " END"


@query(
    "k5_heatmap",
    f"{REQUESTS} SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, {_LE_SQL} AS le, count(*) AS n FROM requests GROUP BY ALL",
)
def k5(spark, sf):
    return tm.heatmap(fx.requests(spark, sf), "ts", "p", credit.PROBABILITY_BOUNDS, "1 hour").drop("window_end")


@query(
    "k6_decision_share",
    f"""{REQUESTS}, d AS (SELECT CASE WHEN p >= 0.70 THEN 'reject' WHEN p >= 0.45 THEN 'manual_review' ELSE 'approve' END AS decision,
      count(*) AS n FROM requests GROUP BY 1) SELECT decision, n, round(n / sum(n) OVER (), 6) AS share FROM d""",
)
def k6(spark, sf):
    from scorelake.functions.decision import decision

    df = fx.requests(spark, sf).withColumn("decision", decision(F.col("p")))
    return _round(tm.shares(df, "decision"), "share")


@query(
    "k7_event_increase",
    f"""{REQUESTS} SELECT ws AS window_start, endpoint, count(*) AS n FROM {_sliding('requests', 60, 15)}
    WHERE endpoint IN ('signup', 'error') GROUP BY ALL""",
)
def k7(spark, sf):
    kinds = fx.requests(spark, sf).filter(F.col("endpoint").isin("signup", "error"))
    return tm.windowed(kinds, "ts", "60 minutes", [F.count("*").alias("n")], "15 minutes", ["endpoint"]).drop("window_end")


@query(
    "k8_alert_rules",
    f"""{REQUESTS}, errors AS (SELECT 'HighErrorRate' AS rule, ws, count(*) / 3600.0 AS v FROM {_sliding('requests', 60, 10)} WHERE status = 500 GROUP BY ws),
    slow AS (SELECT 'HighMeanLatency' AS rule, ws, avg(latency) AS v FROM {_sliding('requests', 60, 10)} GROUP BY ws),
    hot AS (SELECT rule, (epoch(ws) / 600)::BIGINT AS i FROM errors WHERE v > 0.0002 UNION ALL
      SELECT rule, (epoch(ws) / 600)::BIGINT FROM slow WHERE v > 0.03),
    runs AS (SELECT rule, min(i) AS a, max(i) AS b FROM (SELECT *, i - row_number() OVER (PARTITION BY rule ORDER BY i) AS g FROM hot) GROUP BY rule, g)
    SELECT rule, make_timestamp(a * 600 * 1000000) AS pending_since, make_timestamp((a * 600 + 1200) * 1000000) AS firing_since,
    make_timestamp(b * 600 * 1000000) AS last_true FROM runs WHERE (b - a) * 600 >= 1200""",
)
def k8(spark, sf):
    df = fx.requests(spark, sf)
    errors = tm.rate(df.filter("status = 500"), "ts", "60 minutes", 3600, slide="10 minutes")
    slow = tm.windowed(df, "ts", "60 minutes", [F.avg("latency").alias("rate")], "10 minutes")
    series = errors.withColumn("rule", F.lit("HighErrorRate")).unionByName(
        slow.withColumn("rule", F.lit("HighMeanLatency"))
    )
    high = ((F.col("rule") == "HighErrorRate") & (F.col("rate") > 0.0002)) | (
        (F.col("rule") == "HighMeanLatency") & (F.col("rate") > 0.03)
    )
    return _ts(tm.held_alerts(series, 600, 1200, high), "pending_since", "firing_since", "last_true")


def _rules_sql():
    """Runs of the minutes at which each rule's measure is above its threshold, held long enough."""
    hot = []
    for rule, measure, what, minutes, threshold, hold in credit.ALERT_RULES:
        rows = _sliding("watched", minutes, 1)
        if measure == "quantile":
            value, bounds, q = what
            edges = [0.0, *bounds]
            cums = ", ".join(f"count(*) FILTER (WHERE {value} <= {b!r}::DOUBLE)::DOUBLE AS c{i + 1}" for i, b in enumerate(bounds))
            cases = " ".join(
                f"WHEN c{i + 1} >= {q}::DOUBLE * n THEN "
                + ("0.0" if b <= 0 else f"{edges[i]!r}::DOUBLE + {b - edges[i]!r}::DOUBLE * coalesce(({q}::DOUBLE * n - {f'c{i}' if i else '0'}) / nullif(c{i + 1} - {f'c{i}' if i else '0'}, 0), 0)")
                for i, b in enumerate(bounds)
            )
            series = f"SELECT ws, CASE {cases} ELSE {bounds[-1]!r}::DOUBLE END AS v FROM (SELECT ws, 0.0 AS c0, {cums}, count({value}) AS n FROM {rows} GROUP BY ws) WHERE n > 0"
        else:
            series = f"SELECT ws, count(*) / {minutes * 60.0 if measure == 'rate' else 1.0}::DOUBLE AS v FROM {rows} WHERE {what} GROUP BY ws"
        hot.append(f"SELECT '{rule}' AS rule, {hold} AS hold, (epoch(ws) / 60)::BIGINT + {minutes} AS i FROM ({series}) WHERE v > {float(threshold)!r}::DOUBLE")
    return f"""{REQUESTS}, watched AS (SELECT * REPLACE (latency * 2 AS latency), endpoint = 'signup' AS reload_failed FROM requests),
    hot AS ({' UNION ALL '.join(hot)}),
    runs AS (SELECT rule, hold, min(i) AS a, max(i) AS b FROM (SELECT *, i - row_number() OVER (PARTITION BY rule ORDER BY i) AS g FROM hot) GROUP BY rule, hold, g)
    SELECT rule, make_timestamp(a * 60 * 1000000) AS pending_since, make_timestamp((a * 60 + hold) * 1000000) AS firing_since,
    make_timestamp(b * 60 * 1000000) AS last_true FROM runs WHERE (b - a) * 60 >= hold"""


@query("k8_credit_rules", _rules_sql())
def k8_credit_rules(spark, sf):
    """The application's rules. Latencies count twice, so that some windows pass half a second; signups stand for failed reloads."""
    watched = fx.requests(spark, sf).withColumn("latency", F.col("latency") * 2).withColumn("reload_failed", F.col("endpoint") == "signup")
    alerts = tm.rule_alerts(watched, "ts", credit.ALERT_RULES, credit.ALERT_STEP_S)
    return _ts(alerts, "pending_since", "firing_since", "last_true")


@query(
    "k9_silent_sources",
    f"""{REQUESTS}, i AS (SELECT DISTINCT key, epoch_us(ts) AS us FROM requests),
    n AS (SELECT key, us AS from_us, lead(us) OVER (PARTITION BY key ORDER BY us) AS to_us FROM i)
    SELECT key, from_us, to_us, (to_us - from_us) / 1000000.0 AS gap_s FROM n WHERE (to_us - from_us) / 1000000.0 > 43200""",
)
def k9(spark, sf):
    return tm.silent_gaps(fx.requests(spark, sf), "key", "ts", 43_200)


RATE_LIMIT, RATE_WINDOW = 3, 6 * 3600


def _rate_limit_sql(requests):
    return f"""WITH RECURSIVE {fx.REQUESTS_CTE}, asked AS ({requests}),
    e AS (SELECT event_id, key, epoch_us(ts) AS us, row_number() OVER (PARTITION BY key ORDER BY ts, event_id) AS rn FROM asked),
    r AS (SELECT event_id, key, rn, us AS window_us, 1 AS n FROM e WHERE rn = 1 UNION ALL
      SELECT e.event_id, e.key, e.rn, CASE WHEN e.us >= r.window_us + {RATE_WINDOW * 1_000_000} THEN e.us ELSE r.window_us END,
      CASE WHEN e.us >= r.window_us + {RATE_WINDOW * 1_000_000} THEN 1 ELSE r.n + 1 END
      FROM r JOIN e ON e.key IS NOT DISTINCT FROM r.key AND e.rn = r.rn + 1)
    SELECT event_id, key, window_us, n <= {RATE_LIMIT} AS allowed FROM r"""


def _rate_limited(requests):
    out = tm.rate_limit(requests, "key", "ts", "event_id", RATE_LIMIT, RATE_WINDOW, segment_s=86_400)
    return out.select("event_id", "key", "window_us", "allowed")


@query("k10_rate_limit", _rate_limit_sql("SELECT * FROM requests"))
def k10(spark, sf):
    return _rate_limited(fx.requests(spark, sf))


@query("k10_null_caller", _rate_limit_sql("SELECT * REPLACE (CASE WHEN event_id % 4 <> 0 THEN key END AS key) FROM requests"))
def k10_null_caller(spark, sf):
    requests = fx.requests(spark, sf)
    return _rate_limited(requests.withColumn("key", F.when(F.col("event_id") % 4 != 0, F.col("key"))))


@query("k12_trace_ids", f"{REQUESTS} SELECT count(*) AS n, count(DISTINCT event_id) AS n_ids, 36 AS id_length, 0::BIGINT AS n_repeated FROM requests")
def k12(spark, sf):
    traced = tm.trace_ids(fx.requests(spark, sf), "event_id", "ts")
    repeated = tm.duplicate_ids(traced).agg(F.count("*").alias("n_repeated"))
    stats = traced.groupBy("trace_id").agg(F.count("*").alias("c")).agg(
        F.sum("c").alias("n"), F.count("*").alias("n_ids"), F.max(F.length("trace_id")).alias("id_length")
    )
    return stats.withColumn("n_repeated", F.lit(repeated.first().n_repeated))


# ---- K11, L: deployment log ------------------------------------------------------------------

STATE_SQL = "SELECT alias, arg_max(to_version, {ts: ts, id: id}) AS version, max(ts) AS since FROM deployments GROUP BY 1"


@query("k11_active_version", f"{DEPLOYMENTS} SELECT alias, arg_max(to_version, (ts, id)) AS version FROM deployments GROUP BY 1")
def k11(spark, sf):
    return registry.alias_state(fx.deployments(spark, sf)).select("alias", "version")


@query("l3_alias_state", f"{DEPLOYMENTS} {STATE_SQL}")
def l3(spark, sf):
    return registry.alias_state(fx.deployments(spark, sf))


def _log_table(spark, sf):
    path = stage_path(spark, "deployments")
    rows = fx.deployments(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    logs.append(tables.align_columns(rows, logs.DEPLOYMENT_SCHEMA), path)
    return path


@query(
    "l1_promote",
    f"""{DEPLOYMENTS}, last AS (SELECT alias, arg_max(to_version, (ts, id)) AS version FROM deployments GROUP BY 1)
    SELECT event_type, alias, from_version, to_version FROM deployments UNION ALL
    SELECT 'promote', '5-LOW', (SELECT version FROM last WHERE alias = '5-LOW'), '900' UNION ALL
    SELECT 'promote', 'brand-new', NULL, '901'""",
)
def l1(spark, sf):
    path = _log_table(spark, sf)
    registry.promote(spark, path, "900", "5-LOW", "ops")
    registry.promote(spark, path, "901", "brand-new", "ops")
    return logs.read_log(spark, path).select("event_type", "alias", "from_version", "to_version")


TARGET_SQL = """target AS (SELECT alias, e.f AS target_version, e.t AS current_version FROM (
  SELECT alias, arg_max({'f': from_version, 't': to_version}, (ts, id)) AS e FROM deployments WHERE event_type = 'promote' GROUP BY 1)
  WHERE e.f IS NOT NULL)"""


@query("l2_rollback_target", f"{DEPLOYMENTS}, {TARGET_SQL} SELECT * FROM target")
def l2(spark, sf):
    return registry.rollback_target(fx.deployments(spark, sf))


@query("l4_history", f"{DEPLOYMENTS} SELECT id, event_type, alias FROM deployments ORDER BY ts DESC, id DESC LIMIT 10")
def l4(spark, sf):
    return registry.history(fx.deployments(spark, sf)).select("id", "event_type", "alias")


@query(
    "l5_versions_newest_first",
    "SELECT o_orderkey::VARCHAR AS version, row_number() OVER (ORDER BY o_orderkey DESC) AS place FROM orders",
)
def l5(spark, sf):
    versions = fx.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("version"))
    return registry.version_places(versions)


@query("l6_lookup_by_trace", "SELECT event_id, value FROM events WHERE event_id = 7")
def l6(spark, sf):
    path = stage_path(spark, "traced")
    traced = tm.trace_ids(fx.requests(spark, sf), "event_id", "ts").select("event_id", "trace_id", (F.col("latency") * 1000).alias("value"))
    traced.sortWithinPartitions("trace_id").write.parquet(path)
    wanted = traced.filter("event_id = 7").first().trace_id
    return logs.prediction_by_trace(spark.read.parquet(path), wanted).select("event_id", F.round("value", 2).alias("value"))


@query(
    "l7_register_runs",
    """WITH v AS (SELECT o_orderpriority AS model_name, max(o_custkey) AS top FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
    r AS (SELECT o_orderpriority AS model_name, 'run-' || o_orderkey AS run_id FROM orders WHERE o_orderstatus = 'P')
    SELECT model_name, run_id, (coalesce(top, 0) + row_number() OVER (PARTITION BY model_name ORDER BY ('0x' || substr(md5('0|' || run_id), 1, 15))::BIGINT, run_id))::BIGINT AS version FROM r LEFT JOIN v USING (model_name)""",
)
def l7(spark, sf):
    orders = fx.table(spark, sf, "orders").withColumn("model_name", F.col("o_orderpriority"))
    versions = orders.filter("o_orderstatus = 'F'").select("model_name", F.col("o_custkey").alias("version"))
    runs = orders.filter("o_orderstatus = 'P'").select("model_name", F.concat(F.lit("run-"), "o_orderkey").alias("run_id"))
    return registry.register_runs(runs, versions)
