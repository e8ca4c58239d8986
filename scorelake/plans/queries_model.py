"""Model training, comparison, alias scoring and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelake.operators import boosting, models, prep
from scorelake.operators.metrics import all_metrics, score_curve
from scorelake.operators.registry import alias_state, assign_aliases
from scorelake.operators.scorecard import fit_scorecard
from scorelake.operators.split import stratified_split
from scorelake.plans import fixtures as fx
from scorelake.plans.catalog import query
from scorelake.plans.scoring import read_requests, score_by_alias, score_rows
from scorelake.session import stage, stage_path
from scorelake.sources.logs import audit_rows
from scorelake.streaming.scoring import append_stream, refused_stream, request_stream, score_stream

KEEP = ["customer_id", "label"]


def trainable(spark, sf):
    """Applicants with a label that depends on their orders."""
    df = fx.features(spark, sf)
    risk = (
        F.lit(0.06)
        + F.when(F.col("ORD_CNT_12M") >= 2, 0.20).otherwise(0.0)
        + F.when(F.col("ORD_AVG_12M") > 250000, 0.25).otherwise(0.0)
        + F.when(F.col("LI_QTY_12M") > 150, 0.15).otherwise(0.0)
    )
    return stage(df.withColumn("label", (F.col("customer_id") * 7919 % 1000 / 1000.0 < risk).cast("int")), "trainable")


def _ready(spark, sf):
    df = trainable(spark, sf)
    return stage(prep.MedianImputer(KEEP).fit(df).transform(df), "ready")


def _metrics(scored):
    out = all_metrics(score_curve(scored, "p", "label"))
    return out.select(*[F.round(c, 4).alias(c) for c in ("auc", "gini", "ks", "pr_auc")], "tp", "fp", "fn", "tn")


def _halves(spark, sf, fill=True):
    """Train and test rows; medians, where asked for, are those of the training rows."""
    split = stage(stratified_split(trainable(spark, sf), "customer_id", "label"), "split")
    rows = {name: split.filter(F.col("split") == name).drop("split") for name in ("train", "test")}
    if not fill:
        return rows
    medians = prep.MedianImputer(KEEP).fit(rows["train"])
    return {name: stage(medians.transform(df), f"ready-{name}") for name, df in rows.items()}


def _both(score, rows):
    """Metrics of the training and of the test rows."""
    parts = [_metrics(score(df)).select(F.lit(name).alias("split"), "*") for name, df in rows.items()]
    return parts[0].unionByName(parts[1])


def _model_both(spark, sf, fit):
    rows = _halves(spark, sf)
    model = fit(rows["train"])
    return _both(lambda df: models.positive_probability(model, df), rows)


@query("g1_challenger")
def g1(spark, sf):
    return _model_both(spark, sf, lambda df: models.train_challenger(df, fx.FEATURES, "customer_id"))


@query("g2_boosted_trees")
def g2(spark, sf):
    return _model_both(spark, sf, lambda df: models.train_boosted(df, fx.FEATURES, "customer_id"))


@query("g10_light_fallback")
def g10(spark, sf):
    return _model_both(spark, sf, lambda df: models.train_fallback(df, fx.FEATURES, "customer_id"))


# Cuts at fixed places, so that the splits of the first two levels can be said in SQL. Missing values stay missing.
SPLIT_CUTS = {
    c: [float(v) for v in (range(0, 8) if "CNT" in c else range(20_000, 400_001, 20_000) if "AVG" in c else range(0, 401, 25))] for c in fx.FEATURES
}
UNIT, PENALTY, LEAST = boosting.UNIT, boosting.BoostConfig.penalty, boosting.BoostConfig.min_weight


def _score_sql(g, h):
    return f"(({g} / {UNIT}) * ({g} / {UNIT}) / ({h} / {UNIT} + {PENALTY}))"


def _level_sql(rows, out):
    """The best split of every node of ``rows`` (node, label, gq, hq and columns)."""
    long = " UNION ALL ".join(f"SELECT node, {i} AS f, {c} AS x, gq, hq FROM {rows}" for i, c in enumerate(fx.FEATURES))
    cuts = " UNION ALL ".join(f"SELECT {i} AS f, '{c}' AS feature, unnest({v}) AS cut" for i, (c, v) in enumerate(SPLIT_CUTS.items()))
    gain = f"{_score_sql('gl', 'hl')} + {_score_sql('(g - gl)', '(h - hl)')} - {_score_sql('g', 'h')}"
    return f"""{out} AS (SELECT node, feature, cut, missing_left, {gain} AS gain, gl, hl, g, h FROM (
      SELECT node, f, feature, cut, missing_left, sum(gq)::BIGINT AS g, sum(hq)::BIGINT AS h,
        coalesce(sum(gq) FILTER (x <= cut OR (x IS NULL AND missing_left)), 0)::BIGINT AS gl,
        coalesce(sum(hq) FILTER (x <= cut OR (x IS NULL AND missing_left)), 0)::BIGINT AS hl
      FROM ({long}) JOIN ({cuts}) USING (f), (VALUES (false), (true)) s(missing_left) GROUP BY ALL)
      WHERE hl >= {LEAST * UNIT} AND h - hl >= {LEAST * UNIT}
      QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, cut, missing_left) = 1)"""


def _split_sql():
    side = " ".join(f"WHEN '{c}' THEN CASE WHEN {c} <= cut OR ({c} IS NULL AND missing_left) THEN 1 ELSE 2 END" for c in fx.FEATURES)
    return f"""WITH {fx.FEATURES_CTE}, n AS (SELECT count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM features),
    k AS (SELECT greatest(neg // pos, 1)::DOUBLE AS w, w * pos / (w * pos + neg) AS p FROM n),
    r AS (SELECT 0 AS node, features.*, round(CASE label WHEN 1 THEN w * (p - 1) ELSE p END * {UNIT})::BIGINT AS gq,
      round(CASE label WHEN 1 THEN w ELSE 1 END * p * (1 - p) * {UNIT})::BIGINT AS hq FROM features, k),
    {_level_sql('r', 'top')},
    r1 AS (SELECT r.* REPLACE (CASE feature {side} END AS node) FROM r, top),
    {_level_sql('r1', 'below')}
    SELECT node, feature, cut, missing_left, round(gain, 6) AS gain, gl AS g_left, hl AS h_left, g, h
    FROM (FROM top UNION ALL FROM below) WHERE gain > {boosting.BoostConfig.min_gain}"""


@query("g2_first_splits", _split_sql())
def g2_first(spark, sf):
    df = stage(fx.features(spark, sf), "features")
    cfg = boosting.BoostConfig(rows=1.0, columns=1.0)
    return boosting.split_table(df, fx.FEATURES, "label", "customer_id", SPLIT_CUTS, cfg).withColumn("gain", F.round("gain", 6))


CARD_BINS = {"ORD_CNT_12M": 5, "LI_QTY_12M": 8, "ORD_AVG_12M": 8, "ORD_CNT_6M": 3, "EVT_CNT_view": 3}
CARD_RANKED = ["LI_QTY_12M", "ORD_AVG_12M"]


def _card(df):
    return fit_scorecard(df, CARD_BINS, CARD_RANKED, "customer_id")


@query("f13_scorecard_fit")
def f13(spark, sf):
    df = trainable(spark, sf)
    card = _card(df)
    rows = [(f, round(b, 4), round(card.binning.iv[f], 6)) for f, b in zip(card.features, card.beta)]
    return spark.createDataFrame(rows, "feature string, beta double, iv double")


@query("g3_scorecard_metrics")
def g3(spark, sf):
    rows = _halves(spark, sf, fill=False)
    card = _card(rows["train"])
    return _both(lambda df: card.score(df, explain=False), rows)


@query("g4_grid_search")
def g4(spark, sf):
    df = _ready(spark, sf)
    scaled = prep.ZScaler(KEEP).fit(df).transform(df)
    best = models.grid_search(scaled, fx.FEATURES, "customer_id")
    return spark.createDataFrame([(best.c, best.penalty, round(best.cv_gini, 4))], "c double, penalty string, cv_gini double")


@query("g5_batch_probability")
def g5(spark, sf):
    df = _ready(spark, sf)
    fit = models.logistic_model(fx.FEATURES, "label", df.count()).fit(df)
    return models.positive_probability(fit, df).select("customer_id", F.round("p", 6).alias("p"))


# Given probabilities, so that alias routing and comparison are exactly checkable.


def _ratio_scorer(scale):
    return lambda d: d.withColumn("p", F.col("value") / (F.col("value") + F.lit(scale)))


def _alias_sql(other):
    return f"""WITH {fx.DEPLOYMENTS_CTE}, state AS (SELECT alias, arg_max(to_version, (ts, id)) AS version FROM deployments GROUP BY 1),
    req AS (SELECT event_id, value, CASE event_type WHEN 'view' THEN '5-LOW' WHEN 'click' THEN '1-URGENT' ELSE {other} END AS alias FROM events)
    SELECT event_id, req.alias, CASE WHEN state.alias IS NULL THEN 'local' ELSE version END AS model_version,
    round(value / (value + CASE req.alias WHEN '5-LOW' THEN 50.0 WHEN '1-URGENT' THEN 80.0 ELSE 20.0 END), 6) AS p
    FROM req LEFT JOIN state USING (alias)"""


def _scored_by_alias(spark, sf, other):
    log = fx.deployments(spark, sf)
    current = {r.alias: r.version for r in alias_state(log).collect()}
    scorers = {current["5-LOW"]: _ratio_scorer(50.0), current["1-URGENT"]: _ratio_scorer(80.0)}
    alias = F.when(F.col("event_type") == "view", "5-LOW").when(F.col("event_type") == "click", "1-URGENT").otherwise(other)
    rows = fx.table(spark, sf, "events").withColumn("alias", alias)
    out = score_by_alias(rows, "alias", log, scorers, ["event_id"], ("local", _ratio_scorer(20.0)))
    return out.select("event_id", "alias", "model_version", F.round("p", 6).alias("p"))


@query("g6_score_by_alias", _alias_sql("'unheard'"))
def g6(spark, sf):
    return _scored_by_alias(spark, sf, F.lit("unheard"))


@query("g6_null_alias", _alias_sql("NULL"))
def g6_null(spark, sf):
    return _scored_by_alias(spark, sf, F.lit(None).cast("string"))


@query("g7_model_table")
def g7(spark, sf):
    """Test rows only, so that models are compared on rows none of them has seen."""
    rows, raw = _halves(spark, sf), _halves(spark, sf, fill=False)
    trees = models.train_boosted(rows["train"], fx.FEATURES, "customer_id")
    challenger = models.train_challenger(rows["train"], fx.FEATURES, "customer_id")
    scored = {
        "boosted_trees": models.positive_probability(trees, rows["test"]),
        "logistic_regression": models.positive_probability(challenger, rows["test"]),
        "scorecard_woe_lr": _card(raw["train"]).score(raw["test"], explain=False),
    }
    table = models.compare_models(scored)
    return table.select("model", *[F.round(c, 4).alias(c) for c in ("auc", "gini", "ks", "pr_auc")])


@query(
    "g8_assign_aliases",
    """WITH v AS (SELECT o_custkey AS run_id, max(o_orderkey) AS version FROM orders GROUP BY 1)
    SELECT c_custkey AS run_id, CASE c_mktsegment WHEN 'BUILDING' THEN 'champion' WHEN 'MACHINERY' THEN 'challenger' ELSE 'scorecard' END AS alias,
    version AS to_version, 'promote' AS event_type FROM customer JOIN v ON run_id = c_custkey
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE')""",
)
def g8(spark, sf):
    runs = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("run_id"), F.col("c_mktsegment").alias("model_type"))
    versions = fx.table(spark, sf, "orders").select(F.col("o_custkey").alias("run_id"), F.col("o_orderkey").alias("version"))
    return assign_aliases(runs, versions, {"BUILDING": "champion", "MACHINERY": "challenger", "FURNITURE": "scorecard"})


@query(
    "g9_compare_probabilities",
    """WITH t AS (SELECT event_id, value / (value + 50.0) AS a, value / (value + 80.0) AS b FROM events)
    SELECT event_id, round(abs(a - b), 6) AS abs_diff, (CASE WHEN a >= 0.70 THEN 2 WHEN a >= 0.45 THEN 1 ELSE 0 END)
    <> (CASE WHEN b >= 0.70 THEN 2 WHEN b >= 0.45 THEN 1 ELSE 0 END) AS flipped FROM t""",
)
def g9(spark, sf):
    v = F.col("value")
    out = fx.table(spark, sf, "events").select("event_id", *models.probability_shift(v / (v + 50.0), v / (v + 80.0)))
    return out.withColumn("abs_diff", F.round("abs_diff", 6))


# ---- K1: the same requests as a table and as a stream ----------------------------------------

FIELDS = ["k", "amount", "never_sent"]


def _bodies(df):
    odd = F.when(F.col("event_type") == "error", '"abc"').otherwise("null")
    body = F.concat(
        F.lit('{"k":'), F.get_json_object("props", "$.k"), F.lit(',"amount":"'), F.col("value").cast("string"),
        F.lit('","never_sent":'), odd, F.lit("}"),
    )
    return df.select("event_id", F.col("ts").cast("timestamp").alias("ts"), body.alias("body"))


def _amount_scorer(d):
    return d.withColumn("p", F.col("amount") / (F.col("amount") + 50.0))


K1_SQL = """SELECT event_id, round(value / (value + 50.0), 4) AS default_probability,
  round_even(850 - value / (value + 50.0) * 550, 0)::INTEGER AS credit_score, 'v1' AS model_version FROM events WHERE event_type <> 'error'"""


@query("k1_score_stream", K1_SQL)
def k1(spark, sf):
    schema = fx.table(spark, sf, "events").schema
    raw = _bodies(request_stream(spark, sf, schema, "events.parquet"))
    rows = score_stream(raw, "body", FIELDS, _amount_scorer, "v1", ["event_id"], medians={"never_sent": 1.0})
    path = stage_path(spark, "predictions")
    append_stream(rows, path, stage_path(spark, "stream-checkpoint"), once=True).awaitTermination()
    return spark.read.parquet(path).select("event_id", "default_probability", "credit_score", "model_version")


REFUSED_SQL = "SELECT event_id, ['never_sent'] AS errors FROM events WHERE event_type = 'error'"


@query("k1_refused", REFUSED_SQL)
def k1_refused(spark, sf):
    _, refused = read_requests(_bodies(fx.table(spark, sf, "events")), "body", FIELDS)
    return refused.select("event_id", "errors")


@query("k1_refused_stream", REFUSED_SQL)
def k1_refused_stream(spark, sf):
    raw = _bodies(request_stream(spark, sf, fx.table(spark, sf, "events").schema, "events.parquet"))
    path = stage_path(spark, "quarantine")
    append_stream(refused_stream(raw, "body", FIELDS), path, stage_path(spark, "stream-checkpoint"), once=True).awaitTermination()
    return spark.read.parquet(path).select("event_id", "errors")


@query("k1_score_batch", K1_SQL)
def k1_batch(spark, sf):
    good, _ = read_requests(_bodies(fx.table(spark, sf, "events")), "body", FIELDS)
    rows = score_rows(good, _amount_scorer, "v1", ["event_id"], medians={"never_sent": 1.0})
    return audit_rows(rows, FIELDS, ["event_id"]).select("event_id", "default_probability", "credit_score", "model_version")
