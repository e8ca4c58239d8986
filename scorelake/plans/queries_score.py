"""Metrics, decisions, feature preparation, binning and scorecard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelake.functions import decision as rules
from scorelake.operators import binning as bn, metrics as mx, prep, reshape
from scorelake.operators.knn import KNNImputer
from scorelake.operators.scorecard import Scorecard, factor_and_offset
from scorelake.operators.smote import smote
from scorelake.plans import fixtures as fx
from scorelake.plans.catalog import query
from scorelake.session import discard, stage, stage_path

FEATURES = f"WITH {fx.FEATURES_CTE}"
SCORED = f"WITH {fx.SCORED_CTE}"

# ---- H: metrics ------------------------------------------------------------------------------

CURVE_CTE = """hist AS (SELECT p AS score, sum(y)::BIGINT AS pos, (count(*) - sum(y))::BIGINT AS neg FROM scored GROUP BY 1),
curve AS (SELECT score, pos, neg, sum(pos) OVER up AS tp, sum(neg) OVER up AS fp,
  sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM hist WINDOW up AS (ORDER BY score DESC)),
points AS (SELECT *, tp / (tp + fp) AS prec, tp / P AS rec,
  CASE WHEN tp = pos AND fp = neg THEN 1.0 ELSE (tp - pos) / (tp + fp - pos - neg) END AS prec_before FROM curve),
f1s AS (SELECT *, coalesce(2.0 * prec * rec / nullif(prec + rec, 0), 0) AS f1 FROM points),
best AS (SELECT * FROM f1s ORDER BY f1 DESC, score LIMIT 1)"""
AUC_SQL = "sum(neg * (tp - pos + pos / 2.0)) / (max(P)::DOUBLE * max(N))"
CURVE = f"{SCORED}, {CURVE_CTE}"


def _curve(spark, sf):
    return mx.score_curve(fx.scored(spark, sf))


def _rounded(df, *cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("h1_roc_auc", f"{CURVE} SELECT round({AUC_SQL}, 6) AS auc FROM curve")
def h1(spark, sf):
    return _rounded(mx.roc_auc(_curve(spark, sf)), "auc")


@query("h2_gini", f"{CURVE} SELECT round(2 * ({AUC_SQL}) - 1, 6) AS gini FROM curve")
def h2(spark, sf):
    return _rounded(mx.gini(_curve(spark, sf)), "gini")


@query("h3_ks", f"{CURVE} SELECT round(max(tp / P - fp / N), 6) AS ks FROM curve")
def h3(spark, sf):
    return _rounded(mx.ks(_curve(spark, sf)), "ks")


@query("h4_pr_auc", f"{CURVE} SELECT round(sum(pos / P * (prec + prec_before) / 2), 6) AS pr_auc FROM points")
def h4(spark, sf):
    return _rounded(mx.pr_auc(_curve(spark, sf)), "pr_auc")


@query("h5_best_threshold", f"{CURVE} SELECT round(score, 6) AS threshold, round(f1, 6) AS f1 FROM best")
def h5(spark, sf):
    return _rounded(mx.best_threshold(_curve(spark, sf)), "threshold", "f1")


@query(
    "h6_all_metrics",
    f"""{CURVE} SELECT round({AUC_SQL}, 6) AS auc, round(2 * ({AUC_SQL}) - 1, 6) AS gini,
    round(max(c.tp / c.P - c.fp / c.N), 6) AS ks, round(sum(c.pos / c.P * (c.prec + c.prec_before) / 2), 6) AS pr_auc,
    round(max(b.tp / (b.tp + b.fp)), 6) AS precision, round(max(b.tp / b.P), 6) AS recall, round(max(b.score), 6) AS threshold,
    max(b.tp)::BIGINT AS tp, max(b.N - b.fp)::BIGINT AS tn, max(b.fp)::BIGINT AS fp, max(b.P - b.tp)::BIGINT AS fn
    FROM points c CROSS JOIN best b""".replace("sum(neg * (tp - pos + pos / 2.0)) / (max(P)::DOUBLE * max(N))",
        "sum(c.neg * (c.tp - c.pos + c.pos / 2.0)) / (max(c.P)::DOUBLE * max(c.N))"),
)
def h6(spark, sf):
    out = mx.all_metrics(_curve(spark, sf))
    return _rounded(out, "auc", "gini", "ks", "pr_auc", "precision", "recall", "threshold")


@query(
    "h6_metrics_by_type",
    f"""{SCORED}, hist AS (SELECT event_type, p AS score, sum(y)::BIGINT AS pos, (count(*) - sum(y))::BIGINT AS neg FROM scored GROUP BY 1, 2),
    curve AS (SELECT *, sum(pos) OVER up AS tp, sum(pos) OVER w AS P, sum(neg) OVER w AS N FROM hist
      WINDOW up AS (PARTITION BY event_type ORDER BY score DESC), w AS (PARTITION BY event_type))
    SELECT event_type, round({AUC_SQL}, 6) AS auc, max(CASE WHEN score >= 0.45 THEN tp END)::BIGINT AS tp FROM curve GROUP BY 1""",
)
def h6_by(spark, sf):
    out = mx.all_metrics(mx.score_curve(fx.scored(spark, sf), by=["event_type"]), 0.45, by=["event_type"])
    return _rounded(out.select("event_type", "auc", "tp"), "auc")


# ---- I: decisions ----------------------------------------------------------------------------

SCORE_SQL = "round_even(850 - p * 550, 0)::INTEGER"
BAND_SQL = f"""CASE WHEN {SCORE_SQL} >= 750 THEN 'Excellent' WHEN {SCORE_SQL} >= 670 THEN 'Good'
  WHEN {SCORE_SQL} >= 580 THEN 'Fair' WHEN {SCORE_SQL} >= 440 THEN 'Poor' ELSE 'Very Poor' END"""
DECISION_SQL = "CASE WHEN p >= 0.70 THEN 'reject' WHEN p >= 0.45 THEN 'manual_review' ELSE 'approve' END"
VERDICT_SQL = """CASE WHEN y = 1 AND p >= 0.45 THEN 'caught' WHEN y = 1 THEN 'miss'
  WHEN p < 0.45 THEN 'cleared' ELSE 'over_cautious' END"""


@query("i1_credit_score", f"{SCORED} SELECT event_id, {SCORE_SQL} AS credit_score FROM scored")
def i1(spark, sf):
    return fx.scored(spark, sf).select("event_id", rules.credit_score(F.col("p")).alias("credit_score"))


@query("i2_risk_band", f"{SCORED} SELECT event_id, {BAND_SQL} AS risk_band FROM scored")
def i2(spark, sf):
    return fx.scored(spark, sf).select("event_id", rules.risk_band(rules.credit_score(F.col("p"))).alias("risk_band"))


@query("i3_decision", f"{SCORED} SELECT event_id, {DECISION_SQL} AS decision FROM scored")
def i3(spark, sf):
    return fx.scored(spark, sf).select("event_id", rules.decision(F.col("p")).alias("decision"))


@query(
    "i4_decision_row",
    f"""{SCORED} SELECT event_id, round(p, 4) AS default_probability, {SCORE_SQL} AS credit_score,
    {BAND_SQL} AS risk_band, {DECISION_SQL} AS decision FROM scored""",
)
def i4(spark, sf):
    return rules.decide(fx.scored(spark, sf)).select(
        "event_id", "default_probability", "credit_score", "risk_band", "decision"
    )


@query("i5_verdict_counts", f"{SCORED} SELECT y, {VERDICT_SQL} AS verdict, count(*) AS n FROM scored GROUP BY ALL")
def i5(spark, sf):
    verdict = rules.verdict(F.col("y"), rules.decision(F.col("p"))).alias("verdict")
    return fx.scored(spark, sf).groupBy("y", verdict).agg(F.count("*").alias("n"))


@query("i6_gauge", f"{SCORED} SELECT event_id, round(({SCORE_SQL} - 300) / 550.0, 6) AS gauge FROM scored")
def i6(spark, sf):
    return fx.scored(spark, sf).select("event_id", F.round(rules.gauge(rules.credit_score(F.col("p"))), 6).alias("gauge"))


# ---- E: preparation --------------------------------------------------------------------------

KEEP = ["customer_id", "label"]
ROUND = 6


def _features_out(df):
    return df.select(*[c if c in KEEP else F.round(c, ROUND).alias(c) for c in df.columns])


def _cols(expr, names=None):
    return ", ".join(f"round({expr(c)}, {ROUND}) AS {c}" for c in (names or fx.FEATURES))


@query(
    "e2_median_fill",
    f"{FEATURES} SELECT customer_id, label, "
    + _cols(lambda c: f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM features))") + " FROM features",
)
def e2(spark, sf):
    df = stage(fx.features(spark, sf), "features")
    return _features_out(prep.MedianImputer(KEEP).fit(df).transform(df))


@query(
    "e4_winsorize",
    f"{FEATURES}, q AS (SELECT "
    + ", ".join(f"quantile_cont({c}, 0.05) AS lo_{c}, quantile_cont({c}, 0.95) AS hi_{c}" for c in fx.FEATURES)
    + " FROM features) SELECT customer_id, label, "
    + _cols(lambda c: f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, lo_{c}), hi_{c}) END") + " FROM features, q",
)
def e4(spark, sf):
    df = stage(fx.features(spark, sf), "features")
    return _features_out(prep.Winsorizer(KEEP).fit(df).transform(df))


@query(
    "e7_standardize",
    f"{FEATURES} SELECT customer_id, label, "
    + _cols(lambda c: f"({c} - avg({c}) OVER ()) / (CASE WHEN stddev_pop({c}) OVER () > 0 THEN stddev_pop({c}) OVER () ELSE 1 END)")
    + " FROM features",
)
def e7(spark, sf):
    df = stage(fx.features(spark, sf), "features")
    return _features_out(prep.ZScaler(KEEP).fit(df).transform(df))


def _complete(spark, sf):
    """Applicants with median-filled features."""
    df = stage(fx.features(spark, sf), "features")
    return stage(prep.MedianImputer(KEEP).fit(df).transform(df), "complete")


@query("e5_group_components")
def e5(spark, sf):
    df = _complete(spark, sf)
    return _features_out(prep.GroupPCA(fx.GROUPS, fx.COMPONENTS, KEEP).fit(df).transform(df))


@query("e6_component_frame")
def e6(spark, sf):
    df = _complete(spark, sf)
    from pyspark.ml import Pipeline

    fitted = Pipeline(stages=[
        prep.MedianImputer(KEEP), prep.Winsorizer(KEEP), prep.GroupPCA(fx.GROUPS, fx.COMPONENTS, KEEP),
        prep.ConstantDropper(KEEP),
    ]).fit(df)
    return _features_out(prep.component_frame(fitted, df))


@query("e8_feature_elimination")
def e8(spark, sf):
    df = _complete(spark, sf)
    scaled = prep.ZScaler(KEEP).fit(df).transform(df)
    return _features_out(prep.RFESelector(KEEP, "label", 14).fit(scaled).transform(scaled))


@query("e9_feature_steps")
def e9(spark, sf):
    df = stage(fx.features(spark, sf), "features")
    model = prep.feature_steps(fx.GROUPS, fx.COMPONENTS, "customer_id", count=12, k=20).fit(df)
    return _features_out(model.transform(df))


@query("a11_saved_steps_agree", "SELECT 0::BIGINT AS n_different, count(*) AS n_rows FROM customer")
def a11(spark, sf):
    from pyspark.ml import Pipeline, PipelineModel

    df = stage(fx.features(spark, sf), "features")
    fitted = Pipeline(stages=[
        KNNImputer("customer_id", ["label"], k=5), prep.MedianImputer(KEEP), prep.Winsorizer(KEEP), prep.GroupPCA(fx.GROUPS, fx.COMPONENTS, KEEP),
        prep.ConstantDropper(KEEP), prep.ZScaler(KEEP),
    ]).fit(df)
    path = stage_path(spark, "model")
    fitted.save(path)
    before = stage(fitted.transform(df), "before")
    # The loaded model has its own donors.
    discard(spark.read.parquet(fitted.stages[0].donors))
    again = PipelineModel.load(path).transform(df)
    return before.exceptAll(again).agg(F.count("*").alias("n_different")).withColumn("n_rows", F.lit(again.count()).cast("bigint"))


# ---- C1, E3, E10: nearest neighbours ---------------------------------------------------------

KNN_COLS = ["ORD_CNT_12M", "ORD_AVG_3M", "ORD_AVG_6M", "ORD_AVG_12M", "LI_QTY_12M"]
KNN_K = 5


def _knn_sql(cols, k) -> str:
    """Brute force: all pairs of a row with gaps and a donor, ranked for each missing column."""
    gaps = [c for c in cols if c.startswith(("ORD_AVG", "EVT_CNT"))]
    both = {c: f"(a.{c} IS NOT NULL AND b.{c} IS NOT NULL)" for c in cols}
    total = " + ".join(f"CASE WHEN {both[c]} THEN (a.{c} - b.{c}) * (a.{c} - b.{c}) ELSE 0.0 END" for c in cols)
    shared = " + ".join(f"{both[c]}::INTEGER" for c in cols)
    asks = " OR ".join(f"a.{c} IS NULL" for c in gaps)
    pairs = f"""pairs AS (SELECT a.customer_id AS rid, b.customer_id AS donor,
      ({total}) * {len(cols)} / ({shared}) AS d2, {', '.join(f'a.{c} AS q_{c}, b.{c} AS v_{c}' for c in gaps)}
      FROM features a, features b WHERE ({asks}) AND ({shared}) > 0)"""
    per = ", ".join(
        f"""n_{c} AS (SELECT rid, avg(v) AS v FROM (SELECT rid, v_{c} AS v,
        row_number() OVER (PARTITION BY rid ORDER BY d2, donor) AS rn FROM pairs WHERE q_{c} IS NULL AND v_{c} IS NOT NULL)
        WHERE rn <= {k} GROUP BY rid)""" for c in gaps)
    outs = ", ".join(
        f"round(coalesce(f.{c}, n_{c}.v, (SELECT avg({c}) FROM features)), 4) AS {c}" if c in gaps else f"f.{c}" for c in cols)
    joins = " ".join(f"LEFT JOIN n_{c} ON f.customer_id = n_{c}.rid" for c in gaps)
    return f"{FEATURES}, {pairs}, {per} SELECT f.customer_id, {outs} FROM features f {joins}"


def _imputed(df, cols, k):
    out = KNNImputer("customer_id", k=k).fit(df).transform(df)
    return out.select("customer_id", *[F.round(c, 4).alias(c) if c.startswith(("ORD_AVG", "EVT_CNT")) else F.col(c) for c in cols])


@query("c1_knn_impute", _knn_sql(KNN_COLS, KNN_K))
def c1(spark, sf):
    return _imputed(stage(fx.features(spark, sf).select("customer_id", *KNN_COLS), "features"), KNN_COLS, KNN_K)


@query("e3_knn_impute_all", _knn_sql(fx.FEATURES, 20))
def e3(spark, sf):
    return _imputed(stage(fx.features(spark, sf).drop("label"), "features"), fx.FEATURES, 20)


SMOTE_COLS = ["ORD_CNT_12M", "ORD_URGENT_CNT_12M", "LI_QTY_12M"]


def _smote_sql() -> str:
    d2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in SMOTE_COLS)

    def mix(seed, key):
        return f"('0x' || substr(md5('{seed}|' || {key}), 1, 15))::BIGINT"

    cols = ", ".join(SMOTE_COLS)
    return f"""{FEATURES}, m AS (SELECT *, row_number() OVER (ORDER BY {mix(42, 'customer_id')}, customer_id) AS hr FROM features WHERE label = 1),
    k AS (SELECT count(*) FILTER (WHERE label = 1) AS nm, count(*) FILTER (WHERE label = 0) - count(*) FILTER (WHERE label = 1) AS fresh FROM features),
    near AS (SELECT * FROM (SELECT a.customer_id AS rid, b.customer_id AS donor, row_number() OVER (PARTITION BY a.customer_id
      ORDER BY {d2}, b.customer_id) AS rn FROM m a JOIN m b ON a.customer_id <> b.customer_id) WHERE rn <= 5),
    cp AS (SELECT m.*, unnest(range(1, 1 + (fresh // nm + (hr <= fresh % nm)::INTEGER)::BIGINT)) AS copy FROM m, k),
    placed AS (SELECT cp.*, near.donor, {mix(44, "customer_id || '|' || copy")} / 1152921504606846976.0 AS u FROM cp JOIN near
      ON near.rid = customer_id AND near.rn = 1 + {mix(43, "customer_id || '|' || copy")} % 5)
    SELECT customer_id, label, 0 AS copy, {cols} FROM features UNION ALL
    SELECT p.customer_id, p.label, p.copy, {', '.join(f'round(p.{c} + u * (d.{c} - p.{c}), 6) AS {c}' for c in SMOTE_COLS)}
    FROM placed p JOIN m d ON d.customer_id = p.donor"""


@query("e10_smote", _smote_sql())
def e10(spark, sf):
    df = stage(fx.features(spark, sf).select("customer_id", "label", *SMOTE_COLS), "features")
    out = smote(df, SMOTE_COLS, "customer_id")
    return out.select("customer_id", "label", "copy", *[F.round(c, 6).alias(c) for c in SMOTE_COLS])


# ---- F: binning and scorecard ----------------------------------------------------------------

BINS = {"ORD_CNT_12M": 5, "LI_QTY_6M": 4, "LI_QTY_12M": 8, "ORD_AVG_12M": 8, "EVT_CNT_view": 3}
EDGE_DIGITS = 6


#: Least rows of a bin; small enough for bins to stay in the smallest table.
LEAST_OBS = 15


def _edges_sql() -> str:
    raw = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, list_sort(list_distinct(list_transform(
        quantile_cont({c}, [{', '.join(f'{i}/{q}.0' for i in range(q + 1))}]), lambda v: round(v, {EDGE_DIGITS})))) AS e FROM features"""
        for c, q in BINS.items())
    long = " UNION ALL ".join(f"SELECT customer_id, '{c}' AS feature, {c} AS value, label FROM features" for c in BINS)
    return f"""{FEATURES}, long AS ({long}), raw AS ({raw}),
    inner_edges AS (SELECT feature, e[2:len(e) - 1] AS cuts FROM raw),
    sizes AS (SELECT feature, cuts, len(list_filter(cuts, lambda c: c <= value)) AS b, count(*) AS n
      FROM long JOIN inner_edges USING (feature) WHERE value IS NOT NULL GROUP BY ALL),
    edges AS (SELECT feature, coalesce(list_sort(list(cuts[b + 1]) FILTER (WHERE n >= {LEAST_OBS} AND b < len(cuts))), []) AS cuts
      FROM sizes GROUP BY feature),
    binned AS (SELECT customer_id, feature, value, label, len(list_filter(cuts, lambda c: c < value)) AS bin
      FROM long JOIN edges USING (feature) WHERE value IS NOT NULL)"""


COUNTS_SQL = """counts AS (SELECT feature, bin::INTEGER AS bin, count(*) AS n_obs, sum(label)::BIGINT AS n_bad,
  (count(*) - sum(label))::BIGINT AS n_good FROM binned GROUP BY ALL)"""
WOE_SQL = """fixed AS (SELECT feature, bin, n_obs, greatest(n_bad, 1) AS n_bad, n_good FROM counts),
shares AS (SELECT *, n_good / greatest(sum(n_good) OVER w, 1) AS pct_good, n_bad / greatest(sum(n_bad) OVER w, 1) AS pct_bad
  FROM fixed WINDOW w AS (PARTITION BY feature)),
woe AS (SELECT *, CASE WHEN pct_good > 0 THEN ln(pct_good / pct_bad) ELSE 0 END AS woe FROM shares),
woe_iv AS (SELECT *, (pct_good - pct_bad) * woe AS iv FROM woe),
ivs AS (SELECT feature, sum(iv) AS iv FROM woe_iv GROUP BY 1)"""
EDGES = _edges_sql()
WOE = f"{EDGES}, {COUNTS_SQL}, {WOE_SQL}"


def _frame(spark, sf):
    return stage(fx.features(spark, sf), "features")


def _edges(df):
    return bn.equal_frequency_edges(df, BINS, min_obs=LEAST_OBS, digits=EDGE_DIGITS)


def _edge_rows(spark, edges):
    rows = [(c, i, float(e)) for c, cuts in edges.items() for i, e in enumerate(cuts)]
    return spark.createDataFrame(rows, "feature string, i int, edge double")


@query(
    "f1_equal_frequency_edges",
    f"{EDGES} SELECT feature, (generate_subscripts(cuts, 1) - 1)::INTEGER AS i, unnest(cuts) AS edge FROM edges",
)
def f1(spark, sf):
    return _edge_rows(spark, _edges(_frame(spark, sf)))


TREE_COLS = ["ORD_CNT_12M", "LI_QTY_12M", "ORD_AVG_12M", "ORD_CNT_6M"]


def _tree_sql() -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c}::FLOAT::DOUBLE AS value, label FROM features" for c in TREE_COLS)

    def h(n, b):
        return f"(CASE WHEN {b} > 0 THEN -({b}) * log2(({b}) / ({n})) ELSE 0 END + CASE WHEN {n} - ({b}) > 0 THEN -({n} - ({b})) * log2(({n} - ({b})) / ({n})) ELSE 0 END)"

    return f"""{FEATURES}, long AS ({long}),
    hist AS (SELECT feature, value, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS bad FROM long WHERE value IS NOT NULL GROUP BY ALL),
    cum AS (SELECT feature, value, lead(value) OVER o AS nxt, sum(n) OVER o AS cn, sum(bad) OVER o AS cb,
      sum(n) OVER w AS tn, sum(bad) OVER w AS tb FROM hist WINDOW o AS (PARTITION BY feature ORDER BY value), w AS (PARTITION BY feature)),
    gains AS (SELECT feature, value / 2 + nxt / 2 AS edge, {h('tn', 'tb')} - {h('cn', 'cb')} - {h('(tn - cn)', '(tb - cb)')} AS gain
      FROM cum WHERE nxt > value + 1e-7)
    SELECT feature, 0 AS i, edge FROM gains WHERE gain > 1e-9
    QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain DESC, edge) = 1"""


@query("f2_entropy_split", _tree_sql())
def f2(spark, sf):
    return _edge_rows(spark, bn.entropy_edges(_frame(spark, sf), {c: 2 for c in TREE_COLS}))


@query("f2_entropy_edges")
def f2_many(spark, sf):
    return _edge_rows(spark, bn.entropy_edges(_frame(spark, sf), {c: 5 for c in TREE_COLS}))


@query("d3_bin_counts", f"{EDGES}, {COUNTS_SQL} SELECT * FROM counts")
def d3(spark, sf):
    df = _frame(spark, sf)
    return bn.bin_counts(df, _edges(df))


@query(
    "f3_woe_table",
    f"""{WOE} SELECT feature, bin, n_obs, n_bad, n_good, round(pct_good, 6) AS pct_good, round(pct_bad, 6) AS pct_bad,
    round(woe, 6) AS woe, round(iv, 6) AS iv FROM woe_iv""",
)
def f3(spark, sf):
    df = _frame(spark, sf)
    return _rounded(bn.woe_table(bn.bin_counts(df, _edges(df))), "pct_good", "pct_bad", "woe", "iv")


@query(
    "f4_fit_on_present_rows",
    f"{EDGES} SELECT feature, count(*) AS n_fit, len(any_value(cuts)) + 1 AS n_bins FROM binned JOIN edges USING (feature) GROUP BY 1",
)
def f4(spark, sf):
    df = _frame(spark, sf)
    edges = _edges(df)
    fitted = bn.fit_binning(df, edges)
    rows = [(c, sum(r["n_obs"] for r in fitted.table if r["feature"] == c), len(fitted.woe[c])) for c in BINS]
    return spark.createDataFrame(rows, "feature string, n_fit bigint, n_bins bigint")


ENCODED_SQL = f"""{WOE}, coded AS (SELECT long.customer_id, long.feature, long.value, long.label, b.bin, coalesce(woe, 0) AS woe
  FROM long LEFT JOIN binned b USING (customer_id, feature) LEFT JOIN woe_iv t ON t.feature = long.feature AND t.bin = b.bin)"""


def _fitted(df):
    return bn.fit_binning(df, _edges(df))


@query("f5_woe_encode", f"{ENCODED_SQL} SELECT customer_id, feature, round(woe, 6) AS woe FROM coded")
def f5(spark, sf):
    df = _frame(spark, sf)
    fitted = _fitted(df)
    wide = df.select("customer_id", *[fitted.woe_of(c).alias(c) for c in BINS])
    return _rounded(reshape.to_long(wide, ["customer_id"], list(BINS)).withColumnRenamed("value", "woe"), "woe")


@query("c2_woe_lookup_join", f"{ENCODED_SQL} SELECT customer_id, feature, round(woe, 6) AS woe FROM coded")
def c2(spark, sf):
    """The same lookup as a join on (feature, bin); the table has one row per bin, so it is broadcast."""
    df = _frame(spark, sf)
    fitted = _fitted(df)
    rows = [(c, i, w) for c in BINS for i, w in enumerate(fitted.woe[c])]
    table = spark.createDataFrame(rows, "feature string, bin int, woe double")
    from scorelake.functions.scalars import bin_index

    wide = df.select("customer_id", *[bin_index(F.col(c), fitted.edges[c]).alias(c) for c in BINS])
    long = wide.unpivot(["customer_id"], list(BINS), "feature", "bin")
    joined = long.join(F.broadcast(table), ["feature", "bin"], "left")
    return joined.select("customer_id", "feature", F.round(F.coalesce("woe", F.lit(0.0)), 6).alias("woe"))


LABEL_SQL = """'(' || CASE WHEN bin = 0 THEN '-inf' ELSE format('{:.3g}', cuts[bin]) END || ', ' ||
  CASE WHEN bin = len(cuts) THEN '+inf' ELSE format('{:.3g}', cuts[bin + 1]) END || ']'"""


@query(
    "f6_bin_label",
    f"""{EDGES} SELECT long.customer_id, long.feature, CASE WHEN b.bin IS NULL THEN 'unknown' ELSE {LABEL_SQL} END AS label
    FROM long LEFT JOIN binned b USING (customer_id, feature) JOIN edges USING (feature)""",
)
def f6(spark, sf):
    df = _frame(spark, sf)
    fitted = _fitted(df)
    wide = df.select("customer_id", *[fitted.label_of(c).alias(c) for c in BINS])
    return wide.unpivot(["customer_id"], list(BINS), "feature", "label")


@query("f7_iv_ranking", f"{WOE} SELECT feature, round(iv, 6) AS iv FROM ivs")
def f7(spark, sf):
    df = _frame(spark, sf)
    return _rounded(bn.iv_table(bn.woe_table(bn.bin_counts(df, _edges(df)))), "iv")


@query(
    "f8_iv_strength",
    f"""{WOE} SELECT feature, CASE WHEN iv > 1 THEN 'suspicious' WHEN iv > 0.3 THEN 'strong' WHEN iv > 0.1 THEN 'medium'
    WHEN iv >= 0.02 THEN 'weak' ELSE 'useless' END AS strength FROM ivs""",
)
def f8(spark, sf):
    df = _frame(spark, sf)
    ivs = bn.iv_table(bn.woe_table(bn.bin_counts(df, _edges(df))))
    return ivs.select("feature", bn.iv_strength(F.col("iv")).alias("strength"))


@query("b14_iv_filter", f"{WOE} SELECT feature, iv >= 0.02 AS kept FROM ivs")
def b14(spark, sf):
    df = _frame(spark, sf)
    ivs = bn.iv_table(bn.woe_table(bn.bin_counts(df, _edges(df))))
    kept = ivs.filter(F.col("iv") >= bn.MIN_IV).select("feature")
    dropped = ivs.select("feature").join(kept, "feature", "left_anti")
    return kept.withColumn("kept", F.lit(True)).unionByName(dropped.withColumn("kept", F.lit(False)))


@query("a4_write_iv_table", f"{WOE} SELECT feature, round(iv, 6) AS iv FROM ivs")
def a4(spark, sf):
    df = _frame(spark, sf)
    path = stage_path(spark, "iv")
    bn.iv_table(bn.woe_table(bn.bin_counts(df, _edges(df)))).write.csv(path, header=True)
    return _rounded(spark.read.schema("feature string, iv double").csv(path, header=True), "iv")


# A scorecard with given coefficients, so that scoring is exactly checkable.
BETA = {c: -0.5 - 0.1 * i for i, c in enumerate(BINS)}
ALPHA = -1.2
FACTOR, OFFSET = factor_and_offset()


def _card(df) -> Scorecard:
    return Scorecard(_fitted(df), list(BINS), list(BETA.values()), ALPHA)


BETA_SQL = "beta AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', {i}, {b!r}::DOUBLE)" for i, (c, b) in enumerate(BETA.items())) + ") t(feature, pos, beta))"
POINTS_SQL = f"""{ENCODED_SQL}, {BETA_SQL}, pts AS (SELECT coded.*, pos, beta,
  (beta * woe + {ALPHA} / {len(BINS)}) * {FACTOR!r}::DOUBLE + {OFFSET!r}::DOUBLE / {len(BINS)} AS points FROM coded JOIN beta USING (feature))"""


@query("f9_feature_points", f"{POINTS_SQL} SELECT customer_id, feature, round(points, 4) AS points FROM pts")
def f9(spark, sf):
    df = _frame(spark, sf)
    card = _card(df)
    coded = bn.encode(df, card.binning, card.features)
    wide = coded.select("customer_id", *[p.alias(f) for f, p in zip(card.features, card._points())])
    long = reshape.to_long(wide, ["customer_id"], card.features)
    return long.select("customer_id", "feature", F.round("value", 4).alias("points"))


@query(
    "f10_scorecard_score",
    f"{POINTS_SQL} SELECT customer_id, round(sum(points), 4) AS score FROM pts GROUP BY 1",
)
def f10(spark, sf):
    df = _frame(spark, sf)
    return _card(df).score(df, explain=False).select("customer_id", F.round("scorecard_score", 4).alias("score"))


@query(
    "f11_explanation",
    f"""{POINTS_SQL}, labelled AS (SELECT pts.*, CASE WHEN pts.bin IS NULL THEN 'unknown' ELSE {LABEL_SQL.replace('bin', 'pts.bin')} END AS bin_label
      FROM pts JOIN edges USING (feature))
    SELECT customer_id, (row_number() OVER (PARTITION BY customer_id ORDER BY abs(round(points, 2)) DESC, pos) - 1)::INTEGER AS place,
    feature, bin_label AS bin, round(woe, 4) AS woe, round(points, 2) AS points, round(value, 4) AS raw_value FROM labelled""",
)
def f11(spark, sf):
    df = _frame(spark, sf)
    rows = _card(df).score(df).select("customer_id", F.posexplode("scorecard_breakdown").alias("place", "e"))
    return rows.select(
        "customer_id", "place", "e.feature", "e.bin", "e.woe", F.col("e.score_contribution").alias("points"), "e.raw_value"
    )


@query(
    "f12_score_all",
    f"""{POINTS_SQL}, total AS (SELECT customer_id, sum(beta * woe) + {ALPHA} AS x, sum(points) AS score, count(*) AS n FROM pts GROUP BY 1)
    SELECT customer_id, round(1 / (1 + exp(-x)), 6) AS p, round(score, 4) AS score, n AS n_entries FROM total""",
)
def f12(spark, sf):
    df = _frame(spark, sf)
    out = _card(df).score(df)
    return out.select(
        "customer_id", F.round("p", 6).alias("p"), F.round("scorecard_score", 4).alias("score"),
        F.size("scorecard_breakdown").cast("bigint").alias("n_entries"),
    )


@query(
    "f14_scorecard_probability",
    f"{POINTS_SQL} SELECT customer_id, round(1 / (1 + exp(-(sum(beta * woe) + {ALPHA}))), 6) AS p FROM pts GROUP BY 1",
)
def f14(spark, sf):
    df = _frame(spark, sf)
    return _card(df).score(df, explain=False).select("customer_id", F.round("p", 6).alias("p"))


@query(
    "a9_scored_reference",
    f"""{POINTS_SQL}, s AS (SELECT customer_id, max(label) AS y_true, 1 / (1 + exp(-(sum(beta * woe) + {ALPHA}))) AS p FROM pts GROUP BY 1)
    SELECT customer_id, y_true, round(p, 6) AS y_pred_proba, (p >= 0.45)::INTEGER AS y_pred FROM s""",
)
def a9(spark, sf):
    from scorelake.plans.monitoring import scored_reference

    df = _frame(spark, sf)
    ref = scored_reference(spark, stage_path(spark, "reference"), "v1", lambda: _card(df).score(df, explain=False))
    return ref.select("customer_id", "y_true", F.round("y_pred_proba", 6).alias("y_pred_proba"), "y_pred")
