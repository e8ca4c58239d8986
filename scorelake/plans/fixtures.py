"""Views over the base tables that stand in for the applicant table and the logs.

Each view exists twice: as a DataFrame and as the common table expression that the SQL
checks start from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MONTHS = {3: "2001-05-01", 6: "2001-02-01", 9: "2000-11-01", 12: "2000-08-01"}
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
SPLIT_DATE = "2024-01-16"

CNT_COLS = [f"ORD_CNT_{m}M" for m in MONTHS]
URGENT_COLS = [f"ORD_URGENT_CNT_{m}M" for m in MONTHS]
AVG_COLS = [f"ORD_AVG_{m}M" for m in MONTHS]
QTY_COLS = [f"LI_QTY_{m}M" for m in MONTHS]
EVT_COLS = [f"EVT_CNT_{t}" for t in EVENT_TYPES]
FEATURES = CNT_COLS + URGENT_COLS + AVG_COLS + QTY_COLS + EVT_COLS

# Correlated groups and how many components each keeps.
GROUPS = {"ORD_CNT": CNT_COLS + URGENT_COLS, "ORD_AVG": AVG_COLS, "LI_QTY": QTY_COLS}
COMPONENTS = {"ORD_CNT": 5, "ORD_AVG": 3, "LI_QTY": 3}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _whole_cents(recent: Column) -> Column:
    """Average order amount cut to whole cents: integer arithmetic, so no summation order shows."""
    cents = F.sum(F.when(recent, F.round(F.col("o_totalprice") * 100).cast("bigint"))).alias("cents")
    return F.call_function("div", cents, F.nullif(F.count_if(recent), F.lit(0))).cast("double") / 100.0


def features(spark: SparkSession, sf: str) -> DataFrame:
    """One applicant row per customer: look-back aggregates and a 0/1 label."""
    start = F.lit(min(MONTHS.values())).cast("timestamp_ntz")
    orders = table(spark, sf, "orders").filter(F.col("o_orderdate") >= start)
    # Summed per order first, so an order with very many lines is one row in the join.
    recent_lines = table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    lines = recent_lines.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"))
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")

    aggs = []
    for m, since in MONTHS.items():
        recent = F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz")
        urgent = F.col("o_orderpriority") == "1-URGENT"
        aggs += [
            F.count_if(recent).cast("double").alias(f"ORD_CNT_{m}M"),
            F.count_if(recent & urgent).cast("double").alias(f"ORD_URGENT_CNT_{m}M"),
            _whole_cents(recent).alias(f"ORD_AVG_{m}M"),
            F.sum(F.when(recent, F.col("qty"))).alias(f"LI_QTY_{m}M"),
        ]
    by_customer = joined.groupBy(F.col("o_custkey").alias("k")).agg(*aggs)
    by_user = table(spark, sf, "events").groupBy(F.col("user_id").alias("u")).agg(
        *[F.count_if(F.col("event_type") == t).cast("double").alias(f"EVT_CNT_{t}") for t in EVENT_TYPES]
    )
    customer = table(spark, sf, "customer")
    wide = customer.join(by_customer, customer.c_custkey == by_customer.k, "left").join(
        by_user, customer.c_custkey == by_user.u, "left"
    )
    zero = set(CNT_COLS + URGENT_COLS + QTY_COLS)
    return wide.select(
        F.col("c_custkey").alias("customer_id"),
        *[(F.coalesce(c, F.lit(0.0)).alias(c) if c in zero else F.col(c)) for c in FEATURES],
        (F.col("c_acctbal") < 1000).cast("int").alias("label"),
    )


def _features_cte() -> str:
    aggs = []
    for m, since in MONTHS.items():
        recent = f"o_orderdate >= TIMESTAMP '{since}'"
        aggs += [
            f"count(*) FILTER (WHERE {recent})::DOUBLE AS ORD_CNT_{m}M",
            f"count(*) FILTER (WHERE {recent} AND o_orderpriority = '1-URGENT')::DOUBLE AS ORD_URGENT_CNT_{m}M",
            f"(sum(round(o_totalprice * 100)::BIGINT) FILTER (WHERE {recent})"
            f" // nullif(count(*) FILTER (WHERE {recent}), 0))::DOUBLE / 100.0 AS ORD_AVG_{m}M",
            f"sum(qty) FILTER (WHERE {recent}) AS LI_QTY_{m}M",
        ]
    zero = set(CNT_COLS + URGENT_COLS + QTY_COLS)
    cols = ", ".join(f"coalesce({c}, 0.0) AS {c}" if c in zero else c for c in FEATURES)
    evts = ", ".join(
        f"count(*) FILTER (WHERE event_type = '{t}')::DOUBLE AS EVT_CNT_{t}" for t in EVENT_TYPES
    )
    return f"""lines AS (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1),
by_customer AS (SELECT o_custkey AS k, {', '.join(aggs)}
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey
  WHERE o_orderdate >= TIMESTAMP '{min(MONTHS.values())}' GROUP BY 1),
by_user AS (SELECT user_id AS u, {evts} FROM events GROUP BY 1),
features AS (SELECT c_custkey AS customer_id, {cols}, (c_acctbal < 1000)::INTEGER AS label
  FROM customer LEFT JOIN by_customer ON c_custkey = k LEFT JOIN by_user ON c_custkey = u)"""


FEATURES_CTE = _features_cte()


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """A labelled prediction per event, with its features as JSON."""
    e = table(spark, sf, "events")
    e = e.withColumn("p", F.col("value") / (F.col("value") + 50.0))
    k = F.from_json("props", "k int").getField("k")
    return e.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        "p",
        ((F.col("event_id") * 7919) % 1000 / 1000.0 < F.col("p")).cast("int").alias("y"),
        k.cast("double").alias("k"),
        "props",
    )


SCORED_CTE = """scored AS (SELECT event_id, ts, user_id, event_type, value, p,
  (((event_id * 7919) % 1000) / 1000.0::DOUBLE < p)::INTEGER AS y,
  (props->>'k')::DOUBLE AS k, props
  FROM (SELECT *, value / (value + 50.0) AS p FROM events))"""


def reference_and_production(df: DataFrame, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    cut = F.lit(SPLIT_DATE).cast("timestamp_ntz")
    return df.filter(F.col(ts) < cut), df.filter(F.col(ts) >= cut)


PERIODS_CTE = f"""reference AS (SELECT * FROM scored WHERE ts < TIMESTAMP '{SPLIT_DATE}'),
production AS (SELECT * FROM scored WHERE ts >= TIMESTAMP '{SPLIT_DATE}')"""


def deployments(spark: SparkSession, sf: str) -> DataFrame:
    """Deployment log: promote and rollback events per alias."""
    kind = F.when(F.col("o_orderstatus") == "F", "promote").when(F.col("o_orderstatus") == "O", "rollback")
    return table(spark, sf, "orders").filter(F.col("o_orderstatus").isin("F", "O")).select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("ts"),
        kind.alias("event_type"),
        F.col("o_orderpriority").alias("alias"),
        F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey").cast("string")).alias("from_version"),
        F.col("o_orderkey").cast("string").alias("to_version"),
    )


DEPLOYMENTS_CTE = """deployments AS (SELECT o_orderkey AS id, o_orderdate AS ts,
  CASE o_orderstatus WHEN 'F' THEN 'promote' ELSE 'rollback' END AS event_type,
  o_orderpriority AS alias,
  CASE WHEN o_custkey % 10 <> 0 THEN o_custkey::VARCHAR END AS from_version,
  o_orderkey::VARCHAR AS to_version
  FROM orders WHERE o_orderstatus IN ('F', 'O'))"""


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Request log: caller, status, latency in seconds, missing-feature rate and probability."""
    e = table(spark, sf, "events")
    return e.select(
        "event_id",
        "ts",
        F.col("user_id").alias("key"),
        F.col("event_type").alias("endpoint"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        (F.col("value") / 1000.0).alias("latency"),
        (F.col("event_id") % 11 / 10.0).alias("missing_rate"),
        (F.col("value") / (F.col("value") + 50.0)).alias("p"),
    )


REQUESTS_CTE = """requests AS (SELECT event_id, ts, user_id AS key, event_type AS endpoint,
  CASE event_type WHEN 'error' THEN 500 ELSE 200 END AS status,
  value / 1000.0 AS latency, (event_id % 11) / 10.0::DOUBLE AS missing_rate,
  value / (value + 50.0) AS p FROM events)"""
