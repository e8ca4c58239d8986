"""One query for each operator over its whole table, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.llm import bagsearch, crossentropy, decontaminate, langid, lines, mix, neardup, neighbours, pii, planes, simhash, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


OP1_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws(':', doc_id::VARCHAR, text)) AS tie FROM documents),
quality AS (SELECT doc_id AS label_id, 0.5 + 0.5 * least(max(quality), 1) AS q FROM labels WHERE quality IS NOT NULL GROUP BY 1),
keyed AS (
  SELECT doc_id, source, size, tie,
         -ln((('0x' || substr(tie, 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0) / coalesce(q, 1)::DOUBLE AS k
  FROM sized LEFT JOIN quality ON doc_id = label_id),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([5.0, 2.0, 1.0])[1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INTEGER]::DOUBLE AS w
  FROM keyed GROUP BY source),
step AS (
  SELECT 0 AS n, source, source_size, w, false AS capped FROM src
  UNION ALL
  SELECT n + 1, source, source_size, w, capped OR level * w > 3 * source_size FROM (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) FILTER (capped) OVER (), 0))
              / (sum(w) FILTER (NOT capped) OVER ()) AS level FROM step) WHERE n < 60),
targets AS (
  SELECT source, source_size, CASE WHEN capped OR level IS NULL THEN 3.0 * source_size ELSE level * w END::DOUBLE AS target FROM (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) FILTER (capped) OVER (), 0))
              / (sum(w) FILTER (NOT capped) OVER ()) AS level FROM step WHERE n = 60)),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM targets),
drawn AS (
  SELECT doc_id, k.source, size, source_size, target, epochs,
         sum(size) OVER (PARTITION BY k.source ORDER BY k, doc_id NULLS FIRST, tie ROWS UNBOUNDED PRECEDING) - size / 2
         <= target - epochs * source_size AS more
  FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, source, size, source_size, target, epochs + more::BIGINT AS copies, (epochs + more::BIGINT) * size AS taken FROM drawn
"""


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_rows(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_rows(documents(spark, sf_dir))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_rows(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_rows(documents(spark, sf_dir), long_copies=True)


TERMS = "|".join(urls.BLOCKED_TERMS)
SITES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urls.SITE_RULES)
OP8_SQL = rf"""
WITH places AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{urls.UPPER}', '{urls.LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(h, p, v) AS (VALUES {SITES})
SELECT page_id, host, path, rule,
       coalesce(v, CASE WHEN regexp_matches(host || ' ' || path, '(?i)(^|[^a-z0-9])({TERMS})([^a-z0-9]|$)')
                        THEN 'block' ELSE '{urls.DEFAULT_VERDICT}' END) AS verdict
FROM places LEFT JOIN LATERAL (
  SELECT h || p AS rule, v FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  ORDER BY length(h || p) DESC, h || p DESC LIMIT 1) ON true
"""


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), urls.rule_table(spark))


def op9_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is what is labelled as good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return crossentropy.cross_entropy_rows(documents(spark, sf_dir), labels.where(F.col("quality") == 1))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_rows(documents(spark, sf_dir))


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planes.cluster_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def clusters_sql(k: int, rounds: int) -> str:
    """One assignment and one step of the centroids for each round."""
    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda z: floor(256 * z::DOUBLE)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda z: z IS NOT NULL AND isfinite(z))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{planes.SEED}:' || vec_id) NULLS LAST, x) - 1 AS c, x FROM v QUALIFY c < {k})"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(v.x) AS x,
         min([(list_dot_product(v.x, v.x) + list_dot_product(q.x, q.x) - 2 * list_dot_product(v.x, q.x))::BIGINT, q.c]) AS near
  FROM v, c{i} q GROUP BY rid)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT q.c, coalesce(n.x, q.x) AS x FROM c{i} q LEFT JOIN (
    SELECT c, list(floor(s / n) ORDER BY p) AS x FROM (
      SELECT near[2] AS c, p, sum(x[p]) AS s, count(*) AS n FROM a{i}, range(1, 65) t(p) GROUP BY ALL) GROUP BY c) n ON n.c = q.c)""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, near[2]::INTEGER AS cluster, near[1] AS distance, sum(near[1]) OVER (PARTITION BY near[2])::BIGINT AS cluster_inertia,
       sum(near[1]) OVER ()::BIGINT AS inertia, sha256(array_to_string(list_transform(q.x, lambda z: z::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} q ON q.c = near[2]"""


OP12_SQL = rf"""
WITH said AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(text, '{urls.UPPER}', '{urls.LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
sizes AS (SELECT rid, doc_id, len(terms) AS n FROM said WHERE len(terms) > 0),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM sizes),
tf AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(terms) AS t FROM said) GROUP BY ALL),
asked AS (SELECT row_number() OVER () AS iid, item_id, translate(text, '{urls.UPPER}', '{urls.LOWER}') AS text FROM benchmark),
want AS (
  SELECT iid, item_id, t, count(*) AS often FROM (
    SELECT iid, item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM asked) GROUP BY ALL),
weight AS (SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY t, docs),
scored AS (
  SELECT iid, item_id, s.rid, doc_id,
         sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // length))))::BIGINT AS score
  FROM want JOIN weight USING (t) JOIN tf USING (t) JOIN sizes s USING (rid), whole GROUP BY iid, item_id, s.rid, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {bagsearch.TOP}
"""


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagsearch.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_rows(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "op1_mix": op1_mix, "op2_toxicity": op2_toxicity, "op3_nearest": op3_nearest, "op4_personal_data": op4_personal_data,
    "op5_near_duplicates": op5_near_duplicates, "op6_decontaminate": op6_decontaminate, "op7_line_dedup": op7_line_dedup,
    "op8_url_filter": op8_url_filter, "op9_cross_entropy": op9_cross_entropy, "op10_language": op10_language,
    "op11_clusters": op11_clusters, "op12_search": op12_search, "op13_simhash": op13_simhash,
}
SQL: dict[str, str] = {"op1_mix": OP1_SQL, "op8_url_filter": OP8_SQL, "op11_clusters": clusters_sql(planes.K, planes.ROUNDS), "op12_search": OP12_SQL}
