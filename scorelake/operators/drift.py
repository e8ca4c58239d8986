"""Distribution drift of production against a reference, per feature and per chunk."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T

from scorelake.functions.scalars import bin_index
from scorelake.operators.prefix import ROWS_PER_BUCKET, running_totals
from scorelake.session import ship_by_value, stage

ship_by_value(__name__)

JS_THRESHOLD = 0.1
P_VALUE = 0.05
DISTANCE = 0.1
DISCRETE_VALUES = 5
VARIANCE_KEPT = 0.65


# ---- binned distributions and Jensen-Shannon -------------------------------------------------


def equal_width_edges(ref: DataFrame, cols: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Inner edges of equal-width bins over the reference range; the end bins are open."""
    row = ref.agg(*[F.min(c).alias(f"a_{c}") for c in cols], *[F.max(c).alias(f"b_{c}") for c in cols]).first()
    edges = {}
    for c in cols:
        lo, hi = row[f"a_{c}"], row[f"b_{c}"]
        width = None if lo is None else (hi - lo) / bins
        edges[c] = [lo + width * i for i in range(1, bins)] if width else ([lo] if lo is not None else [])
    return edges


def bin_counts(df: DataFrame, edges: Mapping[str, Sequence[float]], by: Sequence[str] = ()) -> DataFrame:
    """Rows per (by, feature, bin), nulls left out, all features in one job."""
    parts = F.array(
        *[F.struct(F.lit(c).alias("feature"), bin_index(F.col(c), list(e)).alias("bin")) for c, e in edges.items()]
    )
    long = df.select(*by, F.inline(parts)).filter("bin is not null")
    return long.groupBy(*by, "feature", "bin").agg(F.count("*").alias("n"))


def compare_bins(ref_counts: DataFrame, prod_counts: DataFrame) -> DataFrame:
    """Both counts of each (feature, bin); a bin one side lacks counts 0."""
    keys = ["feature", "bin"]
    a, b = ref_counts.withColumnRenamed("n", "n_ref"), prod_counts.withColumnRenamed("n", "n_prod")
    zero = F.lit(0).cast("bigint")
    return a.join(b, keys, "full_outer").select(
        *keys, F.coalesce("n_ref", zero).alias("n_ref"), F.coalesce("n_prod", zero).alias("n_prod")
    )


def _shares(counts: DataFrame, bins: int, by: Sequence[str], name: str) -> DataFrame:
    """One row per (by, feature) with its bin shares as an array of fixed length."""
    total = F.sum("n").cast("double")
    parts = [F.sum(F.when(F.col("bin") == i, F.col("n")).otherwise(0)) / total for i in range(bins)]
    return counts.groupBy(*by, "feature").agg(F.array(*parts).alias(name))


def _half_kl(p: Column, q: Column) -> Column:
    return F.when(p > 0, 0.5 * p * F.log2(2.0 * p / (p + q))).otherwise(F.lit(0.0))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares."""
    terms = F.zip_with(p, q, lambda a, b: _half_kl(a, b) + _half_kl(b, a))
    total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def univariate_drift(
    ref: DataFrame,
    prod: DataFrame,
    cols: Sequence[str],
    chunk: str = "chunk_id",
    bins: int = 10,
    threshold: float = JS_THRESHOLD,
) -> DataFrame:
    """Jensen-Shannon distance to the reference per (chunk, feature), and whether it alerts.

    A feature without values on either side keeps its row, with a null value and no alert.
    """
    edges = equal_width_edges(ref, cols, bins)
    size = max(len(e) + 1 for e in edges.values())
    p = _shares(bin_counts(ref, edges), size, [], "p")
    q = _shares(bin_counts(prod, edges, [chunk]), size, [chunk], "q").withColumnRenamed(chunk, "_chunk").withColumnRenamed("feature", "_feature")
    every = prod.select(chunk).distinct().withColumn("feature", F.explode(F.array(*map(F.lit, cols))))
    found = every.join(q, F.col(chunk).eqNullSafe(F.col("_chunk")) & (F.col("feature") == F.col("_feature")), "left")
    return found.join(p, "feature", "left").select(
        chunk, "feature", F.when(F.col("p").isNotNull() & F.col("q").isNotNull(), js_distance(F.col("p"), F.col("q"))).alias("value")
    ).withColumn("alert", F.coalesce(F.col("value") > threshold, F.lit(False)))


# ---- tests on full distributions -------------------------------------------------------------


def two_sample(ref: DataFrame, prod: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per (feature, value) on each side."""

    def side(df: DataFrame, is_ref: int) -> DataFrame:
        parts = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
        return df.select(F.inline(parts)).filter("value is not null").groupBy("feature", "value").agg(
            F.count("*").alias("n")
        ).select(
            "feature", "value", (F.col("n") * is_ref).alias("n_ref"), (F.col("n") * (1 - is_ref)).alias("n_prod")
        )

    both = side(ref, 1).unionByName(side(prod, 0))
    return both.groupBy("feature", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_prod").alias("n_prod"))


def _cumulative(pairs: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    cum = running_totals(
        pairs, "value", ["n_ref", "n_prod"], by=["feature"], rows_per_bucket=rows_per_bucket, with_next=True
    )
    gap = F.abs(
        F.try_divide(F.col("cum_n_ref"), F.col("tot_n_ref")) - F.try_divide(F.col("cum_n_prod"), F.col("tot_n_prod"))
    )
    return cum.withColumn("gap", gap)


def ks_p_value(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value of the two-sample statistic."""
    lam = d * F.sqrt(n * m / (n + m))
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    series = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def ks_test(pairs: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Largest gap between the two distribution functions, and its p-value."""
    out = _cumulative(pairs, rows_per_bucket).groupBy("feature").agg(
        F.max("gap").alias("statistic"),
        F.max("tot_n_ref").cast("double").alias("_n"),
        F.max("tot_n_prod").cast("double").alias("_m"),
    )
    return out.select("feature", "statistic", ks_p_value(F.col("statistic"), F.col("_n"), F.col("_m")).alias("p_value"))


def wasserstein(pairs: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Area between the distribution functions over the reference standard deviation."""
    n, v = F.col("n_ref").cast("double"), F.col("value")
    area = F.coalesce(F.sum(F.col("gap") * (F.col("next_value") - v)), F.lit(0.0))
    # Two passes over one small histogram keep the variance free of cancellation.
    mean = pairs.groupBy("feature").agg(F.try_divide(F.sum(n * v), F.sum(n)).alias("_mean"))
    spread = pairs.join(mean, "feature").groupBy("feature").agg(
        F.sqrt(F.try_divide(F.sum(n * (v - F.col("_mean")) * (v - F.col("_mean"))), F.sum(n))).alias("_std")
    )
    areas = _cumulative(pairs, rows_per_bucket).groupBy("feature").agg(area.alias("_area"))
    return areas.join(spread, "feature").select(
        "feature", (F.col("_area") / F.greatest(F.col("_std"), F.lit(0.001))).alias("distance")
    )


def _gamma_q(a: float, x: float) -> float:
    """Upper regularised incomplete gamma function, by series or continued fraction."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * scale)
    b = x + 1 - a
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b if abs(an * d + b) > 1e-300 else 1e-300)
        c = b + an / c
        if abs(c) < 1e-300:
            c = 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h * scale


@F.pandas_udf(T.DoubleType())
def chi2_p_value(x: pd.Series, dof: pd.Series) -> pd.Series:
    """Tail probability; runs on one row per feature."""
    return pd.Series([1.0 if k < 1 else _gamma_q(k / 2.0, v / 2.0) for v, k in zip(x, dof)])


def chi2_test(pairs: DataFrame) -> DataFrame:
    """Homogeneity of the two samples over the values of a discrete feature."""
    sides = pairs.groupBy("feature").agg(
        F.sum("n_ref").cast("double").alias("_r"), F.sum("n_prod").cast("double").alias("_p")
    )
    both = F.col("n_ref") + F.col("n_prod")
    total = F.col("_r") + F.col("_p")

    def part(n: str, side: str) -> Column:
        expected = both * F.col(side) / total
        return F.coalesce(F.try_divide((F.col(n) - expected) * (F.col(n) - expected), expected), F.lit(0.0))

    out = pairs.join(sides, "feature").groupBy("feature").agg(
        F.sum(part("n_ref", "_r") + part("n_prod", "_p")).alias("statistic"),
        (F.count("*") - 1).cast("int").alias("dof"),
    )
    return out.withColumn("p_value", chi2_p_value("statistic", F.col("dof").cast("double")))


# ---- column report ---------------------------------------------------------------------------


def js_of_values(pairs: DataFrame) -> DataFrame:
    """Jensen-Shannon distance over the distinct values of each feature."""
    sides = pairs.groupBy("feature").agg(F.sum("n_ref").alias("_r"), F.sum("n_prod").alias("_p"))
    p, q = F.try_divide(F.col("n_ref"), F.col("_r")), F.try_divide(F.col("n_prod"), F.col("_p"))
    return pairs.join(sides, "feature").groupBy("feature").agg(
        F.sqrt(F.greatest(F.sum(_half_kl(p, q) + _half_kl(q, p)), F.lit(0.0))).alias("distance")
    )


#: Tests of a drift report: whether their score is a p-value, and their title.
TESTS = {
    "js": (False, "Jensen-Shannon distance"),
    "wasserstein": (False, "Wasserstein distance (normed)"),
    "chi2": (True, "chi-square p_value"),
    "ks": (True, "K-S p_value"),
}


def library_tests(kinds: DataFrame, large: int = 1000, discrete: int = DISCRETE_VALUES) -> dict[str, str]:
    """The choice that common reports make by size: distances above ``large`` reference rows, else p-values.

    It changes with the size of the reference, so a report uses it only where the caller asks for it.
    """
    names = {}
    for r in kinds.collect():
        by_value = r.n_values <= discrete
        names[r.feature] = ("js" if by_value else "wasserstein") if r.n > large else ("chi2" if by_value else "ks")
    return names


def drift_report(
    ref: DataFrame,
    prod: DataFrame,
    cols: Sequence[str],
    tests: Mapping[str, str] | str | None = None,
    large: int | None = None,
    discrete: int = DISCRETE_VALUES,
) -> DataFrame:
    """One row per column: its test, its score, and the verdict.

    ``tests`` names a test for all columns or for each. By default columns with at most ``discrete`` distinct reference
    values compare value counts (``js``), others the ordered distributions (``wasserstein``), at any size. ``large``
    asks for the choice of ``library_tests`` instead. Distances drift from 0.1 up, p-values below 0.05. A column without
    values on either side has its row, with a null score and no verdict.
    """
    pairs = stage(two_sample(ref, prod, cols), "pairs")
    kinds = pairs.groupBy("feature").agg(
        F.count_if(F.col("n_ref") > 0).alias("n_values"), F.sum("n_ref").alias("n"), F.sum("n_prod").alias("m")
    ).filter("n > 0")
    if large is not None:
        names = library_tests(kinds, large, discrete)
    else:
        names = {r.feature: "js" if r.n_values <= discrete else "wasserstein" for r in kinds.collect()}
    if tests is not None:
        names |= {c: tests if isinstance(tests, str) else tests.get(c, names.get(c)) for c in cols}
    filled = {r.feature for r in kinds.filter("m > 0").select("feature").collect()}
    runs = {"js": js_of_values, "wasserstein": wasserstein, "chi2": chi2_test, "ks": ks_test}
    titles = {c: TESTS[names.get(c, "wasserstein")][1] for c in cols}
    out = ref.sparkSession.createDataFrame(
        [(c, None, None, titles[c]) for c in cols if c not in filled],
        "feature string, drift_detected boolean, drift_score double, stattest string",
    )
    for name in sorted({names[c] for c in cols if c in filled}):
        p_value, title = TESTS[name]
        own = [c for c in cols if c in filled and names[c] == name]
        scored = runs[name](pairs.filter(F.col("feature").isin(own))).withColumnRenamed("p_value" if p_value else "distance", "s")
        drifted = F.col("s") < P_VALUE if p_value else F.col("s") >= DISTANCE
        out = out.unionByName(scored.select(
            "feature", drifted.alias("drift_detected"), F.round("s", 4).alias("drift_score"), F.lit(title).alias("stattest")
        ))
    return out


def drift_summary(report: DataFrame) -> DataFrame:
    """One row: drifted and checked columns, and the verdict of each column as a map."""
    entry = F.struct("feature", F.struct("drift_detected", "drift_score", "stattest"))
    return report.agg(
        F.count_if("drift_detected").alias("n_drifted"),
        F.count("*").alias("n_checked"),
        F.map_from_entries(F.collect_list(entry)).alias("features"),
    )


# ---- multivariate ----------------------------------------------------------------------------


@dataclass
class Reconstruction:
    """Mean fill, scaling and components of the reference; error is the distance left over."""

    cols: list[str]
    means: dict[str, float]
    components: int
    stages: PipelineModel

    def error(self, df: DataFrame, out: str = "error") -> DataFrame:
        filled = df.select(
            *[c for c in df.columns if c not in self.cols],
            *[F.coalesce(F.col(c).cast("double"), F.lit(self.means[c])).alias(c) for c in self.cols],
        )
        z, proj = vector_to_array("_z"), vector_to_array("_pc")

        def squares(values: Column) -> Column:
            return F.aggregate(values, F.lit(0.0), lambda s, x: s + x * x)

        # Components are orthonormal, so the residual is the norm minus the projected part.
        left = squares(z) - squares(F.slice(proj, 1, self.components))
        return self.stages.transform(filled).withColumn(out, F.sqrt(F.greatest(left, F.lit(0.0)))).drop(
            "_raw", "_z", "_pc"
        )


def fit_reconstruction(ref: DataFrame, cols: Sequence[str], variance: float = VARIANCE_KEPT) -> Reconstruction:
    """Components explaining at least ``variance`` of the scaled reference."""
    cols = list(cols)
    means = ref.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first().asDict()
    means = {c: m or 0.0 for c, m in means.items()}
    filled = ref.select(*[F.coalesce(F.col(c).cast("double"), F.lit(means[c])).alias(c) for c in cols])
    assemble = VectorAssembler(inputCols=cols, outputCol="_raw")
    scale = StandardScaler(inputCol="_raw", outputCol="_z", withMean=True, withStd=True).fit(assemble.transform(filled))
    pca = PCA(k=len(cols), inputCol="_z", outputCol="_pc").fit(scale.transform(assemble.transform(filled)))
    total, k = 0.0, 0
    for share in pca.explainedVariance:
        k += 1
        total += share
        if total >= variance:
            break
    return Reconstruction(cols, means, k, PipelineModel([assemble, scale, pca]))


def multivariate_drift(
    ref: DataFrame, prod: DataFrame, cols: Sequence[str], chunk: str = "chunk_id", variance: float = VARIANCE_KEPT
) -> DataFrame:
    """Mean reconstruction error per production chunk."""
    fitted = fit_reconstruction(ref, cols, variance)
    return fitted.error(prod.select(chunk, *cols)).groupBy(chunk).agg(F.avg("error").alias("value"))


# ---- reading chunk results -------------------------------------------------------------------


def latest_value(chunks: DataFrame, chunk: str = "chunk_id", by: Sequence[str] = ()) -> DataFrame:
    """Value of the last chunk that has one."""
    return chunks.filter("value is not null").groupBy(*by).agg(F.max_by("value", chunk).alias("value"))


def count_alerts(chunks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Chunks that alert, and whether any does."""
    return chunks.groupBy(*by).agg(
        F.count_if("alert").alias("n_alerts"), F.coalesce(F.bool_or("alert"), F.lit(False)).alias("any_alert")
    )


def drifted_features(chunks: DataFrame) -> DataFrame:
    """Sorted names of the features that alert in any chunk, as one row."""
    return chunks.filter("alert").agg(F.sort_array(F.collect_set("feature")).alias("drifted_features"))
