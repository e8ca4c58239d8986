"""Supervised binning: interval edges, weight of evidence, information value."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from scorelake.functions.scalars import bin_index, bin_label, log_ratio, step
from scorelake.operators.prefix import ROWS_PER_BUCKET, running_totals
from scorelake.operators.quantiles import quantiles
from scorelake.session import stage

MIN_OBS = 80
MIN_IV = 0.02
VALUE_GAP = 1e-7

# Information value floors and what they are called.
STRENGTH = [(1.0, "suspicious"), (0.3, "strong"), (0.1, "medium"), (0.02, "weak")]

Edges = dict[str, list[float]]


def _left_closed(col: Column, edges: Sequence[float]) -> Column:
    """Interval number with edges[i-1] <= col < edges[i]."""
    below = F.lit(0)
    for e in edges:
        below = below + (col >= F.lit(e)).cast("int")
    return F.when(col.isNotNull(), below)


def _long(df: DataFrame, parts: Mapping[str, Sequence[tuple[str, Column]]], *carry: Column) -> DataFrame:
    """One row per input row and feature: (feature, named parts, carried columns)."""
    rows = [
        F.struct(F.lit(c).alias("feature"), *[e.alias(n) for n, e in items], *carry) for c, items in parts.items()
    ]
    return df.select(F.inline(F.array(*rows)))


def equal_frequency_edges(
    df: DataFrame, bins: Mapping[str, int], min_obs: int = MIN_OBS, digits: int | None = None
) -> Edges:
    """Inner edges at the q-tiles, duplicates dropped, sparse bins joined to their right neighbour.

    Bin sizes for the sparse check are counted left-closed; a sparse last bin stays.
    """
    cols = list(bins)
    probs = sorted({i / q for q in bins.values() for i in range(q + 1)})
    found = quantiles(df, cols, probs)
    edges: Edges = {}
    for c in cols:
        at = dict(zip(probs, found[c]))
        cuts = [at[i / bins[c]] for i in range(bins[c] + 1)]
        cuts = [] if cuts[0] is None else sorted({v if digits is None else round(v, digits) for v in cuts})
        edges[c] = cuts[1:-1]
    long = _long(df, {c: [("bin", _left_closed(F.col(c), edges[c]))] for c in cols})
    counts = {
        (r.feature, r.bin): r["count"] for r in long.filter("bin is not null").groupBy("feature", "bin").count().collect()
    }
    for c in cols:
        ends = [*edges[c], math.inf]
        kept = [hi for i, hi in enumerate(ends) if counts.get((c, i), 0) >= min_obs]
        edges[c] = [e for e in kept if e != math.inf]
    return edges


def _entropy(n: Column, bad: Column) -> Column:
    """n times the binary entropy in bits."""

    def part(x: Column) -> Column:
        return F.when(x > 0, -x * F.log2(x / n)).otherwise(F.lit(0.0))

    return part(bad) + part(n - bad)


def entropy_edges(
    df: DataFrame,
    bins: Mapping[str, int],
    label: str = "label",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> Edges:
    """Inner edges of a one-column entropy tree, grown best-first to at most ``max(2, n)`` leaves.

    All features grow together: each round ranks, in one job, every split of every leaf that
    is new, then splits the best leaf of each feature. Values are taken in single precision.
    """
    cols = list(bins)
    value = {c: [("value", F.col(c).cast("float").cast("double"))] for c in cols}
    hist = _long(df, value, F.col(label).cast("double").alias("y")).filter("value is not null")
    hist = stage(hist.groupBy("feature", "value").agg(
        F.count("*").cast("double").alias("n"), F.sum("y").alias("bad")
    ), "tree")
    limit = {c: max(2, bins[c]) for c in cols}
    edges: Edges = {c: [] for c in cols}
    best: dict[tuple[str, float], tuple[float, float] | None] = {}

    while True:
        # A leaf is known by its feature and lower bound; only leaves without a score are ranked.
        leaf = F.lit(None).cast("double")
        for c in cols:
            lows = [-math.inf, *edges[c]]
            named = [F.lit(lo if (c, lo) not in best else None).cast("double") for lo in lows]
            leaf = F.when(F.col("feature") == c, step(F.col("value"), edges[c], named)).otherwise(leaf)
        fresh = [(c, lo) for c in cols for lo in [-math.inf, *edges[c]] if (c, lo) not in best]
        if not fresh:
            break
        part = hist.withColumn("leaf", leaf).filter("leaf is not null")
        cum = running_totals(
            part, "value", ["n", "bad"], by=["feature", "leaf"], rows_per_bucket=rows_per_bucket, with_next=True
        )
        cut = F.col("value") / 2 + F.col("next_value") / 2
        gain = (
            _entropy(F.col("tot_n"), F.col("tot_bad"))
            - _entropy(F.col("cum_n"), F.col("cum_bad"))
            - _entropy(F.col("tot_n") - F.col("cum_n"), F.col("tot_bad") - F.col("cum_bad"))
        )
        top = (
            cum.filter(F.col("next_value") > F.col("value") + VALUE_GAP)
            .select("feature", "leaf", cut.alias("cut"), gain.alias("gain"))
            .groupBy("feature", "leaf")
            .agg(F.max_by(F.struct("cut", "gain"), F.struct(F.col("gain"), -F.col("cut"))).alias("s"))
        )
        best.update({key: None for key in fresh})
        for row in top.collect():
            best[(row.feature, row.leaf)] = (row.s.gain, row.s.cut)
        grew = False
        for c in cols:
            if len(edges[c]) + 1 >= limit[c]:
                continue
            options = [(best[(c, lo)], lo) for lo in [-math.inf, *edges[c]] if best.get((c, lo))]
            options = [(g, -cut, lo) for (g, cut), lo in options if g > 1e-9]
            if not options:
                continue
            _, minus_cut, lo = max(options)
            # The left child keeps the lower bound of its parent, so it must be ranked anew.
            best.pop((c, lo))
            edges[c] = sorted([*edges[c], -minus_cut])
            grew = True
        if not grew:
            break
        for c in cols:
            if len(edges[c]) + 1 >= limit[c]:
                best.update({(c, lo): None for lo in [-math.inf, *edges[c]]})
    return edges


def bin_counts(df: DataFrame, edges: Mapping[str, Sequence[float]], label: str = "label") -> DataFrame:
    """Rows, bads and goods per (feature, bin) in one job; bins are right-closed, nulls left out."""
    parts = {c: [("bin", bin_index(F.col(c), list(e)))] for c, e in edges.items()}
    long = _long(df, parts, F.col(label).cast("bigint").alias("y")).filter("bin is not null")
    counts = long.groupBy("feature", "bin").agg(F.count("*").alias("n_obs"), F.sum("y").alias("n_bad"))
    return counts.withColumn("n_good", F.col("n_obs") - F.col("n_bad"))


def woe_table(counts: DataFrame) -> DataFrame:
    """Shares, weight of evidence and information value of each bin.

    A bin without bads counts one bad, also in the total; a bin without goods has evidence 0.
    """
    feature = Window.partitionBy("feature")  # a handful of bins per feature
    fixed = counts.withColumn("n_bad", F.when(F.col("n_bad") == 0, F.lit(1)).otherwise(F.col("n_bad")))
    shares = fixed.select(
        "*",
        (F.col("n_good") / F.greatest(F.sum("n_good").over(feature), F.lit(1))).alias("pct_good"),
        (F.col("n_bad") / F.greatest(F.sum("n_bad").over(feature), F.lit(1))).alias("pct_bad"),
    )
    return shares.withColumn("woe", log_ratio(F.col("pct_good"), F.col("pct_bad"))).withColumn(
        "iv", (F.col("pct_good") - F.col("pct_bad")) * F.col("woe")
    )


def iv_table(table: DataFrame) -> DataFrame:
    """Information value per feature, highest first."""
    return table.groupBy("feature").agg(F.sum("iv").alias("iv")).orderBy(F.col("iv").desc(), "feature")


def iv_strength(iv: Column) -> Column:
    name = F.when(iv > STRENGTH[0][0], STRENGTH[0][1])
    for floor, word in STRENGTH[1:-1]:
        name = name.when(iv > floor, word)
    return name.when(iv >= STRENGTH[-1][0], STRENGTH[-1][1]).otherwise("useless")


@dataclass
class Binning:
    """Fitted bins: inner edges and evidence per bin, information value per feature."""

    edges: Edges
    woe: dict[str, list[float]]
    iv: dict[str, float]
    table: list[dict] = field(default_factory=list)

    def labels(self, feature: str) -> list[str]:
        ends = [-math.inf, *self.edges[feature], math.inf]
        return [bin_label(lo, hi) for lo, hi in zip(ends, ends[1:])]

    def woe_of(self, feature: str) -> Column:
        """Evidence of a value; 0 for null."""
        values = [F.lit(float(w)) for w in self.woe[feature]]
        return F.coalesce(step(F.col(feature), self.edges[feature], values), F.lit(0.0))

    def label_of(self, feature: str) -> Column:
        values = [F.lit(s) for s in self.labels(feature)]
        return F.coalesce(step(F.col(feature), self.edges[feature], values), F.lit("unknown"))

    def active(self, min_iv: float = MIN_IV) -> list[str]:
        """Features worth keeping, highest information value first."""
        return sorted((f for f, v in self.iv.items() if v >= min_iv), key=lambda f: -self.iv[f])

    def to_json(self) -> str:
        return json.dumps({"edges": self.edges, "woe": self.woe, "iv": self.iv, "table": self.table})

    @staticmethod
    def from_json(text: str) -> "Binning":
        return Binning(**json.loads(text))


def fit_edges(
    df: DataFrame,
    bins: Mapping[str, int],
    equal_frequency: Sequence[str],
    label: str = "label",
    min_obs: int = MIN_OBS,
    digits: int | None = None,
) -> Edges:
    """Equal-frequency edges for the named features, entropy edges for the others."""
    by_rank = {c: n for c, n in bins.items() if c in set(equal_frequency)}
    by_tree = {c: n for c, n in bins.items() if c not in by_rank}
    found = equal_frequency_edges(df, by_rank, min_obs, digits) if by_rank else {}
    if by_tree:
        found |= entropy_edges(df, by_tree, label)
    return {c: found[c] for c in bins}


def fit_binning(df: DataFrame, edges: Edges, label: str = "label") -> Binning:
    """Evidence per bin for given edges. The table has one row per bin, so it fits the driver."""
    table = [r.asDict() for r in woe_table(bin_counts(df, edges, label)).collect()]
    woe = {c: [0.0] * (len(e) + 1) for c, e in edges.items()}
    iv = {c: 0.0 for c in edges}
    for r in table:
        woe[r["feature"]][r["bin"]] = r["woe"]
        iv[r["feature"]] += r["iv"]
    return Binning(edges, woe, iv, sorted(table, key=lambda r: (r["feature"], r["bin"])))


def encode(df: DataFrame, binning: Binning, features: Sequence[str], suffix: str = "_WOE") -> DataFrame:
    """Add one evidence column per feature: literal decision trees in one projection, no join."""
    return df.select("*", *[binning.woe_of(c).alias(c + suffix) for c in features])
