"""Running totals, ranks, quantiles, chunks and splits against numpy, with hot values and small buckets."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorelake.operators import chunks, split
from scorelake.operators.prefix import running_totals
from scorelake.operators.quantiles import quantiles
from scorelake.operators.ranks import nth_in_group, rows_at_ranks


@pytest.fixture(scope="module")
def skewed(spark):
    """One value holds a third of all rows, another group is tiny."""
    rng = np.random.default_rng(1)
    n = 6000
    v = np.where(rng.random(n) < 0.34, 7, rng.integers(0, 900, n)).astype(float)
    pdf = pd.DataFrame({"id": np.arange(n), "g": np.where(rng.random(n) < 0.95, 0, 1), "v": v})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("rows_per_bucket", [10_000, 50])
def test_running_totals(skewed, rows_per_bucket):
    pdf, df = skewed
    hist = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    got = running_totals(hist, "v", ["n"], by=["g"], rows_per_bucket=rows_per_bucket, with_next=True).toPandas()
    want = pdf.groupby(["g", "v"]).size().rename("n").reset_index()
    want["cum_n"] = want.groupby("g")["n"].cumsum()
    want["tot_n"] = want.groupby("g")["n"].transform("sum")
    want["next_v"] = want.groupby("g")["v"].shift(-1)
    pd.testing.assert_frame_equal(
        got[want.columns].sort_values(["g", "v"]).reset_index(drop=True), want, check_dtype=False
    )


@pytest.mark.parametrize("rows_per_bucket, small_rows, slack", [(10_000, 10**9, 1e-3), (50, 10**9, 1e-3), (50, 0, 1e-3), (50, 0, -1e-3)])
def test_rows_at_ranks(skewed, monkeypatch, rows_per_bucket, small_rows, slack):
    """With a negative slack the brackets miss, so the search in full is exercised too."""
    monkeypatch.setattr("scorelake.operators.ranks.SKETCH_SLACK", slack)
    pdf, df = skewed
    ranks = [1, 2, 100, 1500, 2500, len(pdf)]
    ordered = pdf.sort_values(["v", "id"]).reset_index(drop=True)
    got = rows_at_ranks(df, "v", "id", {None: ranks}, rows_per_bucket=rows_per_bucket, small_rows=small_rows)
    assert got == {(None, r): (ordered.v[r - 1], ordered.id[r - 1]) for r in ranks}
    by_group = rows_at_ranks(df, "v", "id", {0: [3, 2000], 1: [5]}, by="g", rows_per_bucket=rows_per_bucket, small_rows=small_rows)
    for (g, r), found in by_group.items():
        mine = pdf[pdf.g == g].sort_values(["v", "id"]).reset_index(drop=True)
        assert found == (mine.v[r - 1], mine.id[r - 1])
    assert len(by_group) == 3


def test_nth_in_group(skewed):
    pdf, df = skewed
    want = pdf[pdf.g == 1].sort_values("id").iloc[4]
    assert nth_in_group(df, "g", 1, "id", 4).first().id == want.id
    assert nth_in_group(df, "g", 1, "id", 10**6).count() == 0


@pytest.mark.parametrize("small_cells, rows_per_bucket", [(10**9, 10**6), (0, 10**6), (0, 40)])
def test_quantiles_are_exact(spark, small_cells, rows_per_bucket):
    rng = np.random.default_rng(2)
    n = 5000
    pdf = pd.DataFrame({
        "a": rng.normal(size=n), "b": np.where(rng.random(n) < 0.4, 3.0, rng.integers(0, 9, n)).astype(float),
        "c": np.where(rng.random(n) < 0.7, np.nan, rng.random(n)), "d": np.nan,
    })
    df = spark.createDataFrame(pdf).select(*[F.nanvl(c, F.lit(None)).alias(c) for c in pdf.columns])
    probs = [0.0, 0.05, 0.5, 0.951, 1.0]
    got = quantiles(df, list("abcd"), probs, small_cells=small_cells, rows_per_bucket=rows_per_bucket)
    for c in "abc":
        np.testing.assert_allclose(got[c], pdf[c].quantile(probs).to_numpy(), rtol=0, atol=1e-12)
    assert got["d"] == [None] * 5


def test_quantiles_sketch(skewed):
    _, df = skewed
    assert quantiles(df, ["v"], [0.5], accuracy=1000)["v"][0] is not None


@pytest.mark.parametrize("rows_per_bucket", [10_000, 300])
def test_row_index_with_a_hot_key(skewed, rows_per_bucket):
    pdf, df = skewed
    keyed = df.withColumn("k", F.col("v").cast("bigint"))
    got = chunks.row_index(keyed, "k", "id", rows_per_bucket=rows_per_bucket).toPandas().sort_values("_idx")
    want = pdf.sort_values(["v", "id"])
    assert (got["id"].to_numpy() == want["id"].to_numpy()).all()
    assert (got["_idx"].to_numpy() == np.arange(len(pdf))).all()


@pytest.mark.parametrize("incomplete, sizes", [("append", [63] * 6 + [64]), ("keep", [63] * 7 + [1])])
def test_chunk_of_442_rows(spark, incomplete, sizes):
    df = spark.range(442).withColumn("ts", F.timestamp_seconds(1_700_000_000 + F.col("id") % 5))
    assert chunks.default_chunk_size(442) == 63
    got = chunks.assign_chunks(df, "ts", "id", 63, incomplete)
    counts = [r["count"] for r in got.groupBy("chunk_id").count().orderBy("chunk_id").collect()]
    assert counts == sizes


def test_split_sizes_and_repeatability(skewed):
    pdf, df = skewed
    a = split.stratified_split(df, "id", "g")
    n = {(r.g, r.split): r["count"] for r in a.groupBy("g", "split").count().collect()}
    wanted = split.test_counts(pdf.g.value_counts().to_dict(), 0.2)
    assert {g: n[(g, "test")] for g in (0, 1)} == wanted
    assert sum(wanted.values()) == 1200
    again = split.stratified_split(df.repartition(3), "id", "g")
    assert a.select("id", "split").exceptAll(again.select("id", "split")).count() == 0
    folds = split.stratified_folds(df, "id", "g").groupBy("g", "fold").count().toPandas()
    assert folds.groupby("g")["count"].agg(lambda s: s.max() - s.min()).max() <= 1


@pytest.mark.parametrize("size, per_bucket", [(100, 10**6), (3, 10**6), (3, 40)])
def test_rows_without_time_come_first(spark, monkeypatch, size, per_bucket):
    """Cut at boundary rows, by position, and by position in many buckets."""
    monkeypatch.setattr(chunks.row_index, "__defaults__", (per_bucket,))
    rows = [(i, None if i % 40 == 7 else (i * 7919) % 400) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.id: r.chunk_id for r in chunks.assign_chunks(df, "ts", "id", size).collect()}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    last = 400 // size - 1
    assert got == {i: min(k // size, last) for k, (i, _) in enumerate(order)}
