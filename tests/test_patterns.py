"""Nearest donors by pattern of gaps, against brute force."""

import numpy as np
import pandas as pd
import pytest

from scorelake.operators import knn, leaves, patterns
from test_prep import brute_impute, frame, matrix


def brute(q, d, donor, p, k, most):
    out = []
    for i, row in enumerate(q):
        d2 = leaves.apart(np.repeat(row[None], len(d), axis=0), d, p)
        near = np.lexsort((donor, d2))[:k]
        out += [(i, int(donor[j]), d2[j]) for j in near if d2[j] <= most[i]]
    return out


@pytest.mark.parametrize("holes", [0.0, 0.3])
def test_search_equals_brute_force(holes):
    """Ties, copies, far centres and donors that lack columns."""
    rng = np.random.default_rng(3)
    d = np.vstack([rng.integers(0, 5, (400, 4)), rng.normal(1e6, 1e3, (300, 4)), np.tile([2.0, 2.0, 2.0, 2.0], (90, 1))]).astype(float)
    q = np.vstack([d[rng.choice(len(d), 150)], rng.normal(1e6, 1e3, (60, 4)), rng.uniform(-3, 9, (60, 4))])
    d[rng.random(d.shape) < holes] = np.nan
    d = d[~np.isnan(d).all(axis=1)]
    donor = rng.permutation(len(d)) * 3
    most = np.where(rng.random(len(q)) < 0.2, 4.0, np.inf)
    row, at, d2 = leaves.search(q, d, donor, 7, 6, most)
    assert list(zip(row.tolist(), donor[at].tolist(), d2.tolist(), strict=True)) == brute(q, d, donor, 7, 6, most)


def test_few_pairs_are_compared():
    """A row that asks meets the donors near it, not all donors of a cell."""
    rng = np.random.default_rng(4)
    d = rng.uniform(0, 1000, (20_000, 3))
    q = rng.uniform(0, 1000, (2_000, 3))
    pairs = sum(len(row) for row, _ in leaves._looks(q, d, 3, 10, np.full(len(q), np.inf)))
    assert pairs < 60 * len(q)


@pytest.fixture(scope="module")
def grouped():
    """Columns 2 and 3 are missing together, column 1 apart from them; a quarter of the rows are alike."""
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.normal(0, 100, 600), rng.normal(0, 90, 600), rng.integers(0, 9, 600), rng.normal(0, 5, 600)])
    x[:150, :2] = [3.0, 4.0]
    x[rng.random(600) < 0.6, 2:] = np.nan
    x[rng.random(600) < 0.3, 1] = np.nan
    x[590:, 0] = np.nan
    x[599] = np.nan
    return x


@pytest.mark.parametrize("settings", [
    {}, {"UNIT_ROWS": 40, "LEAST_SAMPLED": 5, "ASKING_ROWS": 30, "FEW": 0}, {"UNIT_ROWS": 9, "LEAST_SAMPLED": 500},
    {"MOST_UNITS": 3, "SAMPLE": 60}, {"LARGEST": 120.0},
])
def test_impute_by_pattern(spark, grouped, monkeypatch, settings):
    """Several cells, blocks of a cell, small samples, and patterns that go to the cells of the index."""
    for name, value in settings.items():
        monkeypatch.setattr(patterns, name, value)
    monkeypatch.setattr(knn, "LARGEST", settings.get("LARGEST", 1e100))
    df, cols = frame(spark, grouped), ["x0", "x1", "x2", "x3"]
    index = knn.build_index(df, cols, "id", rows_per_cell=60)
    means = {c: float(np.nanmean(grouped[:, i])) for i, c in enumerate(cols)}
    np.testing.assert_allclose(matrix(knn.impute(df, index, "id", 4, means), cols), brute_impute(grouped, 4), atol=1e-9)


def test_patterns_are_not_searched_in_the_index(spark, grouped, monkeypatch):
    """Columns that the same donors have are one search; no row goes to the cells over all columns."""
    def none(*args):
        raise AssertionError("searched in the index")

    planned, plan = [], patterns.plan
    monkeypatch.setattr(knn, "plan", lambda *a: (planned.append(plan(*a)), planned[-1])[1])
    monkeypatch.setattr(knn, "_in_cells", none)
    df, cols = frame(spark, grouped), ["x0", "x1", "x2", "x3"]
    index = knn.build_index(df, cols, "id")
    knn.impute(df, index, "id", 4, dict.fromkeys(cols, 0.0)).count()
    units, left = planned[0]
    assert not left and {tuple(u.wants) for u in units if list(u.has) == [0, 1]} == {(2, 3)}


def test_tree_over_a_sample_still_bounds_cells(spark, monkeypatch):
    """The index of a large table is laid out over a sample; its sizes and boxes are those of all rows."""
    passes, stats = [], knn._node_stats
    monkeypatch.setattr(knn, "_node_stats", lambda *a: (passes.append(1), stats(*a))[1])
    monkeypatch.setattr(knn, "SAMPLE", 500)
    monkeypatch.setattr(patterns, "SAMPLE", 500)
    monkeypatch.setattr(knn, "LEAST_SAMPLED", 5)
    x = np.random.default_rng(5).normal(size=(4000, 3))
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(4000), "x0": x[:, 0], "x1": x[:, 1], "x2": x[:, 2]}))
    index = knn.build_index(df, ["x0", "x1", "x2"], "id", rows_per_cell=200)
    assert index.n.sum() == 4000 and index.n.max() <= 200 and len(passes) <= 4
    leaf = index.tree.leaves(x)
    for i, cell in enumerate(index.ids):
        np.testing.assert_array_equal(index.lo[i], x[leaf == cell].min(axis=0))
        np.testing.assert_array_equal(index.hi[i], x[leaf == cell].max(axis=0))
