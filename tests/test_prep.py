"""Feature preparation, neighbours and oversampling against numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from scorelake.operators import knn, prep
from scorelake.operators import smote as smotes
from scorelake.operators.smote import smote
from scorelake.session import discard

KEEP = ["id", "label"]


def frame(spark, x, **extra):
    cols = {f"x{i}": x[:, i] for i in range(x.shape[1])}
    pdf = pd.DataFrame({"id": np.arange(len(x)), "label": extra.get("label", np.arange(len(x)) % 2), **cols})
    df = spark.createDataFrame(pdf)
    return df.select(*KEEP, *[F.nanvl(c, F.lit(None)).alias(c) for c in cols])


def matrix(df, cols):
    return df.orderBy("id").select(*cols).toPandas().to_numpy(dtype=float)


def test_winsorize_example(spark):
    x = np.array([[1, 2], [3, 4], [100, 200], [-100, -200], [2, 3]], dtype=float)
    df = frame(spark, x)
    out = matrix(prep.Winsorizer(KEEP).fit(df).transform(df), ["x0", "x1"])
    lo, hi = np.quantile(x, 0.05, axis=0), np.quantile(x, 0.95, axis=0)
    np.testing.assert_allclose(out, np.clip(x, lo, hi))
    assert out.max() < 200 and out.min() > -200


def test_constant_columns_are_learned_in_fit(spark):
    df = frame(spark, np.array([[1, 5], [1, 6], [1, 7]], dtype=float))
    model = prep.ConstantDropper(KEEP).fit(df)
    assert model.transform(df).columns == [*KEEP, "x1"]
    assert model.transform(df.withColumn("x0", F.col("x1"))).columns == [*KEEP, "x1"]


def test_scaler_uses_population_deviation(spark):
    x = np.array([[1.0, 4], [3, 4], [5, 4]])
    df = frame(spark, x)
    out = matrix(prep.ZScaler(KEEP).fit(df).transform(df), ["x0", "x1"])
    np.testing.assert_allclose(out[:, 0], (x[:, 0] - 3) / np.std(x[:, 0]))
    np.testing.assert_allclose(out[:, 1], 0)


def test_group_components_match_numpy(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(300, 2))
    x = np.column_stack([base @ rng.normal(size=(2, 4)) + 0.1 * rng.normal(size=(300, 4)) + 5, rng.normal(size=300)])
    df = frame(spark, x)
    model = prep.GroupPCA({"A": ["x0", "x1", "x2", "x3"], "B": ["none"]}, {"A": 3, "B": 2}, KEEP).fit(df)
    out = model.transform(df)
    assert out.columns == [*KEEP, "A_PCA_1", "A_PCA_2", "A_PCA_3", "x4"]
    z = x[:, :4] - x[:, :4].mean(axis=0)
    _, _, vt = np.linalg.svd(z, full_matrices=False)
    vt = vt[:3] * np.sign(vt[np.arange(3), np.abs(vt[:3]).argmax(axis=1)])[:, None]
    np.testing.assert_allclose(matrix(out, ["A_PCA_1", "A_PCA_2", "A_PCA_3"]), z @ vt.T, atol=1e-8)


def brute_impute(x, k):
    out = x.copy()
    p = x.shape[1]
    for i in np.flatnonzero(np.isnan(x).any(axis=1)):
        diff = x - x[i]
        both = ~np.isnan(diff)
        n = both.sum(axis=1)
        d = np.where(n > 0, np.where(both, diff * diff, 0).sum(axis=1) * p / np.maximum(n, 1), np.inf)
        for j in np.flatnonzero(np.isnan(x[i])):
            usable = np.flatnonzero(~np.isnan(x[:, j]) & np.isfinite(d))
            near = usable[np.lexsort((usable, d[usable]))][:k]
            out[i, j] = x[near, j].mean() if len(near) else np.nanmean(x[:, j])
    return out


@pytest.fixture(scope="module")
def gaps():
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(0, 100, 700), rng.normal(0, 30, 700), rng.integers(0, 4, 700), rng.normal(0, 1, 700)])
    x[:250] = [10.0, 5.0, 1.0, 0.0]  # a third of all rows are copies of one row
    x[:250, 3] = np.arange(250) % 3
    hole = rng.random(x.shape) < 0.15
    x[hole] = np.nan
    x[5] = np.nan
    return x


@pytest.mark.parametrize("rows_per_cell, block", [(10_000, 4096), (20, 4096), (20, 33)])
def test_impute_equals_brute_force(spark, gaps, monkeypatch, rows_per_cell, block):
    monkeypatch.setattr(knn, "BLOCK_ROWS", block)
    monkeypatch.setattr(knn, "QUERY_ROWS", block)
    df = frame(spark, gaps)
    cols = ["x0", "x1", "x2", "x3"]
    index = knn.build_index(df, cols, "id", rows_per_cell=rows_per_cell)
    assert (len(index.ids) > 1) == (rows_per_cell == 20)
    means = {c: float(np.nanmean(gaps[:, i])) for i, c in enumerate(cols)}
    got = matrix(knn.impute(df, index, "id", 4, means), cols)
    np.testing.assert_allclose(got, brute_impute(gaps, 4), atol=1e-9)


def test_equal_rows_ask_once(spark, gaps, monkeypatch):
    """Rows that many share are searched once, dealt to several tasks, and donors equal to them are k at most."""
    monkeypatch.setattr(knn, "HOT_ROWS", 7)
    asked, nearest = [], knn.nearest
    monkeypatch.setattr(knn, "nearest", lambda q, *a: (asked.append(q.count()), nearest(q, *a))[1])
    x = np.vstack([gaps[:60], np.tile([3.0, np.nan, 1.0, 0.5], (90, 1)), np.tile([3.0, 8.0, 1.0, 0.5], (90, 1))])
    df, cols = frame(spark, x), ["x0", "x1", "x2", "x3"]
    index = knn.build_index(df, cols, "id", rows_per_cell=20)
    means = {c: float(np.nanmean(x[:, i])) for i, c in enumerate(cols)}
    np.testing.assert_allclose(matrix(knn.impute(df, index, "id", 4, means), cols), brute_impute(x, 4), atol=1e-9)
    unlike = {tuple(np.nan_to_num(r, nan=-1.0)) for r in x if np.isnan(r).any()}
    assert asked == [len(unlike)]
    assert knn._kept(index, spark, 4)[0].where("x[0] = 3 and x[1] = 8").count() == 4


def test_result_does_not_search_again(spark, gaps):
    """A later pass over imputed rows is a join with what was found, not another search."""
    out = knn.KNNImputer("id", ["label"], k=4).fit(frame(spark, gaps)).transform(frame(spark, gaps))
    assert "FlatMapCoGroupsInPandas" not in out._jdf.queryExecution().toString()


def test_rows_under_one_key_share_their_donors(spark):
    x = np.array([[1.0, np.nan], [9.0, np.nan], [1.1, 10.0], [1.3, 20.0], [8.9, 30.0], [5.0, 40.0]])
    df, cols = frame(spark, x), ["x0", "x1"]
    index = knn.build_index(df, cols, "id")
    two = df.withColumn("id", F.when(F.col("id") == 1, 0).otherwise(F.col("id")).cast("long"))
    out = {(r.id, r.x0): r.x1 for r in knn.impute(two, index, "id", 2, {"x0": 0.0, "x1": 0.0}).collect()}
    # 0.01 from 1.1 to 1.0 and from 8.9 to 9.0 (each twice as only one of two columns is shared).
    assert out[(0, 1.0)] == out[(0, 9.0)] == 20.0


def test_ranges_hold_the_distance():
    rng = np.random.default_rng(6)
    q, d = (rng.normal(size=(n, 5)) * [1e6, 1, 1e-3, 1e3, 1e160] for n in (30, 40))
    q[rng.random(q.shape) < 0.4] = np.nan
    d[rng.random(d.shape) < 0.4] = np.nan
    low, high = knn._ranges(q, d)
    apart = np.array([knn._apart(np.tile(row, (len(d), 1)), d) for row in q])
    assert ((low <= apart) & (apart <= high)).all()


def test_cells_that_cannot_be_split(spark):
    """Equal rows are one cell however many they are; rows with and without a column are apart; no rows, no cells."""
    rng = np.random.default_rng(4)
    x = np.vstack([np.tile([1.0, 2.0, 3.0], (120, 1)), np.tile([1.0, np.nan, 3.0], (60, 1)), rng.normal(size=(40, 3))])
    cols = ["x0", "x1", "x2"]
    index = knn.build_index(frame(spark, x), cols, "id", rows_per_cell=10)
    assert index.n.sum() == len(x) and {120, 60} <= set(index.n.tolist())
    means = {c: float(np.nanmean(x[:, i])) for i, c in enumerate(cols)}
    np.testing.assert_allclose(matrix(knn.impute(frame(spark, x), index, "id", 4, means), cols), brute_impute(x, 4), atol=1e-9)
    none = frame(spark, x).limit(0)
    index = knn.build_index(none, cols, "id")
    assert not len(index.ids)
    assert matrix(knn.impute(frame(spark, x[100:125]), index, "id", 4, means), cols)[24].tolist() == [1.0, means["x1"], 3.0]


def test_many_columns_and_tiny_cells(spark, monkeypatch):
    monkeypatch.setattr(knn, "QUERY_ROWS", 9)
    monkeypatch.setattr(knn, "BOUNDS", 200)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(260, 2)) @ rng.normal(size=(2, 60)) + rng.normal(size=(260, 60)) * 0.1
    x[rng.uniform(size=x.shape) < 0.04] = np.nan
    cols = [f"x{i}" for i in range(60)]
    index = knn.build_index(frame(spark, x).repartition(5), cols, "id", rows_per_cell=7)
    assert len(index.ids) > 40
    got = matrix(knn.impute(frame(spark, x), index, "id", 3, dict.fromkeys(cols, 0.0)), cols)
    np.testing.assert_allclose(got, brute_impute(x, 3), atol=1e-9)


def test_saved_model_has_its_own_donors(spark, gaps, tmp_path):
    df = frame(spark, gaps)
    model = knn.KNNImputer("id", ["label"], k=4).fit(df)
    want = matrix(model.transform(df), ["x0", "x1", "x2", "x3"])
    model.save(str(tmp_path / "m"))
    discard(spark.read.parquet(model.donors))
    again = knn.KNNImputerModel.load(str(tmp_path / "m"))
    assert again.donors.startswith(str(tmp_path))
    np.testing.assert_array_equal(matrix(again.transform(df), ["x0", "x1", "x2", "x3"]), want)


def test_complete_rows_are_untouched(spark):
    x = np.random.default_rng(1).normal(size=(60, 3))
    df = frame(spark, x)
    model = knn.KNNImputer("id", ["label"], k=5).fit(df)
    np.testing.assert_array_equal(matrix(model.transform(df), ["x0", "x1", "x2"]), x)


def test_pruning_skips_cells(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1000, size=(3000, 3))
    index = knn.build_index(frame(spark, x), ["x0", "x1", "x2"], "id", rows_per_cell=20)
    q = x[:50].copy()
    q[:, 2] = np.nan
    bounds = index.lower_bounds(q)
    assert len(index.ids) > 50
    first = index.first_cells(bounds, np.isnan(q), 5)
    assert first.sum(axis=1).max() < len(index.ids) / 4


def test_smote_reaches_parity_between_neighbours(spark):
    rng = np.random.default_rng(3)
    label = (np.arange(240) % 8 == 0).astype(int)
    x = rng.normal(size=(240, 3)) + 4 * label[:, None]
    df = frame(spark, x, label=label)
    out = smote(df, ["x0", "x1", "x2"], "id").toPandas()
    assert (out.label == 1).sum() == (out.label == 0).sum() == 210
    assert (out["copy"] == 0).sum() == 240
    made = out[out["copy"] > 0]
    assert made.groupby("id").size().agg(lambda s: s.max() - s.min()) <= 1
    minority = x[label == 1]
    for row in made.itertuples():
        base = x[row.id]
        near = minority[np.argsort(((minority - base) ** 2).sum(axis=1))[1:6]]
        step = np.array([row.x0, row.x1, row.x2]) - base
        along = near - base
        u = (along @ step) / np.maximum((along**2).sum(axis=1), 1e-12)
        assert min(np.abs(along * u[:, None] - step).sum(axis=1)) < 1e-9


def test_shared_values_come_apart_at_once(spark, monkeypatch):
    """Where half of the rows have the largest value, one split takes them off, however close the others come to it."""
    passes, stats = [], knn._node_stats
    monkeypatch.setattr(knn, "_node_stats", lambda *a: (passes.append(1), stats(*a))[1])
    x = np.concatenate([np.full(600, 1.0), 1.0 - 2.0 ** -np.arange(1, 41)])[:, None]
    index = knn.build_index(frame(spark, x), ["x0"], "id", rows_per_cell=50)
    assert sorted(index.n) == [40, 600] and len(passes) == 2


@pytest.mark.parametrize("hole", [False, True])
def test_ranges_hold_the_distance(hole):
    rng = np.random.default_rng(6)
    q, d = rng.normal(size=(40, 5)) * 1e5, rng.normal(size=(30, 5)) * 1e5
    d[:10] = q[:10]
    q[39], d[29] = 1e200, 2.0
    if hole:
        q[3, 2] = d[4, 1] = np.nan
    low, high = knn._ranges(q, d)
    with np.errstate(over="ignore"):
        exact = np.array([knn._apart(np.repeat(r[None], len(d), axis=0), d) for r in q])
    assert (low <= exact).all() and (exact <= high).all()


def brute_others(rids, x, k):
    """Keys of the k nearest rows under another key, of all rows under a key together."""
    out = {}
    for r in set(rids.tolist()):
        mine, rest = np.flatnonzero(rids == r), np.flatnonzero(rids != r)
        hits = sorted((float(((x[i] - x[j]) ** 2).sum()), int(rids[j])) for i in mine for j in rest)
        out[r] = [donor for _, donor in hits[:k]]
    return out


@pytest.mark.parametrize("keys", ["single", "repeated"])
def test_smote_equal_rows_ask_once(spark, monkeypatch, keys):
    """Equal rows are searched once, leave out themselves, and are dealt to several tasks."""
    monkeypatch.setattr(smotes, "HOT_ROWS", 7)
    asked, nearest = [], smotes.nearest
    monkeypatch.setattr(smotes, "nearest", lambda q, *a, **b: (asked.append(q.count()), nearest(q, *a, **b))[1])
    rng = np.random.default_rng(8)
    x = np.vstack([rng.integers(0, 6, size=(70, 3)), np.tile([2, 3, 1], (90, 1)), rng.integers(0, 40, size=(60, 3))]).astype(float)
    rids = rng.permutation(len(x)) * 3
    if keys == "repeated":
        rids[[5, 80, 170]] = rids[[100, 81, 171]]
    df = spark.createDataFrame(pd.DataFrame({"rid": rids, "x0": x[:, 0], "x1": x[:, 1], "x2": x[:, 2]}))
    cols = ["x0", "x1", "x2"]
    index = knn.build_index(df, cols, "rid", rows_per_cell=30)
    assert len(index.ids) > 1
    got = smotes.near_rows(df, cols, index, 4).collect()
    assert {r.rid: [e.donor for e in r.near] for r in got} == brute_others(rids, x, 4) and len(got) == len(set(rids.tolist()))
    single = np.array([(rids == r).sum() == 1 for r in rids])
    assert asked == [len(np.unique(x[single], axis=0))] + [6] * (keys == "repeated")


def test_smote_hot_rows(spark, monkeypatch):
    """Copies of very many equal rows, which have the same few near rows, are the same however they are dealt."""
    x = np.vstack([np.tile([1.0, 2.0], (60, 1)), np.random.default_rng(4).normal(size=(200, 2))])
    df = frame(spark, x, label=(np.arange(260) < 80).astype(int))
    rows = []
    for hot in (50_000, 5):
        monkeypatch.setattr(smotes, "HOT_ROWS", hot)
        rows.append(sorted(map(tuple, smote(df, ["x0", "x1"], "id").collect())))
    assert rows[0] == rows[1] and len(rows[0]) == 360


def test_elimination_keeps_what_matters(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 6))
    y = (rng.random(600) < 1 / (1 + np.exp(-(2 * x[:, 1] - 1.5 * x[:, 4])))).astype(int)
    df = frame(spark, x, label=y)
    out = prep.RFESelector(KEEP, "label", 2).fit(df).transform(df)
    assert out.columns == [*KEEP, "x1", "x4"]


def test_steps_save_load_and_repeat(spark, gaps, tmp_path):
    df = frame(spark, gaps)
    steps = prep.feature_steps({"A": ["x0", "x1"]}, {"A": 2}, "id", count=3, k=3)
    model = steps.fit(df)
    out = model.transform(df)
    assert len(out.columns) == 2 + 3
    assert out.filter(" or ".join(f"{c} is null or isnan({c})" for c in out.columns[2:])).count() == 0
    model.write().overwrite().save(str(tmp_path / "steps"))
    again = PipelineModel.load(str(tmp_path / "steps")).transform(df)
    np.testing.assert_array_equal(matrix(again, out.columns[2:]), matrix(out, out.columns[2:]))
    assert prep.component_frame(model, df).columns == ["id", "label", "A_PCA_1", "A_PCA_2", "x2", "x3"]


def test_median_fill_leaves_nothing_for_neighbours(spark, gaps):
    df = frame(spark, gaps)
    filled = Pipeline(stages=[prep.MedianImputer(KEEP)]).fit(df).transform(df)
    want = np.where(np.isnan(gaps), np.nanmedian(gaps, axis=0), gaps)
    np.testing.assert_allclose(matrix(filled, ["x0", "x1", "x2", "x3"]), want)
