"""A whole training run, its tables, and a resumed second run."""

import dataclasses

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorelake.operators import models
from scorelake.operators.registry import alias_state, rollback
from scorelake.plans.training import TrainingConfig, load_scorer, run_training
from scorelake.sources import logs


@pytest.fixture(scope="module")
def applicants(spark):
    rng = np.random.default_rng(9)
    n = 900
    wealth = rng.normal(size=n)
    pdf = pd.DataFrame({"customer_id": np.arange(n)})
    for i in range(3):
        pdf[f"BAL_{i}"] = wealth * 50 + rng.normal(0, 10, n)
    pdf["LOANS"] = rng.integers(0, 9, n).astype(float)
    pdf["CARDS"] = rng.integers(0, 4, n).astype(float)
    pdf["SAME"] = 1.0
    pdf["label"] = (rng.random(n) < 1 / (1 + np.exp(-(-1.6 + 1.5 * wealth + 0.1 * pdf.LOANS)))).astype(int)
    pdf.loc[rng.random(n) < 0.1, "BAL_1"] = np.nan
    return spark.createDataFrame(pdf).withColumn("BAL_1", F.nanvl("BAL_1", F.lit(None)))


CONFIG = TrainingConfig(
    groups={"BAL": ["BAL_0", "BAL_1", "BAL_2"]}, components={"BAL": 2}, bins={"BAL_PCA_1": 6, "LOANS": 4, "CARDS": 3},
    equal_frequency=["BAL_PCA_1"], selected=3, neighbours=5, trees=3, depth=3,
    regularisation=(1.0,), penalties=("l2",),
)


def test_run_and_resume(spark, applicants, tmp_path):
    root = str(tmp_path / "run")
    result = run_training(spark, applicants, "abcd1234", root, CONFIG)
    table = result.metrics.groupBy("model_type", "split").pivot("metric").agg(F.first("value")).toPandas()
    models_only = table[table.model_type != "data"]
    assert set(models_only.model_type) == {"logistic_regression", "boosted_trees", "scorecard_woe_lr"}
    assert (models_only[models_only.split == "test"].auc > 0.65).all()
    data = table[table.model_type == "data"].set_index("split")
    assert data.n_rows.to_dict() == {"train": 720, "test": 180}
    state = {r.alias: r.version for r in alias_state(logs.read_log(spark, f"{root}/deployments")).collect()}
    assert set(state) == {"challenger", "champion", "scorecard"} and len(set(state.values())) == 3
    assert spark.read.csv(f"{root}/iv_table/abcd1234", header=True).count() == 3

    again = run_training(spark, applicants.limit(0), "abcd1234", root, CONFIG)  # stages are read, not rebuilt
    assert again.scorecard.binning.edges == result.scorecard.binning.edges
    np.testing.assert_allclose(again.scorecard.beta, result.scorecard.beta, rtol=1e-6)
    versions = spark.read.parquet(f"{root}/versions")
    assert sorted(r.version for r in versions.collect()) == [1, 2, 3]  # the same runs are registered once
    log = logs.read_log(spark, f"{root}/deployments")
    assert {r.alias: r.version for r in alias_state(log).collect()} == state and log.count() == 3

    deeper = dataclasses.replace(CONFIG, depth=2)  # only the boosted trees change
    run_training(spark, applicants.limit(0), "abcd1234", root, deeper)
    log = logs.read_log(spark, f"{root}/deployments")
    moved = {r.alias: r.version for r in alias_state(log).collect()}
    assert {a for a in moved if moved[a] != state[a]} == {"champion"} and moved["champion"] == "4"
    assert log.filter("id = 4").first().from_version == state["champion"]
    assert rollback(spark, f"{root}/deployments") == state["champion"]

    ready = spark.read.parquet(f"{root}/ready_test")
    for version in (int(state["champion"]), int(state["challenger"])):
        p = load_scorer(spark, root, version)(ready)
        assert p.filter("p between 0 and 1").count() == 180
    parts = spark.read.parquet(f"{root}/parts_test")
    loaded = load_scorer(spark, root, state["scorecard"])(parts).agg(F.sum("p")).first()[0]
    assert loaded == pytest.approx(result.scorecard.score(parts, explain=False).agg(F.sum("p")).first()[0])
    with pytest.raises(LookupError):
        load_scorer(spark, root, 99)


def test_two_models_on_the_same_rows(spark):
    df = spark.createDataFrame([(0.10, 0.20), (0.44, 0.46), (0.80, 0.60)], "a double, b double")
    got = df.select(*models.probability_shift(F.col("a"), F.col("b"))).collect()
    assert [r.flipped for r in got] == [False, True, True]
    assert [round(r.abs_diff, 2) for r in got] == [0.10, 0.02, 0.20]
