"""Training run: version, split, features, three models, metrics, versions and aliases.

Every stage is a table or a saved model keyed by the data version and the parameters it
depends on, so a repeated run resumes where inputs did not change.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from scorelake.operators import models, prep
from scorelake.operators.metrics import all_metrics, score_curve
from scorelake.operators.registry import alias_state, assign_aliases, next_id, register_runs
from scorelake.operators.scorecard import Scorecard, fit_scorecard
from scorelake.operators.split import stratified_split
from scorelake.operators.stats import missing_rate, split_stats
from scorelake.plans import credit
from scorelake.sources import logs, runs
from scorelake.sources.tables import finished, resume_stage

# Which alias each model type takes.
ROLES = {"logistic_regression": "challenger", "boosted_trees": "champion", "scorecard_woe_lr": "scorecard"}
MODEL_NAME = "credit_score_model"


@dataclass
class TrainingConfig:
    row_id: str = "customer_id"
    label: str = "label"
    groups: Mapping[str, Sequence[str]] = field(default_factory=lambda: credit.GROUPS)
    components: Mapping[str, int] = field(default_factory=lambda: credit.COMPONENTS)
    bins: Mapping[str, int] = field(default_factory=lambda: credit.BINS)
    equal_frequency: Sequence[str] = field(default_factory=lambda: credit.EQUAL_FREQUENCY)
    selected: int = credit.SELECTED_FEATURES
    neighbours: int | None = credit.NEIGHBOURS
    trees: int = 150
    depth: int = 6
    regularisation: Sequence[float] = (0.01, 0.1, 1.0, 10.0)
    penalties: Sequence[str] = ("l1", "l2")
    test_size: float = 0.2
    seed: int = 42

    def tag(self, *names: str) -> str:
        """Short digest of the named parameters, for stage keys."""
        values = asdict(self)
        text = json.dumps({n: values[n] for n in names}, sort_keys=True, default=list)
        return hashlib.sha256(text.encode()).hexdigest()[:8]


@dataclass
class TrainingResult:
    data_version: str
    features: PipelineModel
    challenger: PipelineModel
    champion: PipelineModel
    scorecard: Scorecard
    metrics: DataFrame


def _load_or_fit(spark: SparkSession, path: str, fit: Callable[[], PipelineModel]) -> PipelineModel:
    """The model saved at ``path``; fitted and saved where its last part is not there yet."""
    if not finished(spark, f"{path}/done"):
        fit().write().overwrite().save(f"{path}/model")
        spark.range(1).write.mode("overwrite").parquet(f"{path}/done")
    return PipelineModel.load(f"{path}/model")


def _load_or_fit_card(spark: SparkSession, path: str, fit: Callable[[], Scorecard]) -> Scorecard:
    if not finished(spark, path):
        fit().save(spark, path)
    return Scorecard.load(spark, path)


def load_scorer(spark: SparkSession, root: str, version: int | str) -> Callable[[DataFrame], DataFrame]:
    """Scorer of a registered version, from its saved model; it adds ``p``."""
    row = spark.read.parquet(f"{root}/versions").filter(F.col("version") == int(version)).select("run_id").first()
    if row is None:
        raise LookupError(f"version {version} is not registered")
    path = f"{root}/models/{row.run_id}"
    if row.run_id.endswith("scorecard_woe_lr"):
        card = Scorecard.load(spark, path)
        return lambda d: card.score(d, explain=False)
    model = PipelineModel.load(f"{path}/model")
    return lambda d: models.positive_probability(model, d)


def run_training(
    spark: SparkSession, data: DataFrame, data_version: str, root: str, config: TrainingConfig | None = None
) -> TrainingResult:
    cfg = config or TrainingConfig()
    key = {"data": data_version}
    now = datetime.now(timezone.utc).replace(tzinfo=None)

    split_key = {**key, "cfg": cfg.tag("row_id", "label", "test_size", "seed")}
    split = resume_stage(
        spark, root, "split", split_key,
        lambda: stratified_split(data, cfg.row_id, cfg.label, cfg.test_size, cfg.seed),
    )
    train = split.filter("split = 'train'").drop("split")
    test = split.filter("split = 'test'").drop("split")

    feature_tag = cfg.tag("row_id", "label", "test_size", "seed", "groups", "components", "selected", "neighbours")
    steps = _load_or_fit(
        spark,
        f"{root}/features/{data_version}-{feature_tag}",
        lambda: prep.feature_steps(
            cfg.groups, cfg.components, cfg.row_id, cfg.label, cfg.selected, cfg.neighbours
        ).fit(train),
    )
    feature_key = {**key, "cfg": feature_tag}
    ready = {
        name: resume_stage(spark, root, f"ready_{name}", feature_key, lambda d=df: steps.transform(d))
        for name, df in (("train", train), ("test", test))
    }
    parts = {
        name: resume_stage(spark, root, f"parts_{name}", feature_key, lambda d=df: prep.component_frame(steps, d))
        for name, df in (("train", train), ("test", test))
    }
    cols = [c for c in ready["train"].columns if c not in (cfg.row_id, cfg.label)]

    tags = {
        "logistic_regression": feature_tag,
        "boosted_trees": f"{feature_tag}-{cfg.tag('trees', 'depth')}",
        "scorecard_woe_lr": f"{feature_tag}-{cfg.tag('bins', 'equal_frequency', 'regularisation', 'penalties')}",
    }
    run_ids = {kind: f"{data_version}-{tag}-{kind}" for kind, tag in tags.items()}
    path = {kind: f"{root}/models/{run_id}" for kind, run_id in run_ids.items()}
    challenger = _load_or_fit(
        spark, path["logistic_regression"],
        lambda: models.train_challenger(ready["train"], cols, cfg.row_id, cfg.label, seed=cfg.seed),
    )
    champion = _load_or_fit(
        spark, path["boosted_trees"],
        lambda: models.train_boosted(ready["train"], cols, cfg.row_id, cfg.label, cfg.trees, cfg.depth, seed=cfg.seed),
    )
    card = _load_or_fit_card(
        spark, path["scorecard_woe_lr"],
        lambda: fit_scorecard(
            parts["train"], cfg.bins, cfg.equal_frequency, cfg.row_id, cfg.label, fingerprint=feature_tag,
            regularisation=cfg.regularisation, penalties=cfg.penalties,
        ),
    )

    scorers = {
        "logistic_regression": (ready, lambda d: models.positive_probability(challenger, d)),
        "boosted_trees": (ready, lambda d: models.positive_probability(champion, d)),
        "scorecard_woe_lr": (parts, lambda d: card.score(d, explain=False, fingerprint=feature_tag)),
    }
    wide = None
    for kind, (tables, scorer) in scorers.items():
        for name, df in tables.items():
            row = all_metrics(score_curve(scorer(df), "p", cfg.label)).select(
                F.lit(run_ids[kind]).alias("run_id"), F.lit(kind).alias("model_type"),
                F.lit(name).alias("split"), "*",
            )
            wide = row if wide is None else wide.unionByName(row)
    long = runs.melt_metrics(wide, ["run_id", "model_type", "split"])
    data_run = f"{data_version}-data"
    stats = runs.melt_metrics(split_stats(split, cfg.label), ["split"]).select(
        F.lit(data_run).alias("run_id"), F.lit("data").alias("model_type"), "*"
    )
    holes = missing_rate(train, [c for c in train.columns if c != cfg.row_id]).select(
        F.lit(data_run).alias("run_id"), F.lit("data").alias("model_type"), F.lit("train").alias("split"),
        F.lit("missing_rate").alias("metric"), F.col("missing_rate").alias("value"),
    )
    logs.append(
        long.unionByName(stats).unionByName(holes).withColumn("run_ts", F.lit(now)), f"{root}/runs"
    )
    params = {"data_version": data_version, "n_features": len(cols), "best_C": card.grid["C"], "best_penalty": card.grid["penalty"],
              "n_scorecard_features": len(card.binning.edges), "trees": cfg.trees, "depth": cfg.depth}
    logs.append(runs.param_rows(spark, data_run, params), f"{root}/params")
    spark.createDataFrame(card.iv_rows(), "feature string, iv double").write.mode("overwrite").csv(
        f"{root}/iv_table/{data_version}", header=True
    )
    trained = [(run_id, kind) for kind, run_id in run_ids.items()]
    _register(spark, root, spark.createDataFrame(trained, "run_id string, model_type string"))
    return TrainingResult(data_version, steps, challenger, champion, card, spark.read.parquet(f"{root}/runs"))


def _register(spark: SparkSession, root: str, trained: DataFrame) -> None:
    """A version for each run that has none, and an event for each alias that moves. Single writer."""
    fresh = trained.withColumn("model_name", F.lit(MODEL_NAME))
    if finished(spark, f"{root}/versions"):
        known = spark.read.parquet(f"{root}/versions").select("model_name", "run_id", "version")
    else:
        known = spark.createDataFrame([], "model_name string, run_id string, version bigint")
    new = fresh.join(known.select("run_id"), "run_id", "left_anti")
    logs.append(register_runs(new, known), f"{root}/versions")
    if finished(spark, f"{root}/deployments"):
        past = logs.read_log(spark, f"{root}/deployments")
    else:
        past = spark.createDataFrame([], "id bigint, ts timestamp, alias string, to_version string")
    state = alias_state(past).select("alias", F.col("version").alias("from_version"))
    events = assign_aliases(fresh, spark.read.parquet(f"{root}/versions"), ROLES)
    moved = events.withColumn("to_version", F.col("to_version").cast("string")).join(state, "alias", "left")
    moved = moved.filter(~F.col("to_version").eqNullSafe(F.col("from_version")))
    order = F.row_number().over(Window.partitionBy("event_type").orderBy("alias"))  # one row an alias at most
    rows = moved.select(
        (F.lit(next_id(past) - 1) + order).cast("bigint").alias("id"), F.current_timestamp().alias("ts"), "event_type",
        F.lit(MODEL_NAME).alias("model_name"), "alias", "from_version", "to_version",
        F.lit("training").alias("triggered_by"), F.lit(None).cast("string").alias("reason"),
    )
    logs.append(rows, f"{root}/deployments")
