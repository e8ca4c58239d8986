"""Feature preparation as ML stages.

Every stage treats all columns except ``keep`` as features, in table order, so stages can be
chained although components replace columns on the way.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PCA, ElementwiseProduct, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from scorelake.functions.scalars import clip
from scorelake.operators.knn import KNNImputer
from scorelake.operators.quantiles import quantiles
from scorelake.operators.validate import varying_columns
from scorelake.session import compact, stage


class _Fitted(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted values live in one JSON parameter, so saving and loading come with it."""

    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    def __init__(self, state: dict | None = None):
        super().__init__()
        if state is not None:
            self._set(state=json.dumps(state))

    @property
    def values(self) -> dict:
        return json.loads(self.getOrDefault(self.state))


class _Step(Estimator):
    keep = Param(Params._dummy(), "keep", "columns that are not features", TypeConverters.toListString)

    def __init__(self, keep: Sequence[str] = ()):
        super().__init__()
        self._set(keep=list(keep))

    def features(self, df: DataFrame) -> list[str]:
        skip = set(self.getOrDefault(self.keep))
        return [c for c in df.columns if c not in skip]


def _replace(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


class FillModel(_Fitted):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        known = {c: v for c, v in self.values.items() if v is not None and c in dataset.columns}
        return _replace(dataset, {c: F.coalesce(F.col(c), F.lit(v)) for c, v in known.items()})


class MedianImputer(_Step):
    """Missing values become the exact column median."""

    def _fit(self, dataset: DataFrame) -> FillModel:
        return FillModel({c: q[0] for c, q in quantiles(dataset, self.features(dataset), [0.5]).items()})


class ClipModel(_Fitted):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return _replace(dataset, {c: clip(F.col(c), lo, hi) for c, (lo, hi) in self.values.items()})


class Winsorizer(_Step):
    """Clip to the ``lower`` and ``upper`` quantiles seen in fit."""

    lower = Param(Params._dummy(), "lower", "lower quantile", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "upper quantile", TypeConverters.toFloat)

    def __init__(self, keep: Sequence[str] = (), lower: float = 0.05, upper: float = 0.95):
        super().__init__(keep)
        self._set(lower=lower, upper=upper)

    def _fit(self, dataset: DataFrame) -> ClipModel:
        probs = [self.getOrDefault(self.lower), self.getOrDefault(self.upper)]
        return ClipModel(quantiles(dataset, self.features(dataset), probs))


class ColumnsModel(_Fitted):
    """Keep the chosen features and everything that is not a feature."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        drop = set(self.values["dropped"])
        return dataset.select(*[c for c in dataset.columns if c not in drop])


class ConstantDropper(_Step):
    """Drop features with one distinct value in fit."""

    def _fit(self, dataset: DataFrame) -> ColumnsModel:
        cols = self.features(dataset)
        kept = set(varying_columns(dataset, cols))
        return ColumnsModel({"dropped": [c for c in cols if c not in kept]})


class ScaleModel(_Fitted):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return _replace(
            dataset, {c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.values.items()}
        )


class ZScaler(_Step):
    """Mean 0 and population standard deviation 1; a constant column is only centred."""

    def _fit(self, dataset: DataFrame) -> ScaleModel:
        cols = self.features(dataset)
        row = dataset.agg(
            *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]
        ).first()
        return ScaleModel({c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in cols})


class ExpandVectors(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Component vectors to named columns; the grouped inputs and helper columns go away."""

    state = Param(Params._dummy(), "state", "layout as JSON", TypeConverters.toString)

    def __init__(self, layout: dict | None = None):
        super().__init__()
        if layout is not None:
            self._set(state=json.dumps(layout))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        layout = json.loads(self.getOrDefault(self.state))
        gone = set(layout["inputs"]) | set(layout["helpers"])
        parts: list[Column] = []
        for name, (vector, size) in layout["groups"].items():
            values = vector_to_array(F.col(vector))
            parts += [values[i].alias(f"{name}_PCA_{i + 1}") for i in range(size)]
        rest = [c for c in dataset.columns if c not in gone]
        keep = set(layout["keep"])
        return dataset.select(
            *[c for c in rest if c in keep], *parts, *[c for c in rest if c not in keep]
        )


class GroupPCA(_Step):
    """Principal components of each column group, then the columns outside all groups.

    Components are centred; the entry of largest size in each is made positive.
    """

    groups = Param(Params._dummy(), "groups", "group columns and sizes as JSON", TypeConverters.toString)

    def __init__(self, groups: Mapping[str, Sequence[str]], components: Mapping[str, int], keep: Sequence[str] = ()):
        super().__init__(keep)
        self._set(groups=json.dumps({g: [list(cols), components[g]] for g, cols in groups.items()}))

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        have = self.features(dataset)
        groups = {
            name: ([c for c in have if c in set(wanted)], size)
            for name, (wanted, size) in json.loads(self.getOrDefault(self.groups)).items()
        }
        grouped = [c for cols, _ in groups.values() for c in cols]
        means = dataset.agg(*[F.avg(c).alias(c) for c in grouped]).first().asDict() if grouped else {}
        centre = ScaleModel({c: (m or 0.0, 1.0) for c, m in means.items()})
        centred = centre.transform(dataset)
        stages: list = [centre]
        layout: dict = {"groups": {}, "inputs": [], "helpers": [], "keep": self.getOrDefault(self.keep)}
        for name, (cols, size) in groups.items():
            if not cols:
                continue
            size = max(1, min(size, len(cols)))
            mid, comp, out = (f"_{name}_{s}" for s in ("mid", "pca", "out"))
            assemble = VectorAssembler(inputCols=cols, outputCol=mid)
            model = PCA(k=size, inputCol=mid, outputCol=comp).fit(assemble.transform(centred))
            loads = model.pc.toArray()
            signs = np.sign(loads[np.abs(loads).argmax(axis=0), np.arange(size)])
            flip = ElementwiseProduct(
                scalingVec=Vectors.dense(np.where(signs == 0, 1.0, signs)), inputCol=comp, outputCol=out
            )
            stages += [assemble, model, flip]
            layout["groups"][name] = [out, size]
            layout["inputs"] += cols
            layout["helpers"] += [mid, comp, out]
        return PipelineModel([*stages, ExpandVectors(layout)])


class RFESelector(_Step):
    """Recursive elimination: refit a balanced logistic model, drop the smallest coefficient, repeat."""

    label = Param(Params._dummy(), "label", "0/1 label column", TypeConverters.toString)
    count = Param(Params._dummy(), "count", "features to keep", TypeConverters.toInt)

    def __init__(self, keep: Sequence[str], label: str = "label", count: int = 22):
        super().__init__(keep)
        self._set(label=label, count=count)

    def _fit(self, dataset: DataFrame) -> ColumnsModel:
        label = self.getOrDefault(self.label)
        cols = self.features(dataset)
        left = list(range(len(cols)))
        assembled = VectorAssembler(inputCols=cols, outputCol="_x").transform(dataset).select(label, "_x")
        rows = stage(with_balanced_weight(assembled, label), "rfe")
        total = rows.count()
        rows = compact(rows, total)
        while len(left) > min(self.getOrDefault(self.count), len(cols)):
            sliced = VectorSlicer(inputCol="_x", outputCol="_s", indices=left).transform(rows)
            fit = LogisticRegression(
                featuresCol="_s", labelCol=label, weightCol="_w", maxIter=100, regParam=1.0 / total,
                elasticNetParam=0.0, standardization=False,
            ).fit(sliced)
            size = np.abs(fit.coefficients.toArray())
            worst = max(np.flatnonzero(size == size.min()))
            left.pop(int(worst))
        kept = {cols[i] for i in left}
        return ColumnsModel({"dropped": [c for c in cols if c not in kept]})


def with_balanced_weight(df: DataFrame, label: str, weight: str = "_w") -> DataFrame:
    """Row weight n / (2 * n of the row's class): both classes weigh the same in total."""
    n = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    total = sum(n.values())
    pos, neg = total / (2.0 * n[1]), total / (2.0 * n[0])
    return df.withColumn(weight, F.when(F.col(label) == 1, F.lit(pos)).otherwise(F.lit(neg)))


def feature_steps(
    groups: Mapping[str, Sequence[str]],
    components: Mapping[str, int],
    row_id: str,
    label: str = "label",
    count: int = 22,
    k: int | None = 20,
    keep: Sequence[str] = (),
) -> Pipeline:
    """Impute, winsorize, group components, drop constants, scale, select. ``k=None``: median fill."""
    keep = list(dict.fromkeys([row_id, label, *keep]))
    imputer = MedianImputer(keep) if k is None else KNNImputer(row_id, keep, k)
    return Pipeline(stages=[
        imputer,
        Winsorizer(keep),
        GroupPCA(groups, components, keep),
        ConstantDropper(keep),
        ZScaler(keep),
        RFESelector(keep, label, count),
    ])


def component_frame(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Named components and remaining columns, before constants are dropped and values scaled."""
    return PipelineModel(model.stages[:3]).transform(df)
