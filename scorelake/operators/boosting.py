"""Second-order boosted trees on histograms.

Columns are cut into bins once, and rows are packed into blocks of narrow columns. A tree grows level by level: tasks add
up gradients and second derivatives by node, column and bin, their histograms are merged by column, and the task that has a
column's sums reads the best split of each node off them. Only these splits come to the driver, a row for each column and
node. Sums are whole numbers (``UNIT``), so with given cuts trees do not depend on how rows are dealt to tasks.

A row's margin is that of its block plus what the trees since then add; after ``REFRESH`` trees blocks are written anew.
Levels are many and short jobs over arrays that stay in memory, so they run on an RDD of decoded blocks.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, functions as F

from scorelake.operators.quantiles import quantiles
from scorelake.session import compact, discard, ship_by_value, stage

ship_by_value(__name__)

#: Bin of missing values; real bins are below it.
MISSING = 255
BINS = 256
#: One in gradient sums; sums of 2**38 weighted rows fit in 64 bits.
UNIT = float(1 << 24)
BLOCK_ROWS = 1 << 15
REFRESH = 10
BLOCK_SCHEMA = "n long, x binary, y binary, u binary, margin binary"


@dataclass
class BoostConfig:
    trees: int = 150
    depth: int = 6
    rate: float = 0.1
    rows: float = 0.8
    columns: float = 0.8
    min_weight: float = 2.0
    penalty: float = 1.0
    min_gain: float = 1e-6
    seed: int = 42


@dataclass
class Tree:
    """Nodes in heap order: the children of node i are 2 i + 1 and 2 i + 2. A leaf has feature -1."""

    feature: list[int]
    bin: list[int]
    missing_left: list[bool]
    value: list[float]

    @staticmethod
    def empty(depth: int) -> "Tree":
        n = (1 << (depth + 1)) - 1
        return Tree([-1] * n, [0] * n, [False] * n, [0.0] * n)


@dataclass
class Boosting:
    """A fitted model: names and cuts of its columns, margin without trees, and the trees."""

    cols: list[str]
    cuts: list[list[float]]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def to_state(self) -> dict:
        trees = [[t.feature, t.bin, [int(m) for m in t.missing_left], t.value] for t in self.trees]
        return {"cols": self.cols, "cuts": self.cuts, "base": self.base, "trees": trees}

    @staticmethod
    def from_state(state: dict) -> "Boosting":
        trees = [Tree(f, b, [bool(x) for x in m], v) for f, b, m, v in state["trees"]]
        return Boosting(state["cols"], state["cuts"], state["base"], trees)


def binned(values: np.ndarray, cuts: Sequence[float]) -> np.ndarray:
    """Number of cuts below each value; missing ones have a bin of their own. A split at bin b sends x <= cuts[b] left."""
    return np.where(np.isnan(values), MISSING, np.searchsorted(np.asarray(cuts, dtype=float), values)).astype(np.uint8)


def walk(x: np.ndarray, tree: Tree, depth: int) -> np.ndarray:
    """Node of each row after at most ``depth`` steps; ``x`` has one row of bins for each column."""
    feature, at, left = np.array(tree.feature), np.array(tree.bin), np.array(tree.missing_left)
    node = np.zeros(x.shape[1], dtype=np.int64)
    rows = np.arange(x.shape[1])
    for _ in range(depth):
        own = feature[node]
        b = x[np.maximum(own, 0), rows]
        goes_left = np.where(b == MISSING, left[node], b <= at[node])
        node = np.where(own >= 0, 2 * node + 2 - goes_left, node)
    return node


def tree_margin(x: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    out = np.zeros(x.shape[1])
    for t in trees:
        out += np.array(t.value)[walk(x, t, len(t.feature).bit_length() - 1)]
    return out


def feature_cuts(df: DataFrame, cols: Sequence[str], bins: int = 254) -> list[list[float]]:
    """Inner cuts at sketched quantiles, at most ``bins - 1`` a column, in one pass over all columns."""
    known = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols])
    found = quantiles(known, list(cols), [i / bins for i in range(1, bins)], accuracy=10_000)
    return [sorted({v for v in found[c] if v is not None}) for c in cols]


def pack_blocks(df: DataFrame, cols: Sequence[str], label: str, row_id: str, cuts: Sequence[Sequence[float]], base: float) -> DataFrame:
    """Blocks of rows: bins column by column, labels, row hashes and margins as bytes. Rows without label are left out."""
    chosen = [F.col(label).cast("int").alias("y"), F.xxhash64(F.col(row_id)).alias("u"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = [binned(part.column(i + 2).cast(pa.float64()).to_numpy(zero_copy_only=False), c) for i, c in enumerate(cuts)]
                y, u = part.column(0).to_numpy().astype(np.uint8), part.column(1).to_numpy()
                cells = [b"".join(c.tobytes() for c in x), y.tobytes(), u.tobytes(), np.full(len(y), base).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([len(y)]), *[pa.array([c], pa.binary()) for c in cells]], ["n", "x", "y", "u", "margin"])

    return df.where(F.col(label).isNotNull()).select(*chosen).mapInArrow(pack, BLOCK_SCHEMA)


def unpacked(cells: Sequence[bytes], n: int, columns: int) -> tuple[np.ndarray, ...]:
    """``x, y, u, margin`` of a block."""
    x, y, u, margin = (np.frombuffer(c, dtype=t) for c, t in zip(cells, (np.uint8, np.uint8, np.uint64, np.float64)))
    return x.reshape(columns, n), y, u, margin


def decoded(blocks: DataFrame, columns: int) -> RDD:
    """The blocks as arrays, kept in memory as long as levels read them."""
    return blocks.rdd.map(lambda r: unpacked(r[1:], r[0], columns)).persist(StorageLevel.MEMORY_AND_DISK)


def sampled(u: np.ndarray, share: float, seed: int) -> np.ndarray:
    """Rows that a tree sees: a hash of the row's own with the tree's number."""
    if share >= 1:
        return np.ones(len(u), dtype=bool)
    h = (u ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(29))) < np.uint64(int(share * 2.0**64))


def best_splits(sums: np.ndarray, cut_count: int, cfg: BoostConfig) -> Iterator[tuple]:
    """Best split of every node by one column: ``sums`` has (node, bin, gradient or second derivative) whole sums.

    Missing values are tried on the right, then on the left; ties go to the smaller cut, then to the right.
    """
    real = np.cumsum(sums[:, :cut_count], axis=1)
    total, lost = sums.sum(axis=1), sums[:, MISSING]
    left = np.stack([real, real + lost[:, None]], axis=2)  # node, cut, side of the missing, sum
    right = total[:, None, None] - left

    def score(s: np.ndarray) -> np.ndarray:
        g, h = s[..., 0] / UNIT, s[..., 1] / UNIT
        return g * g / (h + cfg.penalty)

    gain = score(left) + score(right) - score(total)[:, None, None]
    fine = (left[..., 1] >= cfg.min_weight * UNIT) & (right[..., 1] >= cfg.min_weight * UNIT)
    gain = np.where(fine, gain, -np.inf).reshape(len(sums), -1)
    for slot in range(len(sums)):
        at = int(gain[slot].argmax()) if cut_count else 0
        own = left[slot].reshape(-1, 2)[at] if cut_count else total[slot]
        yield slot, float(gain[slot, at]) if cut_count else -math.inf, at // 2, bool(at % 2), int(own[0]), int(own[1]), int(total[slot, 0]), int(total[slot, 1])


def level_splits(
    blocks: RDD, model: Boosting, since: int, tree: Tree, level: int, nodes: Sequence[int], columns: Sequence[int],
    weight: float, cfg: BoostConfig, seed: int,
) -> dict[int, tuple]:
    """Best split of each of ``nodes`` (all on one level) over ``columns``, and the node's sums."""
    pending = model.trees[since:]
    slot_of = np.full(len(tree.feature), -1, dtype=np.int64)
    slot_of[list(nodes)] = np.arange(len(nodes))

    cut_counts = [len(model.cuts[f]) for f in columns]

    def histogram(parts: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        sums = np.zeros((len(columns), len(nodes) * BINS, 2), dtype=np.int64)
        for x, y, u, margin in parts:
            mine = np.flatnonzero(sampled(u, cfg.rows, seed))
            slot = slot_of[walk(x[:, mine], tree, level)]
            mine, slot = mine[slot >= 0], slot[slot >= 0]
            own, y = x[:, mine], y[mine]
            p = 1 / (1 + np.exp(-(margin[mine] + tree_margin(own, pending))))
            w = np.where(y == 1, weight, 1.0)
            g, h = np.rint(w * (p - y) * UNIT), np.rint(w * p * (1 - p) * UNIT)
            for i, f in enumerate(columns):
                key = slot * BINS + own[f]
                for k, v in enumerate((g, h)):
                    # Doubles add whole numbers below 2**53 exactly, and a block stays below that.
                    sums[i, :, k] += np.bincount(key, v, len(nodes) * BINS).astype(np.int64)
        yield from enumerate(sums)

    def splits(own: tuple[int, np.ndarray]) -> list[tuple]:
        i, sums = own
        return [(i, *best) for best in best_splits(sums.reshape(len(nodes), BINS, 2), cut_counts[i], cfg)]

    merged = blocks.mapPartitions(histogram)
    if blocks.getNumPartitions() > 1:
        merged = merged.reduceByKey(np.add, min(len(columns), blocks.context.defaultParallelism))
    found: dict[int, tuple] = {}
    # One row for each column and node; columns in order, so that ties go to the first.
    for i, slot, gain, *rest in sorted(merged.flatMap(splits).collect(), key=lambda r: r[:2]):
        if nodes[slot] not in found or gain > found[nodes[slot]][0]:
            found[nodes[slot]] = (gain, columns[i], *rest)
    return found


def grow(blocks: RDD, model: Boosting, since: int, weight: float, cfg: BoostConfig, number: int) -> Tree:
    """One tree: as many jobs as levels; the leaves of the last level follow from its parents' splits."""
    rng = np.random.default_rng([cfg.seed, number])
    width = len(model.cols)
    columns = sorted(rng.choice(width, max(1, int(cfg.columns * width)), replace=False).tolist())
    seed = int(rng.integers(0, 1 << 63))
    tree = Tree.empty(cfg.depth)
    nodes = [0]

    def leaf(g: int, h: int) -> float:
        return -cfg.rate * (g / UNIT) / (h / UNIT + cfg.penalty)

    for level in range(cfg.depth):
        opened = []
        for node, (gain, feature, at, left, g_left, h_left, g, h) in level_splits(blocks, model, since, tree, level, nodes, columns, weight, cfg, seed).items():
            tree.value[node] = leaf(g, h)
            if gain > cfg.min_gain:
                tree.feature[node], tree.bin[node], tree.missing_left[node] = feature, at, left
                tree.value[2 * node + 1], tree.value[2 * node + 2] = leaf(g_left, h_left), leaf(g - g_left, h - h_left)
                opened += [2 * node + 1, 2 * node + 2]
        nodes = opened
        if not nodes:
            break
    return tree


def refreshed(blocks: DataFrame, width: int, trees: Sequence[Tree]) -> DataFrame:
    """Blocks with the margins that ``trees`` add."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = (unpacked(cells, n, width) for n, *cells in zip(*(c.to_pylist() for c in batch.columns)))
            margins = [(m + tree_margin(x, trees)).tobytes() for x, _, _, m in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(margins, pa.binary())], batch.schema.names)

    return blocks.mapInArrow(add, BLOCK_SCHEMA)


def positive_weight(df: DataFrame, label: str) -> tuple[float, float, int]:
    """Weight of a positive (whole-number class ratio, at least 1), log-odds of the weighted mean, number of rows."""
    n = df.agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).first()
    if not n.pos or not n.neg:
        raise ValueError("both classes are needed")
    weight = float(max(n.neg // n.pos, 1))
    return weight, math.log(weight * n.pos / n.neg), n.pos + n.neg


def fit_boosting(df: DataFrame, cols: Sequence[str], label: str, row_id: str, cfg: BoostConfig | None = None, cuts: Sequence[Sequence[float]] | None = None) -> Boosting:
    """Missing values are allowed in ``cols``; rows without label are not used."""
    cfg = cfg or BoostConfig()
    weight, base, rows = positive_weight(df, label)
    model = Boosting(list(cols), [list(c) for c in cuts or feature_cuts(df, cols)], base)
    blocks = stage(pack_blocks(compact(df, rows), cols, label, row_id, model.cuts, base), "boosting")
    arrays, since = decoded(blocks, len(cols)), 0
    for number in range(cfg.trees):
        model.trees.append(grow(arrays, model, since, weight, cfg, number))
        if number + 1 - since == REFRESH and number + 1 < cfg.trees:
            old, blocks = blocks, stage(refreshed(blocks, len(cols), model.trees[since:]), "boosting")
            arrays.unpersist()
            discard(old)
            arrays, since = decoded(blocks, len(cols)), number + 1
    arrays.unpersist()
    discard(blocks)
    return model


class BoostingModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` as a vector of both classes; saved and loaded with its parameters."""

    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    def __init__(self, model: Boosting | None = None):
        super().__init__()
        if model is not None:
            self._set(state=json.dumps(model.to_state()))

    @property
    def boosting(self) -> Boosting:
        return Boosting.from_state(json.loads(self.getOrDefault(self.state)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        model = self.boosting

        def margin(*columns: pd.Series) -> pd.Series:
            x = np.stack([binned(c.to_numpy(dtype=float), cuts) for c, cuts in zip(columns, model.cuts)])
            return pd.Series(model.base + tree_margin(x, model.trees))

        m = F.pandas_udf(margin, "double")(*[F.col(c).cast("double") for c in model.cols])
        p = 1 / (1 + F.exp(-m))
        scored = dataset.withColumn("_boosted", p)
        return scored.withColumn("probability", array_to_vector(F.array(1 - F.col("_boosted"), F.col("_boosted")))).drop("_boosted")


def split_table(df: DataFrame, cols: Sequence[str], label: str, row_id: str, cuts: Mapping[str, Sequence[float]], cfg: BoostConfig, levels: int = 2) -> DataFrame:
    """node, feature, cut, missing_left, gain and sums of the first levels of the first tree, all rows and columns in use."""
    weight, base, rows = positive_weight(df, label)
    model = Boosting(list(cols), [list(cuts[c]) for c in cols], base)
    blocks = decoded(stage(pack_blocks(df, cols, label, row_id, model.cuts, base), "boosting"), len(cols))
    tree, nodes, out = Tree.empty(levels), [0], []
    for level in range(levels):
        found = level_splits(blocks, model, 0, tree, level, nodes, range(len(cols)), weight, cfg, 0)
        nodes = []
        for node, (gain, f, at, left, g_left, h_left, g, h) in found.items():
            if gain > cfg.min_gain:
                tree.feature[node], tree.bin[node], tree.missing_left[node] = f, at, left
                nodes += [2 * node + 1, 2 * node + 2]
                out.append((node, cols[f], float(model.cuts[f][at]), left, gain, g_left, h_left, g, h))
    blocks.unpersist()
    return df.sparkSession.createDataFrame(out, "node int, feature string, cut double, missing_left boolean, gain double, g_left long, h_left long, g long, h long")
