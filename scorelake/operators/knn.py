"""Exact nearest neighbours under missing values, without comparing all pairs.

Donors lie in the leaves of a k-d tree: a cell with too many rows is split at the median of the column that varies most in
it, rows without that column apart. Cells hold about as many rows as there are cells, so both grow with the square root of
the table. Each cell has a bounding box, so a lower bound tells which cells can hold one of a row's k nearest donors.

Rows that ask are dealt to blocks by the cell they would lie in, so those of a block need much the same cells, and vectors
are sent once for each pair of a block and a cell. Round one visits the closest cells and yields an upper bound for every
row; round two visits the cells whose lower bound does not exceed it for some row of the block, and only for such rows.
Donors of a cell come in blocks of bounded size, so no hot cell becomes one task.

Distance of two rows over p columns: p / (columns both have) * sum of squared differences.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from scorelake.operators.leaves import SLACK, CellTree, apart, lay_out, matrix
from scorelake.operators.patterns import LARGEST, LEAST_SAMPLED, SAMPLE, answers, mean_of, of_units, plan, sampled
from scorelake.session import ship_by_value, stage, stage_path

ship_by_value(__name__)

#: Rows of a cell: this, or so many times the square root of the table's rows, whichever is more.
LEAST_CELL, CELL_ROOTS = 2_000, 8
BLOCK_ROWS = 4_096
QUERY_ROWS = 4_096
#: Bounds held at a time: rows times cells.
BOUNDS = 1 << 21
#: Equal rows that one task joins with their answer.
HOT_ROWS = 50_000
ANY = -1
TASK = ["home", "grp", "cell", "block"]

HIT_SCHEMA = "rid bigint, col int, d2 double, donor bigint, value double"
VISIT_SCHEMA = "home int, grp int, cell int"


class CellIndex:
    """Donor cells: the tree, and per cell the size, column counts and bounding box."""

    def __init__(self, cols: Sequence[str], path: str, tree: CellTree, cells: pd.DataFrame):
        self.cols, self.path, self.tree = list(cols), path, tree
        self.ids = cells["cell"].to_numpy(int)
        self.n = cells["n"].to_numpy(int)
        self.count = np.array(cells["count"].tolist(), dtype=float).reshape(len(cells), len(cols))
        self.lo = np.array(cells["lo"].tolist(), dtype=float).reshape(len(cells), len(cols))
        self.hi = np.array(cells["hi"].tolist(), dtype=float).reshape(len(cells), len(cols))

    def to_state(self) -> dict:
        return {
            "cols": self.cols, "path": self.path, "tree": self.tree.to_state(),
            "cells": {"cell": self.ids.tolist(), "n": self.n.tolist(), "count": self.count.tolist(),
                      "lo": self.lo.tolist(), "hi": self.hi.tolist()},
        }

    @staticmethod
    def from_state(state: dict) -> "CellIndex":
        return CellIndex(state["cols"], state["path"], CellTree(*state["tree"]), pd.DataFrame(state["cells"]))

    def lower_bounds(self, q: np.ndarray, only: slice = slice(None)) -> np.ndarray:
        """Smallest possible distance of each query row to each cell (or those of ``only``); inf if no column is shared."""
        p = q.shape[1]
        always, some = (self.count == self.n[:, None])[only], (self.count > 0)[only]
        lo, hi = self.lo[only], self.hi[only]
        total = np.zeros((len(q), len(lo)))
        shared = np.zeros_like(total)
        for j in range(p):
            x = q[:, j, None]
            seen = ~np.isnan(x)
            gap = np.maximum(np.maximum(lo[None, :, j] - x, x - hi[None, :, j]), 0.0)
            total += np.where(seen & always[None, :, j], gap * gap, 0.0)
            shared += seen & some[None, :, j]
        with np.errstate(divide="ignore", invalid="ignore"):
            bound = total * p / shared * SLACK
        return np.where(shared > 0, bound, np.inf)

    def first_cells(self, bounds: np.ndarray, wanted: np.ndarray, k: int) -> np.ndarray:
        """Mask of the closest cells that together hold k donors for every wanted column."""
        order = np.argsort(bounds, axis=1, kind="stable")
        need = np.ones(len(bounds), dtype=int)

        def reach(rows: np.ndarray, held: np.ndarray) -> None:
            enough = np.cumsum(held[order[rows]], axis=1) >= k
            need[rows] = np.maximum(need[rows], np.where(enough.any(axis=1), enough.argmax(axis=1) + 1, len(held)))

        for j in np.flatnonzero(wanted.any(axis=0)):
            reach(np.flatnonzero(wanted[:, j]), self.count[:, j])
        reach(np.flatnonzero(~wanted.any(axis=1)), self.n)
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :].repeat(len(order), 0), axis=1)
        return (rank < need[:, None]) & np.isfinite(bounds)


def _vector(cols: Sequence[str]) -> Column:
    """Columns as one array, missing as NaN so that it becomes a numeric matrix."""
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols])


def _node_stats(donors: DataFrame, tree: CellTree, nodes: Sequence[int], p: int) -> dict[int, dict[str, np.ndarray]]:
    """Rows, and per column the values there are, their sums, squares and range, of each of ``nodes``."""
    names = ["seen", "total", "square", "lo", "hi"]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0), p)
            node = tree.leaves(x)
            mine = np.flatnonzero(np.isin(node, nodes))
            if not len(mine):
                continue
            mine = mine[np.argsort(node[mine], kind="stable")]
            x, node = x[mine], node[mine]
            own, start = np.unique(node, return_index=True)
            has, zero = ~np.isnan(x), np.nan_to_num(x)
            sums = [np.add.reduceat(v, start, axis=0) for v in (has.astype(float), zero, zero * zero)]
            sums += [f.reduceat(np.where(has, x, e), start, axis=0) for f, e in ((np.minimum, np.inf), (np.maximum, -np.inf))]
            offsets = pa.array(np.arange(len(own) + 1) * p, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v.reshape(-1))) for v in sums]
            rows = np.diff(np.append(start, len(node)))
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(rows), *lists], ["node", "n", *names])

    types = ", ".join(f"{c} array<double>" for c in names)
    parts = donors.select("x").mapInArrow(partial, f"node long, n long, {types}")
    entry = parts.select("node", "n", F.posexplode(F.arrays_zip(*names)).alias("j", "e"))
    aggs = [F.sum(f"e.{c}").alias(c) for c in names[:3]] + [F.min("e.lo").alias("lo"), F.max("e.hi").alias("hi")]
    out: dict[int, dict[str, np.ndarray]] = {}
    # One row for each open cell and column.
    for r in entry.groupBy("node", "j").agg(F.sum("n").alias("n"), *aggs).collect():
        own = out.setdefault(r.node, {"n": 0, **{c: np.zeros(p) for c in names}})
        own["n"] = int(r.n)
        for c in names:
            own[c][r.j] = r[c]
    return out


def _cuts(donors: DataFrame, tree: CellTree, chosen: dict[int, int], highest: dict[int, float], p: int) -> dict[int, tuple]:
    """About the median of the chosen column of each node, and its largest value below the ``highest``."""
    column, top = np.full(len(tree.column), -1), np.full(len(tree.column), np.inf)
    column[list(chosen)] = list(chosen.values())
    top[list(highest)] = list(highest.values())

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0), p)
            node = tree.leaves(x)
            mine = np.flatnonzero(column[node] >= 0)
            v = x[mine, column[node[mine]]]
            own = [pa.array(node[mine]), pa.array(v, mask=np.isnan(v)), pa.array(v, mask=~(v < top[node[mine]]))]
            yield pa.RecordBatch.from_arrays(own, ["node", "v", "lower"])

    values = donors.select("x").mapInArrow(pick, "node long, v double, lower double").groupBy("node")
    cuts = values.agg(F.percentile_approx("v", 0.5, 1000).alias("middle"), F.max("lower").alias("lower"))
    # One row for each open cell.
    return {r.node: (r.middle, r.lower) for r in cuts.collect()}


def build_index(
    df: DataFrame, cols: Sequence[str], row_id: str, path: str | None = None, rows_per_cell: int | None = None
) -> CellIndex:
    """Split the donors into cells level by level, write them by cell and summarise the cells."""
    cols, p = list(cols), len(cols)
    narrow = df.select(F.col(row_id).cast("bigint").alias("donor"), _vector(cols).alias("x"), F.xxhash64(F.col(row_id)).alias("h"))
    donors = stage(narrow, "donors")
    tree, stats, nodes = CellTree(), {}, [0]
    most = rows_per_cell
    while nodes:
        found = _node_stats(donors, tree, nodes, p)
        rows = found[0]["n"] if 0 in found else 0
        most = most or max(LEAST_CELL, int(CELL_ROOTS * math.sqrt(rows)))
        if rows > SAMPLE and most >= LEAST_SAMPLED * rows / SAMPLE:
            # Most splits are laid out over a sample; what they leave too large is split on below.
            tree = lay_out(sampled(donors, rows, p), range(p), 0.8 * most * SAMPLE / rows)
            nodes = [i for i, c in enumerate(tree.column) if c < 0]
            found = _node_stats(donors, tree, nodes, p)
        chosen: dict[int, int] = {}
        for node, s in found.items():
            stats[node] = s
            spread = s["square"] - s["total"] ** 2 / np.maximum(s["seen"], 1)
            # A column splits a cell if its values differ, or if it is there in some rows only.
            splits = np.where(s["lo"] < s["hi"], 1 + np.maximum(spread, 0), np.where((s["seen"] > 0) & (s["seen"] < s["n"]), 0.5, 0))
            if s["n"] > most and splits.max() > 0:
                chosen[node] = int(splits.argmax())
        highest = {node: stats[node]["hi"][j] for node, j in chosen.items()}
        cuts = _cuts(donors, tree, chosen, highest, p) if chosen else {}
        nodes = []
        for node, j in sorted(chosen.items()):
            lo, hi, seen = (stats[node][c][j] for c in ("lo", "hi", "seen"))
            # Both sides have rows: the cut is from the least value up to below the largest. Where half of the rows have the
            # largest, they come apart at once.
            middle, lower = cuts[node]
            cut = middle if lo <= middle < hi else lower if lower is not None and lo <= lower < hi else lo
            nodes += tree.split(node, j, float(cut), lo < hi, seen < stats[node]["n"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = pa.array(tree.leaves(matrix(batch.column(1), p)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, leaf], [*batch.schema.names, "cell"])

    path = path or stage_path(df.sparkSession, "donors")
    donors.mapInArrow(place, "donor long, x array<double>, h long, cell int").write.mode("overwrite").parquet(path)
    leaves = [c for c in sorted(stats) if tree.column[c] < 0]
    cells = pd.DataFrame({
        "cell": leaves, "n": [stats[c]["n"] for c in leaves], "count": [stats[c]["seen"] for c in leaves],
        "lo": [np.where(stats[c]["seen"] > 0, stats[c]["lo"], 0.0) for c in leaves],
        "hi": [np.where(stats[c]["seen"] > 0, stats[c]["hi"], 0.0) for c in leaves],
    })
    return CellIndex(cols, path, tree, cells)


def _batches(pdf: pd.DataFrame, rows: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for start in range(0, len(pdf), rows):
        part = pdf.iloc[start : start + rows]
        yield part, np.array(part["q"].tolist(), dtype=float)


def _wanted(q: np.ndarray, any_donor: bool) -> np.ndarray:
    return np.zeros_like(q, dtype=bool) if any_donor else np.isnan(q)


def _kept(index: CellIndex, spark: SparkSession, k: int) -> tuple[DataFrame, DataFrame]:
    """Donors that can be among k nearest, and the number of blocks of each cell.

    Of equal rows only the k with the lowest ids can, so a value that very many rows share is k rows.
    """
    order = Window.partitionBy("cell", "x").orderBy(F.asc_nulls_last("donor"))
    saved = spark.read.parquet(index.path).select("cell", "donor", "x", "h").withColumn("rank", F.row_number().over(order))
    donors = stage(saved.filter(F.col("rank") <= k).drop("rank"), "donors")
    # One row a cell.
    sizes = donors.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    return donors, F.broadcast(sizes)


def _apart(q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Distance of each row of ``q`` to the row of ``d`` beside it; inf if no column is shared."""
    return apart(q, d, q.shape[1])


def _ranges(q: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Between what the distances of all rows of ``q`` and ``d`` lie: products of matrices with room for their rounding."""
    p = q.shape[1]
    room = (p + 10) * 1e-15
    q_has, d_has = (~np.isnan(q)).astype(float), (~np.isnan(d)).astype(float)
    if q_has.all() and d_has.all():
        with np.errstate(all="ignore"):
            squares = (q * q).sum(axis=1)[:, None] + (d * d).sum(axis=1)
            mixed = 2.0 * (q @ d.T)
            low, high = squares * (1.0 - room) - mixed, squares * (1.0 + room) - mixed
        known = np.isfinite(high)
        return (low, high) if known.all() else (np.where(known, low, -np.inf), np.where(known, high, np.inf))
    q, d = np.where(q_has > 0, q, 0.0), np.where(d_has > 0, d, 0.0)
    with np.errstate(all="ignore"):
        squares = (q * q) @ d_has.T + q_has @ (d * d).T
        mixed, shared = 2.0 * (q @ d.T), q_has @ d_has.T
        low, high = (squares * (1.0 - room) - mixed) * (p / shared), (squares * (1.0 + room) - mixed) * (p / shared)
    # Where squares overflow nothing is known.
    known = np.isfinite(high)
    return np.where(shared > 0, np.where(known, low, -np.inf), np.inf), np.where((shared > 0) & known, high, np.inf)


def _nearest_rows(q: np.ndarray, d: np.ndarray, donor: np.ndarray, low: np.ndarray, high: np.ndarray, most: np.ndarray, k: int):
    """(row, place in ``d``, distance) of the k nearest of each row, at most ``most`` apart, ties to the lower donor."""
    reach = np.partition(high, k - 1, axis=1)[:, k - 1] if high.shape[1] > k else np.full(len(q), np.inf)
    row, at = np.nonzero((low <= np.minimum(reach, most)[:, None]) & (low < np.inf))
    d2 = _apart(q[row], d[at])
    fine = (d2 <= most[row]) & np.isfinite(d2)
    row, at, d2 = row[fine], at[fine], d2[fine]
    order = np.lexsort((donor[at], d2, row))
    row, at, d2 = row[order], at[order], d2[order]
    first = np.searchsorted(row, row)
    top = np.arange(len(row)) - first < k
    return row[top], at[top], d2[top]


def _search(
    queries: DataFrame, visits: DataFrame, index: CellIndex, kept: tuple[DataFrame, DataFrame], k: int, any_donor: bool, others: bool
) -> DataFrame:
    """Local top-k per (row, column) of every visit of a query block to a donor block.

    ``queries`` has (rid, q, home, grp, far); a row takes part where its lower bound of the cell is at most ``far``.
    With ``others`` a donor under the row's own key is none.
    """
    spark = queries.sparkSession
    saved, sizes = kept
    tasks = visits.join(sizes, "cell").withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    tasks = stage(tasks.select(*TASK, "blocks"), "knn-tasks")
    left = queries.join(tasks, ["home", "grp"]).select(*TASK, "rid", "q", "far")
    placed = saved.join(sizes, "cell").withColumn("block", F.expr("pmod(h, blocks)").cast("int"))
    right = placed.drop("blocks", "h").join(tasks, ["cell", "block"]).select(*TASK, "donor", "x")
    p, place = len(index.cols), {int(c): i for i, c in enumerate(index.ids)}

    def local_top(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(left) and len(right):
            d = np.array(right["x"].tolist(), dtype=float)
            by_id = np.argsort(right["donor"].to_numpy(), kind="stable")
            d, donor = d[by_id], right["donor"].to_numpy()[by_id]
            at = place[int(left["cell"].iloc[0])]
            has = ~np.isnan(d)
            for part, q in _batches(left, 256):
                near = index.lower_bounds(q, slice(at, at + 1))[:, 0] <= part["far"].to_numpy()
                part, q = part[near], q[near]
                rid, most = part["rid"].to_numpy(), part["far"].to_numpy()
                low, high = _ranges(q, d)
                if others:
                    own = rid[:, None] == donor[None, :]
                    low[own] = high[own] = np.inf
                # Columns that the same rows lack and the same donors have are answered at once.
                alike: dict[tuple[bytes, bytes], list[int]] = {}
                for j in [ANY] if any_donor else np.flatnonzero(np.isnan(q).any(axis=0)).tolist():
                    alike.setdefault((b"", b"") if any_donor else (np.isnan(q[:, j]).tobytes(), has[:, j].tobytes()), []).append(j)
                for columns in alike.values():
                    rows = np.arange(len(q)) if any_donor else np.flatnonzero(np.isnan(q[:, columns[0]]))
                    usable = np.arange(len(d)) if any_donor else np.flatnonzero(has[:, columns[0]])
                    if not len(rows) or not len(usable):
                        continue
                    whole = len(rows) == len(q) and len(usable) == len(d)
                    box = (slice(None), slice(None)) if whole else np.ix_(rows, usable)
                    row, who, d2 = _nearest_rows(q[rows], d[usable], donor[usable], low[box], high[box], most[rows], k)
                    who = usable[who]
                    for j in columns:
                        value = np.zeros(len(who)) if any_donor else d[who, j]
                        out.append(pd.DataFrame({
                            "rid": rid[rows[row]], "col": np.int32(j), "d2": d2, "donor": donor[who], "value": value,
                        }))
        if out:
            return pd.concat(out, ignore_index=True)
        return pd.DataFrame({"rid": [], "col": [], "d2": [], "donor": [], "value": []}).astype(
            {"rid": "int64", "col": "int32", "d2": "float64", "donor": "int64", "value": "float64"}
        )

    # Few bytes but much arithmetic per group: a count from the cluster's size keeps small stages from being merged.
    wide = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = max(1, min(tasks.count(), wide))
    left, right = left.repartition(parts, *TASK), right.repartition(parts, *TASK)
    return left.groupBy(*TASK).cogroup(right.groupBy(*TASK)).applyInPandas(local_top, HIT_SCHEMA)


def _top(hits: DataFrame, k: int) -> DataFrame:
    """k nearest per (row, column), ties to the lower donor id; cut before and after the shuffle."""
    order = Window.partitionBy("rid", "col").orderBy("d2", "donor")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _dealt(queries: DataFrame, index: CellIndex) -> DataFrame:
    """Queries with ``home`` (the leaf that they would lie in) and ``grp``: blocks of at most about ``QUERY_ROWS`` rows."""
    p = len(index.cols)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = index.tree.leaves(matrix(batch.column(1), p)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], ["rid", "q", "home"])

    placed = stage(queries.select("rid", "q").mapInArrow(homes, "rid long, q array<double>, home int"), "queries")
    # One row a cell.
    groups = placed.groupBy("home").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("groups"))
    grp = F.expr("pmod(xxhash64(rid, 7), groups)").cast("int").alias("grp")
    return placed.join(F.broadcast(groups), "home").select("rid", "q", "home", grp)


def nearest(queries: DataFrame, index: CellIndex, k: int, any_donor: bool = False, keyed: bool = True) -> DataFrame:
    """The k nearest donors of each row of ``queries`` (rid, q).

    For missing columns, whose donors must have them: rows (rid, cols, mean, hits) with the columns that share their donors, the
    means of their values, and (d2, donor, v) of each donor where a row is ``open``, a third column of ``queries``. Rows whose
    gaps many have are searched pattern by pattern, others in the cells of the index.

    With ``any_donor`` every other row is a donor, in rows (rid, col, d2, donor, value, rank), where ``col`` is -1. Where
    ``rid`` is no donor's key (not ``keyed``), every row is. Without donors there are no rows.
    """
    if any_donor:
        return _in_cells(queries, index, k, True, keyed)
    spark, p = queries.sparkSession, len(index.cols)
    none = spark.createDataFrame([], "rid bigint, cols array<int>, mean array<double>, hits array<struct<d2: double, donor: bigint, v: array<double>>>")
    if not len(index.ids):
        return none
    queries = queries if "open" in queries.columns else queries.withColumn("open", F.lit(False))
    donors = spark.read.parquet(index.path)
    # Squares of the largest values overflow, which only the cells of the index allow for.
    wide = max(np.abs(index.lo).max(), np.abs(index.hi).max()) >= LARGEST
    units, left = ([], True) if wide else plan(queries, donors, p, int(index.n.sum()))
    found = answers(queries, donors, units, p, k) if units else none
    if left:
        rest = queries.filter(~of_units(units, p, "q")) if units else queries
        one = F.struct("d2", "donor", F.array("value").alias("v"))
        hits = _in_cells(rest, index, k, False, False).groupBy("rid", "col").agg(F.array_sort(F.collect_list(one)).alias("hits"))
        found = found.unionByName(hits.select("rid", F.array("col").alias("cols"), mean_of("hits"), "hits"))
    return found


def _in_cells(queries: DataFrame, index: CellIndex, k: int, any_donor: bool, keyed: bool) -> DataFrame:
    """Rows (rid, col, d2, donor, value, rank) of the k nearest donors, by the cells of the index."""
    if not len(index.ids):
        return _top(queries.sparkSession.createDataFrame([], HIT_SCHEMA), k)
    dealt = stage(_dealt(queries, index), "queries")
    others = any_donor and keyed
    kept = _kept(index, queries.sparkSession, k + int(others))
    batch = max(16, BOUNDS // len(index.ids))

    def seen(q: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return index.first_cells(bounds, _wanted(q, any_donor), k + int(others))

    def visits(part: pd.DataFrame, mask: np.ndarray) -> pd.DataFrame:
        row, cell = np.nonzero(mask)
        own = part[["home", "grp"]].iloc[row].reset_index(drop=True)
        return own.assign(cell=index.ids[cell].astype("int32")).drop_duplicates()

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part, q in _batches(pdf, batch):
                yield visits(part, seen(q, index.lower_bounds(q)))

    closest = stage(dealt.mapInPandas(first, VISIT_SCHEMA).distinct(), "visits")
    everywhere = dealt.withColumn("far", F.lit(float("inf")))
    round1 = stage(_top(_search(everywhere, closest, index, kept, k, any_donor, others), k), "hits")
    if len(index.ids) == 1:
        return round1

    per_column = round1.groupBy("rid", "col").agg(F.count("*").alias("n"), F.max("d2").alias("far"))
    reached = per_column.groupBy("rid").agg(
        F.max("far").alias("far"), F.count_if(F.col("n") >= k).alias("full")
    )
    missing = F.lit(1) if any_donor else F.size(F.filter("q", F.isnan))
    far = F.when(F.col("full") == missing, F.col("far")).otherwise(F.lit(float("inf"))).alias("far")
    bounded = stage(dealt.join(reached, "rid", "left").select("rid", "q", "home", "grp", far), "bounded")

    def rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part, q in _batches(pdf, batch):
                bounds = index.lower_bounds(q)
                yield visits(part, (bounds <= part["far"].to_numpy()[:, None]) & np.isfinite(bounds))

    more = bounded.mapInPandas(rest, VISIT_SCHEMA).distinct().join(closest, ["home", "grp", "cell"], "left_anti")
    return _top(round1.drop("rank").unionByName(_search(bounded, more, index, kept, k, any_donor, others)), k)


def _means(found: DataFrame) -> DataFrame:
    """Map of column and mean for each row of the hits."""
    mean = found.groupBy("rid", "col").agg(F.avg("value").alias("v"))
    return mean.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("col", "v"))).alias("_fill"))


def impute(df: DataFrame, index: CellIndex, row_id: str, k: int, means: dict[str, float | None]) -> DataFrame:
    """Fill each missing value with the mean over its k nearest donors, else the column mean.

    Equal rows have the same nearest donors, so each different row asks once. The result is staged: a later pass over it
    neither searches nor joins again.
    """
    cols = index.cols
    gaps = df.filter(F.exists(F.array(*[F.col(c).isNull() for c in cols]), lambda b: b))
    asked = stage(gaps.select(F.col(row_id).cast("bigint").alias("rid"), _vector(cols).alias("q")).filter("rid is not null").withColumn("h", F.xxhash64("q")), "asked")
    # Rows under one key share the nearest donors of all of them.
    again = stage(asked.groupBy("rid").count().filter("count > 1").select("rid", F.lit(True).alias("open")), "again")
    repeated = not again.isEmpty()
    each = asked.join(again, "rid", "left") if repeated else asked.withColumn("open", F.lit(False))
    unlike = each.groupBy("h", "q").agg(F.count("*").alias("n"), F.coalesce(F.bool_or("open"), F.lit(False)).alias("open"))
    unlike = stage(unlike.withColumn("qid", F.monotonically_increasing_id()), "unlike")
    found = nearest(unlike.select(F.col("qid").alias("rid"), "q", "open"), index, k).withColumnRenamed("rid", "qid")
    found = stage(found, "found")
    # A row that very many share is dealt to several tasks; there are few of them, and they are in the table often.
    hot = F.broadcast(unlike.filter(F.col("n") > HOT_ROWS).select("h", "q", F.ceil(F.col("n") / HOT_ROWS).alias("salts")))
    salt = F.coalesce(F.expr("pmod(xxhash64(rid), salts)"), F.lit(0)).cast("int").alias("salt")
    # Rows meet by a hash first, which sorts faster than vectors.
    own = asked.join(hot, ["h", "q"], "left").select("rid", "h", "q", salt)
    spread = F.explode(F.expr(f"sequence(0, cast(ceil(n / {HOT_ROWS}) as int) - 1)")).alias("salt")
    fill = F.map_from_entries(F.flatten(F.collect_list(F.arrays_zip("cols", "mean")))).alias("_fill")
    means_of = found.groupBy("qid").agg(fill)
    filled = own.join(means_of.join(unlike, "qid").select("h", "q", "_fill", spread), ["h", "q", "salt"]).select("rid", "_fill")
    if repeated:
        hits = asked.join(again, "rid").join(unlike.select("h", "q", "qid"), ["h", "q"]).join(found, "qid")
        hits = hits.select("rid", "cols", F.explode("hits").alias("hit")).select("rid", "hit.*", F.posexplode(F.arrays_zip("cols", "hit.v")).alias("_", "e"))
        hits = hits.select("rid", F.col("e.cols").alias("col"), "d2", "donor", F.col("e.v").alias("value"))
        filled = filled.join(again, "rid", "left_anti").unionByName(_means(_top(hits, k)))
    wide = df.join(filled, F.col(row_id) == F.col("rid"), "left")
    full = wide.select(
        *[
            F.coalesce(F.col(c).cast("double"), F.col("_fill")[cols.index(c)], F.lit(means.get(c))).alias(c)
            if c in cols
            else F.col(c)
            for c in df.columns
        ]
    )
    return stage(full, "filled")


class KNNImputer(Estimator):
    """Fit on complete or incomplete rows; each missing value becomes the mean of k donors."""

    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    rowId = Param(Params._dummy(), "rowId", "unique integer key", TypeConverters.toString)
    keep = Param(Params._dummy(), "keep", "columns that are not features", TypeConverters.toListString)
    donorsPath = Param(Params._dummy(), "donorsPath", "where the donor table is kept", TypeConverters.toString)

    def __init__(self, rowId: str, keep: Sequence[str] = (), k: int = 20, donorsPath: str | None = None):
        super().__init__()
        self._set(rowId=rowId, keep=list(keep), k=k)
        if donorsPath:
            self._set(donorsPath=donorsPath)

    def _fit(self, dataset: DataFrame) -> "KNNImputerModel":
        row_id = self.getOrDefault(self.rowId)
        skip = {row_id, *self.getOrDefault(self.keep)}
        cols = [c for c in dataset.columns if c not in skip]
        means = dataset.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first().asDict()
        path = self.getOrDefault(self.donorsPath) if self.isDefined(self.donorsPath) else None
        index = build_index(dataset, cols, row_id, path)
        return KNNImputerModel({
            "index": index.to_state(), "means": means, "row_id": row_id, "k": self.getOrDefault(self.k)
        })


class _DonorWriter(DefaultParamsWriter):
    """Saves the donors beside the parameters, so that a saved model needs no other folder."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.sparkSession.read.parquet(self.instance.donors).write.parquet(f"{path}/donors")


class _DonorReader(DefaultParamsReader):
    def load(self, path: str) -> "KNNImputerModel":
        model = super().load(path)
        state = json.loads(model.getOrDefault(model.state))
        state["index"]["path"] = f"{path}/donors"
        return model._set(state=json.dumps(state))


class KNNImputerModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Donors lie where the fit wrote them until the model is saved; a loaded model reads its own copy."""

    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    def __init__(self, state: dict | None = None):
        super().__init__()
        if state is not None:
            self._set(state=json.dumps(state))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = json.loads(self.getOrDefault(self.state))
        return impute(dataset, CellIndex.from_state(s["index"]), s["row_id"], s["k"], s["means"])

    @property
    def donors(self) -> str:
        return json.loads(self.getOrDefault(self.state))["index"]["path"]

    def write(self) -> _DonorWriter:
        return _DonorWriter(self)

    @classmethod
    def read(cls) -> _DonorReader:
        return _DonorReader(cls)
