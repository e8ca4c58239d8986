"""Nearest donors of rows that lack the same columns: one search for each pattern of gaps and each set of wanted columns.

Rows of a pattern are complete in the columns they have, so in these columns their distances are plain ones. A ``Unit`` is a
pattern and the wanted columns that the same donors have; only those donors take part. Its cells come from a tree over a
bounded sample of them, by the columns of the pattern; boxes and counts come from all donors, so results are exact whatever
the sample is. Round one asks in the cell where a row would lie, round two in the cells whose lower bound does not exceed
what was found. A row whose other cells are all too far is done in round one, and only its means leave the task.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scorelake.operators.leaves import SLACK, CellTree, lay_out, least_of_equal, lists, matrix, search
from scorelake.session import ship_by_value, stage

ship_by_value(__name__)

#: Units that are searched by pattern, and the share of the rows that a pattern needs where there are more.
MOST_UNITS, LEAST_SHARE = 64, 0.01
#: Rows of the sample, and those of it that a cell has at least.
SAMPLE, LEAST_SAMPLED = 65_536, 64
#: Donors of a cell: this, or what holds so many values, whichever is less. A task holds twice as many at most.
UNIT_ROWS, UNIT_VALUES = 131_072, 1 << 21
ASKING_ROWS = 32_768
#: Rows of a pattern that are so few that each batch of donors sends only what is nearest to them.
FEW = 64
#: Rows that make a task worth while.
TASK_ROWS = 20_000
#: Squares of larger values may overflow.
LARGEST = 1e100

KEY = ["unit", "cell", "block", "grp"]
NO_ID = np.iinfo(np.int64).max
HITS = "array<struct<d2: double, donor: bigint, v: array<double>>>"
ASKING = "unit int, cell int, rid bigint, q array<double>, far double, open boolean"
FOUND = f"unit int, rid bigint, mean array<double>, hits {HITS}, open boolean, far double, cells array<int>, q array<double>"
HIT_TYPE = pa.list_(pa.struct([("d2", pa.float64()), ("donor", pa.int64()), ("v", pa.list_(pa.float64()))]))


@dataclass
class Unit:
    """A pattern of gaps (packed), the columns its rows have and those wanted, donors of a cell; tree, sizes and boxes of its cells; its rows if few."""

    pattern: bytes
    has: np.ndarray
    wants: np.ndarray
    most: int
    tree: CellTree = field(default_factory=CellTree)
    cells: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=int))
    n: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=int))
    lo: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    hi: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    few: np.ndarray | None = None

    def blocks(self) -> dict[int, int]:
        """Blocks of each cell that has more donors than a task should hold."""
        return {int(c): max(1, -(-int(n) // (2 * self.most))) for c, n in zip(self.cells, self.n, strict=True)}

    def lower_bounds(self, q: np.ndarray) -> np.ndarray:
        total = np.zeros((len(q), len(self.cells)))
        for j in range(q.shape[1]):
            x = q[:, j, None]
            gap = np.maximum(np.maximum(self.lo[None, :, j] - x, x - self.hi[None, :, j]), 0.0)
            total += gap * gap
        return total * self.scale


def _patterns(queries: DataFrame, p: int) -> DataFrame:
    """Rows by pattern, and their largest value."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = matrix(batch.column(0), p)
            gaps = np.isnan(q)
            most = np.where(gaps, 0.0, np.abs(q)).max(axis=1)
            kinds, kind = np.unique(np.packbits(gaps, axis=1), axis=0, return_inverse=True)
            kind = kind.reshape(-1)
            top = np.zeros(len(kinds))
            np.maximum.at(top, kind, most)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k.tobytes() for k in kinds], pa.binary()), pa.array(np.bincount(kind)), pa.array(top)], ["pattern", "n", "top"]
            )

    parts = queries.select("q").mapInArrow(count, "pattern binary, n long, top double")
    return parts.groupBy("pattern").agg(F.sum("n").alias("n"), F.max("top").alias("top"))


def _together(donors: DataFrame, p: int) -> np.ndarray:
    """For each pair of columns, the donors that have both."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((p, p))
        for batch in batches:
            has = (~np.isnan(matrix(batch.column(0), p))).astype(float)
            total += has.T @ has
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p)), lists(total)], ["i", "n"])

    pairs = donors.select("x").mapInArrow(count, "i long, n array<double>").select("i", F.posexplode("n").alias("j", "n"))
    out = np.zeros((p, p), dtype=np.int64)
    # One row for each pair of columns.
    for r in pairs.groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        out[r.i, r.j] = int(r.n)
    return out


def sampled(donors: DataFrame, rows: int, p: int) -> np.ndarray:
    """About ``SAMPLE`` of the vectors, chosen by a hash of key and values."""
    if rows > SAMPLE:
        chosen = F.pmod(F.xxhash64("donor", "x", F.lit(11)), F.lit(1 << 30)) < int((1 << 30) * SAMPLE / rows)
        donors = donors.filter(chosen).limit(2 * SAMPLE)
    found = donors.select("x").toArrow()
    return matrix(found.column(0).combine_chunks(), p) if len(found) else np.zeros((0, p))


def _numbers(df: DataFrame, key: Sequence[str]) -> dict[tuple, int]:
    """Rows of each key; keys are units and cells, so few."""
    return {tuple(r[c] for c in key): r["n"] for r in df.groupBy(*key).agg(F.count("*").alias("n")).collect()}


def _placed(donors: DataFrame, units: list[Unit], p: int, k: int, groups: dict[tuple[int, int], int]) -> DataFrame:
    """Donors by task: those of each cell as often as it has groups of asking rows. Columns a unit has come first, then wanted ones."""
    blocks = [u.blocks() for u in units]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, rows = matrix(batch.column(1), p), np.arange(len(batch))
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            some = ~np.isnan(x)
            for u, unit in enumerate(units):
                mine = rows[some[:, unit.wants[0]] & some[:, unit.has].any(axis=1)]
                # What many rows share is k rows, as far as this unit sees them.
                mine = mine[least_of_equal(x[np.ix_(mine, unit.has)], ids[mine], k)]
                if unit.few is not None:
                    near = search(unit.few, x[np.ix_(mine, unit.has)], ids[mine], p, k, np.full(len(unit.few), np.inf))[1]
                    mine = mine[np.unique(near)]
                cell = unit.tree.leaves(x[mine])
                known, at = np.unique(cell, return_inverse=True)
                times = np.array([groups.get((u, int(c)), 0) for c in known], dtype=int)[at]
                count = np.array([blocks[u][int(c)] for c in known], dtype=int)[at]
                mine, cell, block = (np.repeat(v, times) for v in (mine, cell, (ids[mine] // 7) % count if len(mine) else mine))
                if not len(mine):
                    continue
                grp = np.arange(len(mine)) - np.repeat(np.cumsum(times) - times, times)
                vector = x[np.ix_(mine, np.concatenate([unit.has, unit.wants]))]
                where = [pa.array(v.astype(np.int32)) for v in (np.full(len(mine), u), cell, block, grp)]
                yield pa.RecordBatch.from_arrays([*where, batch.column(0).take(pa.array(mine)), lists(vector)], [*KEY, "donor", "x"])

    return donors.select("donor", "x").mapInArrow(place, "unit int, cell int, block int, grp int, donor bigint, x array<double>")


def _cells(donors: DataFrame, units: list[Unit], p: int) -> None:
    """Sizes and boxes of all cells, from all donors."""
    names = ["seen", "lo", "hi"]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            x = matrix(batch.column(0), p)
            some = ~np.isnan(x)
            for u, unit in enumerate(units):
                mine = np.flatnonzero(some[:, unit.wants[0]] & some[:, unit.has].any(axis=1))
                cell = unit.tree.leaves(x[mine])
                order = np.argsort(cell, kind="stable")
                cell, v = cell[order], x[np.ix_(mine[order], unit.has)]
                if not len(cell):
                    continue
                own, start = np.unique(cell, return_index=True)
                has = ~np.isnan(v)
                new = [np.add.reduceat(has.astype(float), start, axis=0), np.minimum.reduceat(np.where(has, v, np.inf), start, axis=0),
                       np.maximum.reduceat(np.where(has, v, -np.inf), start, axis=0)]
                for i, (c, n) in enumerate(zip(own, np.diff(np.append(start, len(cell))), strict=True)):
                    if old := held.get((u, int(c))):
                        held[u, int(c)] = [old[0] + n, old[1] + new[0][i], np.minimum(old[2], new[1][i]), np.maximum(old[3], new[2][i])]
                    else:
                        held[u, int(c)] = [n, *(v[i] for v in new)]
        for (u, c), (n, *sums) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([u], pa.int32()), pa.array([c], pa.int32()), pa.array([int(n)]), *[lists(v[None]) for v in sums]],
                ["unit", "cell", "n", *names],
            )

    parts = donors.select("x").mapInArrow(partial, f"unit int, cell int, n long, {', '.join(f'{c} array<double>' for c in names)}")
    entry = parts.select("unit", "cell", "n", F.posexplode(F.arrays_zip(*names)).alias("j", "e"))
    found: dict[tuple[int, int], list] = {}
    sums = [F.sum("n").alias("n"), F.sum("e.seen").alias("seen"), F.min("e.lo").alias("lo"), F.max("e.hi").alias("hi")]
    # One row for each cell and column.
    for r in entry.groupBy("unit", "cell", "j").agg(*sums).collect():
        found.setdefault((r.unit, r.cell), []).append((r.j, r.n, r.seen, r.lo, r.hi))
    for u, unit in enumerate(units):
        own = sorted(c for v, c in found if v == u)
        table = np.array([sorted(found[u, c]) for c in own], dtype=float).reshape(len(own), len(unit.has), 5)
        always = table[:, :, 2] == table[:, :, 1]
        unit.cells, unit.n = np.array(own, dtype=int), table[:, 0, 1].astype(int)
        unit.lo, unit.hi = np.where(always, table[:, :, 3], -np.inf), np.where(always, table[:, :, 4], np.inf)
        unit.scale = p / (table[:, :, 2] > 0).sum(axis=1) * SLACK


def _means_of(values: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Hits of each row, and the means of their values."""
    n = np.bincount(row, minlength=rows)
    sums = np.column_stack([np.bincount(row, weights=values[:, j], minlength=rows) for j in range(values.shape[1])])
    return n, sums / np.maximum(n, 1)[:, None]


def _asked(asking: DataFrame, placed: DataFrame, units: list[Unit], p: int, k: int, groups: dict[tuple[int, int], int], last: bool) -> DataFrame:
    """What each asking row finds in its cell, and unless it is the ``last`` round the cells where more may be."""
    blocks = [u.blocks() for u in units]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, cell, rid = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            number, at = np.unique(unit << 32 | cell, return_inverse=True)
            keys = [(int(v >> 32), int(v & 0xFFFFFFFF)) for v in number]
            dealt = np.array([groups[key] for key in keys], dtype=np.int64)[at]
            count = np.array([blocks[u].get(c, 0) for u, c in keys], dtype=np.int64)[at]
            grp = (rid * 0x9E3779B1 >> 16) % dealt
            rows = np.repeat(np.arange(len(batch)), count)
            block = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
            own = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [own.column(0), own.column(1), pa.array(block.astype(np.int32)), pa.array(grp[rows].astype(np.int32)), *own.columns[2:]],
                [*KEY, "rid", "q", "far", "open"],
            )

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([
            ("unit", pa.int32()), ("rid", pa.int64()), ("mean", pa.list_(pa.float64())), ("hits", HIT_TYPE), ("open", pa.bool_()),
            ("far", pa.float64()), ("cells", pa.list_(pa.int32())), ("q", pa.list_(pa.float64())),
        ])
        if not len(left):
            return schema.empty_table()
        u, c, block = (left.column(i)[0].as_py() for i in range(3))
        unit = units[u]
        s, t = len(unit.has), len(unit.wants)
        rid, far, keep = (left.column(i).to_numpy() for i in ("rid", "far", "open"))
        q = matrix(left.column("q").combine_chunks(), s)
        d, donor, ids = np.zeros((0, s + t)), np.zeros(0, dtype=np.int64), pa.array([], pa.int64())
        if len(right):
            d, ids = matrix(right.column("x").combine_chunks(), s + t), right.column("donor").combine_chunks()
            donor = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
        row, at, d2 = search(q, d[:, :s], donor, p, k, far)
        n, mean = _means_of(d[at, s:], row, len(q))
        end = np.cumsum(n)
        reach = far.copy()
        reach[n >= k] = d2[end[n >= k] - 1]
        more = np.zeros((len(q), len(unit.cells)), dtype=bool)
        # Cells to visit are told by the first block alone, as all blocks of a cell see the same rows.
        if not last and block == 0 and len(unit.cells) > 1:
            bounds = unit.lower_bounds(q)
            more = (bounds <= reach[:, None]) & np.isfinite(bounds) & (unit.cells != c)[None, :]
        done = ~more.any(axis=1) & (not last and blocks[u][c] == 1)
        shown = ~done | keep
        hit = shown[row]
        v = pa.ListArray.from_arrays(pa.array(np.arange(hit.sum() + 1, dtype=np.int32) * t), pa.array(d[at[hit], s:].reshape(-1)))
        structs = pa.StructArray.from_arrays([pa.array(d2[hit]), ids.take(pa.array(at[hit])), v], fields=list(HIT_TYPE.value_type))
        hits = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(shown, n, 0))]).astype(np.int32)), structs)
        which = np.nonzero(more)[1]
        cells = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(more.sum(axis=1))]).astype(np.int32)), pa.array(unit.cells[which].astype(np.int32))
        )
        again = more.any(axis=1)
        asked = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(again * s)]).astype(np.int32)), pa.array(q[again].reshape(-1)))
        means = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum((done & (n > 0)) * t)]).astype(np.int32)), pa.array(mean[done & (n > 0)].reshape(-1))
        )
        columns = [pa.array(np.full(len(q), u, dtype=np.int32)), pa.array(rid), means, hits, pa.array(~done | keep), pa.array(reach), cells, asked]
        return pa.Table.from_arrays(columns, schema=schema)

    spark = asking.sparkSession
    dealt = asking.mapInArrow(deal, "unit int, cell int, block int, grp int, rid bigint, q array<double>, far double, open boolean")
    tasks = sum(n * blocks[u].get(c, 0) for (u, c), n in groups.items())
    wide = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = max(1, min(tasks, wide, sum(int(u.n.sum()) for u in units) // TASK_ROWS))
    left, right = dealt.repartition(parts, *KEY), placed.repartition(parts, *KEY)
    return left.groupBy(*KEY).cogroup(right.groupBy(*KEY)).applyInArrow(find, FOUND)


def _round(asking: DataFrame, donors: DataFrame, units: list[Unit], p: int, k: int, last: bool) -> DataFrame:
    groups = {key: -(-n // ASKING_ROWS) for key, n in _numbers(asking, ["unit", "cell"]).items()}
    return _asked(asking, _placed(donors, units, p, k, groups), units, p, k, groups, last)


def plan(queries: DataFrame, donors: DataFrame, p: int, donor_rows: int) -> tuple[list[Unit], bool]:
    """Units with their cells, and whether rows of other patterns are left."""
    often = _patterns(queries, p).orderBy(F.desc("n"), "pattern").limit(MOST_UNITS + 1).collect()
    total = sum(r.n for r in often) if len(often) <= MOST_UNITS else queries.count()
    often = [r for r in often if r.top < LARGEST]
    pairs = _together(donors, p)
    units: list[Unit] = []
    covered, most = 0, max(1, min(UNIT_ROWS, UNIT_VALUES // p))
    for r in often:
        gaps = np.unpackbits(np.frombuffer(bytes(r.pattern), dtype=np.uint8))[:p].astype(bool)
        has, left = np.flatnonzero(~gaps), [j for j in np.flatnonzero(gaps) if pairs[j, j]]
        sets: list[list[int]] = []
        for j in left:
            same = next((s for s in sets if pairs[s[0], s[0]] == pairs[j, j] == pairs[s[0], j]), None)
            if same is None:
                sets.append(same := [])
            same.append(int(j))
        if len(units) + len(sets) > MOST_UNITS:
            break
        # Rows that have nothing have no neighbours.
        units += [Unit(bytes(r.pattern), has, np.array(s), most) for s in sets if len(has)]
        covered += r.n
    if covered < total:
        least = LEAST_SHARE * total
        large = {bytes(r.pattern) for r in often if r.n >= least}
        units = [u for u in units if u.pattern in large]
        covered = sum(r.n for r in often if bytes(r.pattern) in {u.pattern for u in units})
    if units:
        x = sampled(donors, donor_rows, p)
        for unit in units:
            own = x[~np.isnan(x[:, unit.wants[0]])]
            unit.tree = lay_out(own, unit.has, max(LEAST_SAMPLED, most * len(x) / max(donor_rows, 1)))
        _cells(donors, units, p)
        units = [u for u in units if len(u.cells)]
        rare = {bytes(r.pattern) for r in often if r.n <= FEW} & {u.pattern for u in units}
        if rare:
            few = queries.filter(_shape("q").isin([_text(b, p) for b in sorted(rare)])).select("q").toArrow()
            q = matrix(few.column(0).combine_chunks(), p)
            kind = [k.tobytes() for k in np.packbits(np.isnan(q), axis=1)]
            for unit in units:
                if unit.pattern in rare:
                    unit.few = q[[k == unit.pattern for k in kind]][:, unit.has]
    return units, covered < total


def answers(queries: DataFrame, donors: DataFrame, units: list[Unit], p: int, k: int) -> DataFrame:
    """(rid, cols, mean, hits) of the rows whose pattern is one of ``units``; hits where a row is ``open`` or took two rounds.

    ``queries`` has (rid, q, open), ``donors`` (donor, x).
    """
    of: dict[bytes, list[int]] = {}
    for u, unit in enumerate(units):
        of.setdefault(unit.pattern, []).append(u)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = matrix(batch.column(1), p)
            kinds, kind = np.unique(np.packbits(np.isnan(q), axis=1), axis=0, return_inverse=True)
            for i, pattern in enumerate(kinds):
                mine = np.flatnonzero(kind.reshape(-1) == i)
                for u in of.get(pattern.tobytes(), ()):
                    cell = units[u].tree.leaves(q[mine])
                    # A cell that the sample has and the donors have not: any other is a start.
                    cell = np.where(np.isin(cell, units[u].cells), cell, units[u].cells[0]).astype(np.int32)
                    own = batch.take(pa.array(mine))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(mine), u, dtype=np.int32)), pa.array(cell), own.column(0), lists(q[np.ix_(mine, units[u].has)]),
                         pa.array(np.full(len(mine), np.inf)), own.column(2)],
                        ["unit", "cell", "rid", "q", "far", "open"],
                    )

    asking = queries.select("rid", "q", "open").mapInArrow(ask, ASKING)
    first = stage(_round(asking, donors, units, p, k, False), "hits")
    wanted = F.lit(json.dumps([u.wants.tolist() for u in units]))
    cols = F.element_at(F.from_json(wanted, "array<array<int>>"), F.col("unit") + 1).alias("cols")
    done = first.filter(F.size("mean") > 0).select("rid", cols, "mean", F.when(F.col("open"), F.col("hits")).alias("hits"))
    if all(len(u.cells) == 1 and u.blocks()[int(u.cells[0])] == 1 for u in units):
        return done
    visits = first.filter(F.size("cells") > 0).select("unit", F.explode("cells").alias("cell"), "rid", "q", "far", F.lit(True).alias("open"))
    visits = stage(visits, "visits")
    second = _round(visits, donors, units, p, k, True)
    parts = first.filter(F.size("mean") == 0).select("unit", "rid", "hits").unionByName(second.select("unit", "rid", "hits"))
    merged = parts.filter(F.size("hits") > 0).groupBy("unit", "rid").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    merged = merged.select("rid", cols, F.slice(F.array_sort("hits"), 1, k).alias("hits"))
    return done.unionByName(merged.select("rid", "cols", mean_of("hits"), "hits"))


def mean_of(hits: str) -> Column:
    """Means of the values of hits, column by column."""
    return F.expr(
        f"transform(element_at({hits}, 1).v, (e, j) -> aggregate({hits}, 0D, (a, h) -> a + element_at(h.v, j + 1)) / size({hits}))"
    ).alias("mean")


def _text(pattern: bytes, p: int) -> str:
    return "".join(map(str, np.unpackbits(np.frombuffer(pattern, dtype=np.uint8))[:p]))


def _shape(q: str) -> Column:
    """Gaps of a vector as text."""
    return F.array_join(F.transform(q, lambda v: F.when(F.isnan(v), "1").otherwise("0")), "")


def of_units(units: list[Unit], p: int, q: str) -> Column:
    """Whether a vector has a pattern that ``units`` search."""
    return _shape(q).isin([_text(b, p) for b in sorted({u.pattern for u in units})])
