"""Trees over columns with missing values, and the exact search within one block of donors.

``CellTree`` deals rows to cells. ``search`` compares complete rows with donors that may lack columns: donors lie in leaves of
few rows with bounding boxes, rows that ask in groups of near ones. A group visits leaves by their lower bound until none can
hold one of its rows' k nearest; products of matrices leave few pairs for the exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

from scorelake.session import ship_by_value

ship_by_value(__name__)

LEAF_ROWS, GROUP_ROWS = 96, 64
#: Rows that lack the same columns have leaves of their own from this many on.
ALIKE_ROWS = 32
#: Donors of the first leaves that a group looks at; each further look takes twice as many.
FIRST_LOOK = 256
SLACK = 1.0 - 1e-9


class CellTree:
    """Splits by node: column (-1 at a leaf), cut, and the nodes of smaller, larger and missing values."""

    def __init__(self, column=(-1,), cut=(0.0,), below=(0,), above=(0,), gone=(0,)):
        self.column, self.cut = list(column), list(cut)
        self.below, self.above, self.gone = list(below), list(above), list(gone)

    def split(self, node: int, column: int, cut: float, above: bool, gone: bool) -> list[int]:
        """New leaves below ``node``. Without rows above or without missing ones, such values go with the smaller ones."""
        self.column[node], self.cut[node] = column, cut
        self.below[node] = self.above[node] = self.gone[node] = self._leaf()
        if above:
            self.above[node] = self._leaf()
        if gone:
            self.gone[node] = self._leaf()
        return sorted({self.below[node], self.above[node], self.gone[node]})

    def _leaf(self) -> int:
        for values, start in ((self.column, -1), (self.cut, 0.0), (self.below, 0), (self.above, 0), (self.gone, 0)):
            values.append(start)
        return len(self.column) - 1

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row."""
        column, cut, below, above, gone = (np.array(v) for v in (self.column, self.cut, self.below, self.above, self.gone))
        node, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while len(x) and (column[node] >= 0).any():
            v = x[rows, np.maximum(column[node], 0)]
            step = np.where(np.isnan(v), gone[node], np.where(v <= cut[node], below[node], above[node]))
            node = np.where(column[node] >= 0, step, node)
        return node

    def to_state(self) -> list:
        return [self.column, self.cut, self.below, self.above, self.gone]


def lay_out(x: np.ndarray, cols: Sequence[int], most: float) -> CellTree:
    """Tree over rows at hand: a node of more than ``most`` is split at the median of the column of ``cols`` that varies most."""
    tree, cols = CellTree(), np.asarray(cols, dtype=int)
    todo = [(0, np.arange(len(x)))] if len(cols) else []
    while todo:
        node, rows = todo.pop()
        if len(rows) <= most:
            continue
        v = x[np.ix_(rows, cols)]
        has = ~np.isnan(v)
        seen = has.sum(axis=0)
        lo, hi = np.where(has, v, np.inf).min(axis=0), np.where(has, v, -np.inf).max(axis=0)
        mean = np.where(has, v, 0.0).sum(axis=0) / np.maximum(seen, 1)
        spread = (np.where(has, v - mean, 0.0) ** 2).sum(axis=0)
        splits = np.where(lo < hi, 1 + spread, np.where((seen > 0) & (seen < len(rows)), 0.5, 0))
        if splits.max() <= 0:
            continue
        j = int(splits.argmax())
        known = np.sort(v[has[:, j], j])
        middle = known[(len(known) - 1) // 2]
        # Both sides have rows where values differ.
        cut = middle if lo[j] == hi[j] or middle < hi[j] else known[np.searchsorted(known, hi[j]) - 1]
        tree.split(node, int(cols[j]), float(cut), bool(lo[j] < hi[j]), bool(seen[j] < len(rows)))
        v = v[:, j]
        child = np.where(np.isnan(v), tree.gone[node], np.where(v <= cut, tree.below[node], tree.above[node]))
        todo += [(int(c), rows[child == c]) for c in np.unique(child)]
    return tree


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def lists(x: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(x).reshape(-1)))


def least_of_equal(x: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of rows without those that k equal rows with lower ids precede; a few more may stay."""
    bits = np.where(np.isnan(x), 1e300, x + 0.0).view(np.int64)
    mix = np.random.default_rng(7).integers(1, 1 << 62, x.shape[1]) | 1
    key = ((bits ^ (bits >> 29)) * mix).sum(axis=1)
    order = np.lexsort((ids, key))
    key, rows = key[order], bits[order]
    new = np.ones(len(x), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    same = np.flatnonzero(~new)
    new[same] = (rows[same] != rows[same - 1]).any(axis=1)
    start = np.maximum.accumulate(np.where(new, np.arange(len(x)), 0))
    return np.sort(order[np.arange(len(x)) - start < k])


def _boxed(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Places of rows in leaves of at most ``most``, halved along the longest side; equal rows stay together."""
    out, todo = [], [(np.arange(len(x)), x)]
    while todo:
        rows, v = todo.pop()
        if len(rows) > most:
            side = v.max(axis=0) - v.min(axis=0)
            j = int(side.argmax())
            if side[j] > 0:
                half = len(rows) // 2
                part = np.argpartition(v[:, j], half)
                todo += [(rows[p], v[p]) for p in (part[half:], part[:half])]
                continue
        if len(rows):
            out.append(rows)
    return out


def _donor_leaves(d: np.ndarray, has: np.ndarray) -> list[np.ndarray]:
    """Leaves of donors; rows that lack the same columns have their own where they are not too few."""
    kinds, kind, n = np.unique(np.packbits(has, axis=1), axis=0, return_inverse=True, return_counts=True)
    kind = kind.reshape(-1)
    often = np.flatnonzero(n >= ALIKE_ROWS)
    parts = [np.flatnonzero(kind == i) for i in often] + [np.flatnonzero(~np.isin(kind, often))]
    return [rows[leaf] for rows in parts if len(rows) for leaf in _boxed(d[rows], LEAF_ROWS)]


def apart(q: np.ndarray, d: np.ndarray, p: int) -> np.ndarray:
    """Distance over ``p`` columns of each row of ``q`` to the row of ``d`` beside it; inf if no column is shared."""
    total, shared = np.zeros(len(q)), np.zeros(len(q))
    for j in range(q.shape[1]):
        diff = q[:, j] - d[:, j]
        both = ~np.isnan(diff)
        total += np.where(both, diff * diff, 0.0)
        shared += both
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(shared > 0, total * p / shared, np.inf)


def _looks(q: np.ndarray, d: np.ndarray, p: int, k: int, most: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, place in ``d``) of pairs that hold the k nearest at most ``most`` apart, and few others, group by group."""
    has = ~np.isnan(d)
    centre = q.mean(axis=0)
    qs, ds = q - centre, np.where(has, d - centre, 0.0)
    leaves = _donor_leaves(ds, has)
    place = np.concatenate(leaves)
    size = np.array([len(leaf) for leaf in leaves])
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    has, ds = has[place], ds[place]
    always, shared = np.logical_and.reduceat(has, start, axis=0), has.sum(axis=1)
    lo = np.where(always, np.minimum.reduceat(ds, start, axis=0), -np.inf)
    hi = np.where(always, np.maximum.reduceat(ds, start, axis=0), np.inf)
    scale = p / np.maximum.reduceat(shared, start) * SLACK
    # One product of matrices is the distance, but for rounding.
    some = np.flatnonzero(~always.all(axis=0))
    whole = np.setdiff1d(np.arange(d.shape[1]), some)
    squares = (ds * ds).sum(axis=1)
    right = np.column_stack([-2.0 * ds, squares, np.ones(len(ds)), has[:, some]]) * (p / shared)[:, None]
    left = np.column_stack([qs, np.ones(len(qs)), (qs[:, whole] ** 2).sum(axis=1), qs[:, some] ** 2])
    room = (d.shape[1] + 10) * 1e-15 * p * ((qs * qs).sum(axis=1) + squares.max())
    for rows in _boxed(qs, GROUP_ROWS):
        a, reach, spare = left[rows], most[rows], room[rows]
        low, high = qs[rows].min(axis=0), qs[rows].max(axis=0)
        gap = np.maximum(np.maximum(lo - high, low - hi), 0.0)
        bound = (gap * gap).sum(axis=1) * scale
        order = np.argsort(bound, kind="stable")
        bound, held = bound[order], np.cumsum(size[order])
        best = np.full((len(rows), k), np.inf)
        at, look, kept = 0, max(FIRST_LOOK, 2 * k), []
        far = (reach + 2.0 * spare).max()
        while at < len(order) and bound[at] <= far:
            done = held[at - 1] if at else 0
            end = min(int(np.searchsorted(held, done + look)) + 1, int(np.searchsorted(bound, far, "right")))
            sizes = size[order[at:end]]
            who = np.repeat(start[order[at:end]] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            near = a @ right[who].T
            best = np.partition(np.concatenate([best, near], axis=1), k - 1, axis=1)[:, :k]
            reach = np.minimum(reach, best.max(axis=1) + spare)
            flat = np.flatnonzero(near <= (reach + spare)[:, None])
            row, column = np.divmod(flat, len(who))
            kept.append((row, who[column], near.reshape(-1)[flat]))
            far, at, look = (reach + 2.0 * spare).max(), end, 2 * look
        if kept:
            row, who, near = (np.concatenate(v) for v in zip(*kept, strict=True))
            fine = near <= (reach + spare)[row]
            yield rows[row[fine]], place[who[fine]]


def search(
    q: np.ndarray, d: np.ndarray, donor: np.ndarray, p: int, k: int, most: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in ``d``, distance) of the k nearest of each row, at most ``most`` apart, ties to the lower donor.

    Rows of ``q`` are complete, each donor has one of their columns at least.
    """
    kept = least_of_equal(d, donor, k)
    found = [(np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0))]
    for row, who in _looks(q, d[kept], p, k, most) if len(kept) and len(q) else ():
        at = kept[who]
        d2 = apart(q[row], d[at], p)
        fine = d2 <= most[row]
        row, at, d2 = row[fine], at[fine], d2[fine]
        order = np.lexsort((donor[at], d2, row))
        row, at, d2 = row[order], at[order], d2[order]
        top = np.arange(len(row)) - np.searchsorted(row, row) < k
        found.append((row[top], at[top], d2[top]))
    row, at, d2 = (np.concatenate(v) for v in zip(*found, strict=True))
    order = np.argsort(row, kind="stable")
    return row[order], at[order], d2[order]
