"""A K2-treap: a compressed quadtree over a sparse grid of rows and columns whose cells know the greatest value below them.

The grid is halved in both directions from level to level. Only cells that hold something are kept, from the root on, each level in
Z order: which of its four quarters a cell holds (four bits), and a bound of the values below it (one byte, rounded upwards). The
cells of the last level are the values. The path of a row through the levels meets one cell for each range of columns.
"""

from __future__ import annotations

import numpy as np

_ONES = np.array([n.bit_count() for n in range(16)], np.int64)


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of 32-bit numbers, with a zero before each."""
    x = x.astype(np.uint64)
    for shift in (16, 8, 4, 2, 1):
        mask = sum(((1 << shift) - 1) << at for at in range(0, 64, 2 * shift))
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


class Treap:
    """masks: the quarters of all inner cells; bounds: of the same cells, in units of ``step``; values: of the cells of the last level."""

    def __init__(self, height: int, masks: np.ndarray, bounds: np.ndarray, values: np.ndarray, step: int):
        self.height, self.masks, self.bounds, self.values, self.step = height, masks, bounds, values, step
        ones = _ONES[masks]
        # cells are numbered level by level, so that the first quarter of a cell follows all quarters of the cells before it
        self.children = 1 + np.cumsum(ones) - ones
        self.most = np.concatenate([bounds.astype(np.int64) * step, values.astype(np.int64)])

    @staticmethod
    def build(rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> Treap:
        """The treap of distinct points, at least one. Bounds are in 255ths of the greatest value."""
        height = max(1, int(max(rows.max(), columns.max())).bit_length())
        code = _spread(rows) << np.uint64(1) | _spread(columns)
        order = np.argsort(code, kind="stable")
        code, values = code[order], values[order]
        step = int(values.max()) // 255 + 1
        masks, bounds, below = [], [], values
        for _ in range(height):
            parent = code >> np.uint64(2)
            first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
            quarter = np.left_shift(1, (code & np.uint64(3)).astype(np.uint8)).astype(np.uint8)
            masks.append(np.bitwise_or.reduceat(quarter, first))
            below = np.maximum.reduceat(below, first)
            bounds.append((-(-below // step)).astype(np.uint8))
            code = parent[first]
        return Treap(height, np.concatenate(masks[::-1]), np.concatenate(bounds[::-1]), values, step)

    def halves(self, level: np.ndarray, rows: np.ndarray, cells: np.ndarray) -> list[np.ndarray]:
        """One step down the paths of ``rows`` from cells of these levels: the cells in the left and the right half of the columns, -1 for none."""
        bit = (rows >> (self.height - 1 - level) & 1) << 1
        masks, children = self.masks[cells].astype(np.int64), self.children[cells]
        found = []
        for quarter in (bit, bit | 1):
            place = children + _ONES[masks & ((1 << quarter) - 1)]
            found.append(np.where(masks >> quarter & 1, place, -1))
        return found


def smallest_places(places: np.ndarray, height: int) -> np.ndarray:
    """The smallest of the places of the columns in each range: range ``k`` of level ``l`` is at 2**l - 1 + k."""
    level = np.full(1 << height, np.iinfo(np.int64).max)
    level[: len(places)] = places
    levels = [level]
    for _ in range(height):
        level = level.reshape(-1, 2).min(1)
        levels.append(level)
    return np.concatenate(levels[::-1])


def _spans(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each begin to its end, and which span each is of."""
    size = end - begin
    owner = np.repeat(np.arange(len(size)), size)
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + begin[owner], owner


def best_columns(
    treap: Treap, owner: np.ndarray, rows: np.ndarray, weights: np.ndarray, smallest: np.ndarray, most: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every query the ``most`` columns with the greatest sums of weight times value over the query's rows.

    ``owner`` numbers the query that each of ``rows`` with its weight (not negative) belongs to, in ascending order. The paths of
    a query's rows descend jointly, best first: a range of columns is bounded by the sum of the weighted bounds of its cells, and
    the ranges with the greatest bounds are halved until the first ``most`` are single columns; a range that stands behind as many
    single columns is given up. Of equal sums the column with the smaller place wins (``smallest_places``). Sums are exact; only those
    above 0 count. All queries take their steps together.

    Returns (query, column, sum).
    """
    # The paths of all ranges met so far, one behind the other: which of ``rows`` (a slot) and the cell it has come to.
    slots, cells = np.arange(len(rows)), np.zeros(len(rows), np.int64)
    # The ranges still open: query, level, number at that level, bound, smallest place and where their paths stand.
    query = np.unique(owner)
    begin, end = np.searchsorted(owner, query), np.searchsorted(owner, query, "right")
    bound = np.array([int((weights[b:e] * treap.most[0]).sum()) for b, e in zip(begin, end)], np.int64)
    level, number, place = (np.zeros(len(query), np.int64) for _ in range(3))
    found = []
    while len(query):
        positive = bound > 0
        order = np.lexsort((place, -bound, query))
        order = order[positive[order]]
        query, level, number, bound, place, begin, end = (x[order] for x in (query, level, number, bound, place, begin, end))
        if not len(query):
            break
        first = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
        size = np.diff(np.append(first, len(query)))
        rank = np.arange(len(query)) - np.repeat(first, size)
        single = level == treap.height
        leading = rank < most
        waits = np.add.reduceat((leading & ~single).astype(np.int64), first) > 0
        busy = np.repeat(waits, size)
        out = leading & ~busy
        found.append((query[out], number[out], bound[out]))
        # single columns before each range of its query: behind ``most`` of them nothing can come in
        before = np.cumsum(single) - single
        before -= np.repeat(before[first], size)
        stays = busy & (before < most)
        split = np.flatnonzero(stays & leading & ~single)
        stays &= ~leading | single
        path, of = _spans(begin[split], end[split])
        slot = slots[path]
        parts, new_paths, done = [[x[stays] for x in (query, level, number, bound, place, begin, end)]], [], len(slots)
        for side, cell in enumerate(treap.halves(level[split][of], rows[slot], cells[path])):
            held = cell >= 0
            if not held.any():
                continue
            inner, inner_slot, inner_cell = of[held], slot[held], cell[held]
            start = np.flatnonzero(np.append(True, inner[1:] != inner[:-1]))
            at = split[inner[start]]
            stop = np.append(start[1:], len(inner))
            sums = np.add.reduceat(weights[inner_slot] * treap.most[inner_cell], start)
            below, half = level[at] + 1, number[at] * 2 + side
            parts.append([query[at], below, half, sums, smallest[(1 << below) - 1 + half], done + start, done + stop])
            new_paths.append((inner_slot, inner_cell))
            done += len(inner)
        query, level, number, bound, place, begin, end = (np.concatenate(x) for x in zip(*parts))
        slots, cells = (np.concatenate([old, *new]) for old, new in zip((slots, cells), zip(*new_paths) if new_paths else ((), ())))
        if len(slots) > 4 * int((end - begin).sum()) + 100_000:  # most paths belong to ranges that are gone
            path, of = _spans(begin, end)
            slots, cells, size = slots[path], cells[path], end - begin
            end = np.cumsum(size)
            begin = end - size
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))
