"""Which points of many lines lie near a line: shares of length for whole blocks of shapes, exact.

The surroundings of lines are cut into square cells, the same for all lines of a block, and halved where a cell is neither
wholly within the tolerance of a segment nor wholly beyond it. Sampled points are sorted by cell once; those in cells within
the tolerance count, and those in cells that stayed undecided are measured against the segments that left them so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Cells to a tolerance, their least side in metres, at most MOST across.
FINE, SIDE, MOST = 16, 0.5, 2048
#: Cells across at first, about; cells, points, and distances that are worked on at once.
COARSE, CELLS, POINTS, AT_ONCE = 32, 1 << 22, 1 << 21, 1 << 16
#: Cells to a tolerance and at most across where shares are bounded; what rounding may add to a sum of them in single precision.
ROUGH, FEW_CELLS, SLACK = 4, 64, 1e-3
#: Distances of a line below which it is measured without cells.
FEW = 1 << 16


class Lines:
    """Segments of shapes, end to end; a shape is a list of lines (n, 2)."""

    def __init__(self, shapes: list[list[np.ndarray]]):
        lines = [[line for line in shape if len(line) > 1] for shape in shapes]
        count = np.array([sum(len(line) - 1 for line in shape) for shape in lines], int)
        flat = [line for shape in lines for line in shape]
        self.start = np.concatenate([line[:-1] for line in flat]) if flat else np.zeros((0, 2))
        self.step = np.concatenate([np.diff(line, axis=0) for line in flat]) if flat else np.zeros((0, 2))
        self.at = np.concatenate([[0], np.cumsum(count)])
        self.n = len(shapes)

    def segments(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        return self.start[self.at[k] : self.at[k + 1]], self.step[self.at[k] : self.at[k + 1]]

    def some(self, shapes: np.ndarray) -> Lines:
        """Only those shapes, in their order."""
        out = object.__new__(Lines)
        n = np.diff(self.at)[shapes]
        pick = ranges(self.at[shapes], n)
        out.start, out.step, out.at, out.n = self.start[pick], self.step[pick], np.concatenate([[0], np.cumsum(n)]), len(shapes)
        return out

    def counts(self, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
        """(sampled points, length) of each segment."""
        spacing = max(0.75, min(3.0, tolerance / 4 or 1.0))
        length = np.hypot(self.step[:, 0], self.step[:, 1])
        n = np.maximum(1, np.ceil(length / spacing)).astype(int)
        n[length <= 0] = 0
        return n, length

    def sampled(self, tolerance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(x, y, length each stands for, where each shape's begin, length of each shape) of evenly spaced middle points."""
        n, length = self.counts(tolerance)
        seg = np.repeat(np.arange(len(n)), n)
        t = (np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n) + 0.5) / n[seg]
        p = self.start[seg] + self.step[seg] * t[:, None]
        whole = np.array([length[a:b].sum() for a, b in zip(self.at[:-1], self.at[1:], strict=True)])
        return np.ascontiguousarray(p[:, 0]), np.ascontiguousarray(p[:, 1]), (length / np.maximum(n, 1))[seg], np.concatenate([[0], np.cumsum(n)])[self.at], whole


def ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Numbers of ranges, one after the other."""
    ends = np.cumsum(n)
    return np.repeat(first - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)


def once(places: np.ndarray, writer: np.ndarray) -> np.ndarray:
    """True where a place is given for the last time; ``writer`` holds a number for each place, whatever it was."""
    number = np.arange(len(places), dtype=writer.dtype)
    writer[places] = number
    return writer[places] == number


def distance(x: np.ndarray, y: np.ndarray, start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Distances of points from the nearest of some segments."""
    qx, qy, vx, vy = (np.ascontiguousarray(c)[:, None] for c in (*start.T, *step.T))
    out = np.empty(len(x))
    rows = max(1, AT_ONCE // len(qx))
    for at in range(0, len(x), rows):  # points run innermost, as there are far more of them
        out[at : at + rows] = np.sqrt(squares(x[at : at + rows] - qx, y[at : at + rows] - qy, vx, vy).min(0))
    return out


def squares(dx: np.ndarray, dy: np.ndarray, vx: np.ndarray, vy: np.ndarray) -> np.ndarray:
    """Squared distances of points from segments; (dx, dy) lead from a segment's start to the point, and are used up."""
    square = vx * vx + vy * vy
    along = dx * vx
    along += dy * vy
    along /= np.where(square > np.finfo(float).eps, square, np.inf)  # a segment without length is its point
    np.clip(along, 0, 1, out=along)
    dx -= along * vx
    dy -= along * vy
    dx *= dx
    dy *= dy
    dx += dy
    return dx


class Grid:
    """Square cells, counted by columns, around some lines."""

    def __init__(self, lines: Lines, tolerance: float, fine: int, most: int):
        ends = np.concatenate([lines.start, lines.start + lines.step])
        self.low, high = ends.min(0) - tolerance, ends.max(0) + tolerance
        side = float((high - self.low).max())
        self.h = max(tolerance / fine, SIDE, side / most)
        n = np.floor((high - self.low) / self.h).astype(int) + 1
        self.halvings = int(max(0, np.ceil(np.log2(n.max() / COARSE))))
        whole = 1 << self.halvings
        self.nx, self.ny = (int(v) for v in -(-n // whole) * whole)
        # more than rounding can move a place
        self.slack = 1e-9 * (side + float(np.abs(ends).max()))

    def cells(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Cells of points; one more than there are for points outside."""
        i, j = np.floor((x - self.low[0]) / self.h), np.floor((y - self.low[1]) / self.h)
        inside = (i >= 0) & (i < self.nx) & (j >= 0) & (j < self.ny)
        return np.where(inside, i * self.ny + j, self.nx * self.ny).astype(np.int64)

    def around(self, lines: Lines, tolerance: float) -> Iterator[tuple[int, int, tuple[np.ndarray, ...], tuple[np.ndarray, ...]]]:
        """(first shape, last, runs (shape, cell, number) of cells within the tolerance, (shape, cell, segment) of undecided ones)."""
        at_once = max(1, CELLS // (self.nx * self.ny))
        self.within, self.writer = np.zeros(at_once * self.nx * self.ny, bool), np.empty(at_once * self.nx * self.ny, np.int32)
        for first in range(0, lines.n, at_once):
            last = min(lines.n, first + at_once)
            yield first, last, *self._around(lines, first, last, tolerance)

    def _around(self, lines: Lines, first: int, last: int, tolerance: float) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
        a, b = lines.at[first], lines.at[last]
        start, step = lines.start[a:b], lines.step[a:b]
        shape = np.repeat(np.arange(last - first), np.diff(lines.at[first : last + 1]))
        size = self.h * (1 << self.halvings)
        low = np.maximum(0, np.floor((np.minimum(start, start + step) - tolerance - self.slack - self.low) / size).astype(int))
        n = np.floor((np.maximum(start, start + step) + tolerance + self.slack - self.low) / size).astype(int) + 1
        n = np.minimum(n, [self.nx >> self.halvings, self.ny >> self.halvings]) - low
        seg = np.repeat(np.arange(len(start)), n[:, 0] * n[:, 1])
        place = ranges(np.zeros(len(n), int), n[:, 0] * n[:, 1])
        i, j = low[seg, 0] + place // n[seg, 1], low[seg, 1] + place % n[seg, 1]
        runs = []
        for k in range(self.halvings, -1, -1):
            size, wide, high = self.h * (1 << k), self.nx >> k, self.ny >> k
            qx, qy, vx, vy = (np.ascontiguousarray(c)[seg] for c in (*start.T, *step.T))
            d = np.sqrt(squares(self.low[0] + (i + 0.5) * size - qx, self.low[1] + (j + 0.5) * size - qy, vx, vy))
            reach = size * 0.7071067811865476 + self.slack
            key = (shape[seg] * wide + i) * high + j
            found = key[d + reach <= tolerance]
            found = found[once(found, self.writer)]
            self.within[found] = True
            column = (found // high % wide << k)[:, None] + np.arange(1 << k)
            runs.append((np.repeat(found // (wide * high), 1 << k), (column * self.ny + (found % high << k)[:, None]).ravel(), np.full(len(found) << k, 1 << k)))
            keep = np.flatnonzero((d - reach <= tolerance) & ~self.within[key])
            self.within[found] = False
            seg, i, j = seg[keep], i[keep], j[keep]
            if k:
                seg, i, j = np.repeat(seg, 4), (2 * i[:, None] + [0, 0, 1, 1]).ravel(), (2 * j[:, None] + [0, 1, 0, 1]).ravel()
        of, cell, n = (np.concatenate(c) for c in zip(*runs, strict=True))
        order = np.argsort(of, kind="stable")
        owner, open_ = shape[seg], i * self.ny + j
        by_cell = np.argsort(owner * (self.nx * self.ny) + open_, kind="stable")
        return (of[order], cell[order], n[order]), (owner[by_cell], open_[by_cell], a + seg[by_cell])


def _parts(n: np.ndarray, most: int) -> Iterator[slice]:
    """Slices whose numbers add up to about ``most``, at least one each."""
    cut = np.flatnonzero(np.diff(np.cumsum(n) // most)) + 1
    for a, b in zip([0, *cut], [*cut, len(n)], strict=True):
        if b > a:
            yield slice(a, b)


def shares(of: Lines, to: Lines, wanted: np.ndarray, tolerance: float) -> np.ndarray:
    """Share of the length of each shape ``of`` within the tolerance of each shape ``to``, where ``wanted`` (of, to); else 0."""
    out = np.zeros((of.n, to.n))
    counts = np.concatenate([[0], np.cumsum(of.counts(tolerance)[0])])
    count = np.diff(counts[of.at])
    rows, columns = np.flatnonzero(wanted.any(1) & (count > 0)), np.flatnonzero(wanted.any(0) & (np.diff(to.at) > 0))
    if not len(rows) or not len(columns):
        return out
    to = to.some(columns)
    for part in _parts(count[rows], POINTS):
        some = rows[part]
        near = _near(of.some(some), to, tolerance)
        out[np.ix_(some, columns)] = np.where(wanted[np.ix_(some, columns)], near, 0.0)
    return out


def _near(of: Lines, to: Lines, tolerance: float) -> np.ndarray:
    x, y, weight, at, whole = of.sampled(tolerance)
    if len(x) * len(to.start) <= FEW * to.n:
        inside = (weight * (distance(x, y, *to.segments(b)) <= tolerance) for b in range(to.n))
        return np.minimum(1.0, np.stack([np.add.reduceat(w, at[:-1]) for w in inside], 1) / whole[:, None])
    out = np.zeros((to.n, of.n))
    grid = Grid(to, tolerance, FINE, MOST)
    cell = grid.cells(x, y)
    order = np.argsort(cell, kind="stable")
    x, y, weight, shape = x[order], y[order], weight[order], np.repeat(np.arange(of.n), np.diff(at))[order]
    begin = np.concatenate([[0], np.cumsum(np.bincount(cell, minlength=grid.nx * grid.ny + 1))])
    qx, qy, vx, vy = (np.ascontiguousarray(c) for c in (*to.start.T, *to.step.T))
    seen = np.empty(len(x), np.int32)

    def add(b: int, points: np.ndarray) -> None:
        out[b] += np.bincount(shape[points], weight[points], of.n)

    for first, last, (owner, run, length), (open_owner, open_cell, segment) in grid.around(to, tolerance):
        low = begin[run]
        n = begin[run + length] - low
        open_low = begin[open_cell]
        open_n = begin[open_cell + 1] - open_low
        ends, open_ends = (np.searchsorted(o, np.arange(last - first + 1)) for o in (owner, open_owner))
        for b in range(first, last):
            add(b, ranges(low[ends[b - first] : ends[b - first + 1]], n[ends[b - first] : ends[b - first + 1]]))
            mine = np.arange(open_ends[b - first], open_ends[b - first + 1])
            mine = mine[open_n[mine] > 0]
            # the undecided segments of a cell follow each other, and so stay in one part
            same = np.cumsum(np.concatenate([[0], np.diff(open_cell[mine]) != 0])) if len(mine) else mine
            for part in _parts(np.bincount(same, open_n[mine]) if len(mine) else same, 4 * AT_ONCE):
                these = mine[(same >= part.start) & (same < part.stop)]
                points, seg = ranges(open_low[these], open_n[these]), np.repeat(segment[these], open_n[these])
                hit = points[np.sqrt(squares(x[points] - qx[seg], y[points] - qy[seg], vx[seg], vy[seg])) <= tolerance]
                add(b, hit[once(hit, seen)])
    return np.minimum(1.0, out.T / whole[:, None])


class Rough:
    """Bounds of the shares of all pairs by products of matrices over large cells, and exact shares of some pairs."""

    def __init__(self, of: Lines, to: Lines, tolerance: float):
        self.of, self.to, self.tolerance = of, to, tolerance
        self.grid = Grid(to, tolerance, ROUGH, FEW_CELLS)
        self.cells = self.grid.nx * self.grid.ny + 1
        points = np.concatenate([[0], np.cumsum(of.counts(tolerance)[0])])
        self.count = np.diff(points[of.at])
        self.inside, self.open = np.zeros((to.n, self.cells), bool), np.zeros((to.n, self.cells), bool)
        keys, segments = [np.zeros(0, int)], [np.zeros(0, int)]
        for first, _, (owner, run, length), (open_owner, open_cell, segment) in self.grid.around(to, tolerance):
            self.inside[first + np.repeat(owner, length), ranges(run, length)] = True
            self.open[first + open_owner, open_cell] = True
            keys.append((first + open_owner) * self.cells + open_cell)
            segments.append(segment)
        self.segment = np.concatenate(segments)
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(np.concatenate(keys), minlength=to.n * self.cells))])

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """(share that may lie beyond the tolerance, share that may lie within it), within SLACK; nothing beyond is exactly 0."""
        held = np.zeros((self.of.n, self.cells), np.float32)
        for part in _parts(np.maximum(1, self.count), POINTS):
            x, y, weight, at, whole = self.of.some(np.arange(self.of.n)[part]).sampled(self.tolerance)
            n = len(whole)
            place = np.repeat(np.arange(n), np.diff(at)) * self.cells + self.grid.cells(x, y)
            sums = np.bincount(place, weight, n * self.cells).reshape(n, self.cells)
            held[part] = sums / np.where(whole > 0, whole, 1.0)[:, None]
        return held @ (~self.inside).T.astype(np.float32), held @ (self.inside | self.open).T.astype(np.float32)

    def exact(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Shares of pairs (of, to)."""
        out = np.zeros(len(a))
        qx, qy, vx, vy = (np.ascontiguousarray(c) for c in (*self.to.start.T, *self.to.step.T))
        for part in _parts(np.maximum(1, self.count[a]), POINTS // 8):
            x, y, weight, at, whole = self.of.some(a[part]).sampled(self.tolerance)
            pair = np.repeat(np.arange(len(whole)), np.diff(at))
            key = b[part][pair] * self.cells + self.grid.cells(x, y)
            near = self.inside.ravel()[key]
            asked = np.flatnonzero(self.open.ravel()[key])
            n = self.begin[key[asked] + 1] - self.begin[key[asked]]
            for some in _parts(n, 4 * AT_ONCE):
                points, seg = np.repeat(asked[some], n[some]), self.segment[ranges(self.begin[key[asked[some]]], n[some])]
                near[points[np.sqrt(squares(x[points] - qx[seg], y[points] - qy[seg], vx[seg], vy[seg])) <= self.tolerance]] = True
            out[part] = np.minimum(1.0, np.bincount(pair, weight * near, len(whole)) / np.where(whole > 0, whole, 1.0))
        return out
