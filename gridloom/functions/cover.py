"""Which cells of a grid a footprint covers, and by how much."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from .geometry import Geometry, Shapes, shapes_of

#: Cells of the shapes' boxes that are looked at together.
CELLS = 1 << 19
CONVENTIONS = ("centroid", "all_touched", "area_weighted")


@dataclass
class Axis:
    """Cell centres along one dimension, in either direction, and the width of a cell."""

    centres: np.ndarray
    step: float | None = None

    def __post_init__(self):
        n = self.centres.size
        steps = np.diff(self.centres)
        self.rising = bool((steps > 0).all())
        self.monotonic = self.rising or bool((steps < 0).all())
        self.order = np.argsort(self.centres, kind="stable")
        self.sorted = self.centres[self.order]
        if self.step is None:
            # A single cell has no neighbour to tell its width from.
            self.step = float(self.sorted[-1] - self.sorted[0]) / (n - 1) if n > 1 else 0.0

    def clip(self, a: np.ndarray, b: np.ndarray, window: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Places within a half-open window of indices."""
        n = self.centres.size
        low, high = window if self.rising else (n - window[1], n - window[0])
        return np.maximum(a, low), np.minimum(b, high)

    def span(self, low: np.ndarray, high: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """Places, in rising order of the centres, of the cells within a margin of each range; half-open."""
        return np.searchsorted(self.sorted, low - margin, "left"), np.searchsorted(self.sorted, high + margin, "right")

    def near(self, low: float, high: float, margin: float) -> np.ndarray:
        """Indices of cells whose centre is within a margin of the range."""
        a, b = self.span(np.array([low]), np.array([high]), margin)
        return self.order[a[0] : b[0]]


def margins(convention: str, ys: Axis, xs: Axis) -> tuple[float, float]:
    half = 0.0 if convention == "centroid" else 0.5
    return half * ys.step, half * xs.step


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the counted items its owner, and its number within the owner."""
    which = np.repeat(np.arange(counts.size), counts)
    return which, np.arange(which.size) - np.repeat(np.cumsum(counts) - counts, counts)


@dataclass
class Field:
    """The cells of some shapes' boxes, row by row and shape by shape, as places of flat arrays."""

    y0: np.ndarray  # each shape's first row, columns and rows
    x0: np.ndarray
    ny: np.ndarray
    nx: np.ndarray

    def __post_init__(self):
        counts = self.ny * self.nx
        self.base = np.cumsum(counts) - counts
        self.size = int(counts.sum())

    def at(self, shape: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        return self.base[shape] + (row - self.y0[shape]) * self.nx[shape] + column - self.x0[shape]

    def along_rows(self, values: np.ndarray, backwards: bool = False) -> np.ndarray:
        """Running sums that start anew in each row."""
        widths = np.repeat(self.nx, self.ny)
        ends = np.cumsum(widths)
        if backwards:
            sums = np.cumsum(values[::-1])[::-1]
            after = np.append(sums, 0.0)[ends]
            return sums - np.repeat(after, widths)
        sums = np.cumsum(values)
        before = np.concatenate([[0], sums])[ends - widths]
        return sums - np.repeat(before, widths)


def cover_many(
    shapes: list[Geometry] | Shapes,
    ys: Axis,
    xs: Axis,
    convention: str,
    rows: tuple[int, int] | None = None,
    columns: tuple[int, int] | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(shape, iy, ix, weight) of the cells that each shape covers, in parts of bounded size.

    centroid: the centre is inside.  all_touched: the closed cell meets the
    closed footprint.  area_weighted: as that, the weight being the common
    area.  ``rows`` and ``columns`` are half-open windows of indices.  A
    shape's cells come together, unless it alone has more than a part.

    Each row of cells looks at the edges that cross it only, so the work grows
    with a shape's outline and its cells, not with their product.
    """
    if not isinstance(shapes, Shapes):
        shapes = shapes_of(shapes)
    known = shapes.known()
    if not known.size or (convention != "centroid" and not (ys.step and xs.step)):
        return
    edge = shapes.box[known]
    my, mx = margins(convention, ys, xs)
    y0, y1 = ys.span(edge[:, 1], edge[:, 3], my)
    x0, x1 = xs.span(edge[:, 0], edge[:, 2], mx)
    # A window of indices is one of places too, as an axis only ever rises or falls.
    if rows is not None and ys.monotonic:
        y0, y1 = ys.clip(y0, y1, rows)
    if columns is not None and xs.monotonic:
        x0, x1 = xs.clip(x0, x1, columns)
    ny, nx = np.maximum(y1 - y0, 0), np.maximum(x1 - x0, 0)
    counts = ny * nx
    todo = np.flatnonzero(counts)
    start = 0
    while start < todo.size:
        stop = start + max(1, int(np.searchsorted(np.cumsum(counts[todo[start:]]), CELLS, "right")))
        some = todo[start:stop]
        start = stop
        # A shape that is too large alone goes by stretches of its rows.
        k = int(some[0])
        step = max(1, CELLS // int(nx[k])) if some.size == 1 else 0
        stretches = [(a, min(a + step, int(y1[k]))) for a in range(int(y0[k]), int(y1[k]), step)] if step and counts[k] > CELLS else [None]
        for stretch in stretches:
            low, high = (y0[some], ny[some]) if stretch is None else (np.array([stretch[0]]), np.array([stretch[1] - stretch[0]]))
            field = Field(low, x0[some], high, nx[some])
            found, weight = _cells(shapes, known[some], field, ys, xs, convention)
            which = np.searchsorted(field.base, found, "right") - 1
            local = found - field.base[which]
            iy, ix = ys.order[field.y0[which] + local // field.nx[which]], xs.order[field.x0[which] + local % field.nx[which]]
            keep = np.ones(iy.size, bool)
            if rows is not None and not ys.monotonic:
                keep &= (iy >= rows[0]) & (iy < rows[1])
            if columns is not None and not xs.monotonic:
                keep &= (ix >= columns[0]) & (ix < columns[1])
            if not keep.all():
                which, iy, ix, weight = which[keep], iy[keep], ix[keep], weight[keep]
            if which.size:
                yield known[some][which], iy, ix, weight


def _cells(shapes: Shapes, some: np.ndarray, field: Field, ys: Axis, xs: Axis, convention: str) -> tuple[np.ndarray, np.ndarray]:
    """Places in the field of the cells that the shapes cover, and their weights."""
    own, local = spread(shapes.start[some + 1] - shapes.start[some])
    edges = shapes.start[some][own] + local
    half = 0.0 if convention == "centroid" else ys.step / 2
    lower, upper = np.minimum(shapes.y1[edges], shapes.y2[edges]), np.maximum(shapes.y1[edges], shapes.y2[edges])
    first = np.maximum(np.searchsorted(ys.sorted, lower - half, "left"), field.y0[own])
    last = np.minimum(np.searchsorted(ys.sorted, upper + half, "right"), field.y0[own] + field.ny[own])
    part, row = spread(np.maximum(last - first, 0))
    row += first[part]
    own, edges = own[part], edges[part]
    x1, y1, x2, y2 = shapes.x1[edges], shapes.y1[edges], shapes.x2[edges], shapes.y2[edges]
    if convention == "centroid":
        inside = _centres(field, own, row, x1, y1, x2, y2, ys, xs)
        found = np.flatnonzero(inside)
        return found, np.ones(found.size)
    return _areas(field, own, row, x1, y1, x2, y2, shapes.turn[edges], ys, xs, convention == "area_weighted")


def _centres(field: Field, own, row, x1, y1, x2, y2, ys: Axis, xs: Axis) -> np.ndarray:
    """Which centres are inside: those with an odd number of edges on their left; on the outline they aren't."""
    y = ys.sorted[row]
    crossing = (y1 > y) != (y2 > y)
    o, r = own[crossing], row[crossing]
    ax, ay, bx, by, at = x1[crossing], y1[crossing], x2[crossing], y2[crossing], y[crossing]
    x = np.where(at == ay, ax, np.where(at == by, bx, ax + (at - ay) * ((bx - ax) / (by - ay))))
    first = np.searchsorted(xs.sorted, x, "right")
    low, high = field.x0[o], field.x0[o] + field.nx[o]
    there = first < high
    turns = np.bincount(field.at(o[there], r[there], np.maximum(first, low)[there]), minlength=field.size)
    inside = (field.along_rows(turns) & 1).astype(bool)
    # A centre on a crossing, or on an edge along its row, is on the outline.
    on = (first > low) & (first <= high) & (xs.sorted[np.maximum(first - 1, 0)] == x)
    inside[field.at(o[on], r[on], first[on] - 1)] = False
    flat = np.flatnonzero((y1 == y) | (y2 == y))
    if flat.size:
        level = y1[flat] == y2[flat]
        left = np.where(level, np.minimum(x1[flat], x2[flat]), np.where(y1[flat] == y[flat], x1[flat], x2[flat]))
        right = np.where(level, np.maximum(x1[flat], x2[flat]), left)
        a = np.maximum(np.searchsorted(xs.sorted, left, "left"), field.x0[own[flat]])
        b = np.minimum(np.searchsorted(xs.sorted, right, "right"), field.x0[own[flat]] + field.nx[own[flat]])
        part, column = spread(np.maximum(b - a, 0))
        inside[field.at(own[flat][part], row[flat][part], column + a[part])] = False
    return inside


def _areas(field: Field, own, row, x1, y1, x2, y2, turn, ys: Axis, xs: Axis, weigh: bool) -> tuple[np.ndarray, np.ndarray]:
    """Cells that meet the shapes, and the common area.

    Within a row of cells, the area left of an edge's part in it counts with
    the sign of its direction.  Cells that the part runs through get their own
    share; all cells on its left are full under it, which a running sum adds.
    """
    hy, hx = ys.step / 2, xs.step / 2
    width = 2 * hx
    bottom, top = np.maximum(np.minimum(y1, y2), ys.sorted[row] - hy), np.minimum(np.maximum(y1, y2), ys.sorted[row] + hy)
    run = np.where(y1 == y2, 1.0, y2 - y1)

    def x_at(y):
        return np.where(y == y1, x1, np.where(y == y2, x2, x1 + (y - y1) * ((x2 - x1) / run)))

    level = y1 == y2
    xa, xb = np.where(level, x1, x_at(bottom)), np.where(level, x2, x_at(top))
    rise = np.where(level, 0.0, np.maximum(top - bottom, 0)) * turn * np.sign(y2 - y1)
    left, right = np.minimum(xa, xb), np.maximum(xa, xb)
    low, high = field.x0[own], field.x0[own] + field.nx[own]
    a, b = np.searchsorted(xs.sorted, left - hx, "left"), np.searchsorted(xs.sorted, right + hx, "right")
    full = np.minimum(a, high) - 1
    there = (full >= low) & (rise != 0)
    filled = np.bincount(field.at(own[there], row[there], full[there]), rise[there] * width, field.size)
    area = field.along_rows(filled, backwards=True)

    part, column = spread(np.maximum(np.minimum(b, high) - np.maximum(a, low), 0))
    column += np.maximum(a, low)[part]
    at = field.at(own[part], row[part], column)
    origin = xs.sorted[column] - hx
    p, q = left[part] - origin, right[part] - origin
    # The mean over the part of its distance from the cell's left side, held to the cell's width.
    inner_p, inner_q = np.clip(p, 0, width), np.clip(q, 0, width)
    grown = (inner_q**2 - inner_p**2) / 2 + (np.maximum(q - width, 0) - np.maximum(p - width, 0)) * width
    steep = q - p < 1e-12 * width
    mean = np.where(steep, (inner_p + inner_q) / 2, grown / np.where(steep, 1, q - p))
    area += np.bincount(at, rise[part] * mean, field.size)
    touched = area > 0.5 * width * 2 * hy
    touched[at] = True
    found = np.flatnonzero(touched)
    return found, np.clip(area[found], 0, width * 2 * hy) if weigh else np.ones(found.size)


def cover(geometry: Geometry, ys: Axis, xs: Axis, convention: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(iy, ix, weight) of the cells that one shape covers."""
    parts = [p[1:] for p in cover_many([geometry], ys, xs, convention)]
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
