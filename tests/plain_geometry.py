"""Every cell against every edge: what the scanline cover is held against."""

import numpy as np

from gridloom.functions.geometry import Geometry, _signed


class Edges:
    """The edges of many geometries, as arrays of (geometry, edge).

    Outer rings run clockwise and holes the other way.  Rows are filled up with
    edges of no length, which no test notices.
    """

    def __init__(self, shapes: list[Geometry]):
        rows = []
        for shape in shapes:
            rings = [r if (_signed(r) < 0) == (k == 0) else r[::-1] for p in shape for k, r in enumerate(p) if len(r) > 1]
            rows.append(np.concatenate([np.hstack([r[:-1], r[1:]]) for r in rings]) if rings else np.empty((0, 4)))
        self.counts = np.array([len(r) for r in rows], np.int64)
        most = int(self.counts.max(initial=0))
        self.all = np.zeros((4, most, len(rows)))
        for k, r in enumerate(rows):
            if len(r):
                self.all[:, : len(r), k] = r.T
                self.all[:, len(r) :, k] = np.tile(r[-1, 2:], 2)[:, None]

    def each(self, which: np.ndarray):
        """x1, y1, x2, y2 of one edge after the other, for the geometry of each cell."""
        for k in range(self.all.shape[1]):
            yield self.all[:, k][:, which]


def contains(e: Edges, which: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether each point is inside its geometry; on the boundary it isn't."""
    odd, on = np.zeros(x.size, bool), np.zeros(x.size, bool)
    for x1, y1, x2, y2 in e.each(which):
        side = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
        odd ^= ((y1 > y) != (y2 > y)) & ((side > 0) == (y2 > y1))
        line = side == 0
        if line.any():
            on |= line & (np.minimum(x1, x2) <= x) & (x <= np.maximum(x1, x2)) & (np.minimum(y1, y2) <= y) & (y <= np.maximum(y1, y2))
    return odd & ~on


def touches(e: Edges, which: np.ndarray, x0: np.ndarray, x1: np.ndarray, y0: np.ndarray, y1: np.ndarray) -> np.ndarray:
    """Whether each closed box meets its closed geometry, be it in one point."""
    out = contains(e, which, (x0 + x1) / 2, (y0 + y1) / 2)
    for ax, ay, bx, by in e.each(which):
        # An edge misses a box if a side of the box, or the edge's own line, parts them.
        near = (np.maximum(ax, bx) >= x0) & (np.minimum(ax, bx) <= x1) & (np.maximum(ay, by) >= y0) & (np.minimum(ay, by) <= y1) & ~out
        k = np.flatnonzero(near)
        if not k.size:
            continue
        ax, ay, dx, dy = ax[k], ay[k], (bx - ax)[k], (by - ay)[k]
        lx, hx, ly, hy = x0[k], x1[k], y0[k], y1[k]
        least = dx * (np.where(dx < 0, hy, ly) - ay) - dy * (np.where(dy > 0, hx, lx) - ax)
        most = dx * (np.where(dx < 0, ly, hy) - ay) - dy * (np.where(dy > 0, lx, hx) - ax)
        out[k] |= (least <= 0) & (most >= 0)
    return out


def overlap(e: Edges, which: np.ndarray, x0: np.ndarray, x1: np.ndarray, y0: np.ndarray, y1: np.ndarray) -> np.ndarray:
    """Area of each box within its geometry.

    Along an edge, the height that a box sees of it is its y held to the box's
    range; the signed integral of that over the box's width, summed over all
    edges, is the area.
    """
    out = np.zeros(x0.size)
    for ax, ay, bx, by in e.each(which):
        left, right = np.maximum(np.minimum(ax, bx), x0), np.minimum(np.maximum(ax, bx), x1)
        k = np.flatnonzero(right > left)
        if not k.size:
            continue
        left, right, base, top = left[k], right[k], y0[k], (y1 - y0)[k]
        ax, ay, run = ax[k], ay[k], (bx - ax)[k]
        slope = (by[k] - ay) / run
        p, q = ay + slope * (left - ax) - base, ay + slope * (right - ax) - base
        # The integral of a height held to 0 .. top, up to p and to q.
        inner_p, inner_q = np.clip(p, 0, top), np.clip(q, 0, top)
        grown = (inner_q**2 - inner_p**2) / 2 + (np.maximum(q - top, 0) - np.maximum(p - top, 0)) * top
        rise = q - p
        flat = np.abs(rise) < 1e-12 * top
        mean = np.where(flat, (inner_p + inner_q) / 2, grown / np.where(flat, 1, rise))
        out[k] += np.sign(run) * (right - left) * mean
    return np.maximum(out, 0)
