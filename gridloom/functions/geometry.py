"""Planar geometry on NumPy arrays: parsing and measures.

A geometry is a list of polygons, a polygon a list of rings (the first is the
outer one), a ring an (n, 2) array of x and y whose last point is its first.
``Shapes`` has the edges of many geometries in flat arrays.
"""

from __future__ import annotations

import json
import re
import struct

import numpy as np

Ring = np.ndarray
Geometry = list[list[Ring]]



def _ring(points) -> Ring:
    a = np.asarray(points, np.float64).reshape(len(points), -1)[:, :2]
    if a.shape[0] and not (a[0] == a[-1]).all():
        a = np.vstack([a, a[:1]])
    return a


def from_geojson(text: str | dict | None) -> Geometry:
    """Polygons of a GeoJSON geometry; points and lines have none."""
    g = json.loads(text) if isinstance(text, str) else text
    if not g:
        return []
    kind = g.get("type")
    if kind == "Polygon":
        return [[_ring(r) for r in g["coordinates"] if r]]
    if kind == "MultiPolygon":
        return [[_ring(r) for r in p if r] for p in g["coordinates"]]
    if kind == "GeometryCollection":
        return [p for part in g["geometries"] for p in from_geojson(part)]
    return []


_NUMBER = re.compile(r"[-+0-9.eE]+")


def from_wkt(text: str) -> Geometry:
    kind, _, body = text.strip().partition("(")
    kind = kind.strip().upper().removesuffix(" Z").strip()
    rings = [[tuple(map(float, _NUMBER.findall(p)[:2])) for p in r.split(",")] for r in re.findall(r"\(([^()]+)\)", "(" + body)]
    if kind == "POLYGON":
        return [[_ring(r) for r in rings]]
    if kind == "MULTIPOLYGON":
        out = []
        for part in re.findall(r"\(\s*(\([^()]*\)(?:\s*,\s*\([^()]*\))*)\s*\)", body):
            out.append([_ring([tuple(map(float, _NUMBER.findall(p)[:2])) for p in r.split(",")]) for r in re.findall(r"\(([^()]+)\)", part)])
        return out
    raise ValueError(f"unsupported geometry {kind or text!r}")


def from_wkb(data: bytes | None) -> Geometry:
    out: Geometry = []
    if not data:
        return out

    def read(at: int) -> int:
        order = "<" if data[at] else ">"
        (kind,) = struct.unpack_from(order + "I", data, at + 1)
        width = 3 if kind & 0x80000000 or 1000 <= kind % 10000 < 2000 else 2
        at += 5 + (4 if kind & 0x20000000 else 0)
        kind = (kind & 0xFFFF) % 1000
        if kind == 1:
            return at + 8 * width
        (n,) = struct.unpack_from(order + "I", data, at)
        at += 4
        if kind == 2:
            return at + 8 * width * n
        if kind == 3:
            rings = []
            for _ in range(n):
                (m,) = struct.unpack_from(order + "I", data, at)
                rings.append(_ring(np.frombuffer(data, order + "f8", m * width, at + 4).reshape(m, width)))
                at += 4 + 8 * width * m
            out.append(rings)
            return at
        for _ in range(n):
            at = read(at)
        return at

    read(0)
    return out


def to_wkb(geometry: Geometry) -> bytes:
    parts = []
    for rings in geometry:
        body = b"".join(struct.pack("<I", len(r)) + np.ascontiguousarray(r, "<f8").tobytes() for r in rings)
        parts.append(struct.pack("<BII", 1, 3, len(rings)) + body)
    return parts[0] if len(parts) == 1 else struct.pack("<BII", 1, 6, len(parts)) + b"".join(parts)


def point_wkb(x: float, y: float) -> bytes:
    return struct.pack("<BIdd", 1, 1, x, y)


def point_of(data: bytes | None) -> tuple[float, float] | None:
    if not data or len(data) < 21:
        return None
    order = "<" if data[0] else ">"
    kind = struct.unpack_from(order + "I", data, 1)[0]
    return struct.unpack_from(order + "dd", data, 5) if (kind & 0xFFFF) % 1000 == 1 else None


def bounds(geometry: Geometry) -> tuple[float, float, float, float] | None:
    """x and y at least, x and y at most."""
    rings = [p[0] for p in geometry if p and len(p[0])]
    if not rings:
        return None
    a = np.concatenate(rings)
    return (*a.min(axis=0).tolist(), *a.max(axis=0).tolist())


def _signed(ring: Ring) -> float:
    x, y = (ring - ring[0]).T
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def area(geometry: Geometry) -> float:
    return sum(abs(_signed(r)) * (1 if k == 0 else -1) for p in geometry for k, r in enumerate(p))


def centroid(geometry: Geometry) -> tuple[float, float] | None:
    """The centre of the area; of the points where there is none."""
    total = x = y = 0.0
    for p in geometry:
        for k, r in enumerate(p):
            q = r - r[0]
            cross = q[:-1, 0] * q[1:, 1] - q[1:, 0] * q[:-1, 1]
            a = cross.sum() / 2
            if not a:
                continue
            w = abs(a) * (1 if k == 0 else -1)
            x += w * (r[0, 0] + ((q[:-1, 0] + q[1:, 0]) * cross).sum() / (6 * a))
            y += w * (r[0, 1] + ((q[:-1, 1] + q[1:, 1]) * cross).sum() / (6 * a))
            total += w
    if total:
        return float(x / total), float(y / total)
    box = bounds(geometry)
    return None if box is None else ((box[0] + box[2]) / 2, (box[1] + box[3]) / 2)


#: Little-endian, a polygon, one ring.
SIMPLE = b"\1\3\0\0\0\1\0\0\0"


class Shapes:
    """The edges of many geometries as flat arrays, those of a geometry together.

    ``turn`` is 1 where an edge runs with the inside on its left: outer rings
    anticlockwise and holes the other way; else -1.  ``box`` has x and y at
    least and at most, NaN for a geometry without points.
    """

    def __init__(self, owner: np.ndarray, edges: np.ndarray, turn: np.ndarray, n: int):
        order = np.argsort(owner, kind="stable")
        self.owner, self.turn = owner[order], turn[order]
        self.x1, self.y1, self.x2, self.y2 = np.ascontiguousarray(edges[order].T)
        self.start = np.searchsorted(self.owner, np.arange(n + 1))
        self.box = np.full((n, 4), np.nan)
        some = np.flatnonzero(np.diff(self.start))
        if some.size:
            at = self.start[some]
            for k, (values, f) in enumerate(((self.x1, np.minimum), (self.y1, np.minimum), (self.x1, np.maximum), (self.y1, np.maximum))):
                # Rings are closed, so first points are all points.
                self.box[some, k] = f.reduceat(values, at)

    def __len__(self) -> int:
        return len(self.box)

    def known(self) -> np.ndarray:
        return np.flatnonzero(~np.isnan(self.box[:, 0]))


def shapes_of(geometries: list[Geometry]) -> Shapes:
    owner, edges, turn = [np.empty(0, np.int64)], [np.empty((0, 4))], [np.empty(0)]
    for i, geometry in enumerate(geometries):
        for polygon in geometry:
            for k, r in enumerate(polygon):
                if len(r) < 2:
                    continue
                owner.append(np.full(len(r) - 1, i))
                edges.append(np.hstack([r[:-1], r[1:]]))
                turn.append(np.full(len(r) - 1, 1.0 if (_signed(r) > 0) == (k == 0) else -1.0))
    return Shapes(np.concatenate(owner), np.concatenate(edges), np.concatenate(turn), len(geometries))


def shapes_of_wkb(column: list[bytes | None]) -> Shapes:
    """The same from WKB: polygons of one closed ring and equally many points are parsed together."""
    sizes = np.array([len(w) if w is not None and w.startswith(SIMPLE) else -1 for w in column], np.int64)
    owner, edges, turn, rest = [], [], [], np.flatnonzero(sizes < 0).tolist()
    for size in np.unique(sizes[sizes >= 0]):
        at = np.flatnonzero(sizes == size)
        n = (int(size) - 13) // 16
        raw = np.frombuffer(b"".join([column[k] for k in at]), np.uint8).reshape(at.size, -1) if size == 13 + 16 * n and n > 1 else None
        if raw is None:
            rest += at.tolist()
            continue
        points = np.ascontiguousarray(raw[:, 13:]).view("<f8").reshape(at.size, n, 2)
        good = (np.ascontiguousarray(raw[:, 9:13]).view("<u4")[:, 0] == n) & (points[:, 0] == points[:, -1]).all(axis=1)
        rest += at[~good].tolist()
        points, at = points[good], at[good]
        from_first = points - points[:, :1]
        twice = (from_first[:, :-1, 0] * from_first[:, 1:, 1] - from_first[:, 1:, 0] * from_first[:, :-1, 1]).sum(axis=1)
        owner.append(np.repeat(at, n - 1))
        edges.append(np.concatenate([points[:, :-1], points[:, 1:]], axis=2).reshape(-1, 4))
        turn.append(np.repeat(np.where(twice > 0, 1.0, -1.0), n - 1))
    if rest:
        others = shapes_of([from_wkb(column[k]) for k in rest])
        owner.append(np.array(rest)[others.owner])
        edges.append(np.stack([others.x1, others.y1, others.x2, others.y2], axis=1))
        turn.append(others.turn)
    if not owner:
        return shapes_of([[]] * len(column))
    return Shapes(np.concatenate(owner).astype(np.int64), np.concatenate(edges), np.concatenate(turn), len(column))
