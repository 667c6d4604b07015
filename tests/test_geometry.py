import math

import numpy as np
import plain_geometry
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.functions.cover import Axis, cover, cover_many
from gridloom.functions.geometry import area, bounds, centroid, from_geojson, from_wkb, from_wkt, point_of, point_wkb, shapes_of, shapes_of_wkb, to_wkb

HOLED = "POLYGON((0 0,10 0,10 10,0 10,0 0),(2 2,4 2,4 4,2 4,2 2))"
MANY = "MULTIPOLYGON(((0 0,1 0,1 1,0 1,0 0)),((2 2,3 2,3 3,2 3,2 2),(2.2 2.2,2.4 2.2,2.4 2.4,2.2 2.4,2.2 2.2)))"
UNIT = Axis(np.arange(0.5, 10))


@st.composite
def stars(draw):
    """Simple polygons around (10, 10)."""
    n = draw(st.integers(4, 11))
    angles = 2 * np.pi * (np.arange(n) + draw(st.floats(0, 0.4))) / n
    radii = np.array(draw(st.lists(st.floats(0.5, 8), min_size=n, max_size=n)))
    return [[np.vstack([p := np.c_[10 + radii * np.cos(angles), 10 + radii * np.sin(angles)], p[:1]])]]


@settings(max_examples=60, deadline=None)
@given(stars(), st.booleans(), st.booleans())
def test_overlaps_add_up(shape, flip_y, flip_x):
    ys, xs = (Axis(np.arange(0.5, 20)[:: -1 if f else 1].copy()) for f in (flip_y, flip_x))
    iy, ix, w = cover(shape, ys, xs, "area_weighted")
    assert math.isclose(w.sum(), area(shape), abs_tol=1e-9)
    touched = set(zip(*cover(shape, ys, xs, "all_touched")[:2], strict=True))
    inside = set(zip(*cover(shape, ys, xs, "centroid")[:2], strict=True))
    assert inside <= touched and set(zip(iy, ix, strict=True)) == touched


def plain_cover(shape, ys, xs, convention):
    """Each cell of the grid against each edge."""
    e = plain_geometry.Edges([shape])
    iy, ix = (a.ravel() for a in np.meshgrid(np.arange(ys.centres.size), np.arange(xs.centres.size), indexing="ij"))
    y, x, which = ys.centres[iy], xs.centres[ix], np.zeros(iy.size, np.int64)
    if convention == "centroid":
        keep, w = plain_geometry.contains(e, which, x, y), np.ones(iy.size)
    else:
        box = (x - xs.step / 2, x + xs.step / 2, y - ys.step / 2, y + ys.step / 2)
        keep = plain_geometry.touches(e, which, *box)
        w = plain_geometry.overlap(e, which, *box) if convention == "area_weighted" else np.ones(iy.size)
    return {(int(a), int(b)): round(float(c), 9) + 0.0 for a, b, c in zip(iy[keep], ix[keep], w[keep], strict=True)}


def quantized(shape, to):
    return [[np.round(r * to) / to for r in p] for p in shape]


@settings(max_examples=120, deadline=None)
@given(stars(), st.sampled_from([None, 1, 2, 4]), st.sampled_from([1, 2]), st.booleans())
def test_cover_is_every_cell_against_every_edge(shape, to, parts, hole):
    shape = quantized(shape, to) if to else shape
    shape = shape * parts if parts == 1 else shape + [[shape[0][0] + 20]]
    if hole:
        shape = [[shape[0][0], 10 + (shape[0][0][::-1] - 10) * 0.5], *shape[1:]]
    ys, xs = Axis(np.arange(39.5, 0, -1)), Axis(np.arange(0.5, 40))
    for convention in ("centroid", "all_touched", "area_weighted"):
        iy, ix, w = cover(shape, ys, xs, convention)
        got = {(int(a), int(b)): round(float(c), 9) + 0.0 for a, b, c in zip(iy, ix, w, strict=True)}
        assert got == pytest.approx(plain_cover(shape, ys, xs, convention), abs=2e-9)


def test_wkb_in_one_go():
    shapes = [from_wkt(HOLED), [], from_wkt(MANY), *[from_wkt(f"POLYGON(({k} 0,{k + 1} 0,{k + 1} 1,{k} 0))") for k in range(5)], from_wkt("POLYGON((0 0,0 1,1 1,0 0))")]
    wkb = [to_wkb(s) if s else None for s in shapes]
    one, many = shapes_of_wkb(wkb), shapes_of(shapes)
    assert len(one) == len(many) == 9 and np.array_equal(one.box, many.box, equal_nan=True) and (one.start == many.start).all()
    for name in ("x1", "y1", "x2", "y2", "turn"):
        assert (getattr(one, name) == getattr(many, name)).all()


@settings(max_examples=30, deadline=None)
@given(st.lists(stars(), min_size=1, max_size=6))
def test_many_at_once_are_the_same(shapes):
    grid = Axis(np.arange(0.5, 20))
    for convention in ("centroid", "all_touched", "area_weighted"):
        got = {}
        for which, iy, ix, w in cover_many(shapes, grid, grid, convention):
            for k, *cell in zip(which, iy, ix, np.round(w, 9), strict=True):
                got.setdefault(int(k), set()).add(tuple(cell))
        for k, shape in enumerate(shapes):
            iy, ix, w = cover(shape, grid, grid, convention)
            assert got.get(k, set()) == set(zip(iy, ix, np.round(w, 9), strict=True))


def test_windows_split_a_cover():
    shape, grid = from_wkt(HOLED), Axis(np.arange(9.5, 0, -1))
    full = sorted(zip(*cover(shape, UNIT, grid, "all_touched")[:2], strict=True))
    parts = []
    for rows in ((0, 4), (4, 10)):
        for columns in ((0, 3), (3, 10)):
            for _, iy, ix, _ in cover_many([shape], UNIT, grid, "all_touched", rows, columns):
                parts += zip(iy, ix, strict=True)
    assert sorted(parts) == full


def test_holes_and_parts():
    shape = from_wkt(HOLED)
    assert area(shape) == 96 and math.isclose(cover(shape, UNIT, UNIT, "area_weighted")[2].sum(), 96)
    assert cover(shape, UNIT, UNIT, "centroid")[0].size == 96
    assert cover(shape, UNIT, UNIT, "all_touched")[0].size == 100  # cells in the hole touch its edge
    both = from_wkt(MANY)
    assert len(both) == 2 and len(both[1]) == 2 and math.isclose(area(both), 1.96)
    assert math.isclose(cover(both, UNIT, UNIT, "area_weighted")[2].sum(), 1.96)


def test_boundaries():
    square = from_wkt("POLYGON((0.5 0.5,2.5 0.5,2.5 2.5,0.5 2.5,0.5 0.5))")
    assert cover(square, UNIT, UNIT, "centroid")[0].tolist() == [1]  # centres on the edge are outside
    point = from_wkt("POLYGON((1 1,2 1,2 2,1 2,1 1))")
    assert cover(point, UNIT, UNIT, "all_touched")[0].size == 9  # one shared corner is enough
    assert cover(point, Axis(np.array([1.5])), UNIT, "area_weighted")[0].size == 0
    assert cover([], UNIT, UNIT, "centroid")[0].size == 0
    far = from_wkt("POLYGON((50 50,51 50,51 51,50 50))")
    assert cover(far, UNIT, UNIT, "all_touched")[0].size == 0


def test_formats():
    for text in (HOLED, MANY):
        shape = from_wkt(text)
        again = from_wkb(to_wkb(shape))
        assert all((a == b).all() for p, q in zip(shape, again, strict=True) for a, b in zip(p, q, strict=True))
    g = {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2]}, {"type": "Polygon", "coordinates": [[[0, 0, 5], [1, 0, 5], [1, 1, 5]]]}]}
    assert area(from_geojson(g)) == 0.5
    assert point_of(point_wkb(3, 4)) == (3, 4) and from_wkb(point_wkb(3, 4)) == []
    assert bounds(from_wkt(MANY)) == (0, 0, 3, 3) and bounds([]) is None and centroid([]) is None
    assert centroid(from_wkt("POLYGON((0 0,4 0,4 2,0 2,0 0))")) == (2, 1)
    with pytest.raises(ValueError):
        from_wkt("LINESTRING(0 0,1 1)")
