import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from gridloom.plans.chunks import Box, boxes, cost
from gridloom.plans.constraints import Constraints, index_ranges, merged, outward, parse_pins, translate, turns, within

UP = np.array([0.0, 10, 20, 30, 40, 50])
COMPARE = {">": np.greater, ">=": np.greater_equal, "<": np.less, "<=": np.less_equal}


@given(st.lists(st.integers(-50, 50), min_size=1, max_size=12, unique=True), st.sampled_from(list(COMPARE)), st.floats(-60, 60), st.booleans())
def test_translate_is_the_comparison(values, op, value, falling):
    coords = np.array(sorted(values, reverse=falling), float)
    want = np.flatnonzero(COMPARE[op](coords, value))
    got = translate(coords, op, value)
    assert (got is None and not want.size) or (got == (want[0], want[-1]))


def test_translate_equality_and_disorder():
    assert translate(UP, "=", 20 + 1e-9) == (2, 2)
    assert translate(UP, "=", 21) is None
    assert translate(np.array([3.0, 1, 2]), ">", 2) == (0, 2)
    with pytest.raises(ValueError):
        translate(UP, "!=", 1)


def test_bounds_that_match_nothing():
    assert within(UP, (60, None)) is None
    assert within(UP, (11, 19)) is None
    assert within(UP[::-1], (10, 30)) == (2, 4)


def test_pins_clamp_and_win():
    assert parse_pins("time=2, lat = 3,bad,x=,=1,y=-1") == {"time": 2, "lat": 3}
    got = index_ranges(["lat", "lon"], [6, 6], {"lat": UP, "lon": UP}, Constraints({"lat": (0, 10), "lon": (15, 45)}, {"lat": 99}))
    assert got == [[(5, 5)], [(2, 4)]]


def test_affine_axes():
    assert outward(2.0, 1.0, 10, (4.0, 8.0)) == (1, 4)
    exact = index_ranges(["y"], [10], {}, Constraints({"y": (4.0, 8.0)}), [2.0], [1.0])
    assert exact == [[(2, 3)]]
    assert index_ranges(["y"], [10], {}, Constraints({"y": (4.0, 8.0)}), [2.0], [1.0], exact=False) == [[(1, 4)]]
    assert index_ranges(["lat"], [10], {}, Constraints({"y": (4.0, 8.0)}), [-2.0], [19.0]) == [[(6, 7)]]


def test_unplaced_dimensions_ignore_bounds_and_aliases_find_names():
    assert index_ranges(["dim_0"], [4], {}, Constraints({"lat": (0, 1)})) == [[(0, 3)]]
    assert index_ranges(["latitude"], [6], {"latitude": UP}, Constraints({"lat": (10, 20)})) == [[(1, 2)]]


@given(st.integers(-180, 180), st.integers(-180, 180))
def test_longitudes_around_the_seam(low, high):
    if low > high:
        low, high = high, low
    raw = np.arange(0, 360, 7.0)
    shown = np.where(raw > 180, raw - 360, raw)
    got = index_ranges(["lon"], [raw.size], {"lon": raw}, Constraints({"lon": (low, high)}), wrapped=["lon"])[0]
    have = sorted(i for a, b in got for i in range(a, b + 1))
    want = [i for i in range(raw.size) if low <= shown[i] <= high]
    # 180 and -180 are one meridian: a box that ends there may show it.
    assert [i for i in have if raw[i] != 180] == [i for i in want if raw[i] != 180]
    assert len(have) == len(set(have))


def test_one_sided_longitudes():
    raw = np.arange(0, 360, 10.0)
    shown = np.where(raw > 180, raw - 360, raw)
    for bound, keep in (((-100, None), shown >= -100), ((None, -100), shown <= -100), ((100, None), shown >= 100), ((None, 100), shown <= 100)):
        got = [i for part in turns(bound) if (r := within(raw, part)) for i in range(r[0], r[1] + 1)]
        assert sorted(got) == np.flatnonzero(keep).tolist()


def test_merged():
    assert merged([(5, 9), (0, 3), (3, 4)]) == [(0, 4), (5, 9)]


def test_chunk_boxes_and_costs():
    assert cost(boxes([[(0, 99)], [(0, 99)]], [10, 10]), "float32") == (100, 40_000)
    assert cost(boxes([[(10, 24)], [(5, 9)]], [5, 5]), "int16") == (3, 150)
    assert cost(boxes([[(0, 937)], [(20, 25)], [(0, 143)]], [12, 73, 144]), "float32") == (79, 39_861_504)
    assert cost(boxes([[]], [4]), "int8") == (0, 0)
    # Two ranges in one chunk cost it once.
    assert cost(boxes([[(0, 1), (3, 4)]], [5]), "int8") == (1, 5)


def test_box_order_and_insides():
    b = Box(((1, 3), (1, 7)), (5, 5))
    assert list(b.chunks()) == [(0, 0), (0, 1)]
    assert b.inside((0, 1)) == ((1, 4), (5, 8))
