"""From bounds and pins to index ranges of each dimension.

Ranges are inclusive pairs.  A dimension may need two, when a box crosses the
seam of a 0-360 longitude axis; none means that nothing matches.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

import numpy as np

Range = tuple[int, int]
Bound = tuple[float | None, float | None]

#: How far apart two coordinates may be and still count as equal.
TOLERANCE = 1e-8
#: Names under which a bound finds its dimension.
ALIASES = {
    "lat": ("lat", "latitude", "y"),
    "lon": ("lon", "longitude", "x"),
    "time": ("time", "t"),
    "y": ("y", "lat", "latitude"),
    "x": ("x", "lon", "longitude"),
}


@dataclass(frozen=True)
class Constraints:
    """What a scan is asked for: coordinate bounds and index pins by dimension."""

    bounds: Mapping[str, Bound] = field(default_factory=dict)
    pins: Mapping[str, int] = field(default_factory=dict)
    #: Further bounds, all of which must hold.
    also: tuple[tuple[str, Bound], ...] = ()


def parse_pins(text: str | None) -> dict[str, int]:
    """``dim=index,...``; parts that aren't of that form are ignored."""
    pins = {}
    for part in (text or "").split(","):
        name, sep, value = part.partition("=")
        if sep and name.strip() and value.strip().isdigit():
            pins[name.strip()] = int(value)
    return pins


def direction(coords: np.ndarray) -> int:
    """1 if the coordinates never fall, -1 if they never rise, else 0."""
    if coords.size < 2:
        return 1
    steps = np.diff(coords)
    return 1 if (steps >= 0).all() else -1 if (steps <= 0).all() else 0


def translate(coords: np.ndarray, op: str, value: float) -> Range | None:
    """The positions where ``coordinate op value`` holds, on a monotonic axis; None: nowhere.

    On an axis that is not monotonic it is the whole axis, and a filter on the
    rows must do the rest.
    """
    n = coords.size
    way = direction(coords)
    if not n or math.isnan(value):
        return None
    if way == 0:
        return (0, n - 1)
    up = coords if way > 0 else coords[::-1]
    if op == "=":
        lo, hi = np.searchsorted(up, value - TOLERANCE, "left"), np.searchsorted(up, value + TOLERANCE, "right") - 1
    elif op in (">", ">="):
        lo, hi = np.searchsorted(up, value, "right" if op == ">" else "left"), n - 1
    elif op in ("<", "<="):
        lo, hi = 0, np.searchsorted(up, value, "left" if op == "<" else "right") - 1
    else:
        raise ValueError(f"no such comparison: {op}")
    if lo > hi:
        return None
    return (int(lo), int(hi)) if way > 0 else (int(n - 1 - hi), int(n - 1 - lo))


def within(coords: np.ndarray, bound: Bound) -> Range | None:
    """Both ends of a bound at once."""
    lo, hi = 0, coords.size - 1
    for op, value in ((">=", bound[0]), ("<=", bound[1])):
        if value is not None:
            got = translate(coords, op, float(value))
            if got is None:
                return None
            lo, hi = max(lo, got[0]), min(hi, got[1])
    return (lo, hi) if lo <= hi else None


def outward(scale: float, translation: float, size: int, bound: Bound) -> Range | None:
    """An affine axis without looking at its coordinates: at most a cell too many on each side."""
    ends = [None if v is None else (v - translation) / scale for v in bound]
    if scale < 0:
        ends.reverse()
    lo = 0 if ends[0] is None else max(0, math.floor(ends[0]))
    hi = size - 1 if ends[1] is None else min(size - 1, math.ceil(ends[1]))
    return (lo, hi) if lo <= hi else None


def turns(bound: Bound) -> list[Bound]:
    """A bound, in degrees from -180 or from 0, on an axis of 0 to 360: one that crosses its seam is two."""
    low, high = bound
    lo, hi = (None if v is None else v + 360 if v < 0 else v for v in bound)
    if low is not None and high is not None:
        return [(lo, None), (None, hi)] if lo >= hi and low < high else [(lo, hi)]
    if low is not None:  # as far as 180, over the seam if it starts west of it
        return [(lo, None), (None, 180.0)] if low < 0 else [(lo, 180.0 if lo <= 180 else None)]
    west = np.nextafter(180.0, 360.0)
    return [(west, hi)] if high < 0 else [(west, None), (None, hi)] if hi <= 180 else [(None, hi)]


def merged(ranges: Iterable[Range]) -> list[Range]:
    """Sorted ranges without overlaps."""
    out: list[Range] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def find_dim(dims: Iterable[str], name: str) -> str | None:
    dims = list(dims)
    return next((d for d in (name, *ALIASES.get(name, ())) if d in dims), None)


def index_ranges(
    dims: list[str],
    shape: list[int],
    coords: Mapping[str, np.ndarray],
    constraints: Constraints,
    scale: list[float] | None = None,
    translation: list[float] | None = None,
    wrapped: Iterable[str] = (),
    exact: bool = True,
) -> list[list[Range]]:
    """Ranges for each dimension.  A pin wins over a bound and is held to the last index."""
    bounds: dict[str, list[Bound]] = {}
    for name, bound in (*constraints.bounds.items(), *constraints.also):
        if (dim := find_dim(dims, name)) is not None and (bound[0] is not None or bound[1] is not None):
            bounds.setdefault(dim, []).append(bound)
    out: list[list[Range]] = []
    for d, name in enumerate(dims):
        last = shape[d] - 1
        if name in constraints.pins:
            at = min(constraints.pins[name], last)
            out.append([(at, at)] if last >= 0 else [])
            continue
        ranges = [(0, last)] if last >= 0 else []
        for bound in bounds.get(name, []):
            found: list[Range] = []
            for part in turns(bound) if name in wrapped else [bound]:
                if name in coords:
                    got = within(coords[name], part)
                elif scale is not None and scale[d]:
                    if exact:
                        got = within(translation[d] + scale[d] * np.arange(shape[d]), part)
                    else:
                        got = outward(scale[d], translation[d], shape[d], part)
                else:
                    got = (0, last)  # no coordinates: a bound says nothing
                if got is not None:
                    found.append(got)
            ranges = [(max(a, c), min(b, e)) for a, b in ranges for c, e in merged(found) if max(a, c) <= min(b, e)]
        out.append(sorted(ranges))
    return out
