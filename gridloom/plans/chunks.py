"""Chunk grids: which chunks an index box needs, and what they cost."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

from .constraints import Range

#: Decoded bytes of an element; strings are an estimate.
ELEMENT_BYTES = {"bool": 1, "int8": 1, "int16": 2, "int32": 4, "int64": 8, "uint8": 1, "uint16": 2, "uint32": 4, "uint64": 8, "float32": 4, "float64": 8, "string": 64}


@dataclass(frozen=True)
class Box:
    """An index box over a regular chunk grid."""

    ranges: tuple[Range, ...]
    chunk: tuple[int, ...]

    @property
    def grid(self) -> tuple[Range, ...]:
        return tuple((lo // c, hi // c) for (lo, hi), c in zip(self.ranges, self.chunk, strict=True))

    @property
    def total(self) -> int:
        return math.prod(hi - lo + 1 for lo, hi in self.grid)

    def nth(self, k: int) -> tuple[int, ...]:
        """The k-th chunk, the last dimension running fastest."""
        out = []
        for lo, hi in reversed(self.grid):
            k, r = divmod(k, hi - lo + 1)
            out.append(lo + r)
        return tuple(reversed(out))

    def chunks(self) -> Iterator[tuple[int, ...]]:
        return (self.nth(k) for k in range(self.total))

    def inside(self, at: tuple[int, ...]) -> tuple[tuple[int, int], ...]:
        """The part of a chunk that is in the box, as global half-open ranges."""
        return tuple((max(lo, g * c), min(hi, g * c + c - 1) + 1) for (lo, hi), g, c in zip(self.ranges, at, self.chunk, strict=True))


def boxes(ranges: list[list[Range]], chunk: list[int]) -> list[Box]:
    """All combinations of the dimensions' ranges."""
    return [Box(tuple(r), tuple(chunk)) for r in product(*ranges)]


def cost(parts: list[Box], dtype: str) -> tuple[int, int]:
    """Chunks and decoded bytes of whole chunks; a chunk that two boxes need counts once."""
    if not parts:
        return 0, 0
    if len(parts) == 1:
        n = parts[0].total
    else:
        n = len({c for b in parts for c in b.chunks()})
    return n, n * math.prod(parts[0].chunk) * ELEMENT_BYTES[dtype]
