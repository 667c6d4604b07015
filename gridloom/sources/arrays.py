"""The chunked array behind every source: its description, and how chunks are read."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
from pyspark.sql import types as T

from ..plans.chunks import Box, boxes, cost
from ..plans.constraints import Constraints, index_ranges

MAX_RANK = 16
MAX_STRINGS = 1_000_000
MAX_CHUNK_BYTES = 256 << 20
#: Coordinates of an axis: a reader, and each of its tasks, holds them as float64.
MAX_COORDS = 1 << 24

SPARK_TYPES = {
    "bool": T.BooleanType(),
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    # Spark has no unsigned types: each gets the next that holds it.
    "uint8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "string": T.StringType(),
}


class ChunkReader(Protocol):
    def read(self, at: tuple[int, ...], part: tuple[slice, ...]) -> np.ndarray | None:
        """The part of a chunk; None if the chunk isn't stored."""


@dataclass
class ArrayInfo:
    """A chunked array as a relation: a column per dimension, then ``value``."""

    uri: str
    shape: list[int]
    chunk: list[int]
    dtype: str
    dims: list[str]
    reader: ChunkReader
    coords: Mapping[str, np.ndarray] = field(default_factory=dict)
    scale: list[float] | None = None
    translation: list[float] | None = None
    fill: object = None  # None: nothing is missing
    crs: str | None = None
    wrapped: frozenset[str] = frozenset()

    def validate(self) -> ArrayInfo:
        if len(self.shape) > MAX_RANK:
            raise ValueError(f"an array of {len(self.shape)} dimensions; {MAX_RANK} at most")
        if self.dtype not in SPARK_TYPES:
            raise ValueError(f"unsupported data type {self.dtype}")
        if any(c <= 0 for c in self.chunk) or len(self.chunk) != len(self.shape):
            raise ValueError(f"a chunk shape of {self.chunk} for {self.shape}")
        volume = math.prod(self.chunk)
        if self.dtype == "string":
            if volume > MAX_STRINGS:
                raise ValueError(f"{volume} strings in a chunk; {MAX_STRINGS} at most")
        elif volume * np.dtype(self.dtype).itemsize > MAX_CHUNK_BYTES:
            raise ValueError(f"a chunk of {volume} elements of {self.dtype}; {MAX_CHUNK_BYTES} bytes at most")
        return self

    def placed(self, d: int) -> bool:
        """Whether dimension d has coordinates rather than a bare index."""
        return self.dims[d] in self.coords or (self.scale is not None and self.scale[d] is not None)

    def axis(self, d: int, start: int, stop: int) -> np.ndarray:
        """Coordinates (longitudes from -180) or indices of a stretch of dimension d."""
        name = self.dims[d]
        if name in self.coords:
            values = np.asarray(self.coords[name][start:stop], np.float64)
        elif self.placed(d):
            values = self.translation[d] + np.arange(start, stop) * self.scale[d]
        else:
            return np.arange(start, stop, dtype=np.int64)
        return np.where(values > 180, values - 360, values) if name in self.wrapped else values

    def boxes(self, constraints: Constraints, exact: bool = True) -> list[Box]:
        scale = None if self.scale is None else [s or 0.0 for s in self.scale]
        found = index_ranges(self.dims, self.shape, self.coords, constraints, scale, self.translation, self.wrapped, exact)
        return boxes(found, self.chunk)

    def cost(self, constraints: Constraints, exact: bool = True) -> tuple[int, int]:
        return cost(self.boxes(constraints, exact), self.dtype)

    def missing(self, values: np.ndarray) -> np.ndarray | None:
        """Which values are the fill value, bit for bit."""
        if self.fill is None or (self.dtype == "string" and self.fill == ""):
            return None
        if self.dtype == "string":
            return values == self.fill
        fill = np.array(self.fill, values.dtype)
        if values.dtype.kind == "f":
            bits = f"u{values.dtype.itemsize}"
            return np.ascontiguousarray(values).view(bits) == fill.reshape(1).view(bits)[0]
        return values == fill

    def schema(self, index_columns: bool = False) -> T.StructType:
        out = T.StructType()
        for d, name in enumerate(self.dims):
            out.add(name, T.DoubleType() if self.placed(d) else T.LongType(), False)
        out.add(T.StructField("value", SPARK_TYPES[self.dtype], True, {"zarr_dtype": self.dtype}))
        if index_columns:
            for name in self.dims:
                out.add(f"__i_{name}", T.LongType(), False)
        return out


def wraps(name: str, coords: np.ndarray) -> bool:
    """Longitudes of which some are beyond 180."""
    return name in ("lon", "longitude") and bool(coords.size) and bool((coords > 180).any())
