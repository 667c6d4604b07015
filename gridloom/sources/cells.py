"""The ``cells`` data source: an array as one row per cell."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNull,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..plans.chunks import Box
from ..plans.constraints import Constraints, parse_pins
from .arrays import ArrayInfo
from .resolve import open_source
from .stores import ALLOW, permit

NAME = "cells"
#: Decoded bytes that a task reads, about.
TASK_BYTES = 64 << 20
BATCH_ROWS = 1 << 17
BOUNDED = ("lat", "lon", "time", "x", "y")


def bounds_of(options: dict[str, str]) -> dict[str, tuple[float | None, float | None]]:
    """``<dim>_min`` and ``<dim>_max``, of any dimension."""
    out: dict[str, list] = {}
    for key, value in options.items():
        name, _, end = key.rpartition("_")
        if end in ("min", "max") and name and value not in (None, ""):
            out.setdefault(name, [None, None])[end == "max"] = float(value)
    return {k: (v[0], v[1]) for k, v in out.items()}


def flag(options: dict[str, str], name: str, default: bool = False) -> bool:
    return str(options.get(name, default)).lower() in ("true", "1", "yes")


@dataclass
class Chunks(InputPartition):
    """A stretch of the chunks of one box."""

    box: Box
    start: int
    stop: int

    def __init__(self, box: Box, start: int, stop: int):
        super().__init__((start, stop))
        self.box, self.start, self.stop = box, start, stop


class CellSource(DataSource):
    """Options: path; <dim>_min and <dim>_max; pins; asset; columns; index_columns; exact; task_bytes."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def _open(self) -> ArrayInfo:
        if not hasattr(self, "_info"):
            path = self.options.get("path") or self.options.get("uri")
            # The planner's process doesn't have the driver's environment.
            permit(self.options.get("allow"))
            if not path:
                raise ValueError("the cells source needs a path")
            self._info = open_source(path, bounds_of(dict(self.options)), self.options.get("asset"))
        return self._info

    def schema(self) -> StructType:
        full = self._open().schema(flag(self.options, "index_columns"))
        wanted = self.options.get("columns")
        if not wanted:
            return full
        names = [c.strip() for c in wanted.split(",") if c.strip()]
        unknown = set(names) - set(full.names)
        if unknown:
            raise ValueError(f"no column {', '.join(sorted(unknown))}; there are {', '.join(full.names)}")
        return StructType([full[c] for c in names])

    def reader(self, schema: StructType) -> DataSourceReader:
        return CellReader(self._open(), schema, dict(self.options))


class CellReader(DataSourceReader):
    def __init__(self, info: ArrayInfo, schema: StructType, options: dict[str, str]):
        self.info, self.spark_schema = info, schema
        self.bounds = bounds_of(options)
        self.pins = parse_pins(options.get("pins"))
        self.exact = flag(options, "exact", True)
        self.task_bytes = int(options.get("task_bytes", TASK_BYTES))
        self.pushed: list[tuple[str, tuple[float | None, float | None]]] = []
        #: Dimensions of which only some values are asked for; those that never match have none.
        self.wanted: list[tuple[str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of a dimension narrow the box; Spark still applies them all."""
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            value = getattr(f, "value", None)
            if name in self.info.dims and isinstance(f, IsNull):
                self.wanted.append((name, ()))
            elif name in self.info.dims and isinstance(f, In):
                self.wanted.append((name, tuple(v for v in f.value if v is not None)))
            elif name in self.info.dims and isinstance(value, int | float) and not isinstance(value, bool):
                if isinstance(f, EqualTo):
                    self.pushed.append((name, (value, value)))
                elif isinstance(f, GreaterThan | GreaterThanOrEqual):
                    self.pushed.append((name, (value, None)))
                elif isinstance(f, LessThan | LessThanOrEqual):
                    self.pushed.append((name, (None, value)))
            yield f

    def _boxes(self) -> list[Box]:
        on_axis = tuple((n, b) for n, b in self.pushed if self.info.placed(self.info.dims.index(n)))
        found = self.info.boxes(Constraints(self.bounds, self.pins, on_axis), self.exact)
        # The value of a bare index is its position; an option says nothing about it.
        for name, (low, high) in self.pushed:
            d = self.info.dims.index(name)
            if self.info.placed(d):
                continue
            kept = []
            for b in found:
                lo, hi = b.ranges[d]
                lo = lo if low is None else max(lo, math.ceil(low))
                hi = hi if high is None else min(hi, math.floor(high))
                if lo <= hi:
                    kept.append(Box((*b.ranges[:d], (lo, hi), *b.ranges[d + 1 :]), b.chunk))
            found = kept
        for name, values in self.wanted:
            found = [part for b in found for part in self._stretches(b, self.info.dims.index(name), values)]
        return found

    def _stretches(self, box: Box, d: int, values: tuple) -> Iterator[Box]:
        """The box cut down to runs of neighbouring chunks that have any of the values along a dimension."""
        lo, hi = box.ranges[d]
        at = lo + np.flatnonzero(np.isin(self.info.axis(d, lo, hi + 1), values))
        if not at.size:
            return
        for run in np.split(at, np.flatnonzero(np.diff(at // box.chunk[d]) > 1) + 1):
            yield Box((*box.ranges[:d], (int(run[0]), int(run[-1])), *box.ranges[d + 1 :]), box.chunk)

    def partitions(self) -> list[InputPartition]:
        width = 8 if self.info.dtype == "string" else np.dtype(self.info.dtype).itemsize
        each = math.prod(self.info.chunk) * (width + 8 * len(self.info.dims))
        n = max(1, self.task_bytes // max(1, each))
        return [Chunks(b, k, min(k + n, b.total)) for b in self._boxes() for k in range(0, b.total, n)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(self.spark_schema)
        if not isinstance(partition, Chunks):
            return
        for k in range(partition.start, partition.stop):
            at = partition.box.nth(k)
            yield from self._emit(at, partition.box.inside(at), arrow)

    def _emit(self, at: tuple[int, ...], inside, arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
        info = self.info
        part = tuple(slice(a - g * c, b - g * c) for (a, b), g, c in zip(inside, at, info.chunk, strict=True))
        shape = tuple(b - a for a, b in inside)
        if 0 in shape:
            return
        need_value = "value" in arrow.names
        block = info.reader.read(at, part) if need_value else None
        if need_value and block is None and info.fill is None:
            dtype = object if info.dtype == "string" else info.dtype
            block = np.full(shape, getattr(info.reader, "fill", 0), dtype)
        # Cut along the first dimension, so that batches stay bounded.
        rows = max(1, BATCH_ROWS // max(1, math.prod(shape[1:])))
        for a in range(0, shape[0] if shape else 1, rows):
            lead = min(rows, shape[0] - a) if shape else 1
            some = (lead, *shape[1:]) if shape else ()
            columns = []
            for field in arrow:
                if field.name == "value":
                    columns.append(self._values(block, some, a, field.type))
                    continue
                index = field.name.startswith("__i_")
                d = info.dims.index(field.name[4:] if index else field.name)
                lo, hi = inside[d]
                if d == 0:
                    lo, hi = lo + a, lo + a + lead
                axis = np.arange(lo, hi, dtype=np.int64) if index else info.axis(d, lo, hi)
                spread = axis.reshape([-1 if j == d else 1 for j in range(len(some))])
                columns.append(pa.array(np.broadcast_to(spread, some).ravel(), field.type))
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    def _values(self, block: np.ndarray | None, shape: tuple[int, ...], a: int, kind: pa.DataType) -> pa.Array:
        if block is None:
            return pa.nulls(math.prod(shape), kind)
        return arrow_values(self.info, np.ascontiguousarray(block[a : a + shape[0]] if shape else block).ravel(), kind)


def arrow_values(info: ArrayInfo, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Values of an array as a column, the missing ones null."""
    mask = info.missing(values)
    if info.dtype == "uint64":
        return pa.array(values, pa.uint64(), mask=mask).cast(pa.decimal128(20, 0)).cast(kind)
    if info.dtype == "string":
        return pa.array(values.tolist(), kind, mask=mask)
    return pa.array(values, mask=mask).cast(kind)


def read_geo(
    spark: SparkSession,
    uri: str,
    lat_min: float | None = None,
    lat_max: float | None = None,
    lon_min: float | None = None,
    lon_max: float | None = None,
    time_min: float | None = None,
    time_max: float | None = None,
    pins: str | None = None,
    asset: str | None = None,
    columns: list[str] | None = None,
    index_columns: bool = False,
    exact: bool = True,
    task_bytes: int = TASK_BYTES,
    **bounds: float,
) -> DataFrame:
    """The cells of an array within bounds, as a distributed DataFrame."""
    register(spark)
    options = dict(lat_min=lat_min, lat_max=lat_max, lon_min=lon_min, lon_max=lon_max, time_min=time_min, time_max=time_max, pins=pins, asset=asset, **bounds)
    options |= dict(allow=os.environ.get(ALLOW) or os.getcwd(), columns=",".join(columns) if columns else None, index_columns=str(index_columns), exact=str(exact), task_bytes=task_bytes)
    reader = spark.read.format(NAME)
    for key, value in options.items():
        if value is not None:
            reader = reader.option(key, str(value))
    return reader.load(uri)


def register(spark: SparkSession) -> None:
    """Make the source, the sink and the table functions known to a session."""
    from .tables import functions
    from .zarr_sink import ZarrSink

    spark.dataSource.register(CellSource)
    spark.dataSource.register(ZarrSink)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    allowed = os.environ.get(ALLOW) or os.getcwd()
    if getattr(spark, "_gridloom_allowed", None) != allowed:
        for name, function in functions(allowed).items():
            spark.udtf.register(name, function)
        spark._gridloom_allowed = allowed
