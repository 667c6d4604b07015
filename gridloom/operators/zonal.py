"""Statistics of an array's cells per footprint.

Footprints go to the chunks that their boxes meet.  A task has the footprints at
one column of chunks (those that differ in other dimensions than the spatial
two), for a stretch of that column; it lists the footprints' cells once, takes
them out of one chunk after the other, and emits partial aggregates, which are
merged by footprint.  No cell becomes a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.cover import CONVENTIONS, cover_many
from ..functions.geometry import shapes_of_wkb
from ..plans.chunks import Box
from ..plans.constraints import Constraints, parse_pins
from ..sources.arrays import ArrayInfo
from ..sources.resolve import open_source
from ..sources.vector import read_features
from .columns import block_of, by_column, column_chunks, dealt, footprint_chunks, groups_of, windows
from .grids import Grid, grid_of

METRICS = ("max", "min", "mean", "sum", "count")
#: Decoded values that a task keeps while it goes through its footprints; beyond it, chunks are read again.
HELD_BYTES = 128 << 20
#: As many properties travel with the partial aggregates; more are joined.
FEW_PROPERTIES = 8


def check(metric: str, convention: str) -> None:
    if convention not in CONVENTIONS:
        raise ValueError(f"no convention {convention!r}; there are {', '.join(CONVENTIONS)}")
    if metric not in METRICS:
        raise ValueError(f"no metric {metric!r}; there are {', '.join(METRICS)}")
    if convention == "area_weighted" and metric not in ("mean", "sum"):
        raise ValueError(f"area_weighted has mean and sum, not {metric}")


def keyed(features: DataFrame, by_feature: bool) -> tuple[DataFrame, list[str]]:
    """Adds k1 and k2, a 128-bit key of the properties (and the geometry, to keep equal ones apart)."""
    names = [c for c in features.columns if c != "geom"]
    parts = [F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])) if names else F.lit("")]
    parts += [F.col("geom")] if by_feature else []
    return features.withColumn("k1", F.xxhash64(F.lit(1), *parts)).withColumn("k2", F.xxhash64(F.lit(2), *parts)), names


def partial_stats(placed: DataFrame, info: ArrayInfo, grid: Grid, convention: str, metric: str, boxes: list[Box], groups: int, by_time: bool, carried: list[str]) -> DataFrame:
    """k1, k2, (time,) v, n and the carried columns of each footprint at each chunk with cells; what v and n are depends on the metric."""
    dy, dx = info.dims.index(grid.y), info.dims.index(grid.x)
    rest = [d for d in range(len(info.dims)) if d not in (dy, dx)]
    time = info.dims.index("time") if by_time and "time" in info.dims else None
    kinds = [T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType())]
    if by_time:
        kinds.append(T.StructField("time", T.DoubleType()))
    kinds += [T.StructField("v", T.DoubleType()), T.StructField("n", T.DoubleType()), *(placed.schema[c] for c in carried)]
    schema = T.StructType(kinds)
    arrow = to_arrow_schema(schema)

    def slab(b: Box, at: tuple[int, ...]):
        """A chunk's part in the box: (time, values with a row per step and a column per cell), rows, columns; None if it is all missing."""
        inside = b.inside(at)
        block = block_of(info, b, at)
        if block is None:
            return None
        missing = info.missing(np.ascontiguousarray(block))
        values = block.astype(np.float64 if block.dtype.kind != "f" else block.dtype)
        if missing is not None and missing.any():
            values[missing.reshape(values.shape)] = np.nan
        values = np.moveaxis(values, (dy, dx), (-2, -1))
        if time is None:
            steps = [(None, np.ascontiguousarray(values).reshape(-1, math.prod(values.shape[-2:])))]
        else:
            lead = np.moveaxis(values, rest.index(time), 0)
            steps = [(float(t), np.ascontiguousarray(lead[i]).reshape(-1, math.prod(values.shape[-2:]))) for i, t in enumerate(info.axis(time, *inside[time]))]
        return steps, inside[dy], inside[dx]

    def reduced(values: np.ndarray, flat: np.ndarray, starts: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """v, n and the number of cells with a value, for each footprint."""
        got = np.take(values, flat, axis=1).astype(np.float64)
        there = ~np.isnan(got)
        steps = got.shape[0]
        whole = there.all()
        n = np.full(flat.size, float(steps)) if whole else there.sum(axis=0).astype(float)
        counts = np.add.reduceat(n, starts)
        if metric in ("max", "min"):
            f, empty = (np.maximum, -np.inf) if metric == "max" else (np.minimum, np.inf)
            return f.reduceat(f.reduce(got if whole else np.where(there, got, empty), axis=0), starts), counts, counts
        if metric == "count":
            return counts, counts, counts
        total = (got if whole else np.where(there, got, 0)).sum(axis=0)
        if convention == "area_weighted":
            return np.add.reduceat(total * weight, starts), np.add.reduceat(n * weight, starts), counts
        return np.add.reduceat(total, starts), counts, counts

    class Column:
        """The chunks of one task's column: held if they are small, else read whenever they are asked for."""

        def __init__(self, key: tuple[int, int, int]):
            self.chunks = list(column_chunks(boxes, dy, dx, *key, groups))
            each = math.prod(info.chunk) * 8
            self.held = [slab(*c) for c in self.chunks] if each * len(self.chunks) <= HELD_BYTES else None

        def slabs(self):
            found = self.held if self.held is not None else (slab(*c) for c in self.chunks)
            return (s for s in found if s is not None)

    def footprints(column: Column, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Partial aggregates of some footprints at one column."""
        shapes = shapes_of_wkb(batch.column("geom").to_pylist())
        for ys, xs in windows(column.chunks, dy, dx):
            for which, iy, ix, weight in cover_many(shapes, grid.ys, grid.xs, convention, ys, xs):
                # Cells of a footprint stand together.
                starts = np.flatnonzero(np.diff(which, prepend=-1))
                ids = which[starts]
                flat = (iy - ys[0]) * (xs[1] - xs[0]) + ix - xs[0]
                for steps, rows, columns in column.slabs():
                    if (rows, columns) != (ys, xs):
                        continue
                    for t, values in steps:
                        v, n, counts = reduced(values, flat, starts, weight)
                        some = counts > 0
                        if not some.any():
                            continue
                        at = pa.array(ids[some])
                        own = [batch.column("k1").take(at), batch.column("k2").take(at)]
                        own += [pa.array(np.full(len(at), np.nan if t is None else t))] if by_time else []
                        yield pa.RecordBatch.from_arrays([*own, pa.array(v[some]), pa.array(n[some]), *(batch.column(c).take(at) for c in carried)], schema=arrow)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, column = None, None
        for key, rows in by_column(batches):
            if here != key:
                here, column = key, Column(key)
            yield from footprints(column, rows)

    return placed.mapInArrow(part, schema)


def metric_column(metric: str, convention: str):
    if metric == "mean":
        return F.sum("v") / (F.nullif(F.sum("n"), F.lit(0.0)) if convention == "area_weighted" else F.sum("n"))
    if metric == "count":
        return F.sum("n").cast("long")
    return {"max": F.max, "min": F.min, "sum": F.sum}[metric]("v")


def zonal_stats(
    spark: SparkSession,
    uri: str,
    features: DataFrame | str,
    metric: str = "mean",
    convention: str = "centroid",
    by_time: bool = False,
    by_feature: bool = False,
    asset: str | None = None,
    pins: str | None = None,
    bounds: dict | None = None,
) -> DataFrame:
    """One row per footprint with cells: its properties, (time,) metric.

    All other dimensions are pooled.  Footprints of equal properties are one,
    unless ``by_feature``.  Missing cells count nowhere.
    """
    check(metric, convention)
    if isinstance(features, str):
        features = read_features(spark, features)
    info = open_source(uri, bounds, asset)
    grid = grid_of(info)
    features, names = keyed(features, by_feature)
    boxes = info.boxes(Constraints(bounds or {}, parse_pins(pins)))
    groups = groups_of(spark, info, grid, boxes)
    few = len(names) <= FEW_PROPERTIES
    own = F.struct(*[F.col(f"`{c}`").alias(f"p{i}") for i, c in enumerate(names)]) if names else F.lit(None).cast("string")
    kept = features.select("k1", "k2", "geom", *([own.alias("own")] if few else []))
    placed = dealt(footprint_chunks(kept, info, grid, convention), features, groups)
    partial = partial_stats(placed, info, grid, convention, metric, boxes, groups, by_time, ["own"] if few else [])
    keys = ["k1", "k2", *(["time"] if by_time else [])]
    merged = partial.groupBy(*keys).agg(metric_column(metric, convention).alias("metric"), *([F.first("own").alias("own")] if few else []))
    last = [*(["time"] if by_time else []), "metric"]
    if few:
        return merged.select(*[F.col(f"own.p{i}").alias(c) for i, c in enumerate(names)], *last)
    properties = features.select("k1", "k2", *[F.col(f"`{c}`") for c in names]).dropDuplicates(["k1", "k2"])
    return merged.join(properties, ["k1", "k2"]).select(*[F.col(f"`{c}`") for c in names], *last)
