"""Cells in footprints.

The grid is known, so a footprint's cells can be listed without looking at any.
Extraction does so at the chunks that footprints meet, and reads no others;
``cover_cells`` gives the list as a table, for joins on two integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.cover import Axis, cover_many
from ..functions.geometry import shapes_of_wkb, to_wkb
from ..plans.chunks import Box
from ..plans.constraints import Constraints, parse_pins
from ..sources.arrays import ArrayInfo
from ..sources.cells import BATCH_ROWS, arrow_values
from ..sources.resolve import open_source
from ..sources.vector import read_features
from .columns import block_of, by_column, column_chunks, dealt, footprint_chunks, groups_of, windows
from .grids import Grid, grid_of

NETWORK_BYTES = 25_000_000


def cover_cells(features: DataFrame, grid: Grid, convention: str = "centroid", keys: tuple[str, ...] = ("fid",)) -> DataFrame:
    """The keys with __iy, __ix and __weight of each covered cell."""
    schema = pa.schema([("i", pa.int64()), ("__iy", pa.int64()), ("__ix", pa.int64()), ("__weight", pa.float64())])
    kinds = [features.schema[k] for k in keys]
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kinds] + ["__iy long", "__ix long", "__weight double"])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = shapes_of_wkb(batch.column(len(keys)).to_pylist())
            for which, iy, ix, w in cover_many(shapes, grid.ys, grid.xs, convention):
                at = pa.array(which)
                yield pa.RecordBatch.from_arrays([*[batch.column(j).take(at) for j in range(len(keys))], pa.array(iy), pa.array(ix), pa.array(w)], [*keys, *schema.names[1:]])

    return features.select(*keys, "geom").mapInArrow(part, ddl)


@dataclass
class Plan:
    chunks: int
    megabytes: float
    seconds: float


def plan(uri: str, box, pins: str | None = None, asset: str | None = None) -> Plan:
    """What an extraction will read, and how long that takes over an assumed network."""
    bounds = {"lon": (box[0], box[2]), "lat": (box[1], box[3])} if box else {}
    chunks, size = open_source(uri, bounds, asset).cost(Constraints(bounds, parse_pins(pins)))
    return Plan(chunks, size / 1e6, size / NETWORK_BYTES)


def extract(
    spark: SparkSession,
    uri: str,
    features: DataFrame | str,
    pins: str | None = None,
    asset: str | None = None,
    convention: str = "centroid",
    value: str = "value",
) -> DataFrame:
    """Every cell with each footprint that it is in: dimensions, value, properties.

    A cell in two footprints comes twice.  A property named like a dimension
    or the value gets ``feature_`` in front.  Only chunks that meet a
    footprint's own box are read.
    """
    if isinstance(features, str):
        features = read_features(spark, features)
    info = open_source(uri, {}, asset)
    grid = grid_of(info)
    names = [c for c in features.columns if c != "geom"]
    taken = {*info.dims, "value", value}
    renamed = [f"feature_{c}" if c in taken else c for c in names]
    boxes = info.boxes(Constraints({}, parse_pins(pins)))
    groups = groups_of(spark, info, grid, boxes)
    parts = [F.col("geom"), F.monotonically_increasing_id().alias("k1"), *[F.col(f"`{c}`").alias(f"__p{i}") for i, c in enumerate(names)]]
    kept = features.select(*parts)
    placed = dealt(footprint_chunks(kept, info, grid, convention), features, groups)
    cells = info.schema()
    schema = T.StructType([*cells.fields, *(T.StructField(f"__p{i}", kept.schema[f"__p{i}"].dataType) for i in range(len(names)))])
    found = placed.mapInArrow(covered_cells(info, grid, convention, boxes, groups, schema), schema)
    return found.toDF(*info.dims, value, *renamed)


def covered_cells(info: ArrayInfo, grid: Grid, convention: str, boxes: list[Box], groups: int, schema: T.StructType):
    """A function of Arrow batches: footprints at chunks to the cells that they cover there."""
    dy, dx = info.dims.index(grid.y), info.dims.index(grid.x)
    rest = [d for d in range(len(info.dims)) if d not in (dy, dx)]
    arrow = to_arrow_schema(schema)
    width = len(info.dims) + 1

    def cells_of(b: Box, at: tuple[int, ...], which: pa.Array, iy: np.ndarray, ix: np.ndarray, own: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        inside = b.inside(at)
        block = block_of(info, b, at)
        values = None if block is None else np.moveaxis(block, (dy, dx), (-2, -1)).reshape(-1, inside[dy][1] - inside[dy][0], inside[dx][1] - inside[dx][0])
        axes = {d: info.axis(d, *inside[d]) for d in range(len(info.dims))}
        sizes = [inside[d][1] - inside[d][0] for d in rest]
        y, x = iy - inside[dy][0], ix - inside[dx][0]
        step = max(1, BATCH_ROWS // max(1, y.size))
        for first in range(0, math.prod(sizes), step):
            numbers = np.arange(first, min(first + step, math.prod(sizes)))
            n = numbers.size
            places = dict(zip(rest, np.unravel_index(numbers, sizes) if rest else (), strict=True))
            columns = []
            for d in range(len(info.dims)):
                at_d = np.tile(axes[d][y if d == dy else x], n) if d in (dy, dx) else np.repeat(axes[d][places[d]], y.size)
                columns.append(pa.array(at_d, arrow.field(d).type))
            got = pa.nulls(n * y.size, arrow.field(width - 1).type) if values is None else arrow_values(info, values[numbers][:, y, x].ravel(), arrow.field(width - 1).type)
            yield pa.RecordBatch.from_arrays([*columns, got, *(pa.chunked_array([c.take(which)] * n).combine_chunks() for c in own)], schema=arrow)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, chunks = None, []
        for key, rows in by_column(batches):
            if here != key:
                here, chunks = key, list(column_chunks(boxes, dy, dx, *key, groups))
            shapes = shapes_of_wkb(rows.column("geom").to_pylist())
            own = [rows.column(f.name) for f in arrow if f.name in rows.schema.names and f.name not in info.dims and f.name != "value"]
            for ys, xs in windows(chunks, dy, dx):
                for which, iy, ix, _ in cover_many(shapes, grid.ys, grid.xs, convention, ys, xs):
                    for b, at in chunks:
                        if (b.inside(at)[dy], b.inside(at)[dx]) == (ys, xs):
                            yield from cells_of(b, at, pa.array(which), iy, ix, own)

    return part


def _index(place: Column, axis: Axis) -> Column:
    """The index of the cell that a place is in.

    On an even axis it is round((place - origin) / step); on any other the cell
    of the nearest centre, found between the centres' midpoints.  Places more
    than half a cell outside of the axis are in none.
    """
    centres = axis.centres
    steps = np.diff(centres)
    if not steps.size or np.allclose(steps, steps.mean(), rtol=1e-6, atol=0):
        step = float(steps.mean()) if steps.size else 1.0
        return F.round((place - F.lit(float(centres[0]))) / F.lit(step)).cast("long")
    middles = (axis.sorted[1:] + axis.sorted[:-1]) / 2
    low, high = axis.sorted[0] - (middles[0] - axis.sorted[0]), axis.sorted[-1] + (axis.sorted[-1] - middles[-1])

    @F.pandas_udf("long")
    def nearest(column: pd.Series) -> pd.Series:
        v = column.to_numpy(float, na_value=np.nan)
        inside = (v >= low) & (v <= high)
        out = pd.Series(axis.order[np.searchsorted(middles, np.where(inside, v, low), "right")], dtype="Int64")
        return out.mask(~inside)

    return nearest(place)


def join_by_index(points: DataFrame, cells: DataFrame, grid: Grid, y: str = "y", x: str = "x") -> DataFrame:
    """Sub-cell assets to their cell by its indices, so it is an equi-join."""
    indexed = points.withColumn("__iy", _index(F.col(y), grid.ys)).withColumn("__ix", _index(F.col(x), grid.xs))
    joined = indexed.join(cells, (F.col("__iy") == F.col(f"__i_{grid.y}")) & (F.col("__ix") == F.col(f"__i_{grid.x}")))
    return joined.drop("__iy", "__ix", *[c for c in cells.columns if c.startswith("__i_")])


def box_candidates(features: DataFrame, grid: Grid, keys: tuple[str, ...] = ("fid",)) -> DataFrame:
    """Cells in the footprints' boxes: a candidate stage only, as it takes in too many."""

    @F.pandas_udf("binary")
    def boxed(column: pd.Series) -> pd.Series:
        boxes = shapes_of_wkb(column.tolist()).box
        corners = boxes[:, [0, 1, 2, 1, 2, 3, 0, 3, 0, 1]].reshape(-1, 5, 2)
        return pd.Series([None if np.isnan(c[0, 0]) else to_wkb([[c]]) for c in corners])

    return cover_cells(features.select(*keys, boxed(F.col("geom")).alias("geom")), grid, "all_touched", keys)
