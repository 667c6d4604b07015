"""Footprints at the chunks that they meet.

A column of chunks is all those that differ in other dimensions than the two
spatial ones.  Its chunks are cut into groups, so that an array of few columns
still gives every core something to do; a task has one group and the footprints
at that column.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cover import margins, spread
from ..functions.geometry import shapes_of_wkb
from ..plans.chunks import Box
from ..sources.arrays import ArrayInfo
from .grids import Grid

#: Footprints at one column of chunks that a task takes, about; more are dealt out to several.
PER_TASK = 100_000
#: Footprints of less data than this can't be too many for the tasks.
FEW_BYTES = 32 << 20
#: Tasks for each core at least, if the array has as many chunks.
TASKS_A_CORE = 4

Key = tuple[int, int, int]


def footprint_chunks(features: DataFrame, info: ArrayInfo, grid: Grid, convention: str) -> DataFrame:
    """The features with the (cy, cx) of each chunk that their box meets."""
    dy, dx = info.dims.index(grid.y), info.dims.index(grid.x)
    chunk_y, chunk_x = info.chunk[dy], info.chunk[dx]
    my, mx = margins(convention, grid.ys, grid.xs)
    schema = T.StructType([*features.schema.fields, T.StructField("cy", T.IntegerType()), T.StructField("cx", T.IntegerType())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = shapes_of_wkb(batch.column(batch.schema.get_field_index("geom")).to_pylist())
            known = shapes.known()
            if not known.size:
                continue
            edge = shapes.box[known]
            spans = []
            for axis, low, high, margin, size in ((grid.ys, 1, 3, my, chunk_y), (grid.xs, 0, 2, mx, chunk_x)):
                first, last = axis.span(edge[:, low], edge[:, high], margin)
                some = last > first
                ends = np.stack([axis.order[np.minimum(first, axis.order.size - 1)], axis.order[np.maximum(last - 1, 0)]]) // size
                spans.append((some, ends.min(axis=0), ends.max(axis=0)))
            (sy, y0, y1), (sx, x0, x1) = spans
            ny, nx = y1 - y0 + 1, x1 - x0 + 1
            which, local = spread(np.where(sy & sx, ny * nx, 0))
            at = pa.array(known[which])
            cy, cx = (pa.array(c.astype(np.int32)) for c in (y0[which] + local // nx[which], x0[which] + local % nx[which]))
            yield pa.RecordBatch.from_arrays([*(c.take(at) for c in batch.columns), cy, cx], [*batch.schema.names, "cy", "cx"])

    return features.mapInArrow(part, schema)


def groups_of(spark: SparkSession, info: ArrayInfo, grid: Grid, boxes: list[Box]) -> int:
    """Into how many groups the chunks of a column are cut."""
    dy, dx = info.dims.index(grid.y), info.dims.index(grid.x)
    columns = sum((b.grid[dy][1] - b.grid[dy][0] + 1) * (b.grid[dx][1] - b.grid[dx][0] + 1) for b in boxes)
    deep = max((math.prod(hi - lo + 1 for d, (lo, hi) in enumerate(b.grid) if d not in (dy, dx)) for b in boxes), default=1)
    return min(deep, max(1, TASKS_A_CORE * spark.sparkContext.defaultParallelism // max(1, columns)))


def dealt(placed: DataFrame, features: DataFrame, groups: int) -> DataFrame:
    """Footprints at a column of chunks to as many tasks as it has groups; where there are too many of them, to more."""
    spark = placed.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.withColumn("part_of", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))) if groups > 1 else F.lit(0))
    keys = ["cy", "cx", "part_of"]
    size = features._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if size > FEW_BYTES:
        # A row for every PER_TASK footprints at most.
        hot = placed.groupBy("cy", "cx").agg(F.ceil(F.count("*") / F.lit(PER_TASK * groups)).cast("int").alias("parts")).where("parts > 1")
        rows = hot.collect()
        if rows:
            table = F.broadcast(spark.createDataFrame(rows, "cy int, cx int, parts int"))
            placed = placed.join(table, ["cy", "cx"], "left").withColumn("salt", F.pmod("k1", F.coalesce("parts", F.lit(1)))).drop("parts")
            return placed.repartition(n, *keys, "salt").sortWithinPartitions(*keys).drop("salt")
    return placed.repartition(n, *keys).sortWithinPartitions(*keys)


def by_column(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Key, pa.RecordBatch]]:
    """The rows of ``dealt`` by column and group."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("cy", "cx", "part_of")])
        cuts = np.flatnonzero(np.append(True, (np.diff(keys, axis=1) != 0).any(axis=0)))
        for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
            yield tuple(int(x) for x in keys[:, a]), batch.slice(a, b - a)


def column_chunks(boxes: list[Box], dy: int, dx: int, cy: int, cx: int, group: int, groups: int) -> Iterator[tuple[Box, tuple[int, ...]]]:
    """The chunks of a column that belong to a group, each with its box."""
    for b in boxes:
        if not (b.grid[dy][0] <= cy <= b.grid[dy][1] and b.grid[dx][0] <= cx <= b.grid[dx][1]):
            continue
        rest = [d for d in range(len(b.chunk)) if d not in (dy, dx)]
        sizes = [b.grid[d][1] - b.grid[d][0] + 1 for d in rest]
        for number in range(group, math.prod(sizes), groups):
            at = [0] * len(b.chunk)
            at[dy], at[dx] = cy, cx
            for d, i in zip(rest, np.unravel_index(number, sizes) if rest else (), strict=True):
                at[d] = b.grid[d][0] + int(i)
            yield b, tuple(at)


def windows(chunks: list[tuple[Box, tuple[int, ...]]], dy: int, dx: int) -> set:
    """Rows and columns, half-open, of a column's chunks: those of one box have the same ones."""
    return {(b.inside(at)[dy], b.inside(at)[dx]) for b, at in chunks}


def block_of(info: ArrayInfo, b: Box, at: tuple[int, ...]) -> np.ndarray | None:
    """A chunk's part in its box; None if all of it is missing."""
    inside = b.inside(at)
    part = tuple(slice(lo - g * c, hi - g * c) for (lo, hi), g, c in zip(inside, at, info.chunk, strict=True))
    block = info.reader.read(at, part)
    if block is None and info.fill is None:
        kind = object if info.dtype == "string" else info.dtype
        block = np.full([hi - lo for lo, hi in inside], getattr(info.reader, "fill", 0), kind)
    return block
