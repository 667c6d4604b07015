"""The time series of an array at a point."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.cells import read_geo
from ..sources.resolve import open_source
from .grids import Grid, grid_of

METHODS = {"nearest": 1, "idw": 4}
LEAST = 1e-9


def nearest_cells(grid: Grid, lat: float, lon: float, k: int) -> list[tuple[int, int, float]]:
    """(iy, ix, planar distance) of the k closest cells; ties go to the lower latitude, then longitude.

    The axes are known, so only the k closest rows and columns can matter.
    """
    iy = np.lexsort((grid.ys.centres, np.abs(grid.ys.centres - lat)))[: k + 1]
    ix = np.lexsort((grid.xs.centres, np.abs(grid.xs.centres - lon)))[: k + 1]
    found = [(float(np.hypot(grid.ys.centres[y] - lat, grid.xs.centres[x] - lon)), grid.ys.centres[y], grid.xs.centres[x], int(y), int(x)) for y in iy for x in ix]
    return [(y, x, d) for d, _, _, y, x in sorted(found)[:k]]


def point_timeseries(spark: SparkSession, uri: str, lat: float, lon: float, method: str = "nearest", asset: str | None = None, value: str = "value") -> DataFrame:
    """time, lat, lon, value, in the order of time.

    nearest: the closest cell's own place and values.  idw: the place asked
    for, and the mean of the four closest by inverse distance, over those that
    aren't missing.
    """
    if method not in METHODS:
        raise ValueError(f"no method {method!r}; there are {', '.join(METHODS)}")
    info = open_source(uri, {}, asset)
    grid = grid_of(info)
    closest = nearest_cells(grid, lat, lon, METHODS[method])
    iy, ix = [y for y, _, _ in closest], [x for _, x, _ in closest]
    ys, xs = grid.ys.centres, grid.xs.centres
    window = {
        f"{grid.y}_min": float(ys[iy].min()), f"{grid.y}_max": float(ys[iy].max()),
        f"{grid.x}_min": float(xs[ix].min()), f"{grid.x}_max": float(xs[ix].max()),
    }
    cells = read_geo(spark, uri, asset=asset, index_columns=True, **window)
    table = spark.createDataFrame(closest, T.StructType([T.StructField("__iy", T.LongType()), T.StructField("__ix", T.LongType()), T.StructField("__dist", T.DoubleType())]))
    # One or four rows.
    joined = cells.join(F.broadcast(table), (F.col(f"__i_{grid.y}") == F.col("__iy")) & (F.col(f"__i_{grid.x}") == F.col("__ix")))
    if method == "nearest":
        return joined.select("time", F.col(grid.y).alias("lat"), F.col(grid.x).alias("lon"), F.col("value").alias(value)).orderBy("time")
    weight = F.lit(1.0) / F.greatest(F.col("__dist"), F.lit(LEAST))
    there = F.when(F.col("value").isNotNull(), weight)
    out = joined.groupBy("time").agg((F.sum(F.col("value") * weight) / F.nullif(F.sum(there), F.lit(0.0))).alias(value))
    return out.select("time", F.lit(float(lat)).alias("lat"), F.lit(float(lon)).alias("lon"), value).orderBy("time")
