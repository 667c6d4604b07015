"""What the operators need to know of a grid: its two spatial axes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cover import Axis
from ..functions.geometry import shapes_of_wkb
from ..plans.constraints import ALIASES
from ..sources.arrays import ArrayInfo

Box = tuple[float, float, float, float]


@dataclass
class Grid:
    y: str
    x: str
    ys: Axis
    xs: Axis


def spatial_dims(dims: list[str]) -> tuple[str, str]:
    y = next((d for d in ALIASES["lat"] if d in dims), None)
    x = next((d for d in ALIASES["lon"] if d in dims), None)
    if y is None or x is None:
        raise ValueError(f"no spatial dimensions among {', '.join(dims)}")
    return y, x


def grid_of(info: ArrayInfo) -> Grid:
    y, x = spatial_dims(info.dims)
    axes = []
    for name in (y, x):
        d = info.dims.index(name)
        axes.append(Axis(np.asarray(info.axis(d, 0, info.shape[d]), float), _step(info, d)))
    return Grid(y, x, *axes)


def _step(info: ArrayInfo, d: int) -> float | None:
    """The width of a cell, from the metadata of the whole axis rather than from what a query reads."""
    if info.dims[d] not in info.coords and info.scale is not None and info.scale[d]:
        return abs(float(info.scale[d]))
    raw = info.coords.get(info.dims[d])
    return float(abs(raw[-1] - raw[0]) / (raw.size - 1)) if raw is not None and raw.size > 1 else None


def _boxes(features: DataFrame, geom: str) -> DataFrame:
    """xmin, ymin, xmax, ymax of each footprint, null where it has no points."""

    @F.pandas_udf("xmin double, ymin double, xmax double, ymax double")
    def box(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(shapes_of_wkb(column.tolist()).box, columns=["xmin", "ymin", "xmax", "ymax"])

    return features.select(box(F.col(geom)).alias("b")).select(*[F.nullif(F.col(f"b.{n}"), F.lit(float("nan"))).alias(n) for n in ("xmin", "ymin", "xmax", "ymax")])


def extent(features: DataFrame, geom: str = "geom") -> Box | None:
    """The box around all footprints: each is boxed where it is, one row comes back."""
    row = extent_frame(features, geom).first()
    return None if row is None or row["xmin"] is None else tuple(row)


def extent_frame(features: DataFrame, geom: str = "geom") -> DataFrame:
    """The same as a row of xmin, ymin, xmax, ymax."""
    parts = zip(("xmin", "ymin", "xmax", "ymax"), (F.min, F.min, F.max, F.max), strict=True)
    return _boxes(features, geom).agg(*[f(n).alias(n) for n, f in parts])


def cell_step(cells: DataFrame, y: str = "lat", x: str = "lon") -> DataFrame:
    """dx and dy from the cells themselves; null where there is one row or column."""
    step = lambda c: (F.max(c) - F.min(c)) / F.nullif(F.count_distinct(F.col(c)) - 1, F.lit(0))
    return cells.agg(step(x).alias("dx"), step(y).alias("dy"))
