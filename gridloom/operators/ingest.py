"""Vector and tabular files to arrays."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from ..sources.vector import read_features
from ..sources.zarr_sink import export_zarr

COORDINATES = ("geom", "x", "y", "lon", "lat", "longitude", "latitude", "time", "t")
SPATIAL_CHUNK, TIME_CHUNK = 100, 10


def default_chunks(dims: list[str]) -> dict[str, int]:
    out = {}
    for d in dims:
        name = d.lower()
        if name in ("x", "y") or name.startswith(("lon", "lat")):
            out[d] = SPATIAL_CHUNK
        elif name.startswith(("time", "date")):
            out[d] = TIME_CHUNK
    return out


def ingest(spark: SparkSession, path: str, out: str, value: str | None = None, chunks: str | None = None, mode: str = "error") -> dict:
    """All columns but the geometry and the value are dimensions."""
    df = read_features(spark, path)
    df = df.drop("geom")
    value = value or next((c for c in df.columns if c.lower() not in COORDINATES), None)
    if value is None or value not in df.columns:
        raise ValueError(f"no value column {value or ''} in {path}")
    dims = [c for c in df.columns if c != value]
    sizes = default_chunks(dims)
    if chunks:
        try:
            own = json.loads(chunks)
        except ValueError as e:
            raise ValueError(f"chunk sizes aren't JSON: {e}") from e
        if not isinstance(own, dict):
            raise ValueError("chunk sizes must be an object")
        sizes |= own
    return export_zarr(df, out, value, dims, sizes, mode=mode)
