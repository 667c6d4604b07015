"""Arrays derived from tables: a way to have an array of any table with coordinates."""

from __future__ import annotations

import hashlib
import os
import threading

from pyspark.sql import DataFrame, SparkSession

from ..session import allow, shared_space
from ..sources.zarr_sink import exists, export_zarr, remove

_LOCK = threading.Lock()
_BUILT: dict[str, str] = {}


def stored(spark: SparkSession, name: str, source: str, make, **layout) -> str:
    """The path of an array that ``make()`` gives the cells of, written once per session and source."""
    space = shared_space(spark)
    allow(space)
    key = f"{spark.sparkContext.applicationId}:{source}:{name}"
    with _LOCK:
        path = _BUILT.get(key)
        if path is None or not exists(path):
            path = os.path.join(space, f"{name}-{hashlib.sha1(key.encode()).hexdigest()[:12]}.zarr")
            if exists(path):
                remove(path)
            cells: DataFrame = make()
            export_zarr(cells, path, **layout)
            _BUILT[key] = path
    return path
