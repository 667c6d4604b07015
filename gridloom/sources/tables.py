"""The same scans as SQL table functions, and the dry runs.

A table function over constants runs in one task: for large reads register
``read_geo``'s DataFrame as a view instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import LongType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..plans.constraints import Constraints, parse_pins
from .arrays import ArrayInfo
from .resolve import open_source
from .stores import permit

ARGUMENTS = ["uri", "lat_min", "lat_max", "lon_min", "lon_max", "time_min", "time_max", "pins", "asset"]
TYPE_NAMES = {"bool": "Bool", "string": "String"}

PLAN_SCHEMA = StructType().add("total_chunks", LongType()).add("total_bytes", LongType())
METADATA_SCHEMA = StructType().add("array_shape", StringType()).add("chunk_shape", StringType()).add("data_type", StringType()).add("crs", StringType())


def _bounds(given: dict) -> dict:
    out = {}
    for name in ("lat", "lon", "time", "x", "y"):
        ends = tuple(None if given.get(f"{name}_{e}") is None else float(given[f"{name}_{e}"]) for e in ("min", "max"))
        if ends != (None, None):
            out[name] = ends
    return out


def plan(uri: str, exact: bool = True, **given) -> tuple[int, int]:
    """Chunks that a scan would read and their decoded bytes; nothing but metadata is read."""
    bounds = _bounds(given)
    info = open_source(uri, bounds, given.get("asset"))
    return info.cost(Constraints(bounds, parse_pins(given.get("pins"))), exact)


def describe(uri: str, asset: str | None = None) -> tuple[str, str, str, str]:
    info: ArrayInfo = open_source(uri, asset=asset)
    show = lambda xs: "[" + ", ".join(map(str, xs)) + "]"
    kind = TYPE_NAMES.get(info.dtype) or info.dtype.replace("uint", "UInt").replace("int", "Int").replace("UInt", "UInt").replace("float", "Float")
    return show(info.shape), show(info.chunk), kind, info.crs or "UNKNOWN"


def plan_read_geo(spark: SparkSession, uri: str, **given) -> DataFrame:
    return spark.createDataFrame([plan(uri, **given)], PLAN_SCHEMA)


def read_zarr_metadata(spark: SparkSession, uri: str, asset: str | None = None, pins: str | None = None) -> DataFrame:
    """Pins are accepted, and don't change what is described."""
    return spark.createDataFrame([describe(uri, asset)], METADATA_SCHEMA)


def _given(args: tuple, named: dict) -> dict:
    both = {**dict(zip(ARGUMENTS, args, strict=False)), **named}
    if unknown := set(both) - set(ARGUMENTS):
        raise ValueError(f"no argument {', '.join(sorted(unknown))}; there are {', '.join(ARGUMENTS)}")
    return both


def functions(allowed: str) -> dict:
    """The table functions by name, for what a driver allows; their processes don't have its environment."""

    class CellTable:
        @staticmethod
        def analyze(*args: AnalyzeArgument, **named: AnalyzeArgument) -> AnalyzeResult:
            permit(allowed)
            given = {k: a.value for k, a in _given(args, named).items()}
            return AnalyzeResult(open_source(given["uri"], _bounds(given), given.get("asset")).schema())

        def eval(self, *args, **named):
            from .cells import CellReader

            permit(allowed)
            given = _given(args, named)
            uri = given.pop("uri")
            info = open_source(uri, _bounds(given), given.get("asset"))
            reader = CellReader(info, info.schema(), {k: str(v) for k, v in given.items() if v is not None})
            for part in reader.partitions():
                for batch in reader.read(part):
                    yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    class PlanCells:
        @staticmethod
        def analyze(*args: AnalyzeArgument, **named: AnalyzeArgument) -> AnalyzeResult:
            return AnalyzeResult(PLAN_SCHEMA)

        def eval(self, *args, **named):
            permit(allowed)
            given = _given(args, named)
            yield plan(given.pop("uri"), **given)

    class MetadataTable:
        @staticmethod
        def analyze(*args: AnalyzeArgument, **named: AnalyzeArgument) -> AnalyzeResult:
            return AnalyzeResult(METADATA_SCHEMA)

        def eval(self, *args, **named):
            permit(allowed)
            given = _given(args, named)
            yield describe(given["uri"], given.get("asset"))

    return {"read_geo": udtf(CellTable), "plan_read_geo": udtf(PlanCells), "read_zarr_metadata": udtf(MetadataTable)}
