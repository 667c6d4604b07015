"""An agent's tools over one session: each returns plain data that can be sent as JSON."""

from __future__ import annotations

import collections
import datetime
import decimal
import itertools
import json
import math
import re
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import guard
from .operators.timeseries import point_timeseries
from .operators.zonal import zonal_stats
from .session import session
from .sources.cells import read_geo, register
from .sources.tables import METADATA_SCHEMA, describe, plan

DEFAULT_LIMIT = 1000
SAMPLE = 5
#: Results that stay in the executors' memory.
KEPT = 16
TIMEOUT = 120.0
NAME = re.compile(r"[A-Za-z0-9_]+")


def plain(value):
    """JSON's idea of a value: whole numbers beyond 64 bits and all that it lacks as text."""
    if value is None or isinstance(value, bool | str):
        return value
    if isinstance(value, int):
        return value if -(1 << 63) <= value < 1 << 63 else str(value)
    if isinstance(value, float):
        return value if math.isfinite(value) else None
    if isinstance(value, decimal.Decimal):
        return plain(int(value)) if value == value.to_integral_value() and value.as_tuple().exponent >= 0 else str(value)
    if isinstance(value, datetime.datetime | datetime.date):
        return value.isoformat(sep=" ") if isinstance(value, datetime.datetime) else value.isoformat()
    if isinstance(value, list | tuple):
        return [plain(v) for v in value]
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    return str(value)


def identifier(name: str) -> str:
    if not NAME.fullmatch(name or ""):
        raise ValueError(f"{name!r} is not a plain name")
    return name


class TimedOut(TimeoutError):
    pass


class Tools:
    def __init__(self, spark: SparkSession | None = None, timeout: float = TIMEOUT, progress: Callable[[float], None] | None = None):
        self.spark = spark or session()
        register(self.spark)
        self.timeout, self.progress = timeout, progress
        self._numbers = itertools.count(1)
        self._kept: collections.OrderedDict[str, DataFrame] = collections.OrderedDict()
        self._one = threading.Lock()

    # -- running ---------------------------------------------------------

    def _run(self, work: Callable[[], dict]) -> dict:
        """One call at a time; its jobs are cancelled when its time is over.

        A call may submit jobs later than that, as when it is still planned at
        that moment, so cancelling goes on until the call has ended.
        """
        with self._one:
            context, tag = self.spark.sparkContext, f"tool-{uuid.uuid4().hex}"
            over, began = threading.Event(), datetime.datetime.now()
            late = []

            def watch() -> None:
                while not over.wait(0.5):
                    spent = (datetime.datetime.now() - began).total_seconds()
                    if self.progress:
                        self.progress(spent)
                    if spent > self.timeout:
                        late.append(spent)
                        context.cancelJobsWithTag(tag)

            watcher = threading.Thread(target=watch, daemon=True)
            context.addJobTag(tag)
            watcher.start()
            try:
                return work()
            except Exception as e:
                if late:
                    raise TimedOut(f"the call took more than {self.timeout:g} s") from e
                raise
            finally:
                over.set()
                context.removeJobTag(tag)

    def materialize(self, df: DataFrame, limit: int | None = None) -> dict:
        """Keep the whole result as a view of this session and return its head.

        The last KEPT results are held by the executors; what is older is
        released, and its view computes it anew when it is asked for.
        """
        limit = DEFAULT_LIMIT if limit is None else limit
        handle = f"result_{next(self._numbers)}"
        kept = df.persist()
        self._kept[handle] = kept
        while len(self._kept) > KEPT:
            self._kept.popitem(last=False)[1].unpersist()
        kept.createOrReplaceTempView(handle)
        total = kept.count()
        rows = [[plain(v) for v in r] for r in kept.limit(limit).collect()]
        return {"table_handle": handle, "row_count": total, "columns": kept.columns, "rows": rows, "truncated": total > len(rows)}

    # -- tools -----------------------------------------------------------

    def describe_dataset(self, uri: str) -> dict:
        return self._run(lambda: {"metadata": [dict(zip(METADATA_SCHEMA.names, describe(uri), strict=True))]})

    def estimate_cost(self, uri: str, bbox: dict | None = None, time: dict | None = None) -> dict:
        def work() -> dict:
            chunks, size = plan(uri, **_window(bbox, time))
            return {"estimate": [{"total_chunks": chunks, "total_bytes": size}]}

        return self._run(work)

    def read_region(self, uri: str, bbox: dict | None = None, time: dict | None = None, asset: str | None = None, limit: int | None = None) -> dict:
        return self._run(lambda: self.materialize(read_geo(self.spark, uri, asset=asset, **_window(bbox, time)), limit))

    def list_tables(self) -> dict:
        def work() -> dict:
            found = [{"name": t.name, "temporary": t.isTemporary} for t in self.spark.catalog.listTables()]
            return {"tables": sorted(found, key=lambda t: t["name"])}

        return self._run(work)

    def describe_table(self, table: str) -> dict:
        name = identifier(table)

        def work() -> dict:
            df = self.spark.table(name)
            schema = [{"column_name": f.name, "column_type": f.dataType.simpleString(), "null": f.nullable} for f in df.schema]
            return {"schema": schema, "sample": [{k: plain(v) for k, v in r.asDict().items()} for r in df.limit(SAMPLE).collect()]}

        return self._run(work)

    def run_sql(self, sql: str, limit: int | None = None) -> dict:
        statement = guard.check(sql, self.spark)

        def work() -> dict:
            df = self.spark.sql(statement.text)
            return self.materialize(df, limit) if statement.reads else {"status": "ok"}

        return self._run(work)

    def zonal_stats(self, grid: str, polygons: str, metric: str, convention: str = "centroid", value_col: str | None = None, limit: int | None = None) -> dict:
        value = identifier(value_col or "value")

        def work() -> dict:
            if value != "value":
                raise ValueError(f"no column {value}")
            out = self.materialize(zonal_stats(self.spark, grid, polygons, metric, convention), limit)
            return out | {"convention": convention, "metric": metric}

        return self._run(work)

    def extract_point_timeseries(self, uri: str, lat: float, lon: float, method: str = "nearest", value_col: str | None = None) -> dict:
        value = identifier(value_col or "value")
        return self._run(lambda: self.materialize(point_timeseries(self.spark, uri, lat, lon, method, value=value)) | {"method": method})


def _window(bbox: dict | None, time: dict | None) -> dict:
    given = {k: float(v) for k, v in (bbox or {}).items() if k in ("lat_min", "lat_max", "lon_min", "lon_max") and v is not None}
    for end in ("min", "max"):
        value = (time or {}).get(f"time_{end}", (time or {}).get(end))
        if value is not None:
            given[f"time_{end}"] = float(value)
    return given


TOOLS = ["describe_dataset", "estimate_cost", "read_region", "list_tables", "describe_table", "run_sql", "zonal_stats", "extract_point_timeseries"]


def serve(lines, write: Callable[[str], None], tools: Tools | None = None) -> None:
    """JSON-RPC over lines: ``initialize``, ``tools/list`` and ``tools/call``."""
    import inspect

    tools = tools or Tools()
    for line in lines:
        if not line.strip():
            continue
        request = json.loads(line)
        if "id" not in request:
            continue
        method, params = request.get("method"), request.get("params") or {}
        reply: dict = {"jsonrpc": "2.0", "id": request["id"]}
        try:
            if method == "initialize":
                reply["result"] = {"protocolVersion": params.get("protocolVersion", "2024-11-05"), "capabilities": {"tools": {}}, "serverInfo": {"name": "gridloom", "version": "1"}}
            elif method == "tools/list":
                described = []
                for name in TOOLS:
                    arguments = inspect.signature(getattr(Tools, name)).parameters
                    properties = {p: {} for p in arguments if p != "self"}
                    needed = [p for p, a in arguments.items() if p != "self" and a.default is inspect.Parameter.empty]
                    described.append({"name": name, "inputSchema": {"type": "object", "properties": properties, "required": needed}})
                reply["result"] = {"tools": described}
            elif method == "tools/call":
                if params.get("name") not in TOOLS:
                    raise ValueError(f"no tool {params.get('name')!r}")
                got = getattr(tools, params["name"])(**(params.get("arguments") or {}))
                reply["result"] = {"content": [{"type": "text", "text": json.dumps(got)}], "isError": False}
            else:
                reply["error"] = {"code": -32601, "message": f"no method {method!r}"}
        except Exception as e:  # the caller gets every failure as a reply
            reply["result"] = {"content": [{"type": "text", "text": str(e)}], "isError": True}
        write(json.dumps(reply))
