"""Queries over formats, files, remote sources, tools and commands, each with its SQL.

What they read is written from the driver's tables: the lattice of ``queries``
as other kinds of arrays, and its customers as vector files.
"""

from __future__ import annotations

import contextlib
import io
import json
import os
import shutil
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import guard
from .config import PROVIDERS, Config, load
from .functions.geometry import area, centroid, from_wkb
from .operators.extract import extract, join_by_index, plan
from .operators.grids import Grid
from .operators.ingest import ingest
from .operators.lattice import stored
from .operators.plots import heatmap, histogram
from .operators.resample import detect, value_column
from .operators.search import collections, search
from .operators.timeseries import point_timeseries
from .operators.zonal import zonal_stats
from .functions.cover import Axis
from .queries import ALL, BIN, BOX, IN_BOX, IN_DIAMOND, IN_TRIANGLE, INSIDE, RECTANGLES, SQL_RECTANGLES, WITH, cells, lattice, query, read, rectangles, shapes, there
from .session import shared_space
from .sources import codecs
from .sources.arrays import ArrayInfo
from .sources.cells import read_geo
from .sources.cog import write_cog
from .sources.folder_server import CATALOGUE, FolderServer
from .sources.resolve import Group, list_sources, open_source
from .sources.stores import Forbidden, checked
from .sources.tables import read_zarr_metadata
from .sources.vector import read_features
from .sources.zarr_sink import array_json, auto_chunks, export_zarr
from .tools import TimedOut, Tools

_MADE: dict[tuple, object] = {}


def values(*rows: tuple, names: str) -> str:
    """Rows that don't depend on the tables, as SQL."""
    show = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"CAST({v} AS {'BIGINT' if isinstance(v, int) else 'DOUBLE'})"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(show, r)) + ')' for r in rows)}) v({names})"


def made(spark: SparkSession, sf_dir: str, name: str, make) -> str:
    """A folder that ``make`` has filled, once per session and source."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _MADE:
        lattice(spark, sf_dir)  # allows the shared space
        folder = os.path.join(shared_space(spark), f"{name}-{uuid.uuid4().hex[:12]}")
        os.makedirs(folder)
        make(folder)
        _MADE[key] = folder
    return _MADE[key]


def cube(spark: SparkSession, sf_dir: str) -> np.ndarray:
    """The lattice in memory: its 12 x 20 x 24 cells, whatever the size of the tables."""
    out = np.full((12, 20, 24), np.nan)
    for r in cells(spark, sf_dir).collect():
        if r["value"] is not None:
            out[r["it"], r["iy"], r["ix"]] = r["value"]
    return out


TIMES, LATS, LONS = np.arange(12.0), 40 + 0.5 * np.arange(20), -100 + 0.5 * np.arange(24)


def put(folder: str, key: str, data) -> None:
    path = os.path.join(folder, key)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else json.dumps(data).encode())


def blocks(a: np.ndarray, chunks: tuple[int, ...], fill):
    """(chunk's place, whole chunk) of an array."""
    for at in np.ndindex(*[-(-s // c) for s, c in zip(a.shape, chunks, strict=True)]):
        block = np.full(chunks, fill, a.dtype)
        part = a[tuple(slice(i * c, (i + 1) * c) for i, c in zip(at, chunks, strict=True))]
        block[tuple(slice(0, n) for n in part.shape)] = part
        yield at, block


def version_two(folder: str, name: str, a: np.ndarray, chunks: tuple[int, ...], dims: list[str], press: str | None = "zlib", order: str = "C", separator: str = ".") -> None:
    fill = np.nan if a.dtype.kind == "f" else 0
    put(folder, f"{name}/.zarray", {"zarr_format": 2, "shape": a.shape, "chunks": chunks, "dtype": a.dtype.str, "compressor": press and {"id": press}, "filters": None, "order": order, "fill_value": "NaN" if a.dtype.kind == "f" else 0, "dimension_separator": separator})
    put(folder, f"{name}/.zattrs", {"_ARRAY_DIMENSIONS": dims})
    for at, block in blocks(a, chunks, fill):
        raw = block.tobytes(order=order)
        put(folder, f"{name}/{separator.join(map(str, at))}", codecs.compress(press, raw, width=a.dtype.itemsize) if press else raw)


def group_two(spark: SparkSession, sf_dir: str) -> str:
    def make(folder: str) -> None:
        a = cube(spark, sf_dir)
        dims = ["time", "lat", "lon"]
        version_two(folder, "quantity", a, (3, 7, 5), dims)
        version_two(folder, "quantity_f", a.astype(">f8"), (5, 6, 24), dims, "gzip", "F", "/")
        for name, axis in zip(dims, (TIMES, LATS, LONS), strict=True):
            version_two(folder, name, axis, axis.shape, [name], None)
        # Version 3 with axes stored in another order.
        meta = array_json(a.shape, (4, 10, 24), "float64", float("nan"), dims, {}, "gzip")
        meta["codecs"].insert(0, {"name": "transpose", "configuration": {"order": [2, 0, 1]}})
        put(folder, "turned/zarr.json", meta)
        for at, block in blocks(a, (4, 10, 24), np.nan):
            put(folder, "turned/c/" + "/".join(map(str, at)), codecs.compress("gzip", np.ascontiguousarray(block.transpose(2, 0, 1)).tobytes()))

    return made(spark, sf_dir, "group-two.zarr", make)


@query("read_zarr_v2", f"{WITH}{ALL} WHERE {IN_BOX}")
def _(spark, sf):
    return there(read_geo(spark, group_two(spark, sf), asset="quantity", **BOX))


@query("read_zarr_v2_fortran", f"{WITH}{ALL}")
def _(spark, sf):
    return there(read_geo(spark, group_two(spark, sf), asset="quantity_f"))


@query("read_zarr_transposed", f"{WITH}{ALL} WHERE lat >= 44")
def _(spark, sf):
    return there(read_geo(spark, f"{group_two(spark, sf)}/turned", lat_min=44.0))


@query("list_arrays", values(*[(n,) for n in ("lat", "lon", "quantity", "quantity_f", "time", "turned")], names="name"))
def _(spark, sf):
    return spark.createDataFrame([(n,) for n in list_sources(group_two(spark, sf))], "name string")


def outcome(call, *errors) -> str:
    """ok, or the kind of error that a call ends with."""
    try:
        call()
        return "ok"
    except errors as e:
        return type(e).__name__


@query("group_is_refused", values(("lat,lon,quantity,quantity_f,time,turned",), names="arrays"))
def _(spark, sf):
    try:
        open_source(group_two(spark, sf))
    except Group as g:
        return spark.createDataFrame([(",".join(g.arrays),)], "arrays string")


@query("read_geo_in_list", f"{WITH}{ALL} WHERE time IN (1, 7) AND lat IN (41.5, 42, 48.5, 60)")
def _(spark, sf):
    return there(read_geo(spark, lattice(spark, sf)).where("time IN (1, 7) AND lat IN (41.5, 42, 48.5, 60)"))


@query("open_validation", values(("chunk 0", "ValueError"), ("chunk too large", "ValueError"), ("complex numbers", "ValueError"), ("good", "ok"), ("seventeen dimensions", "ValueError"), names='"case", outcome'))
def _(spark, sf):
    def info(shape, chunk, dtype="float32"):
        return ArrayInfo("x", shape, chunk, dtype, [f"d{k}" for k in range(len(shape))], None).validate()

    tried = {"good": ([9], [3]), "chunk 0": ([9], [0]), "chunk too large": ([1 << 40], [1 << 30]), "complex numbers": ([9], [3], "complex64"), "seventeen dimensions": ([1] * 17, [1] * 17)}
    return spark.createDataFrame([(k, outcome(lambda a=a: info(*a), ValueError)) for k, a in tried.items()], "case string, outcome string")


@query("path_sandbox", values(("inside", "ok"), ("outside", "Forbidden"), ("out by a link", "Forbidden"), ("out by dots", "Forbidden"), names='"case", outcome'))
def _(spark, sf):
    folder = made(spark, sf, "sandbox", lambda f: os.symlink("/etc", os.path.join(f, "link")))
    tried = {"inside": folder, "outside": "/etc/passwd", "out by dots": f"{folder}/../../../../../../../../etc/passwd", "out by a link": f"{folder}/link/passwd"}
    return spark.createDataFrame([(k, outcome(lambda p=p: checked(p), Forbidden)) for k, p in tried.items()], "case string, outcome string")


# -- rasters and items ------------------------------------------------------


def images(spark: SparkSession, sf_dir: str) -> str:
    """Rasters of several types and kinds, and an item with one for each month."""

    def make(folder: str) -> None:
        a = np.nan_to_num(cube(spark, sf_dir), nan=-1)[:, ::-1]
        scale, origin = (0.5, 0.5), (-100.25, 49.75)
        for dtype in ("uint8", "int16", "uint16", "int32", "uint32", "float32", "float64"):
            write_cog(f"{folder}/{dtype}.tif", np.where(a[2] < 0, 255, a[2] % 200).astype(dtype), scale, origin, 4326, 16, dtype[0] == "u", 255, big=dtype == "uint16")
        write_cog(f"{folder}/bands.tif", a.astype("i4"), scale, origin, 4326, 16, True, -1)
        assets = {}
        for k in range(12):
            write_cog(f"{folder}/m{k}.tif", a[k].astype("i4"), scale, origin, 4326, 16, True, -1)
            assets[f"m{k}"] = {"href": f"./m{k}.tif", "type": "image/tiff; application=geotiff"}
        put(folder, "item.json", {"type": "Feature", "id": "year", "properties": {"datetime": "2026-01-01T00:00:00Z"}, "assets": assets | {"notes": {"href": "n.txt", "type": "text/plain"}}, "links": []})
        links = lambda k: [{"rel": "self", "href": f"http://catalogue/m{k}"}]
        months = [{"type": "Feature", "id": f"m{k}", "collection": "months", "properties": {"datetime": f"2026-{k + 1:02d}-01T00:00:00Z"}, "assets": {"quantity": {"href": f"m{k}.tif", "type": "image/tiff; application=geotiff"}}, "links": links(k)} for k in range(12)]
        put(folder, CATALOGUE, {"items": months, "collections": [{"id": "months", "title": "By month", "assets": {"q": {"href": "q.zarr"}}}, {"id": "papers", "assets": {"p": {"href": "p.pdf", "type": "application/pdf"}}}]})
        put(folder, "uneven.json", {"type": "FeatureCollection", "features": [months[0], {**months[1], "assets": {"quantity": {"href": "small.tif", "type": "image/tiff"}}}]})
        write_cog(f"{folder}/small.tif", a[0, :5].astype("i4"), scale, origin, 4326, 16)
        put(folder, "undated.json", {"type": "FeatureCollection", "features": [{**months[0], "properties": {}}]})
        put(folder, "empty.json", {"type": "FeatureCollection", "features": []})

    return made(spark, sf_dir, "images", make)


def served(spark: SparkSession, folder: str) -> FolderServer:
    key = ("server", folder)
    if key not in _MADE:
        local = spark.sparkContext.master.startswith("local")
        _MADE[key] = FolderServer(folder, "127.0.0.1" if local else spark.conf.get("spark.driver.host"))
    return _MADE[key]


KINDS = ("uint8", "int16", "uint16", "int32", "uint32", "float32", "float64")


@query("read_cog_types", f"{WITH}SELECT kind, lat, lon, value - 200 * floor(value / 200) AS value FROM l, (VALUES {', '.join(f'({chr(39)}{k}{chr(39)})' for k in KINDS)}) k(kind) WHERE time = 2 AND lon <= -92")
def _(spark, sf):
    folder = images(spark, sf)
    parts = [read_geo(spark, f"{folder}/{k}.tif", lon_max=-92.0).where("value IS NOT NULL").select(F.lit(k).alias("kind"), "lat", "lon", F.col("value").cast("double").alias("value")) for k in KINDS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("read_cog_bands", f"{WITH}SELECT CAST(time AS BIGINT) AS band, lat, lon, CAST(value AS INTEGER) AS value FROM l WHERE lat < 47")
def _(spark, sf):
    return read_geo(spark, f"{images(spark, sf)}/bands.tif", lat_max=46.9).where("value IS NOT NULL")


ONE_MONTH = f"{WITH}SELECT lat, lon, CAST(value AS INTEGER) AS value FROM l WHERE time = 5 AND lat BETWEEN 41 AND 46"


def month(df: DataFrame) -> DataFrame:
    return df.where("value IS NOT NULL").select("lat", "lon", "value")


@query("read_stac_item", ONE_MONTH)
def _(spark, sf):
    return month(read_geo(spark, f"{images(spark, sf)}/item.json", asset="m5", lat_min=41.0, lat_max=46.0))


@query("stac_item_assets", values(*[(f"m{k}",) for k in range(12)], names="name"))
def _(spark, sf):
    return spark.createDataFrame([(n,) for n in list_sources(f"{images(spark, sf)}/item.json")], "name string")


@query("read_stac_item_http", ONE_MONTH)
def _(spark, sf):
    return month(read_geo(spark, f"{served(spark, images(spark, sf)).url}/item.json", asset="m5", lat_min=41.0, lat_max=46.0))


@query("read_stac_asset_url", ONE_MONTH)
def _(spark, sf):
    return month(read_geo(spark, f"{served(spark, images(spark, sf)).url}/item.json/m5", lat_min=41.0, lat_max=46.0))


@query("read_cog_http", ONE_MONTH)
def _(spark, sf):
    return month(read_geo(spark, f"{served(spark, images(spark, sf)).url}/m5.tif", lat_min=41.0, lat_max=46.0))


@query("read_stac_search", f"{WITH}SELECT CAST(epoch(make_timestamp(2026, CAST(time AS BIGINT) + 1, 1, 0, 0, 0)) AS DOUBLE) AS time, lat, lon, CAST(value AS INTEGER) AS value FROM l WHERE lat BETWEEN 42 AND 45 AND lon BETWEEN -98 AND -94")
def _(spark, sf):
    return there(read_geo(spark, f"{served(spark, images(spark, sf)).url}/search", lat_min=42.0, lat_max=45.0, lon_min=-98.0, lon_max=-94.0))


@query("stac_search_requests", values(("/search?bbox=-98,42,-94,45&datetime=1970-01-01T00:00:00Z/2033-05-18T03:33:20Z", 12), names="first_request, pages"))
def _(spark, sf):
    server = served(spark, images(spark, sf))
    before = len(server.paths)
    open_source(f"{server.url}/search", {"lat": (42.0, 45.0), "lon": (-98.0, -94.0), "time": (0.0, 2e9)})
    asked = [p for p in server.paths[before:] if p.startswith("/search")]
    return spark.createDataFrame([(asked[0], len(asked))], "first_request string, pages long")


@query(
    "stac_refusals",
    values(("a search everywhere", "ValueError"), ("a search without a box", "ValueError"), ("an asset that isn't there", "ValueError"), ("an empty collection", "ValueError"), ("an item without a time", "ValueError"), ("several assets, none chosen", "ValueError"), ("two grids", "ValueError"), names='"case", outcome'),
)
def _(spark, sf):
    folder = images(spark, sf)
    url = served(spark, folder).url
    tried = {
        "a search without a box": lambda: open_source(f"{url}/search"),
        "a search everywhere": lambda: open_source(f"{url}/search", {"lat": (-90.0, 90.0), "lon": (-180.0, 180.0)}),
        "two grids": lambda: open_source(f"{folder}/uneven.json"),
        "an item without a time": lambda: open_source(f"{folder}/undated.json"),
        "an empty collection": lambda: open_source(f"{folder}/empty.json"),
        "several assets, none chosen": lambda: open_source(f"{folder}/item.json"),
        "an asset that isn't there": lambda: open_source(f"{folder}/item.json", asset="red"),
    }
    return spark.createDataFrame([(k, outcome(f, ValueError)) for k, f in tried.items()], "case string, outcome string")


@query("catalogue_search", values(*[(f"m{k}", f"http://catalogue/m{k}") for k in range(10)], names="id, uri"))
def _(spark, sf):
    return spark.createDataFrame([(r["id"], r["uri"]) for r in search(served(spark, images(spark, sf)).url, "months", "-100,40,-88,50", "2026-01-01/..")], "id string, uri string")


@query("catalogue_collections", values(("months", "By month"), names="id, title"))
def _(spark, sf):
    return spark.createDataFrame([(r["id"], r["title"]) for r in collections(served(spark, images(spark, sf)).url)], "id string, title string")


@query("read_zarr_http", f"{WITH}{ALL} WHERE {IN_BOX}")
def _(spark, sf):
    path = lattice(spark, sf, "shards")
    return there(read_geo(spark, f"{served(spark, os.path.dirname(path)).url}/{os.path.basename(path)}", **BOX))


@query("http_reads_in_part", values((True, True), names="metadata_only_to_plan, part_of_a_shard"))
def _(spark, sf):
    path = lattice(spark, sf, "shards")
    server = served(spark, os.path.dirname(path))
    url, stored_bytes = f"{server.url}/{os.path.basename(path)}", sum(os.path.getsize(f"{path}/c/0/0/0") for _ in range(1))
    before = len(server.paths)
    info = open_source(url)
    planned = not any("/c/0/0/0" in p for p in server.paths[before:])
    at = server.bytes
    info.reader.read((0, 0, 0), (slice(0, 1), slice(0, 2), slice(0, 2)))
    return spark.createDataFrame([(planned, 0 < server.bytes - at < stored_bytes)], "metadata_only_to_plan boolean, part_of_a_shard boolean")


@query("forbidden_chunks_are_errors", values(("a forbidden chunk", "Forbidden"), ("an absent chunk", "ok"), names='"case", outcome'))
def _(spark, sf):
    folder = group_two(spark, sf)
    server = served(spark, folder)
    reader = open_source(f"{server.url}/quantity").reader
    part = (slice(0, 1),) * 3
    server.forbidden.add("/quantity/0.0.0")
    try:
        rows = [("a forbidden chunk", outcome(lambda: reader.read((0, 0, 0), part), Forbidden)), ("an absent chunk", outcome(lambda: reader.read((90, 0, 0), part), Forbidden))]
    finally:
        server.forbidden.clear()
    return spark.createDataFrame(rows, "case string, outcome string")


# -- vector files -----------------------------------------------------------

PLACE = "40 + (c_custkey * 37 % 9409) / 1000.0 AS y, -100 + (c_custkey * 53 % 11411) / 1000.0 AS x"
CUSTOMERS = f"SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, {PLACE} FROM customer"


def customers(spark: SparkSession, sf_dir: str) -> str:
    """Customers as squares of 0.2 degrees or points, in each kind of vector file."""

    def make(folder: str) -> None:
        rows = read(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name", "CAST(c_acctbal AS DOUBLE) AS balance", *[p.strip() for p in PLACE.split(",")])
        corner = lambda dx, dy: F.array(F.round(F.col("x") + dx, 6), F.round(F.col("y") + dy, 6))
        ring = F.array(*[corner(dx, dy) for dx, dy in ((-0.1, -0.1), (0.1, -0.1), (0.1, 0.1), (-0.1, 0.1), (-0.1, -0.1))])
        geometry = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
        feature = F.struct(F.lit("Feature").alias("type"), F.struct("id", "name", "balance").alias("properties"), geometry.alias("geometry"))
        rows.select(F.to_json(feature).alias("value")).write.text(f"{folder}/c.geojsonl")
        whole = rows.groupBy(F.floor(F.col("id") / 500)).agg(F.collect_list(feature).alias("features"))
        whole.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")).write.option("maxRecordsPerFile", 1).text(f"{folder}/c.geojson")
        text = lambda c: F.concat_ws(" ", F.get(c, F.lit(0)).cast("string"), F.get(c, F.lit(1)).cast("string"))
        wkt = F.concat(F.lit("POLYGON(("), F.array_join(F.transform(ring, text), ","), F.lit("))"))
        rows.select("id", "name", "balance", wkt.alias("wkt")).write.csv(f"{folder}/c.csv", header=True)
        read_features(spark, f"{folder}/c.csv").write.parquet(f"{folder}/c.parquet")

    return made(spark, sf_dir, "customers", make)


def measured(features: DataFrame) -> DataFrame:
    """id, name, balance with area and centre of each footprint."""

    @F.pandas_udf("area double, x double, y double")
    def measure(column: pd.Series) -> pd.DataFrame:
        shapes_ = [from_wkb(w) for w in column]
        centres = [centroid(s) for s in shapes_]
        return pd.DataFrame({"area": [area(s) for s in shapes_], "x": [c[0] for c in centres], "y": [c[1] for c in centres]})

    rows = features.withColumn("m", measure("geom"))
    return rows.select(F.col("id").cast("long").alias("id"), "name", "balance", F.round("m.area", 5).alias("area"), F.round("m.x", 5).alias("x"), F.round("m.y", 5).alias("y"))


for _suffix, _name in (("geojson", "read_geojson"), ("geojsonl", "read_geojson_lines"), ("csv", "read_csv_wkt"), ("parquet", "read_features_parquet")):

    def _vector(suffix: str, name: str) -> None:
        @query(name, f"SELECT id, name, CAST(balance AS DOUBLE) AS balance, CAST(0.04 AS DOUBLE) AS area, round(CAST(x AS DOUBLE), 5) AS x, round(CAST(y AS DOUBLE), 5) AS y FROM ({CUSTOMERS})")
        def _(spark, sf):
            return measured(read_features(spark, f"{customers(spark, sf)}/c.{suffix}"))

    _vector(_suffix, _name)


@query("centroids", "SELECT name, round((w + e) / 2, 6) AS x, round((s + n) / 2, 6) AS y FROM " + SQL_RECTANGLES)
def _(spark, sf):
    @F.pandas_udf("array<double>")
    def middle(column: pd.Series) -> pd.Series:
        return column.map(lambda w: list(centroid(from_wkb(w))))

    return rectangles(spark).select("name", F.round(F.get(middle("geom"), F.lit(0)), 6).alias("x"), F.round(F.get(middle("geom"), F.lit(1)), 6).alias("y"))


def footprint_file(spark: SparkSession, sf_dir: str) -> str:
    def make(folder: str) -> None:
        ring = lambda w, s, e, n: [[w, s], [e, s], [e, n], [w, n], [w, s]]
        features = [{"type": "Feature", "properties": {"name": r[0]}, "geometry": {"type": "Polygon", "coordinates": [ring(*r[1:])]}} for r in RECTANGLES]
        put(folder, "f.geojson", {"type": "FeatureCollection", "features": features})

    return os.path.join(made(spark, sf_dir, "footprints", make), "f.geojson")


@query("zonal_by_path", f"{WITH}SELECT name, max(value) AS metric FROM l, {SQL_RECTANGLES} WHERE {INSIDE} GROUP BY name")
def _(spark, sf):
    return zonal_stats(spark, lattice(spark, sf), footprint_file(spark, sf), "max", "centroid")


@query("extract_by_path", f"{WITH}SELECT time, lat, lon, value, name FROM l, {SQL_RECTANGLES} WHERE {INSIDE}")
def _(spark, sf):
    return extract(spark, lattice(spark, sf), footprint_file(spark, sf)).where("value IS NOT NULL")


@query("mean_of_peaks", f"{WITH}, p AS (SELECT name, max(value) AS peak FROM l, {SQL_RECTANGLES} WHERE {INSIDE} GROUP BY name) SELECT avg(peak) AS mean_peak, count(*) AS footprints FROM p")
def _(spark, sf):
    peaks = extract(spark, lattice(spark, sf), rectangles(spark)).where("value IS NOT NULL").groupBy("name").agg(F.max("value").alias("peak"))
    return peaks.agg(F.avg("peak").alias("mean_peak"), F.count("*").alias("footprints"))


@query("index_join_uneven", f"{WITH}, p AS (SELECT id, y, x FROM ({CUSTOMERS})), u AS (SELECT lat AS v, lead(lat) OVER (ORDER BY lat) AS nxt, lag(lat) OVER (ORDER BY lat) AS prv FROM (VALUES (40.0::DOUBLE), (40.5), (41.5), (43.5), (47.5)) t(lat)) "
    "SELECT p.id, max(l.value) AS peak FROM p JOIN u ON p.y >= coalesce((v + prv) / 2, v - (nxt - v) / 2) AND p.y < coalesce((v + nxt) / 2, v + (v - prv) / 2 + 1e-12) JOIN l ON l.lat = u.v AND round((x + 100) / 0.5) = (lon + 100) / 0.5 GROUP BY p.id")
def _(spark, sf):
    wanted = [40.0, 40.5, 41.5, 43.5, 47.5]
    index = F.array_position(F.array(*map(F.lit, wanted)), F.col("lat")) - 1
    some = there(read_geo(spark, lattice(spark, sf))).where(F.col("lat").isin(wanted)).select("value", index.alias("__i_lat"), ((F.col("lon") + 100) * 2).cast("long").alias("__i_lon"))
    points = read(spark, sf, "customer").selectExpr("c_custkey AS id", *[p.strip() for p in PLACE.split(",")])
    return join_by_index(points, some, Grid("lat", "lon", Axis(np.array(wanted)), Axis(LONS))).groupBy("id").agg(F.max("value").alias("peak"))


# -- writing ----------------------------------------------------------------


@query("ingest_csv", "SELECT CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, value FROM (SELECT l_partkey % 20 AS lat, l_suppkey % 24 AS lon, CAST(sum(l_quantity) AS DOUBLE) AS value FROM lineitem GROUP BY 1, 2)")
def _(spark, sf):
    def make(folder: str) -> None:
        rows = read(spark, sf, "lineitem").groupBy((F.col("l_partkey") % 20).cast("double").alias("lat"), (F.col("l_suppkey") % 24).cast("double").alias("lon")).agg(F.sum("l_quantity").cast("double").alias("value"))
        rows.write.csv(f"{folder}/t.csv", header=True)
        ingest(spark, f"{folder}/t.csv", f"{folder}/t.zarr")

    return read_geo(spark, made(spark, sf, "ingest", make) + "/t.zarr").where("value IS NOT NULL")


@query("ingest_chunks", "SELECT '[' || count(DISTINCT l_partkey % 20) || ', ' || count(DISTINCT l_suppkey % 24) || ']' AS array_shape, '[' || least(100, count(DISTINCT l_partkey % 20)) || ', ' || least(100, count(DISTINCT l_suppkey % 24)) || ']' AS chunk_shape FROM lineitem")
def _(spark, sf):
    from .queries import QUERIES

    QUERIES["ingest_csv"](spark, sf)
    return read_zarr_metadata(spark, made(spark, sf, "ingest", None) + "/t.zarr").select("array_shape", "chunk_shape")


@query("export_auto_chunks", "SELECT '[' || count(*) || ']' AS array_shape, '[' || least(count(*), 10000000) || ']' AS chunk_shape FROM customer")
def _(spark, sf):
    def make():
        return read(spark, sf, "customer").select(F.col("c_custkey").alias("dim"), F.col("c_acctbal").alias("value"))

    return read_zarr_metadata(spark, stored(spark, "customers-auto", sf, make)).select("array_shape", "chunk_shape")


@query("auto_chunk_rule", values(("1000,1000,100", "1000,1000,10"), ("10000000,7", "10000000,1"), ("30000000,7", "10000000,1"), ("4,5", "4,5"), names="shape, chunk"))
def _(spark, sf):
    rows = [s for s in ([1000, 1000, 100], [10_000_000, 7], [30_000_000, 7], [4, 5])]
    text = lambda xs: ",".join(map(str, xs))
    return spark.createDataFrame([(text(s), text(auto_chunks(s))) for s in rows], "shape string, chunk string")


@query("export_refusals", values(("a hole in a bare index", "ValueError"), ("an existing array", "FileExistsError"), ("overwriting it", "ok"), names='"case", outcome'))
def _(spark, sf):
    path = os.path.join(made(spark, sf, "refusals", lambda f: None), f"{uuid.uuid4().hex}.zarr")
    good, bad = (spark.createDataFrame([(k, 1.0) for k in ks], "dim int, value double") for ks in ((0, 1), (0, 5)))
    export_zarr(good, path)
    tried = {"an existing array": lambda: export_zarr(good, path), "overwriting it": lambda: export_zarr(good, path, mode="overwrite"), "a hole in a bare index": lambda: export_zarr(bad, path + "b")}
    return spark.createDataFrame([(k, outcome(f, ValueError, FileExistsError)) for k, f in tried.items()], "case string, outcome string")


# -- commands ---------------------------------------------------------------


def command(*args: str) -> tuple[int, str]:
    """A command's exit code and what it prints."""
    from .cli import main

    out = io.StringIO()
    with contextlib.redirect_stdout(out), contextlib.redirect_stderr(out):
        code = main(list(args))
    return code, out.getvalue()


def extracted(spark: SparkSession, sf_dir: str) -> str:
    def make(folder: str) -> None:
        code, said = command("--output", "json", "extract", lattice(spark, sf_dir), footprint_file(spark, sf_dir), "--out", f"{folder}/cells.parquet")
        if code:
            raise RuntimeError(said)

    return made(spark, sf_dir, "extracted", make) + "/cells.parquet"


@query("extracted_table", f"{WITH}SELECT time, lat, lon, value, name FROM l, {SQL_RECTANGLES} WHERE {INSIDE}")
def _(spark, sf):
    return spark.read.parquet(extracted(spark, sf)).where("value IS NOT NULL")


@query("extraction_plan", "WITH c AS (SELECT count(DISTINCT y.i // 7) * count(DISTINCT x.i // 5) * 4 AS k FROM range(20) y(i), range(24) x(i) WHERE 40 + 0.5 * y.i BETWEEN 41.1 AND 49.2 AND -100 + 0.5 * x.i BETWEEN -98.6 AND -89.4) SELECT CAST(k AS BIGINT) AS chunks, round(k * 840 / 1e6, 6) AS megabytes, round(k * 840 / 25e6, 9) AS seconds FROM c")
def _(spark, sf):
    got = plan(lattice(spark, sf), (-98.6, 41.1, -89.4, 49.2))
    return spark.createDataFrame([(got.chunks, round(got.megabytes, 6), round(got.seconds, 9))], "chunks long, megabytes double, seconds double")


@query("overwrite_protection", values(("again", "error"), ("again, with leave", "success"), names='"case", status'))
def _(spark, sf):
    path, args = extracted(spark, sf), ("--output", "json", "extract", lattice(spark, sf), footprint_file(spark, sf), "--out")
    copy = f"{path}-{uuid.uuid4().hex[:8]}"
    shutil.copytree(path, copy)
    said = {"again": command(*args, copy)[1], "again, with leave": command(*args, copy, "--yes")[1]}
    return spark.createDataFrame([(k, json.loads(s.strip().splitlines()[-1])["status"]) for k, s in said.items()], "case string, status string")


@query("output_modes", values(("agent", 0, "array_shape=[12, 20, 24]"), ("json", 0, '{"status": "success"'), ("table", 0, "array_shape: [12, 20, 24]"), names="mode, code, starts"))
def _(spark, sf):
    rows = []
    for mode in ("table", "json", "agent"):
        code, said = command("--output", mode, "info", lattice(spark, sf))
        line = said.strip().splitlines()[0]
        rows.append((mode, code, line[:20] if mode == "json" else line))
    return spark.createDataFrame(rows, "mode string, code long, starts string")


@query("completions", values(("bash", True), ("fish", True), ("zsh", True), names="shell, names_every_command"))
def _(spark, sf):
    from .cli import COMMANDS

    rows = [(s, all(c in command("completions", s)[1] for c in COMMANDS)) for s in ("bash", "zsh", "fish")]
    return spark.createDataFrame(rows, "shell string, names_every_command boolean")


@query("attached_tables", "SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def _(spark, sf):
    from .cli import views

    views(spark, [f"my_nation={sf}/nation.parquet", f"my_region={sf}/region.parquet"])
    return spark.sql("SELECT r_name, count(*) AS nations FROM my_nation JOIN my_region ON n_regionkey = r_regionkey GROUP BY r_name")


@query("config_layers", values(("providers.mine", "http://m"), ("s3_access_key_id", "k"), ("s3_endpoint", "e"), ("s3_region", "b"), names="key, value"))
def _(spark, sf):
    def make(folder: str) -> None:
        put(folder, "home/gridloom/config.toml", b's3_region = "a"\ns3_endpoint = "e"\n[providers]\nmine = "http://m"\n')
        put(folder, "gridloom.toml", b's3_region = "b"\n')

    folder = made(spark, sf, "config", make)
    c = load(f"{folder}/home", folder, {"GRIDLOOM_S3_ACCESS_KEY_ID": "k"})
    return spark.createDataFrame([("s3_region", c.s3_region), ("s3_endpoint", c.s3_endpoint), ("s3_access_key_id", c.s3_access_key_id), ("providers.mine", c.all_providers()["mine"])], "key string, value string")


@query("s3_settings", values(("spark.hadoop.fs.s3a.access.key", "k"), ("spark.hadoop.fs.s3a.endpoint", "e"), ("spark.hadoop.fs.s3a.endpoint.region", "r"), ("spark.hadoop.fs.s3a.secret.key", "s"), names="key, value"))
def _(spark, sf):
    return spark.createDataFrame(list(Config("r", "k", "s", "e").spark_settings().items()), "key string, value string")


@query("providers", values(("copernicus",), ("earth-search",), ("mine",), ("planetary-computer",), names="name"))
def _(spark, sf):
    return spark.createDataFrame([(n,) for n in Config(providers={"mine": "http://m"}).all_providers() if n in PROVIDERS or n == "mine"], "name string")


# -- tools ------------------------------------------------------------------


def tools(spark: SparkSession) -> Tools:
    key = ("tools", spark.sparkContext.applicationId)
    if key not in _MADE:
        _MADE[key] = Tools(spark)
    return _MADE[key]


DEGREES = {"lat_min": 42.0, "lat_max": 45.0, "lon_min": -98.0, "lon_max": -94.0}


def region(spark: SparkSession, sf_dir: str, **more) -> dict:
    return tools(spark).read_region(lattice(spark, sf_dir), DEGREES, {"time_min": 2.0, "time_max": 7.0}, **more)


@query("tool_read_region", f"{WITH}{ALL} WHERE {IN_BOX}")
def _(spark, sf):
    return there(spark.table(region(spark, sf)["table_handle"]))


@query("tool_result_head", values((378, 20, True), names="row_count, returned, truncated"))
def _(spark, sf):
    got = region(spark, sf, limit=20)
    return spark.createDataFrame([(got["row_count"], len(got["rows"]), got["truncated"])], "row_count long, returned long, truncated boolean")


@query("tool_estimate_cost", "WITH t AS (SELECT count(DISTINCT i // 3) AS c FROM range(12) r(i) WHERE i BETWEEN 2 AND 7), y AS (SELECT count(DISTINCT i // 7) AS c FROM range(20) r(i) WHERE 40 + 0.5 * i BETWEEN 42 AND 45), x AS (SELECT count(DISTINCT i // 5) AS c FROM range(24) r(i) WHERE -100 + 0.5 * i BETWEEN -98 AND -94) SELECT t.c * y.c * x.c AS total_chunks, t.c * y.c * x.c * 840 AS total_bytes FROM t, y, x")
def _(spark, sf):
    got = tools(spark).estimate_cost(lattice(spark, sf), DEGREES, {"time_min": 2.0, "time_max": 7.0})["estimate"][0]
    return spark.createDataFrame([(got["total_chunks"], got["total_bytes"])], "total_chunks long, total_bytes long")


@query("tool_describe_dataset", values(("[12, 20, 24]", "[3, 7, 5]", "Float64", "UNKNOWN"), names="array_shape, chunk_shape, data_type, crs"))
def _(spark, sf):
    return spark.createDataFrame([tuple(tools(spark).describe_dataset(lattice(spark, sf))["metadata"][0].values())], "array_shape string, chunk_shape string, data_type string, crs string")


def viewed(spark: SparkSession, sf_dir: str) -> None:
    read(spark, sf_dir, "lineitem").createOrReplaceTempView("surface_lines")
    read(spark, sf_dir, "nation").createOrReplaceTempView("surface_nations")


@query("tool_list_tables", values(("surface_lines", True), ("surface_nations", True), names="name, temporary"))
def _(spark, sf):
    viewed(spark, sf)
    got = [(t["name"], t["temporary"]) for t in tools(spark).list_tables()["tables"] if t["name"] in ("surface_lines", "surface_nations")]
    return spark.createDataFrame(got, "name string, temporary boolean")


@query("tool_describe_table", "SELECT column_name, least(5, n) AS sampled FROM (SELECT unnest(['n_nationkey', 'n_name', 'n_regionkey']) AS column_name), (SELECT count(*) AS n FROM nation)")
def _(spark, sf):
    viewed(spark, sf)
    got = tools(spark).describe_table("surface_nations")
    return spark.createDataFrame([(c["column_name"], len(got["sample"])) for c in got["schema"] if c["column_name"] in ("n_nationkey", "n_name", "n_regionkey")], "column_name string, sampled long")


def ran(spark: SparkSession, sql: str) -> DataFrame:
    return spark.table(tools(spark).run_sql(sql, 5)["table_handle"])


@query("run_sql_group_by_all", "SELECT l_returnflag, year(l_shipdate) AS y, count(*) AS n, max(l_quantity) AS most FROM lineitem GROUP BY ALL")
def _(spark, sf):
    viewed(spark, sf)
    return ran(spark, "SELECT l_returnflag, year(l_shipdate) AS y, count(*) AS n, max(l_quantity) AS most FROM surface_lines GROUP BY ALL")


@query("run_sql_ordinals", "SELECT n_regionkey AS region, n_name[1:1] || '-' || n_regionkey AS tag, count(*) AS n FROM nation GROUP BY 1, 2")
def _(spark, sf):
    viewed(spark, sf)
    return ran(spark, "SELECT n_regionkey AS region, concat(substring(n_name, 1, 1), '-', n_regionkey) AS tag, count(*) AS n FROM surface_nations GROUP BY 1, 2 ORDER BY 1, 2")


@query("run_sql_variable", "SELECT count(*) AS n FROM lineitem WHERE l_quantity > 30")
def _(spark, sf):
    viewed(spark, sf)
    tools(spark).run_sql("DECLARE OR REPLACE VARIABLE surface_least DOUBLE DEFAULT 0")
    tools(spark).run_sql("SET VARIABLE surface_least = 30")
    return ran(spark, "SELECT count(*) AS n FROM surface_lines WHERE l_quantity > surface_least")


@query("run_sql_random", "SELECT count(*) AS n, true AS within FROM nation")
def _(spark, sf):
    viewed(spark, sf)
    return ran(spark, "SELECT count(*) AS n, bool_and(r >= 0 AND r < 1) AS within FROM (SELECT random() AS r FROM surface_nations)")


@query("run_sql_table_function", f"{WITH}SELECT lat, avg(value) AS mean FROM l WHERE lat BETWEEN 42 AND 45 GROUP BY lat")
def _(spark, sf):
    return ran(spark, f"WITH c AS (SELECT * FROM read_geo('{lattice(spark, sf)}', lat_min => 42.0D, lat_max => 45.0D)) SELECT lat, avg(value) AS mean FROM c GROUP BY lat")


@query("run_sql_statements", values(("CREATE", "ok"), ("DESCRIBE", "a"), ("SHOW", "surface_made"), ("VALUES", "1"), names="statement, said"))
def _(spark, sf):
    run = tools(spark).run_sql
    rows = [("CREATE", run("CREATE OR REPLACE TEMP TABLE surface_made AS SELECT 1 AS a")["status"])]
    rows.append(("DESCRIBE", run("DESCRIBE surface_made")["rows"][0][0]))
    rows.append(("SHOW", next(r[1] for r in run("SHOW TABLES")["rows"] if r[1] == "surface_made")))
    rows.append(("VALUES", str(run("VALUES (1)")["rows"][0][0])))
    return spark.createDataFrame(rows, "statement string, said string")


GUARDED = {
    "SELECT 1": True, "WITH a AS (SELECT 1) SELECT * FROM a": True, "EXPLAIN SELECT 1": True, "SELECT 'DROP x; y'": True, "CREATE TEMP VIEW v AS SELECT 1": True,
    "DROP TABLE t": False, "SELECT 1; SELECT 2": False, "INSERT INTO t VALUES (1)": False, "SET spark.x = 1": False, "ADD JAR 'x'": False, "CREATE TABLE t AS SELECT 1": False,
    "SELECT * FROM `text`.`/etc/passwd`": False, "SELECT reflect('java.lang.System', 'getenv', 'PATH')": False, "CREATE TEMP VIEW v AS SELECT * FROM `csv`.`/x`": False,
}


@query("guard_verdicts", values(*GUARDED.items(), names="statement, allowed"))
def _(spark, sf):
    return spark.createDataFrame([(s, outcome(lambda s=s: guard.check(s, spark), guard.Rejected) == "ok") for s in GUARDED], "statement string, allowed boolean")


@query("identifiers", values(("a b", "ValueError"), ("surface_nations", "ok"), ("x; DROP y", "ValueError"), names="name, outcome"))
def _(spark, sf):
    viewed(spark, sf)
    return spark.createDataFrame([(n, outcome(lambda n=n: tools(spark).describe_table(n), ValueError)) for n in ("a b", "surface_nations", "x; DROP y")], "name string, outcome string")


@query("call_timeout", values(("a long call", "TimedOut"), ("a short call", "ok"), names='"case", outcome'))
def _(spark, sf):
    quick = Tools(spark, timeout=1.0)
    long = "SELECT count(*) AS n FROM range(0, 2000000) a JOIN range(0, 2000000) b ON a.id <> b.id + 0.5"
    return spark.createDataFrame([("a long call", outcome(lambda: quick.run_sql(long), TimedOut)), ("a short call", outcome(lambda: tools(spark).run_sql("SELECT 1"), TimedOut))], "case string, outcome string")


@query("tool_zonal_stats", f"{WITH}SELECT name, min(value) AS metric FROM l, {SQL_RECTANGLES} WHERE {INSIDE} GROUP BY name")
def _(spark, sf):
    return spark.table(tools(spark).zonal_stats(lattice(spark, sf), footprint_file(spark, sf), "min")["table_handle"])


@query("tool_point_timeseries", f"{WITH}SELECT time, lat, lon, value FROM l WHERE lat = 43.5 AND lon = -96")
def _(spark, sf):
    return there(spark.table(tools(spark).extract_point_timeseries(lattice(spark, sf), 43.4, -96.1)["table_handle"]))


# -- order, columns, pins ---------------------------------------------------


def in_order(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A small result with the place of each row."""
    schema = T.StructType([T.StructField("place", T.LongType()), *df.schema.fields])
    return spark.createDataFrame([(k, *r) for k, r in enumerate(df.collect())], schema)


@query("point_order", f"{WITH}SELECT row_number() OVER (ORDER BY time) - 1 AS place, time, value FROM l WHERE lat = 43.5 AND lon = -96")
def _(spark, sf):
    return in_order(spark, point_timeseries(spark, lattice(spark, sf), 43.4, -96.1).where("value IS NOT NULL").select("time", "value"))


@query("hist_order", f"{WITH}, m AS (SELECT min(value) AS lo, max(value) AS hi FROM l) SELECT row_number() OVER (ORDER BY 2) - 1 AS place, {BIN} AS bin_idx, count(*) AS freq FROM l, m GROUP BY bin_idx".replace("OVER (ORDER BY 2)", f"OVER (ORDER BY {BIN})"))
def _(spark, sf):
    return in_order(spark, histogram(read_geo(spark, lattice(spark, sf)), "value"))


@query("hist_pinned", f"{WITH}, m AS (SELECT min(value) AS lo, max(value) AS hi FROM l WHERE time = 3 AND lat = 42.5) SELECT {BIN} AS bin_idx, count(*) AS freq FROM l, m WHERE time = 3 AND lat = 42.5 GROUP BY 1")
def _(spark, sf):
    return histogram(read_geo(spark, lattice(spark, sf)), "value", pins={"time": 3.0, "lat": 42.5})


@query("heatmap_pinned", f"{WITH}, p AS (SELECT * FROM l WHERE time = 3), m AS (SELECT min(lat) y0, max(lat) y1, min(lon) x0, max(lon) x1, count(DISTINCT lat) r, count(DISTINCT lon) c FROM p) SELECT CAST(least(floor((lat - y0) / ((y1 - y0) / r)), r - 1) AS BIGINT) AS row, CAST(least(floor((lon - x0) / ((x1 - x0) / c)), c - 1) AS BIGINT) AS col, round(avg(value), 9) AS mean FROM p, m GROUP BY 1, 2")
def _(spark, sf):
    return heatmap(read_geo(spark, lattice(spark, sf)), "value", {"time": 3.0}).withColumn("mean", F.round("mean", 9))


@query("column_detection", values(("date,Latitude,x,geom,t2m", "date", "Latitude", "x", "t2m"), ("time,lat,lon,value", "time", "lat", "lon", "value"), ("valid_time,y,long_name,pr", "valid_time", "y", "long_name", "pr"), names="columns, time, lat, lon, value"))
def _(spark, sf):
    rows = []
    for columns in ("time,lat,lon,value", "date,Latitude,x,geom,t2m", "valid_time,y,long_name,pr"):
        c = detect(spark.createDataFrame([], ", ".join(f"{n} double" for n in columns.split(","))))
        rows.append((columns, c.time, c.lat, c.lon, c.value))
    return spark.createDataFrame(rows, "columns string, time string, lat string, lon string, value string")


@query("value_column", values(("time,lat,lon,t2m,q", "t2m"), ("x,y,geom,height", "height"), names="columns, value"))
def _(spark, sf):
    rows = [(c, value_column(spark.createDataFrame([], ", ".join(f"{n} double" for n in c.split(","))))) for c in ("time,lat,lon,t2m,q", "x,y,geom,height")]
    return spark.createDataFrame(rows, "columns string, value string")


@query("zonal_triangle_count", f"{WITH}SELECT 'diamond' AS name, count(value) AS metric FROM l WHERE {IN_DIAMOND} UNION ALL SELECT 'triangle', count(value) FROM l WHERE {IN_TRIANGLE}")
def _(spark, sf):
    return zonal_stats(spark, lattice(spark, sf), shapes(spark), "count", "centroid")
