"""Queries over arrays that are written from, and read back as, the driver's tables.

The lattice: a cell per month of shipping, part number modulo 20 and supplier
number modulo 24, with the quantity shipped.  Spark writes it as an array and
reads it through the engine; the SQL computes the same from the tables.
"""

from __future__ import annotations

import datetime
import json
import os
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.geometry import from_wkt, to_wkb
from .operators.extract import box_candidates, cover_cells, extract, join_by_index
from .operators.grids import cell_step, extent_frame, grid_of
from .operators.lattice import stored
from .operators.plots import heatmap, histogram, line
from .operators.resample import AGGREGATES, FREQUENCIES, resample
from .operators.timeseries import point_timeseries
from .operators.zonal import zonal_stats
from .session import shared_space
from .sources.cells import read_geo
from .sources.cog import write_cog
from .sources.resolve import open_source
from .sources.tables import plan_read_geo, read_zarr_metadata

CHUNKS = {"time": 3, "lat": 7, "lon": 5}
Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        def utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return f(spark, sf_dir)

        QUERIES[name] = utc
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


# -- the lattice and its SQL ------------------------------------------------


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cells(spark: SparkSession, sf_dir: str, least: int = 0) -> DataFrame:
    """it, iy, ix and the summed quantity of all 12 x 20 x 24 cells; null where nothing was shipped."""
    rows = read(spark, sf_dir, "lineitem").where(F.col("l_quantity") > least)
    summed = rows.groupBy((F.month("l_shipdate") - 1).cast("long").alias("it"), (F.col("l_partkey") % 20).alias("iy"), (F.col("l_suppkey") % 24).alias("ix")).agg(F.sum("l_quantity").cast("double").alias("value"))
    grid = spark.range(12 * 20 * 24).select(F.floor(F.col("id") / 480).alias("it"), F.floor(F.col("id") / 24 % 20).alias("iy"), (F.col("id") % 24).alias("ix"))
    return grid.join(summed, ["it", "iy", "ix"], "left")


def degrees(df: DataFrame, east: float = 0.0) -> DataFrame:
    return df.select(F.col("it").cast("double").alias("time"), (40 + 0.5 * F.col("iy")).alias("lat"), (-100 + east + 0.5 * F.col("ix")).alias("lon"), "value")


def lattice(spark: SparkSession, sf_dir: str, kind: str = "plain") -> str:
    make = {
        "plain": (lambda: degrees(cells(spark, sf_dir)), {}),
        "gaps": (lambda: degrees(cells(spark, sf_dir, 45)), {}),
        "north": (lambda: degrees(cells(spark, sf_dir)), {"descending": ("lat",)}),
        "east": (lambda: degrees(cells(spark, sf_dir), 360.0), {}),
        "shards": (lambda: degrees(cells(spark, sf_dir)), {"chunks": {"time": 6, "lat": 8, "lon": 8}, "inner": {"time": 2, "lat": 4, "lon": 4}}),
        "blosc": (lambda: degrees(cells(spark, sf_dir)), {"codec": "blosc"}),
        "gzip": (lambda: degrees(cells(spark, sf_dir)), {"codec": "gzip"}),
        "affine": (
            lambda: cells(spark, sf_dir).toDF("time", "lat", "lon", "value"),
            {"attributes": {"geozarr": {"crs": "EPSG:4326", "spatial_transform": {"scale": [1, 0.5, 0.5], "translation": [0, 40, -100]}}}},
        ),
        "index": (lambda: cells(spark, sf_dir).toDF("a", "b", "c", "value"), {"chunks": {"a": 3, "b": 7, "c": 5}}),
        "whole": (lambda: degrees(cells(spark, sf_dir)).withColumn("value", F.col("value").cast("int")), {}),
    }[kind]
    return stored(spark, f"lattice-{kind}", sf_dir, make[0], **({"chunks": CHUNKS} | make[1]))


def sql_cells(least: int = 0) -> str:
    return f"""SELECT CAST(month(l_shipdate) - 1 AS DOUBLE) AS time, CAST(40 + 0.5 * (l_partkey % 20) AS DOUBLE) AS lat,
        CAST(-100 + 0.5 * (l_suppkey % 24) AS DOUBLE) AS lon, CAST(sum(l_quantity) AS DOUBLE) AS value
        FROM lineitem WHERE l_quantity > {least} GROUP BY 1, 2, 3"""


WITH = f"WITH l AS ({sql_cells()}) "
ALL = "SELECT time, lat, lon, value FROM l"
BOX = {"lat_min": 42.0, "lat_max": 45.0, "lon_min": -98.0, "lon_max": -94.0, "time_min": 2.0, "time_max": 7.0}
IN_BOX = "lat BETWEEN 42 AND 45 AND lon BETWEEN -98 AND -94 AND time BETWEEN 2 AND 7"


def there(df: DataFrame) -> DataFrame:
    return df.where("value IS NOT NULL").select("time", "lat", "lon", "value")


# -- scans ------------------------------------------------------------------


@query("read_geo_full", f"{WITH}{ALL}")
def _(spark, sf):
    return there(read_geo(spark, lattice(spark, sf)))


@query("read_geo_bbox", f"{WITH}{ALL} WHERE {IN_BOX}")
def _(spark, sf):
    return there(read_geo(spark, lattice(spark, sf), **BOX))


@query("read_geo_pushed_filter", f"{WITH}{ALL} WHERE lat > 42 AND lat < 45.5 AND lon >= -97 AND time = 4")
def _(spark, sf):
    return there(read_geo(spark, lattice(spark, sf)).where("lat > 42 AND lat < 45.5 AND lon >= -97 AND time = 4"))


@query("read_geo_pins", f"{WITH}{ALL} WHERE time = 3 AND lat = 42.5")
def _(spark, sf):
    return there(read_geo(spark, lattice(spark, sf), pins="time=3,lat=5"))


@query("read_geo_empty", f"{WITH}{ALL} WHERE lat > 60")
def _(spark, sf):
    return there(read_geo(spark, lattice(spark, sf), lat_min=60.0))


@query("read_geo_between_cells", f"{WITH}{ALL} WHERE lat BETWEEN 42.1 AND 42.4")
def _(spark, sf):
    return there(read_geo(spark, lattice(spark, sf), lat_min=42.1, lat_max=42.4))


@query("read_geo_desc_lat", f"{WITH}{ALL} WHERE {IN_BOX}")
def _(spark, sf):
    return there(read_geo(spark, lattice(spark, sf, "north"), **BOX))


@query("read_geo_lon360", f"{WITH}{ALL} WHERE lon BETWEEN -97 AND -92")
def _(spark, sf):
    return there(read_geo(spark, lattice(spark, sf, "east"), lon_min=-97.0, lon_max=-92.0))


@query("read_geo_affine", f"{WITH}{ALL} WHERE {IN_BOX}")
def _(spark, sf):
    return there(read_geo(spark, lattice(spark, sf, "affine"), **BOX))


@query(
    "read_geo_index_dims",
    "SELECT CAST(month(l_shipdate) - 1 AS BIGINT) AS a, CAST(l_partkey % 20 AS BIGINT) AS b, CAST(l_suppkey % 24 AS BIGINT) AS c, CAST(sum(l_quantity) AS DOUBLE) AS value FROM lineitem WHERE l_partkey % 20 = 7 GROUP BY 1, 2, 3",
)
def _(spark, sf):
    return read_geo(spark, lattice(spark, sf, "index"), pins="b=7").where("value IS NOT NULL")


@query("read_geo_sharded", f"{WITH}{ALL} WHERE {IN_BOX}")
def _(spark, sf):
    return there(read_geo(spark, lattice(spark, sf, "shards"), **BOX))


@query("read_geo_blosc", f"{WITH}{ALL} WHERE {IN_BOX}")
def _(spark, sf):
    return there(read_geo(spark, lattice(spark, sf, "blosc"), **BOX))


@query("read_geo_gzip", f"{WITH}{ALL}")
def _(spark, sf):
    return there(read_geo(spark, lattice(spark, sf, "gzip")))


@query("read_geo_columns", f"{WITH}SELECT lat, value FROM l")
def _(spark, sf):
    return read_geo(spark, lattice(spark, sf), columns=["lat", "value"]).where("value IS NOT NULL")


@query("read_geo_sql", f"{WITH}{ALL} WHERE lat BETWEEN 42 AND 43")
def _(spark, sf):
    path = lattice(spark, sf)
    read_geo(spark, path)  # registers the table functions
    return there(spark.sql(f"SELECT * FROM read_geo('{path}', lat_min => 42.0D, lat_max => 43.0D)"))


@query("missing_cells", f"WITH l AS ({sql_cells(45)}) SELECT CAST(5760 - count(*) AS BIGINT) AS missing, CAST(count(*) AS BIGINT) AS present FROM l")
def _(spark, sf):
    r = read_geo(spark, lattice(spark, sf, "gaps"))
    return r.agg(F.sum(F.col("value").isNull().cast("long")).alias("missing"), F.count("value").alias("present"))


@query("whole_number_fill", f"{WITH}SELECT time, lat, lon, CAST(value AS INTEGER) AS value FROM l")
def _(spark, sf):
    return there(read_geo(spark, lattice(spark, sf, "whole")))


@query(
    "plan_read_geo",
    "WITH t AS (SELECT i // 3 AS c FROM range(12) r(i) WHERE i BETWEEN 2 AND 7), y AS (SELECT i // 7 AS c FROM range(20) r(i) WHERE 40 + 0.5 * i BETWEEN 42 AND 45), "
    "x AS (SELECT i // 5 AS c FROM range(24) r(i) WHERE -100 + 0.5 * i BETWEEN -98 AND -94), "
    "n AS (SELECT (SELECT count(DISTINCT c) FROM t) * (SELECT count(DISTINCT c) FROM y) * (SELECT count(DISTINCT c) FROM x) AS k) "
    "SELECT CAST(k AS BIGINT) AS total_chunks, CAST(k * 105 * 8 AS BIGINT) AS total_bytes FROM n",
)
def _(spark, sf):
    return plan_read_geo(spark, lattice(spark, sf), **BOX)


@query("read_metadata", "SELECT '[12, 20, 24]' AS array_shape, '[3, 7, 5]' AS chunk_shape, 'Float64' AS data_type, 'EPSG:4326' AS crs")
def _(spark, sf):
    return read_zarr_metadata(spark, lattice(spark, sf, "affine"))


@query("avg_by_lat", f"{WITH}SELECT lat, avg(value) AS mean FROM l WHERE {IN_BOX} GROUP BY lat")
def _(spark, sf):
    return read_geo(spark, lattice(spark, sf), **BOX).groupBy("lat").agg(F.avg("value").alias("mean"))


# -- rasters and stacks -----------------------------------------------------


def rasters(spark: SparkSession, sf_dir: str) -> str:
    """A STAC collection of all months of the lattice, a raster each; the document's path."""
    folder = os.path.join(shared_space(spark), "stac-" + spark.sparkContext.applicationId + "-" + str(abs(hash(sf_dir)) % 10**9))
    document = os.path.join(folder, "items.json")
    if os.path.exists(document):
        return document
    os.makedirs(folder, exist_ok=True)
    # A single slice of 20 x 24 cells each: the size of the lattice, not of the tables.
    rows = cells(spark, sf_dir).collect()
    items = []
    for k in range(12):
        image = np.full((20, 24), -1, np.int32)
        for r in rows:
            if r["it"] == k and r["value"] is not None:
                image[19 - r["iy"], r["ix"]] = int(r["value"])
        write_cog(os.path.join(folder, f"m{k}.tif"), image, (0.5, 0.5), (-100.25, 49.75), 4326, 16, deflate=bool(k % 2), nodata=-1)
        items.append({"type": "Feature", "id": f"m{k}", "properties": {"datetime": f"2026-{k + 1:02d}-01T00:00:00Z"}, "assets": {"quantity": {"href": f"./m{k}.tif", "type": "image/tiff; application=geotiff"}}, "links": []})
    with open(document, "w") as f:
        json.dump({"type": "FeatureCollection", "features": items}, f)
    return document


@query("read_cog", f"{WITH}SELECT lat, lon, CAST(value AS INTEGER) AS value FROM l WHERE time = 1 AND lat BETWEEN 41 AND 46")
def _(spark, sf):
    lattice(spark, sf)
    path = os.path.join(os.path.dirname(rasters(spark, sf)), "m1.tif")
    return read_geo(spark, path, lat_min=41.0, lat_max=46.0).where("value IS NOT NULL")


@query(
    "read_stac_stack",
    f"{WITH}SELECT CAST(epoch(make_timestamp(2026, CAST(time AS BIGINT) + 1, 1, 0, 0, 0)) AS DOUBLE) AS time, lat, lon, CAST(value AS INTEGER) AS value FROM l WHERE time < 3 AND lon >= -95",
)
def _(spark, sf):
    lattice(spark, sf)
    # Its SQL asks for the first three months.
    april = datetime.datetime(2026, 4, 1, tzinfo=datetime.UTC).timestamp()
    return there(read_geo(spark, rasters(spark, sf), lon_min=-95.0).where(F.col("time") < april))


@query(
    "read_stac_stack_year",
    f"{WITH}SELECT CAST(epoch(make_timestamp(2026, CAST(time AS BIGINT) + 1, 1, 0, 0, 0)) AS DOUBLE) AS time, lat, lon, CAST(value AS INTEGER) AS value FROM l WHERE lon >= -95",
)
def _(spark, sf):
    lattice(spark, sf)
    return there(read_geo(spark, rasters(spark, sf), lon_min=-95.0))


# -- footprints -------------------------------------------------------------

SHAPES = {
    "diamond": "POLYGON((-94.13 47.92,-91.08 44.87,-94.13 41.82,-97.18 44.87,-94.13 47.92))",
    "triangle": "POLYGON((-99.3 41.2,-93.1 41.2,-96.2 47.7,-99.3 41.2))",
}
IN_DIAMOND = "abs(lon + 94.13) + abs(lat - 44.87) < 3.05"
IN_TRIANGLE = "lat > 41.2 AND (lat - 41.2) * 3.1 < 6.5 * (lon + 99.3) AND (lat - 41.2) * 3.1 < 6.5 * (-93.1 - lon)"
# name, west, south, east, north
RECTANGLES = [("a", -98.6, 41.1, -95.4, 44.3), ("b", -96.1, 43.2, -92.7, 46.6), ("c", -90.9, 48.1, -89.4, 49.2)]
SQL_RECTANGLES = "(VALUES " + ", ".join(f"('{n}', {w}::DOUBLE, {s}::DOUBLE, {e}::DOUBLE, {t}::DOUBLE)" for n, w, s, e, t in RECTANGLES) + ") r(name, w, s, e, n)"

FOOTPRINT = T.StructType([T.StructField("name", T.StringType()), T.StructField("geom", T.BinaryType())])


def shapes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, to_wkb(from_wkt(v))) for k, v in SHAPES.items()], FOOTPRINT)


def rectangles(spark: SparkSession) -> DataFrame:
    rows = [(n, to_wkb(from_wkt(f"POLYGON(({w} {s},{e} {s},{e} {t},{w} {t},{w} {s}))"))) for n, w, s, e, t in RECTANGLES]
    return spark.createDataFrame(rows, FOOTPRINT)


@query("extract_polygons", f"{WITH}SELECT time, lat, lon, value, 'diamond' AS name FROM l WHERE {IN_DIAMOND} UNION ALL SELECT time, lat, lon, value, 'triangle' FROM l WHERE {IN_TRIANGLE}")
def _(spark, sf):
    return extract(spark, lattice(spark, sf), shapes(spark)).where("value IS NOT NULL")


@query("extract_overlap", f"{WITH}SELECT time, lat, lon, value, name FROM l, {SQL_RECTANGLES} WHERE lon > w AND lon < e AND lat > s AND lat < n")
def _(spark, sf):
    return extract(spark, lattice(spark, sf), rectangles(spark)).where("value IS NOT NULL")


@query("extract_pinned", f"{WITH}SELECT time, lat, lon, value, name FROM l, {SQL_RECTANGLES} WHERE lon > w AND lon < e AND lat > s AND lat < n AND time = 2")
def _(spark, sf):
    return extract(spark, lattice(spark, sf), rectangles(spark), pins="time=2").where("value IS NOT NULL")


@query("polygon_max", f"{WITH}SELECT name, max(value) AS peak FROM l, {SQL_RECTANGLES} WHERE lon > w AND lon < e AND lat > s AND lat < n GROUP BY name")
def _(spark, sf):
    return extract(spark, lattice(spark, sf), rectangles(spark)).where("value IS NOT NULL").groupBy("name").agg(F.max("value").alias("peak"))


SQL_METRICS = {"max": "max(value)", "min": "min(value)", "mean": "avg(value)", "sum": "sum(value)", "count": "count(value)"}
INSIDE = "lon > w AND lon < e AND lat > s AND lat < n"
TOUCHED = "lon + 0.25 >= w AND lon - 0.25 <= e AND lat + 0.25 >= s AND lat - 0.25 <= n"
SHARED = "greatest(0, least(lon + 0.25, e) - greatest(lon - 0.25, w)) * greatest(0, least(lat + 0.25, n) - greatest(lat - 0.25, s))"


def zonal(name: str, metric: str, convention: str, kind: str, sql: str) -> None:
    digits = 6 if convention == "area_weighted" else 9

    @query(name, sql)
    def _(spark, sf):
        out = zonal_stats(spark, lattice(spark, sf, kind), rectangles(spark), metric, convention)
        return out.select("name", out.metric if metric == "count" else F.round(F.col("metric"), digits).alias("metric"))


for _m, _s in SQL_METRICS.items():
    _v = _s if _m == "count" else f"round({_s}, 9)"
    zonal(f"zonal_centroid_{_m}", _m, "centroid", "plain", f"{WITH}SELECT name, {_v} AS metric FROM l, {SQL_RECTANGLES} WHERE {INSIDE} GROUP BY name")
for _m in ("max", "mean", "count"):
    _v = SQL_METRICS[_m] if _m == "count" else f"round({SQL_METRICS[_m]}, 9)"
    zonal(f"zonal_all_touched_{_m}", _m, "all_touched", "plain", f"{WITH}SELECT name, {_v} AS metric FROM l, {SQL_RECTANGLES} WHERE {TOUCHED} GROUP BY name")
for _k, _w in (("plain", WITH), ("gaps", f"WITH l AS ({sql_cells(45)}) ")):
    _tail = "" if _k == "plain" else "_gaps"
    zonal(f"zonal_area_mean{_tail}", "mean", "area_weighted", _k, f"{_w}SELECT name, round(sum(value * {SHARED}) / sum({SHARED}), 6) AS metric FROM l, {SQL_RECTANGLES} WHERE {TOUCHED} GROUP BY name")
    zonal(f"zonal_area_sum{_tail}", "sum", "area_weighted", _k, f"{_w}SELECT name, round(sum(value * {SHARED}), 6) AS metric FROM l, {SQL_RECTANGLES} WHERE {TOUCHED} GROUP BY name")


@query("zonal_by_time", f"{WITH}SELECT name, time, max(value) AS metric FROM l, {SQL_RECTANGLES} WHERE {INSIDE} GROUP BY name, time")
def _(spark, sf):
    return zonal_stats(spark, lattice(spark, sf), rectangles(spark), "max", "centroid", by_time=True)


@query("zonal_diamond", f"{WITH}SELECT 'diamond' AS name, avg(value) AS metric FROM l WHERE {IN_DIAMOND} UNION ALL SELECT 'triangle', avg(value) FROM l WHERE {IN_TRIANGLE}")
def _(spark, sf):
    return zonal_stats(spark, lattice(spark, sf), shapes(spark), "mean", "centroid")


@query("bbox_block_candidates", f"WITH l AS (SELECT 40 + 0.5 * a.i AS lat, -100 + 0.5 * b.i AS lon FROM range(20) a(i), range(24) b(i)) SELECT name, count(*) AS cells FROM l, {SQL_RECTANGLES} WHERE {TOUCHED} GROUP BY name")
def _(spark, sf):
    return box_candidates(rectangles(spark), grid_of(open_source(lattice(spark, sf))), ("name",)).groupBy("name").agg(F.count("*").alias("cells"))


@query("cover_weights", f"WITH l AS (SELECT 40 + 0.5 * a.i AS lat, -100 + 0.5 * b.i AS lon FROM range(20) a(i), range(24) b(i)) SELECT name, round(sum({SHARED}), 6) AS area FROM l, {SQL_RECTANGLES} WHERE {TOUCHED} GROUP BY name")
def _(spark, sf):
    covered = cover_cells(rectangles(spark), grid_of(open_source(lattice(spark, sf))), "area_weighted", ("name",))
    return covered.groupBy("name").agg(F.round(F.sum("__weight"), 6).alias("area"))


@query(
    "index_join",
    f"{WITH}, p AS (SELECT c_custkey, 40 + (c_custkey * 37 % 9409) / 1000.0 AS y, -100 + (c_custkey * 53 % 11411) / 1000.0 AS x FROM customer) "
    "SELECT c_custkey, avg(value) AS mean FROM p JOIN l ON round((y - 40) / 0.5) = (lat - 40) / 0.5 AND round((x + 100) / 0.5) = (lon + 100) / 0.5 GROUP BY c_custkey",
)
def _(spark, sf):
    path = lattice(spark, sf)
    points = read(spark, sf, "customer").select("c_custkey", (40 + (F.col("c_custkey") * 37 % 9409) / 1000.0).alias("y"), (-100 + (F.col("c_custkey") * 53 % 11411) / 1000.0).alias("x"))
    joined = join_by_index(points, read_geo(spark, path, index_columns=True).where("value IS NOT NULL"), grid_of(open_source(path)))
    return joined.groupBy("c_custkey").agg(F.avg("value").alias("mean"))


@query("extent", "SELECT min(w) AS xmin, min(s) AS ymin, max(e) AS xmax, max(n) AS ymax FROM " + SQL_RECTANGLES)
def _(spark, sf):
    return extent_frame(rectangles(spark))


@query("cell_step", f"{WITH}SELECT (max(lon) - min(lon)) / nullif(count(DISTINCT lon) - 1, 0) AS dx, (max(lat) - min(lat)) / nullif(count(DISTINCT lat) - 1, 0) AS dy FROM l")
def _(spark, sf):
    return cell_step(read_geo(spark, lattice(spark, sf)).where("value IS NOT NULL"))


# -- time -------------------------------------------------------------------

EVENTS = "SELECT CAST(floor(epoch(ts)) AS BIGINT) AS time, CAST(user_id % 5 AS DOUBLE) AS lat, CAST(user_id % 7 AS DOUBLE) AS lon, value FROM events"
SHIPPED = "SELECT CAST(floor(epoch(l_shipdate)) AS BIGINT) AS time, CAST(l_partkey % 5 AS DOUBLE) AS lat, CAST(l_suppkey % 7 AS DOUBLE) AS lon, l_quantity AS value FROM lineitem"


def events(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select(F.unix_timestamp(F.col("ts").cast("timestamp")).alias("time"), (F.col("user_id") % 5).cast("double").alias("lat"), (F.col("user_id") % 7).cast("double").alias("lon"), "value")


def shipped(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").select(F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).alias("time"), (F.col("l_partkey") % 5).cast("double").alias("lat"), (F.col("l_suppkey") % 7).cast("double").alias("lon"), F.col("l_quantity").alias("value"))


def resampled(name: str, source: str, freq: str, agg: str) -> None:
    table, sql = (events, EVENTS) if source == "events" else (shipped, SHIPPED)
    expression = {"avg": "avg(value)", "mean": "avg(value)", "stddev": "stddev_samp(value)", "variance": "var_samp(value)", "mode": "m"}.get(agg, f"{agg}(value)")
    at = f"date_trunc('{freq}', make_timestamp(time * 1000000))"
    whole = agg == "count"
    if agg == "mode":
        body = f"SELECT b AS time, lat, lon, round(CAST(arg_min(value, (-k, value)) AS DOUBLE), 6) AS value FROM (SELECT {at} AS b, lat, lon, value, count(*) AS k FROM s GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3"
    else:
        body = f"SELECT {at} AS time, lat, lon, {'CAST(count(value) AS BIGINT)' if whole else f'round(CAST({expression} AS DOUBLE), 6)'} AS value FROM s GROUP BY 1, 2, 3"
    sql = f"WITH s AS ({sql}), r AS ({body}) SELECT CAST(time AS TIMESTAMP) AS time, lat, lon, value FROM r"

    @query(name, sql)
    def _(spark, sf):
        out = resample(table(spark, sf), freq, agg)
        value = F.col("value") if whole else F.round(F.col("value").cast("double"), 6)
        return out.select(F.col("time").cast("timestamp_ntz").alias("time"), "lat", "lon", value.alias("value"))


for _f in FREQUENCIES:
    resampled(f"resample_{_f}_avg", "events" if _f in ("hour", "day", "week") else "lineitem", _f, "avg")
for _a in AGGREGATES:
    if _a != "avg":
        resampled(f"resample_agg_{_a}", "lineitem", "month", _a)


@query("point_nearest", f"{WITH}SELECT time, lat, lon, value FROM l WHERE lat = 43.5 AND lon = -96")
def _(spark, sf):
    return there(point_timeseries(spark, lattice(spark, sf), 43.4, -96.1))


@query("point_outside", f"{WITH}SELECT time, lat, lon, value FROM l WHERE lat = 49.5 AND lon = -88.5")
def _(spark, sf):
    return there(point_timeseries(spark, lattice(spark, sf), 80.0, 10.0))


@query(
    "point_idw",
    f"{WITH}, d AS (SELECT *, 1 / greatest(sqrt((lat - 43.6) ** 2 + (lon + 96.2) ** 2), 1e-9) AS w FROM l WHERE lat IN (43.5, 44) AND lon IN (-96.5, -96)) "
    "SELECT time, CAST(43.6 AS DOUBLE) AS lat, CAST(-96.2 AS DOUBLE) AS lon, round(sum(value * w) / sum(w), 6) AS value FROM d GROUP BY time",
)
def _(spark, sf):
    return there(point_timeseries(spark, lattice(spark, sf), 43.6, -96.2, "idw").withColumn("value", F.round("value", 6)))


# -- plots ------------------------------------------------------------------

BIN = "CAST(coalesce(floor((value - lo) / nullif((hi - lo) / 10.0::DOUBLE, 0)), 0) AS BIGINT)"


@query("hist", f"{WITH}, m AS (SELECT min(value) AS lo, max(value) AS hi FROM l) SELECT {BIN} AS bin_idx, count(*) AS freq FROM l, m GROUP BY 1")
def _(spark, sf):
    return histogram(read_geo(spark, lattice(spark, sf)), "value")


@query("hist_grouped", f"{WITH}, m AS (SELECT min(value) AS lo, max(value) AS hi FROM l) SELECT printf('%.1f', time) AS \"group\", {BIN} AS bin_idx, count(*) AS freq FROM l, m GROUP BY 1, 2")
def _(spark, sf):
    return histogram(read_geo(spark, lattice(spark, sf)), "value", group="time")


@query("heatmap", f"{WITH}SELECT CAST(least(floor((lat - 40) / (9.5 / 20)), 19) AS BIGINT) AS row, CAST(least(floor((lon + 100) / (11.5 / 24)), 23) AS BIGINT) AS col, round(avg(value), 9) AS mean FROM l GROUP BY 1, 2")
def _(spark, sf):
    return heatmap(read_geo(spark, lattice(spark, sf)), "value").withColumn("mean", F.round("mean", 9))


@query(
    "line_downsample",
    f"{WITH}, r AS (SELECT value, row_number() OVER (ORDER BY time, lat, lon, value) - 1 AS k, count(*) OVER () AS n FROM l) "
    "SELECT CAST(k // (CASE WHEN n > 100 THEN CAST(ceil(n / 100.0) AS BIGINT) ELSE 1 END) AS BIGINT) AS block, round(avg(value), 6) AS mean FROM r GROUP BY 1",
)
def _(spark, sf):
    return line(read_geo(spark, lattice(spark, sf)), "value", "time").withColumn("mean", F.round("mean", 6))


# -- export -----------------------------------------------------------------


@query("export_roundtrip", "SELECT CAST(c_custkey AS BIGINT) AS dim, c_acctbal AS value FROM customer")
def _(spark, sf):
    def make():
        return read(spark, sf, "customer").select(F.col("c_custkey").alias("dim"), F.col("c_acctbal").alias("value"))

    return read_geo(spark, stored(spark, "customers", sf, make, chunks={"dim": 1000})).where("value IS NOT NULL")


@query("export_strings", "SELECT CAST(n_nationkey AS BIGINT) AS dim, n_name AS value FROM nation")
def _(spark, sf):
    def make():
        return read(spark, sf, "nation").select(F.col("n_nationkey").alias("dim"), F.col("n_name").alias("value"))

    return read_geo(spark, stored(spark, "nations", sf, make, chunks={"dim": 10}))


@query("export_shape", "SELECT '[' || count(*) || ']' AS array_shape FROM customer")
def _(spark, sf):
    def make():
        return read(spark, sf, "customer").select(F.col("c_custkey").alias("dim"), F.col("c_acctbal").alias("value"))

    return read_zarr_metadata(spark, stored(spark, "customers", sf, make, chunks={"dim": 1000})).select("array_shape")


# Queries over formats, files, tools and commands register themselves.
from . import queries_surface  # noqa: E402, F401
