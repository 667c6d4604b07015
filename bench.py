"""Time the headline queries; prints one line of JSON.

Array queries run over the lattice of $BENCH_SF_DIR.  The zonal ones run over a
Others grow with the tables (an export and a scan of all lines) or have a fixed
large size (a thousand time steps, a million points and footprints).
"""

from __future__ import annotations

import json
import os
import struct
import sys
import tempfile
import time

import numpy as np

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
QUERIES = ["read_geo_bbox", "avg_by_lat", "plan_read_geo", "extract_polygons", "index_join", "point_nearest", "point_idw", "resample_month_avg", "resample_agg_median", "hist", "heatmap", "export_roundtrip"]
FOOTPRINTS = (10_000, 100_000, 1_000_000)
POINTS, STEPS = 1_000_000, 1_000
CASES = [("centroid", "max"), ("all_touched", "mean"), ("area_weighted", "mean")]


def raster(folder: str) -> str:
    from gridloom.sources.cog import write_cog

    rng, n = np.random.default_rng(42), 2000
    image = np.add.outer(np.linspace(0, 25, n), np.linspace(0, 25, n)) + rng.normal(0, 2, (n, n))
    path = os.path.join(folder, "fine.tif")
    write_cog(path, image.astype("f4"), (30, 30), (0, 60_000), 3857, 256, deflate=True)
    return path


def diamonds(spark, folder: str, n: int) -> str:
    import pyarrow as pa

    centres = np.random.default_rng(n).uniform(300, 59_700, (n, 2))
    around = 212.0 * np.array([[1, 0], [0, 1], [-1, 0], [0, -1], [1, 0]])
    head = np.frombuffer(struct.pack("<BIII", 1, 3, 1, 5), np.uint8)
    wkb = np.hstack([np.tile(head, (n, 1)), (centres[:, None] + around).reshape(n, 10).astype("<f8").view(np.uint8)])
    geom = pa.FixedSizeBinaryArray.from_buffers(pa.binary(wkb.shape[1]), n, [None, pa.py_buffer(wkb.tobytes())]).cast(pa.binary())
    path = os.path.join(folder, f"diamonds{n}.parquet")
    spark.createDataFrame(pa.table({"poly_id": np.arange(n), "geom": geom})).repartition(int(CPUS)).write.parquet(path)
    return path


def grown(spark, folder: str) -> str:
    """Lines of the scale factor's table as an array of their own: a cell for each order and line number."""
    from gridloom.sources.zarr_sink import export_zarr

    rows = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").selectExpr("l_orderkey AS lat", "l_linenumber AS lon", "l_extendedprice AS value").dropDuplicates(["lat", "lon"])
    path = os.path.join(folder, "lines.zarr")
    export_zarr(rows, path, chunks={"lat": 100_000, "lon": 1}, coords=True, mode="overwrite")
    return path


def remote_ratio(spark, folder: str) -> dict[str, float]:
    from gridloom.sources.cells import read_geo
    from gridloom.sources.cog import write_cog
    from gridloom.sources.folder_server import FolderServer
    from gridloom.sources.zarr_sink import array_json, encode_block

    n, chunk = 4000, 250
    image = np.random.default_rng(5).random((n, n), np.float32)
    write_cog(os.path.join(folder, "remote.tif"), image, (1, 1), (0, n), 3857, 256)
    base = os.path.join(folder, "remote.zarr")
    for y in range(n // chunk):
        os.makedirs(f"{base}/c/{y}")
        for x in range(n // chunk):
            with open(f"{base}/c/{y}/{x}", "wb") as f:
                f.write(encode_block(image[y * chunk : (y + 1) * chunk, x * chunk : (x + 1) * chunk], "float32", None))
    with open(f"{base}/zarr.json", "w") as f:
        json.dump(array_json((n, n), (chunk, chunk), "float32", float("nan"), ["y", "x"], {"geozarr": {"spatial_transform": {"scale": [1, 1], "translation": [0, 0]}}}, None), f)
    server = FolderServer(folder)
    out = {}
    for name in ("remote.zarr", "remote.tif"):
        server.bytes = 0
        read_geo(spark, f"{server.url}/{name}", y_min=2001, y_max=2249, x_min=1001, x_max=1249).agg({"value": "sum"}).collect()
        out[name] = round(server.bytes / image.nbytes, 4)
    return out


def main() -> None:
    from gridloom.queries import QUERIES as ALL
    from gridloom.functions.geometry import from_wkt, to_wkb
    from gridloom.operators.extract import join_by_index
    from gridloom.operators.grids import grid_of
    from gridloom.operators.zonal import zonal_stats
    from gridloom.session import allow, session
    from gridloom.sources.cells import read_geo
    from gridloom.sources.resolve import open_source
    from gridloom.sources.zarr_sink import export_zarr

    spark = session("bench", f"local[{CPUS}]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}

    def timed(name: str, make, repeat: int = 2) -> None:
        """The better of two runs: the first one also starts workers and compiles."""
        best = float("inf")
        for _ in range(repeat):
            began = time.time()
            make().write.format("noop").mode("overwrite").save()
            best = min(best, time.time() - began)
        took[name] = round(best, 3)

    for name in QUERIES:
        timed(name, lambda name=name: ALL[name](spark, SF_DIR))
    with tempfile.TemporaryDirectory() as folder:
        allow(folder)
        image = raster(folder)
        for n in FOOTPRINTS:
            path = diamonds(spark, folder, n)
            for convention, metric in CASES:
                timed(f"zonal_{convention}_{metric}_{n}", lambda: zonal_stats(spark, image, spark.read.parquet(path), metric, convention))
        began = time.time()
        lines = grown(spark, folder)
        took["export_lines"] = round(time.time() - began, 3)
        timed("scan_lines", lambda: read_geo(spark, lines))
        deep = os.path.join(folder, "deep.zarr")
        cells = spark.range(STEPS * 60 * 60).selectExpr("id div 3600 AS time", "CAST(id div 60 % 60 AS DOUBLE) AS lat", "CAST(id % 60 AS DOUBLE) AS lon", "CAST(id % 1009 AS DOUBLE) AS value")
        export_zarr(cells, deep, chunks={"time": 12, "lat": 60, "lon": 60}, coords=True)
        shape = spark.createDataFrame([(1, to_wkb(from_wkt("POLYGON((5 5,55 9,50 50,5 5))")))], "id int, geom binary")
        timed(f"zonal_one_footprint_{STEPS}_steps", lambda: zonal_stats(spark, deep, shape, "mean", "centroid"))
        points = spark.range(POINTS).selectExpr("id", "rand(3) * 59 AS y", "rand(4) * 59 AS x")
        one = read_geo(spark, deep, pins="time=3", index_columns=True)
        timed(f"index_join_{POINTS}", lambda: join_by_index(points, one, grid_of(open_source(deep))).agg({"value": "max"}))
        ratio = remote_ratio(spark, folder)
    print(json.dumps({"metric": "headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "remote_bytes_ratio": ratio, "sf": os.path.basename(SF_DIR.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
