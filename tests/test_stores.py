import json
import math
import struct
import threading
import zlib
from functools import partial
from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.plans.constraints import Constraints
from gridloom.sources import codecs
from gridloom.sources.cells import read_geo
from gridloom.sources.cog import open_cog, write_cog
from gridloom.sources.resolve import Group, list_sources, open_source
from gridloom.sources.stores import Forbidden, HttpStore, LocalStore
from gridloom.sources.tables import describe, plan
from gridloom.sources.zarr import open_array
from gridloom.sources.zarr_sink import array_json, auto_chunks, export_zarr, shard_block


class Ranged(SimpleHTTPRequestHandler):
    """Serves byte ranges, STAC searches in pages, and counts."""

    sent = 0
    calls: list = []

    def log_message(self, *args):
        pass

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        type(self).calls.append(("POST", self.path, body))
        self.reply_json({"features": [{"id": "i1", "links": [{"rel": "self", "href": "http://h/i1"}], "assets": {"a": {"href": "x.tif"}}}, {"id": "i2", "links": [], "assets": {"a": {"href": "x.tif"}}}]})

    def reply_json(self, data):
        raw = json.dumps(data).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(raw)))
        self.end_headers()
        self.wfile.write(raw)

    def do_GET(self):
        type(self).calls.append(("GET", self.path, None))
        path, _, query = self.path.partition("?")
        if path == "/collections":
            return self.reply_json({"collections": [{"id": "c1", "title": "One", "assets": {"z": {"href": "a.zarr"}}}, {"id": "c2", "assets": {"t": {"href": "a.txt", "type": "text/plain"}}}]})
        if path == "/search":
            page = int(dict(p.split("=") for p in query.split("&")).get("page", 0))
            items = json.loads(open(f"{self.directory}/items.json").read())["features"]
            links = [{"rel": "next", "href": f"/search?page={page + 1}"}] if page + 1 < len(items) else []
            return self.reply_json({"type": "FeatureCollection", "features": [items[page]], "links": links})
        if path == "/circle/items":
            return self.reply_json({"type": "FeatureCollection", "features": [{}], "links": [{"rel": "next", "href": "?page=1"}]})
        try:
            with open(f"{self.directory}{path}", "rb") as f:
                data = f.read()
        except OSError:
            return self.send_error(404)
        span = self.headers.get("Range")
        if span:
            a, _, b = span.removeprefix("bytes=").partition("-")
            data = data[-int(b) :] if not a else data[int(a) : int(b) + 1 if b else None]
        type(self).sent += len(data)
        self.send_response(206 if span else 200)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)


@pytest.fixture
def server(folder):
    handler = type("Handler", (Ranged,), {"sent": 0, "calls": []})
    httpd = ThreadingHTTPServer(("127.0.0.1", 0), partial(handler, directory=str(folder)))
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_address[1]}", handler
    httpd.shutdown()


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else json.dumps(data).encode())


def v2(root, a, chunks, attributes=None, press="zlib", order="C", separator=".", fill=0):
    kind = a.dtype.str
    meta = {"zarr_format": 2, "shape": a.shape, "chunks": chunks, "dtype": kind, "compressor": press and {"id": press}, "filters": None, "order": order, "fill_value": fill, "dimension_separator": separator}
    put(root / ".zarray", meta)
    if attributes:
        put(root / ".zattrs", attributes)
    for at in np.ndindex(*[-(-s // c) for s, c in zip(a.shape, chunks, strict=True)]):
        block = np.full(chunks, fill, a.dtype)
        part = a[tuple(slice(i * c, (i + 1) * c) for i, c in zip(at, chunks, strict=True))]
        block[tuple(slice(0, n) for n in part.shape)] = part
        raw = block.tobytes(order=order)
        put(root / separator.join(map(str, at)), codecs.compress(press, raw, width=a.dtype.itemsize) if press else raw)


def whole(info):
    """All of an array, chunk by chunk."""
    out = np.empty(info.shape, info.dtype)
    for b in info.boxes(Constraints()):
        for at in b.chunks():
            inside = b.inside(at)
            part = tuple(slice(lo - g * c, hi - g * c) for (lo, hi), g, c in zip(inside, at, info.chunk, strict=True))
            out[tuple(slice(*i) for i in inside)] = info.reader.read(at, part)
    return out


def test_crc32c():
    assert codecs.crc32c(b"123456789") == 0xE3069283
    data = bytes(range(256)) * 41
    table = codecs._crc_table()
    state = 0xFFFFFFFF
    for b in data:
        state = int(table[(state ^ b) & 255]) ^ state >> 8
    assert codecs.crc32c(data) == state ^ 0xFFFFFFFF
    with pytest.raises(ValueError):
        codecs.decompress("crc32c", data + b"0000")


@pytest.mark.parametrize("name", ["gzip", "zlib", "zstd", "blosc", "crc32c"])
def test_codecs_there_and_back(name):
    data = np.arange(5000, dtype="i4").tobytes()
    assert codecs.decompress(name, codecs.compress(name, data, width=4)) == data


def test_blosc_layouts():
    import pyarrow as pa

    raw = np.arange(4096, dtype="<i4").tobytes()
    shuffled = np.frombuffer(raw, np.uint8).reshape(-1, 4).T.tobytes()
    lz4 = pa.Codec("lz4_raw")
    streams = b"".join(struct.pack("<i", len(p)) + p for k in range(4) if (p := lz4.compress(shuffled[k * 4096 : (k + 1) * 4096], asbytes=True)))
    frame = bytes([2, 1, 1 | 1 << 5, 4]) + struct.pack("<III", len(raw), len(raw), 20 + len(streams)) + struct.pack("<I", 20) + streams
    assert codecs.blosc_decode(frame) == raw
    stored = bytes([2, 1, 2, 4]) + struct.pack("<III", len(raw), len(raw), 16 + len(raw)) + raw
    assert codecs.blosc_decode(stored) == raw
    # blosclz: a literal run, then a match that overlaps itself.
    assert codecs._blosclz(bytes([2]) + b"abc" + bytes([(7 << 5) | 0, 0, 2]), 12) == b"abcabcabcabc"
    bits = np.packbits(np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little").reshape(-1, 32).T, axis=1, bitorder="little").tobytes()
    assert codecs._unshuffle_bits(bits, 4) == raw


@pytest.mark.parametrize("order,separator,press", [("C", ".", "zlib"), ("F", "/", "gzip"), ("C", "/", None), ("C", ".", "blosc"), ("C", ".", "zstd")])
def test_zarr_v2(folder, order, separator, press):
    a = np.arange(7 * 11, dtype="<i2").reshape(7, 11)
    root = folder / "a.zarr"
    v2(root, a, (3, 4), {"_ARRAY_DIMENSIONS": ["lat", "lon"]}, press, order, separator)
    info = open_source(str(root))
    assert (info.dims, info.dtype, info.chunk) == (["lat", "lon"], "int16", [3, 4])
    assert (whole(info) == a).all()


def test_zarr_v2_big_endian_and_coordinates(folder):
    a = np.arange(6, dtype=">f8").reshape(2, 3)
    v2(folder / "g.zarr" / "t", a, (2, 2), {"_ARRAY_DIMENSIONS": ["lat", "lon"]})
    v2(folder / "g.zarr" / "lat", np.array([45, 46], "<f4"), (2,))
    v2(folder / "g.zarr" / "lon", np.array([179, 181, 183], "<f8"), (3,))
    info = open_source(str(folder / "g.zarr"), asset="t")
    assert (whole(info) == a).all()
    assert info.axis(1, 0, 3).tolist() == [179, -179, -177]
    assert list_sources(str(folder / "g.zarr")) == ["lat", "lon", "t"]
    with pytest.raises(Group, match="t"):
        open_source(str(folder / "g.zarr"))


def test_plan_numbers(folder):
    put(folder / "p.zarr" / "zarr.json", array_json([100, 100], [10, 10], "float32", 0.0, [None, None], {}))
    assert plan(str(folder / "p.zarr")) == (100, 40_000)
    root = folder / "q.zarr"
    put(root / "zarr.json", array_json([50, 50], [5, 5], "int16", 0, ["lat", "lon"], {}))
    for n in ("lat", "lon"):
        v2(root / n, np.arange(50.0), (50,))
    assert plan(str(root), lat_min=10, lat_max=24, lon_min=5, lon_max=9) == (3, 150)
    assert plan(str(root), lat_min=70) == (0, 0)
    assert describe(str(root)) == ("[50, 50]", "[5, 5]", "Int16", "UNKNOWN")


@pytest.mark.parametrize("at_end", [True, False])
def test_shards_are_read_in_part(folder, at_end):
    """Windows that straddle shards; an absent inner chunk is fill."""
    a = (np.arange(16)[:, None] * 1000 + np.arange(16)).astype("i4")
    a[0:2, 0:2] = -1
    meta = array_json([16, 16], [8, 8], "int32", -1, ["y", "x"], {}, "zstd", [2, 2])
    meta["codecs"][0]["configuration"]["index_location"] = "end" if at_end else "start"
    put(folder / "s.zarr" / "zarr.json", meta)
    for i in range(2):
        for j in range(2):
            data = shard_block(a[i * 8 : i * 8 + 8, j * 8 : j * 8 + 8], "int32", "zstd", (2, 2), -1)
            if not at_end:
                size = 16 * 16 + 4
                body, index = data[:-size], np.frombuffer(data[-size:-4], "<u8").reshape(-1, 2).copy()
                index[index[:, 0] != 2**64 - 1, 0] += size
                data = codecs.compress("crc32c", index.tobytes()) + body
            put(folder / "s.zarr" / "c" / str(i) / str(j), data)
    info = open_source(str(folder / "s.zarr"))
    assert (whole(info) == a).all()
    info.reader.store.traffic.bytes = 0
    assert (info.reader.read((0, 0), (slice(6, 8), slice(6, 8))) == a[6:8, 6:8]).all()
    assert info.reader.store.traffic.bytes < 400
    assert info.missing(np.array([-1, 5], "i4")).tolist() == [True, False]


def test_cells_of_every_type(spark, folder):
    for dtype, fill in (("bool", None), ("int8", -128), ("uint8", 255), ("uint16", 7), ("uint32", 7), ("uint64", 2**64 - 1), ("int64", 0), ("float32", "NaN"), ("float64", "NaN")):
        root = folder / f"{dtype}.zarr"
        meta = array_json([4], [3], dtype, fill if fill is not None else False, ["i"], {"no_fill": True} if fill is None else {}, "none")
        put(root / "zarr.json", meta)
        values = np.array([1, 0, 1, 1] if dtype == "bool" else [1, 2, fill if fill != "NaN" else np.nan, 3], dtype)
        put(root / "c" / "0", values[:3].tobytes())
        put(root / "c" / "1", np.concatenate([values[3:], np.zeros(2, dtype)]).tobytes())
        got = [r["value"] for r in read_geo(spark, str(root)).orderBy("i").collect()]
        assert got == ([True, False, True, True] if dtype == "bool" else [1, 2, None, 3]), dtype


def test_absent_chunks_bad_metadata_and_limits(spark, folder):
    put(folder / "n.zarr" / "zarr.json", array_json([4], [2], "int32", 9, ["i"], {"geozarr": "nonsense"}))
    assert [r["value"] for r in read_geo(spark, str(folder / "n.zarr")).collect()] == [None] * 4
    for change in ({"data_type": "complex64"}, {"chunk_grid": {"name": "regular", "configuration": {"chunk_shape": [0]}}}, {"shape": [1] * 17, "chunk_grid": {"name": "regular", "configuration": {"chunk_shape": [1] * 17}}, "dimension_names": None}, {"chunk_grid": {"name": "regular", "configuration": {"chunk_shape": [1 << 30]}}}):
        put(folder / "b.zarr" / "zarr.json", array_json([4], [2], "int32", 9, ["i"], {}) | change)
        with pytest.raises(ValueError):
            open_source(str(folder / "b.zarr"))
    with pytest.raises(FileNotFoundError):
        open_source(str(folder / "none.zarr"))
    with pytest.raises(Forbidden):
        open_source("/etc/hostname")


@pytest.mark.parametrize("big", [False, True])
@pytest.mark.parametrize("deflate", [False, True])
def test_cog(folder, big, deflate):
    image = np.array([[0, 1, 2, 3], [10, 11, 12, 13]], "i2")
    write_cog(str(folder / "a.tif"), image, (2, 2), (-180, 90), 4326, 16, deflate, None, big)
    info = open_source(str(folder / "a.tif"))
    assert (info.dims, info.shape, info.crs, info.fill) == (["lat", "lon"], [2, 4], "EPSG:4326", None)
    assert info.axis(0, 0, 2).tolist() == [89, 87] and info.axis(1, 0, 4).tolist() == [-179, -177, -175, -173]
    assert (whole(info) == image).all()


def test_cog_bands_nodata_and_refusals(spark, folder):
    image = np.arange(3 * 20 * 20, dtype="f4").reshape(3, 20, 20)
    write_cog(str(folder / "b.tif"), image, (30, 30), (0, 600), 3857, 16, True, 5)
    got = {(r["band"], r["y"], r["x"]): r["value"] for r in read_geo(spark, str(folder / "b.tif"), y_min=500, y_max=600, x_min=0, x_max=200).collect()}
    assert got[(0, 585.0, 165.0)] is None  # the fifth value is the nodata value
    assert got[(2, 585.0, 15.0)] == 800 and len(got) == 3 * 3 * 7
    raw = bytearray((folder / "b.tif").read_bytes())
    raw[:2] = b"XX"
    (folder / "c.tif").write_bytes(raw)
    with pytest.raises(ValueError, match="not a TIFF"):
        open_source(str(folder / "c.tif"))


def stack(folder, times=("2026-02-01T00:00:00Z", "2026-01-01T00:00:00Z"), shapes=((2, 4), (2, 4))):
    items = []
    for k, (time, shape) in enumerate(zip(times, shapes, strict=True)):
        write_cog(str(folder / f"i{k}.tif"), np.arange(shape[0] * shape[1], dtype="i2").reshape(shape) + 100 * k, (2, 2), (-180, 90), 4326)
        items.append({"type": "Feature", "id": f"i{k}", "properties": {"datetime": time} if time else {}, "assets": {"band": {"href": f"./i{k}.tif", "type": "image/tiff"}, "doc": {"href": "x.txt"}}})
    put(folder / "items.json", {"type": "FeatureCollection", "features": items})
    put(folder / "item.json", items[0])
    return str(folder / "items.json")


def test_stac_stack(spark, folder):
    path = stack(folder)
    info = open_source(path)
    assert info.dims == ["time", "lat", "lon"] and info.shape == [2, 2, 4] and info.coords["time"][0] == 1767225600.0
    got = read_geo(spark, path, time_min=1769904000.0).groupBy("time").agg(F.min("value").alias("v")).collect()
    assert [(r["time"], r["v"]) for r in got] == [(1769904000.0, 0)]
    assert open_source(str(folder / "item.json")).shape == [2, 4]
    assert list_sources(path) == ["band"]
    with pytest.raises(ValueError, match="band"):
        open_source(path, asset="red")


@pytest.mark.parametrize("change,message", [({"times": ("2026-01-01T00:00:00Z", None)}, "says no datetime"), ({"times": ("soon", "2026-01-01T00:00:00Z")}, "i0"), ({"shapes": ((2, 4), (3, 4))}, "i0 has another grid|i1 has another grid")])
def test_stac_refusals(folder, change, message):
    with pytest.raises(ValueError, match=message):
        open_source(stack(folder, **change))


def test_stac_empty(folder):
    put(folder / "e.json", {"type": "FeatureCollection", "features": []})
    with pytest.raises(ValueError, match="empty"):
        open_source(str(folder / "e.json"))


def test_http_zarr_reads_little(spark, folder, server):
    url, handler = server
    a = np.arange(400 * 400, dtype="f4").reshape(400, 400)
    df = spark.range(400 * 400).selectExpr("id div 400 as lat", "id % 400 as lon", "cast(id as float) value")
    export_zarr(df, str(folder / "h.zarr"), chunks={"lat": 200, "lon": 200}, inner={"lat": 20, "lon": 20}, codec="none")
    info = open_array(url, HttpStore(f"{url}/h.zarr"))
    handler.sent = 0
    assert (info.reader.read((0, 0), (slice(5, 15), slice(5, 15))) == a[5:15, 5:15]).all()
    assert handler.sent < 0.02 * a.nbytes
    got = read_geo(spark, f"{url}/h.zarr", pins="lat=3,lon=7").collect()
    assert [r["value"] for r in got] == [1207.0]


def test_http_stac_pages_bbox_and_assets(folder, server):
    url, handler = server
    stack(folder)
    box = {"lat": (80.0, 90.0), "lon": (-180.0, -170.0), "time": (0.0, 2e9)}
    with pytest.raises(ValueError, match="lat_min"):
        open_source(f"{url}/search")
    with pytest.raises(ValueError, match="square degrees"):
        open_source(f"{url}/search", {"lat": (-90, 90), "lon": (-180, 180)})
    info = open_source(f"{url}/search", box)
    assert info.shape == [2, 2, 4]
    first = next(p for m, p, _ in handler.calls if p.startswith("/search"))
    assert "bbox=-180,80,-170,90" in first and "datetime=1970-01-01" in first
    assert open_source(f"{url}/item.json/band").shape == [2, 4]
    with pytest.raises(ValueError, match="circle"):
        open_source(f"{url}/circle/items", box)


def test_catalogue_search(server):
    from gridloom.operators.search import collections, search, search_body

    url, handler = server
    assert collections(url) == [{"id": "c1", "title": "One"}]
    assert search(url, "c1", "0,0,1,1", "2026-01-01/..") == [{"id": "i1", "uri": "http://h/i1"}]
    assert handler.calls[-1][2] == {"collections": ["c1"], "limit": 10, "bbox": [0, 0, 1, 1], "datetime": "2026-01-01/.."}
    for bad in ("1,2,3", "a,b,c,d"):
        with pytest.raises(ValueError):
            search_body("c", bad)


def test_export_refusals_and_chunks(spark, folder):
    assert auto_chunks([1000, 1000, 100]) == [1000, 1000, 10]
    assert auto_chunks([4, 5], {"b": 2}, ["a", "b"]) == [4, 2]
    with pytest.raises(ValueError):
        auto_chunks([4], {"a": 0}, ["a"])
    bad = spark.createDataFrame([(0, 1.0), (5, 2.0)], "t int, value double")
    with pytest.raises(ValueError, match="exceeds maximum bound"):
        export_zarr(bad, str(folder / "x.zarr"))
    with pytest.raises(Exception, match="same coordinates"):
        export_zarr(spark.createDataFrame([(0, 1.0), (0, 2.0)], "t int, value double"), str(folder / "y.zarr"))
    assert not (folder / "y.zarr" / "zarr.json").exists()
    good = spark.createDataFrame([(0, 1), (1, 0), (2, None)], "t int, value int")
    export_zarr(good, str(folder / "z.zarr"))
    with pytest.raises(FileExistsError):
        export_zarr(good, str(folder / "z.zarr"))
    assert [r["value"] for r in read_geo(spark, str(folder / "z.zarr")).orderBy("t").collect()] == [1, 0, None]


def test_local_store_ranges(folder):
    (folder / "f").write_bytes(b"0123456789")
    s = LocalStore(str(folder))
    assert (s.get("f", 2, 3), s.get("f", -2), s.get("g")) == (b"234", b"89", None)
    assert math.isclose(s.traffic.bytes, 5)
    assert zlib.crc32(s.get("f")) == zlib.crc32(b"0123456789") and open_cog("x", s, "g") is None
