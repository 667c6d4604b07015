"""Zarr arrays, versions 2 and 3, sharded ones included."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

import numpy as np

from .arrays import MAX_COORDS, ArrayInfo, wraps
from .codecs import crc32c, decode_strings, decompress
from .stores import Store

NAMES = {"b1": "bool", "i1": "int8", "i2": "int16", "i4": "int32", "i8": "int64", "u1": "uint8", "u2": "uint16", "u4": "uint32", "u8": "uint64", "f4": "float32", "f8": "float64"}
SPECIAL = {"NaN": math.nan, "Infinity": math.inf, "-Infinity": -math.inf}
NO_CHUNK = (1 << 64) - 1


@dataclass
class Pipeline:
    """How a chunk's bytes become an array: byte codecs, then an order of bytes and axes."""

    dtype: str
    stored: str  # NumPy's type of the stored bytes
    codecs: list[str] = field(default_factory=list)  # in the order of decoding
    transpose: list[int] | None = None  # stored axis k is axis transpose[k]
    big: bool = False

    def decode(self, data: bytes, shape: tuple[int, ...]) -> np.ndarray:
        for name in self.codecs:
            data = decompress(name, data)
        stored = tuple(shape[k] for k in self.transpose) if self.transpose else shape
        if self.dtype == "string":
            if self.stored == "O":
                flat = decode_strings(data)
            else:
                flat = np.frombuffer(data, self.stored)
                flat = np.array([x.decode() if isinstance(x, bytes) else str(x) for x in flat], object)
            a = flat.reshape(stored)
        else:
            a = np.frombuffer(data, np.dtype(self.stored).newbyteorder(">" if self.big else "<"), math.prod(stored)).reshape(stored)
            a = a.astype(np.dtype(self.dtype), copy=False)
        return a.transpose(np.argsort(self.transpose)) if self.transpose else a


@dataclass
class ZarrReader:
    """Reads chunks; picklable, as it keeps an address rather than an open store."""

    store: Store
    shape: tuple[int, ...]  # of a stored chunk, or of a shard
    pipeline: Pipeline
    prefix: str
    separator: str
    inner: tuple[int, ...] | None = None  # chunks of a shard
    index_at_end: bool = True
    index_codecs: tuple[str, ...] = ()

    def key(self, at: tuple[int, ...]) -> str:
        name = self.separator.join(map(str, at)) if at else ("" if self.prefix else "0")
        return (f"{self.prefix}{self.separator}{name}" if name else self.prefix) if self.prefix else name

    def read(self, at: tuple[int, ...], part: tuple[slice, ...]) -> np.ndarray | None:
        if self.inner is None:
            data = self.store.get(self.key(at))
            return None if data is None else self.pipeline.decode(data, self.shape)[part]
        return self._from_shard(self.key(at), part)

    def _index(self, key: str, counts: tuple[int, ...]) -> np.ndarray | None:
        n = math.prod(counts) * 16
        extra = 4 * ("crc32c" in self.index_codecs)
        data = self.store.get(key, -(n + extra)) if self.index_at_end else self.store.get(key, 0, n + extra)
        if data is None:
            return None
        if extra:
            if crc32c(data[:-4]) != int.from_bytes(data[-4:], "little"):
                raise ValueError(f"{key}: the shard's index doesn't match its checksum")
            data = data[:-4]
        return np.frombuffer(data, "<u8").reshape(*counts, 2)

    def _from_shard(self, key: str, part: tuple[slice, ...]) -> np.ndarray | None:
        """Only the inner chunks that the part needs, each by its byte range."""
        counts = tuple(s // c for s, c in zip(self.shape, self.inner, strict=True))
        index = self._index(key, counts)
        if index is None:
            return None
        starts = [p.start for p in part]
        stops = [p.stop for p in part]
        out, found = None, False
        wanted = [range(a // c, (b - 1) // c + 1) for a, b, c in zip(starts, stops, self.inner, strict=True)]
        holes = []
        for at in np.ndindex(*[len(w) for w in wanted]):
            k = tuple(w[i] for w, i in zip(wanted, at, strict=True))
            lo = [max(a, i * c) for a, i, c in zip(starts, k, self.inner, strict=True)]
            hi = [min(b, (i + 1) * c) for b, i, c in zip(stops, k, self.inner, strict=True)]
            into = tuple(slice(a - s, b - s) for a, b, s in zip(lo, hi, starts, strict=True))
            offset, size = (int(x) for x in index[k])
            if offset == NO_CHUNK and size == NO_CHUNK:
                holes.append(into)
                continue
            block = self.pipeline.decode(self.store.get(key, offset, size), self.inner)
            piece = block[tuple(slice(a - i * c, b - i * c) for a, b, i, c in zip(lo, hi, k, self.inner, strict=True))]
            if out is None:
                out = np.empty([b - a for a, b in zip(starts, stops, strict=True)], piece.dtype)
            out[into] = piece
            found = True
        if not found:
            return None
        for into in holes:
            out[into] = self.fill
        return out

    fill: object = 0


def _fill(value, dtype: str):
    if value is None:
        return None
    if dtype == "string":
        return str(value)
    if isinstance(value, str):
        if value in SPECIAL:
            return SPECIAL[value]
        if value.startswith("0x"):
            return np.frombuffer(int(value, 16).to_bytes(np.dtype(dtype).itemsize, "little"), dtype)[0]
    return np.array(value, dtype)[()]


def _geo(attributes: dict) -> tuple[str | None, list | None, list | None]:
    """CRS, scale and translation of the geozarr attribute; a malformed one says nothing."""
    geo = attributes.get("geozarr")
    try:
        if not isinstance(geo, dict):
            return None, None, None
        crs = geo.get("crs") or (geo.get("spatial_reference") or {}).get("crs")
        transform = geo.get("spatial_transform")
        scale = translation = None
        if transform is not None:
            scale, translation = [float(x) for x in transform["scale"]], [float(x) for x in transform["translation"]]
            if len(scale) != len(translation):
                return None, None, None
        return (str(crs) if crs else None), scale, translation
    except (TypeError, ValueError, AttributeError, KeyError):
        return None, None, None


def metadata(store: Store) -> dict | None:
    """The array's metadata, in one form for both versions; None if there is no array."""
    if (raw := store.probe("zarr.json")) is not None:
        meta = json.loads(raw)
        return {"version": 3, **meta} if meta.get("node_type") == "array" else None
    if (raw := store.probe(".zarray")) is not None:
        attributes = store.probe(".zattrs")
        return {"version": 2, **json.loads(raw), "attributes": json.loads(attributes) if attributes else {}}
    return None


def _v2(store: Store, meta: dict) -> tuple[ZarrReader, str]:
    kind = meta["dtype"]
    if not isinstance(kind, str):
        raise ValueError("structured data types aren't supported")
    filters = [f["id"] for f in meta.get("filters") or []]
    if kind[1:] == "O" and "vlen-utf8" in filters:
        dtype, stored = "string", "O"
    elif kind[1] in "SU":
        dtype, stored = "string", kind
    else:
        dtype, stored = NAMES.get(kind[1:]), kind[1:]
    if dtype is None or any(f != "vlen-utf8" for f in filters):
        raise ValueError(f"unsupported data type {kind} with filters {filters}")
    press = meta.get("compressor")
    order = list(reversed(range(len(meta["shape"])))) if meta.get("order") == "F" else None
    pipeline = Pipeline(dtype, stored, [press["id"]] if press else [], order, kind[0] == ">")
    return ZarrReader(store, tuple(meta["chunks"]), pipeline, "", meta.get("dimension_separator", ".")), dtype


def _chain(codecs: list[dict], dtype: str, rank: int) -> Pipeline:
    pipeline = Pipeline(dtype, "O" if dtype == "string" else dtype)
    for codec in codecs:
        name, options = codec["name"], codec.get("configuration") or {}
        if name == "transpose":
            order = options["order"]
            order = list(range(rank)) if order == "C" else list(reversed(range(rank))) if order == "F" else order
            before = pipeline.transpose or list(range(rank))
            pipeline.transpose = [before[k] for k in order]
        elif name == "bytes":
            pipeline.big = options.get("endian") == "big"
        elif name != "vlen-utf8":
            pipeline.codecs.insert(0, name)
    return pipeline


def _v3(store: Store, meta: dict) -> tuple[ZarrReader, str]:
    dtype = meta["data_type"]
    if not isinstance(dtype, str) or (dtype not in NAMES.values() and dtype != "string"):
        raise ValueError(f"unsupported data type {dtype}")
    grid = meta["chunk_grid"]
    if grid["name"] != "regular":
        raise ValueError("only regular chunk grids are supported")
    shape, rank = tuple(grid["configuration"]["chunk_shape"]), len(meta["shape"])
    encoding = meta.get("chunk_key_encoding") or {"name": "default"}
    options = encoding.get("configuration") or {}
    prefix, separator = ("c", options.get("separator", "/")) if encoding["name"] == "default" else ("", options.get("separator", "."))
    codecs = meta["codecs"]
    if codecs and codecs[0]["name"] == "sharding_indexed":
        shard = codecs[0]["configuration"]
        checks = tuple(c["name"] for c in shard.get("index_codecs", []))
        reader = ZarrReader(
            store, shape, _chain(shard["codecs"], dtype, rank), prefix, separator,
            tuple(shard["chunk_shape"]), shard.get("index_location", "end") == "end", checks,
        )
    else:
        reader = ZarrReader(store, shape, _chain(codecs, dtype, rank), prefix, separator)
    return reader, dtype


def open_array(uri: str, store: Store, with_coords: bool = True) -> ArrayInfo | None:
    """Describe the array at a store's root; None if there is none."""
    meta = metadata(store)
    if meta is None:
        return None
    reader, dtype = (_v2 if meta["version"] == 2 else _v3)(store, meta)
    shape, attributes = list(meta["shape"]), meta.get("attributes") or {}
    rank = len(shape)
    names = meta.get("dimension_names")
    if not (names and len(names) == rank and all(n is not None for n in names)):
        names = attributes.get("_ARRAY_DIMENSIONS")
    if not (isinstance(names, list) and len(names) == rank):
        names = [f"dim_{i}" for i in range(rank)]
    crs, scale, translation = _geo(attributes)
    if scale is not None and len(scale) < rank:
        # It is about the last dimensions; those before have none.
        scale = [None] * (rank - len(scale)) + scale
        translation = [None] * (rank - len(translation)) + translation
    fill = _fill(meta.get("fill_value"), dtype)
    reader.fill = fill if fill is not None else ("" if dtype == "string" else 0)
    info = ArrayInfo(
        uri, shape, list(reader.shape), dtype, list(map(str, names)), reader, {}, scale, translation,
        None if attributes.get("no_fill") else fill, crs,
    ).validate()
    if with_coords:
        coords = {n: c for d, n in enumerate(info.dims) if (c := coordinate(store, n, shape[d])) is not None}
        info.coords = coords
        info.wrapped = frozenset(n for n, c in coords.items() if wraps(n, c))
    return info


def coordinate(store: Store, name: str, size: int) -> np.ndarray | None:
    """The coordinate array of a dimension: in the array's own store, else beside it."""
    for home in (store, store.parent()):
        if home is None:
            continue
        try:
            info = open_array(name, home.child(name), with_coords=False)
        except (ValueError, PermissionError):
            continue
        if info is None or len(info.shape) != 1 or info.shape[0] != size or info.dtype not in ("float64", "float32", "int64", "int32"):
            continue
        if size > MAX_COORDS:
            raise ValueError(f"the axis {name} has {size} coordinates; {MAX_COORDS} at most")
        out = np.empty(size, np.float64)
        for k in range(-(-size // info.chunk[0])):
            a, b = k * info.chunk[0], min(size, (k + 1) * info.chunk[0])
            got = info.reader.read((k,), (slice(0, b - a),))
            out[a:b] = info.reader.fill if got is None else got
        return out
    return None


def list_arrays(store: Store) -> list[str]:
    """Names of the arrays in a group: by consolidated metadata, else by looking."""
    for key, place in ((".zmetadata", "metadata"), ("zarr.json", "consolidated_metadata")):
        if (raw := store.probe(key)) is None:
            continue
        meta = json.loads(raw).get(place) or {}
        meta = meta.get("metadata", meta) if place == "consolidated_metadata" else meta
        names = [k[: -len("/.zarray")] for k in meta if k.endswith("/.zarray")]
        names += [k for k, v in meta.items() if isinstance(v, dict) and v.get("node_type") == "array"]
        if names:
            return sorted(names)
    found = []
    for name in store.list():
        child = store.child(name)
        raw = child.probe("zarr.json")
        if child.probe(".zarray") is not None or (raw is not None and json.loads(raw).get("node_type") == "array"):
            found.append(name)
    return found
