"""The ``zarr`` sink: rows of cells to a Zarr version 3 array.

Rows are dealt out by chunk, so that each chunk is assembled and written by
one task.  The array's metadata is written last, by the driver: until then, and
if a task fails for good, there is no array.
"""

from __future__ import annotations

import json
import math
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .arrays import MAX_COORDS
from .codecs import compress, encode_strings
from .stores import local_path

#: Elements of a chunk at most, where none are asked for.
AUTO_VOLUME = 10_000_000

DTYPES = {
    "boolean": "bool", "tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64",
    "float": "float32", "double": "float64", "string": "string",
}


def dtype_of(field: T.StructField) -> str:
    """The array type of a column; a column that came from an array keeps its own."""
    origin = (field.metadata or {}).get("zarr_dtype")
    if origin:
        return origin
    kind = field.dataType.simpleString()
    if isinstance(field.dataType, T.DecimalType):
        return "float64"
    if kind not in DTYPES:
        raise ValueError(f"a column of type {kind} can't be exported")
    return DTYPES[kind]


def auto_chunks(shape: list[int], wanted: dict[str, int] | None = None, names: list[str] | None = None) -> list[int]:
    """Whole dimensions from the first on, as long as the volume allows; ``wanted`` sizes come first."""
    wanted, names = wanted or {}, names or []
    volume, out = 1, []
    for d, size in enumerate(shape):
        name = names[d] if d < len(names) else None
        if name in wanted:
            c = int(wanted[name])
            if c <= 0:
                raise ValueError(f"a chunk size of {c} for {name}")
        else:
            c = max(1, size if volume * size <= AUTO_VOLUME else AUTO_VOLUME // volume)
        volume *= c
        out.append(c)
    return out


def parse_chunks(text: str | dict | None) -> dict[str, int]:
    if not text:
        return {}
    got = json.loads(text) if isinstance(text, str) else text
    if not isinstance(got, dict):
        raise ValueError("chunk sizes must be an object of sizes by dimension")
    return {k: int(v) for k, v in got.items()}


def array_json(shape, chunk, dtype, fill, names, attributes, codec="zstd", inner=None) -> dict:
    press = [] if codec in (None, "none") else [{"name": codec, "configuration": {"level": 3} if codec in ("zstd", "gzip") else {"typesize": 1, "cname": "zstd", "clevel": 3, "shuffle": "shuffle", "blocksize": 0} if codec == "blosc" else {}}]
    first = {"name": "vlen-utf8"} if dtype == "string" else {"name": "bytes", "configuration": {"endian": "little"}}
    codecs = [first, *press]
    if inner:
        codecs = [{"name": "sharding_indexed", "configuration": {"chunk_shape": list(inner), "codecs": codecs, "index_codecs": [{"name": "bytes", "configuration": {"endian": "little"}}, {"name": "crc32c"}], "index_location": "end"}}]
    if isinstance(fill, float) and not math.isfinite(fill):
        fill = "NaN" if math.isnan(fill) else "Infinity" if fill > 0 else "-Infinity"
    return {
        "zarr_format": 3, "node_type": "array", "shape": list(shape), "data_type": dtype,
        "chunk_grid": {"name": "regular", "configuration": {"chunk_shape": list(chunk)}},
        "chunk_key_encoding": {"name": "default", "configuration": {"separator": "/"}},
        "fill_value": fill, "codecs": codecs, "dimension_names": list(names), "attributes": attributes,
    }


def encode_block(block: np.ndarray, dtype: str, codec: str | None) -> bytes:
    if dtype == "string":
        raw, width = encode_strings(block), 1
    else:
        kind = np.dtype(dtype)
        raw, width = np.ascontiguousarray(block).astype(kind.newbyteorder("<")).tobytes(), kind.itemsize
    return raw if codec in (None, "none") else compress(codec, raw, 3, width)


def shard_block(block: np.ndarray, dtype: str, codec: str | None, inner: tuple[int, ...], fill) -> bytes:
    """Inner chunks one after the other, then their index and its checksum."""
    counts = tuple(s // c for s, c in zip(block.shape, inner, strict=True))
    index = np.full((*counts, 2), (1 << 64) - 1, np.uint64)
    out, at = [], 0
    for k in np.ndindex(*counts):
        piece = block[tuple(slice(i * c, (i + 1) * c) for i, c in zip(k, inner, strict=True))]
        same = np.isnan(piece).all() if isinstance(fill, float) and math.isnan(fill) else (piece == fill).all()
        if same:
            continue
        data = encode_block(piece, dtype, codec)
        index[k] = (at, len(data))
        out.append(data)
        at += len(data)
    return b"".join(out) + compress("crc32c", index.astype("<u8").tobytes())


def put(root: str, key: str, data: bytes) -> None:
    """Write one object; a file appears under its name only when it is whole."""
    if "://" in root and not root.startswith("file:"):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        store.create_dir(f"{base}/{os.path.dirname(key)}", recursive=True)
        with store.open_output_stream(f"{base}/{key}") as f:
            f.write(data)
        return
    path = os.path.join(local_path(root), key)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(temporary, "wb") as f:
        f.write(data)
    os.replace(temporary, path)


def remove(root: str) -> None:
    if "://" in root and not root.startswith("file:"):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        store.delete_dir(base)
    else:
        shutil.rmtree(local_path(root), ignore_errors=True)


@dataclass
class Wrote(WriterCommitMessage):
    chunks: int = 0


@dataclass
class Layout:
    path: str
    shape: list[int]
    chunk: list[int]
    dims: list[str]
    value: str
    dtype: str
    fill: object
    codec: str
    inner: list[int] | None = None
    attributes: dict = field(default_factory=dict)


class ZarrSink(DataSource):
    """Use ``export_zarr``: it deals the rows out by chunk and passes the layout as an option."""

    @classmethod
    def name(cls) -> str:
        return "zarr"

    def schema(self) -> str:
        raise ValueError("the zarr format is a sink; read arrays with the cells format")

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ChunkWriter(Layout(**json.loads(self.options["layout"])))


class ChunkWriter(DataSourceArrowWriter):
    def __init__(self, layout: Layout):
        self.layout = layout
        if isinstance(layout.fill, str) and layout.dtype.startswith("float"):
            layout.fill = float(layout.fill)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        """Rows come sorted by chunk (__chunk) with their place in it (__at)."""
        n, current, places, values, last = 0, None, [], [], None
        for batch in iterator:
            if not batch.num_rows:
                continue
            names = batch.schema.names
            chunks, at = (batch.column(names.index(c)).to_numpy() for c in ("__chunk", "__at"))
            column = batch.column(names.index("__value"))
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(chunks)) + 1, [len(chunks)]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if chunks[a] != current:
                    n += self._flush(current, places, values)
                    current, places, values, last = int(chunks[a]), [], [], None
                own = at[a:b]
                if (last is not None and own[0] == last) or (np.diff(own) == 0).any():
                    raise ValueError("two rows have the same coordinates")
                last = own[-1]
                places.append(own)
                values.append(column.slice(a, b - a))
        return Wrote(n + self._flush(current, places, values))

    def _flush(self, chunk: int | None, places: list, values: list) -> int:
        if chunk is None:
            return 0
        x = self.layout
        at = np.concatenate(places)
        column = pa.chunked_array(values)
        there = ~column.is_null().to_numpy()
        if not there.any():
            return 0
        block = np.full(math.prod(x.chunk), x.fill, object if x.dtype == "string" else x.dtype)
        kept = column.filter(pa.array(there))
        got = np.array(kept.to_pylist(), object) if x.dtype in ("string", "uint64") else kept.to_numpy()
        block[at[there]] = got if x.dtype == "string" else got.astype(x.dtype)
        block = block.reshape(x.chunk)
        grid = np.unravel_index(chunk, [-(-s // c) for s, c in zip(x.shape, x.chunk, strict=True)])
        data = shard_block(block, x.dtype, x.codec, tuple(x.inner), x.fill) if x.inner else encode_block(block, x.dtype, x.codec)
        put(x.path, "/".join(["c", *map(str, map(int, grid))]), data)
        return 1

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        x = self.layout
        put(x.path, "zarr.json", json.dumps(array_json(x.shape, x.chunk, x.dtype, x.fill, x.dims, x.attributes, x.codec, x.inner)).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        remove(f"{self.layout.path}/c" if "://" in self.layout.path else os.path.join(local_path(self.layout.path), "c"))


def write_coords(path: str, name: str, values: np.ndarray) -> None:
    """A coordinate array, as one chunk below the array's own root."""
    kind = "float64" if values.dtype.kind == "f" else "int64"
    meta = array_json([values.size], [max(1, values.size)], kind, 0, [name], {}, "none")
    put(path, f"{name}/c/0", values.astype(np.dtype(kind).newbyteorder("<")).tobytes())
    put(path, f"{name}/zarr.json", json.dumps(meta).encode())


def exists(path: str) -> bool:
    if "://" in path and not path.startswith("file:"):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(path)
        return store.get_file_info(base).type != fs.FileType.NotFound
    return os.path.exists(local_path(path))


def choose_fill(df: DataFrame, value: str, dtype: str):
    """A value that the data doesn't have, so that all of it reads back; and whether there is none."""
    if dtype.startswith("float"):
        return math.nan, False
    if dtype in ("bool", "string"):
        return ("" if dtype == "string" else False), dtype == "bool"
    low, high = df.agg(F.min(value), F.max(value)).first()
    info = np.iinfo(dtype)
    if low is None or low > info.min:
        return int(info.min), False
    if high < info.max:
        return int(info.max), False
    return 0, True


def export_zarr(
    df: DataFrame,
    path: str,
    value: str = "value",
    dims: list[str] | None = None,
    chunks: str | dict | None = None,
    codec: str = "zstd",
    inner: dict[str, int] | None = None,
    coords: bool | None = None,
    descending: tuple[str, ...] = (),
    attributes: dict | None = None,
    mode: str = "error",
) -> dict:
    """Write rows of coordinates and a value as an array; returns its shape, chunk and type.

    All columns but the value are dimensions, in their order.  Without
    ``coords`` each must hold whole numbers from 0 to its number of different
    values less one; with it (the default where a dimension isn't integer) the
    sorted different values become coordinate arrays.  Null values are left
    out and read back as null.  ``inner`` sizes make shards of the chunks.
    """
    from .cells import register

    if value not in df.columns:
        raise ValueError(f"no column {value}")
    dims = dims or [c for c in df.columns if c != value]
    if exists(path):
        if mode != "overwrite":
            raise FileExistsError(f"{path} exists; overwrite it by mode='overwrite'")
        remove(path)
    dtype = dtype_of(df.schema[value])
    kinds = [df.schema[d].dataType for d in dims]
    whole = all(isinstance(k, T.IntegralType) for k in kinds)
    coords = not whole if coords is None else coords

    rows = df.select(*dims, F.col(value).alias("__value"))
    if df.where(" OR ".join(f"`{d}` IS NULL" for d in dims)).head(1):
        raise ValueError("a coordinate is null")
    if coords:
        axes = {}
        for d in dims:
            # The axes of an array are bounded, as its readers hold them in memory.
            whole = isinstance(df.schema[d].dataType, T.IntegralType)
            got = rows.select(F.col(d).cast("long" if whole else "double").alias("v")).distinct().limit(MAX_COORDS + 1).toArrow().column(0).to_numpy()
            if got.size > MAX_COORDS:
                raise ValueError(f"{d} has more than {MAX_COORDS} different coordinates")
            got = np.sort(got)
            axes[d] = got[::-1].copy() if d in descending else got
        spark = df.sparkSession
        for d in dims:
            index = spark.createDataFrame(pa.table({f"__c_{d}": axes[d], f"__i_{d}": np.arange(axes[d].size)}))
            place = F.col(d).cast("long" if axes[d].dtype.kind == "i" else "double")
            rows = rows.join(F.broadcast(index) if axes[d].size <= 100_000 else index, place == F.col(f"__c_{d}")).drop(f"__c_{d}")
        shape = [int(axes[d].size) for d in dims]
        at = [F.col(f"__i_{d}") for d in dims]
    else:
        counts = df.agg(*[F.count_distinct(d).alias(d) for d in dims]).first()
        shape = [int(counts[d]) for d in dims]
        at = [F.col(d).cast("long") for d in dims]
        checks = [F.bool_or((F.col(d) != F.floor(d)) | (F.col(d) < 0) | (F.col(d) >= n)) for d, n in zip(dims, shape, strict=True)]
        for d, n, bad in zip(dims, shape, df.agg(*checks).first() or [], strict=True):
            if bad:
                raise ValueError(f"a coordinate of {d} exceeds maximum bound {n - 1}, is negative or isn't whole")
    chunk = [min(c, max(1, n)) if not inner else c for c, n in zip(auto_chunks(shape, parse_chunks(chunks), dims), shape, strict=True)]
    inside = [int(inner.get(d, c)) for d, c in zip(dims, chunk, strict=True)] if inner else None
    if inside and any(c % i for c, i in zip(chunk, inside, strict=True)):
        raise ValueError("inner chunks must divide the chunks")
    fill, none = choose_fill(rows, "__value", dtype)
    extra = dict(attributes or {}) | ({"no_fill": True} if none else {})

    number, place = F.lit(0).cast("long"), F.lit(0).cast("long")
    for a, n, c in zip(at, shape, chunk, strict=True):
        number = number * F.lit(-(-n // c)) + F.floor(a / F.lit(c)).cast("long")
        place = place * F.lit(c) + F.pmod(a, F.lit(c))
    dealt = rows.select(number.alias("__chunk"), place.alias("__at"), "__value")
    total = math.prod(-(-n // c) for n, c in zip(shape, chunk, strict=True))
    tasks = min(max(1, total), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = dealt.repartition(tasks, "__chunk").sortWithinPartitions("__chunk", "__at")

    layout = Layout(path, shape, chunk, dims, value, dtype, repr(fill) if isinstance(fill, float) else fill, codec, inside, extra)
    if coords:
        for d in dims:
            write_coords(path, d, axes[d])
    register(df.sparkSession)
    dealt.write.format("zarr").option("layout", json.dumps(layout.__dict__)).mode("append").save()
    return {"shape": shape, "chunk": chunk, "dtype": dtype}
