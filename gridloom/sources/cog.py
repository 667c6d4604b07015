"""Cloud-optimised GeoTIFF: tiles of the first image as chunks."""

from __future__ import annotations

import math
import struct
import zlib
from dataclasses import dataclass

import numpy as np

from .arrays import ArrayInfo
from .stores import Store

# Fixed values of the format.
TYPE_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 16: 8, 17: 8, 18: 8}
TYPE_CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, SAMPLES, PLANAR, PREDICTOR = 256, 257, 258, 259, 277, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, FORMAT = 322, 323, 324, 325, 339
SCALE, TIEPOINT, MATRIX, GEOKEYS, NODATA = 33550, 33922, 34264, 34735, 42113
FORMATS = {1: "uint", 2: "int", 3: "float"}
HEAD = 16 << 10


@dataclass
class Tags:
    """The first directory of a file; long values are fetched where they stand."""

    store: Store
    key: str
    order: str
    big: bool
    entries: dict[int, tuple[int, int, bytes]]
    head: bytes

    def bytes_at(self, start: int, size: int) -> bytes:
        if start + size <= len(self.head):
            return self.head[start : start + size]
        return self.store.get(self.key, start, size) or b""

    def get(self, tag: int, default=None):
        """A list of numbers, or text; the default if the tag isn't there."""
        if tag not in self.entries:
            return default
        kind, count, raw = self.entries[tag]
        size = TYPE_SIZES[kind] * count
        if size > len(raw):
            at = struct.unpack(self.order + ("Q" if self.big else "I"), raw)[0]
            raw = self.bytes_at(at, size)
            if len(raw) < size:
                raise ValueError(f"{self.key}: the values of tag {tag} are cut off")
        raw = raw[:size]
        if kind in (2, 7):
            return raw.rstrip(b"\0").decode("ascii", "replace")
        return list(struct.unpack(f"{self.order}{count}{TYPE_CODES[kind]}", raw))

    def one(self, tag: int, default: int) -> int:
        got = self.get(tag)
        return got[0] if got else default


def read_tags(store: Store, key: str = "") -> Tags | None:
    head = store.get(key, 0, HEAD)
    if head is None:
        return None
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    magic = struct.unpack(order + "H", head[2:4])[0] if order else 0
    if magic not in (42, 43):
        raise ValueError(f"{key or 'file'}: not a TIFF")
    big = magic == 43
    at = struct.unpack(order + ("Q" if big else "I"), head[8:16] if big else head[4:8])[0]
    tags = Tags(store, key, order, big, {}, head)
    width, step = (8, 20) if big else (2, 12)
    n = struct.unpack(order + ("Q" if big else "H"), tags.bytes_at(at, width))[0]
    table = tags.bytes_at(at + width, n * step)
    for k in range(n):
        entry = table[k * step : (k + 1) * step]
        tag, kind = struct.unpack(order + "HH", entry[:4])
        count = struct.unpack(order + ("Q" if big else "I"), entry[4 : 12 if big else 8])[0]
        if kind in TYPE_SIZES:
            tags.entries[tag] = (kind, count, entry[12 if big else 8 :])
    return tags


@dataclass
class TileReader:
    store: Store
    key: str
    offsets: np.ndarray
    counts: np.ndarray
    across: int
    tile: tuple[int, int]
    bands: int
    stored: str
    deflated: bool

    def read(self, at: tuple[int, ...], part: tuple[slice, ...]) -> np.ndarray | None:
        y, x = at[-2:]
        k = y * self.across + x
        if k >= len(self.offsets) or not self.counts[k]:
            return None
        data = self.store.get(self.key, int(self.offsets[k]), int(self.counts[k]))
        if data is None:
            raise OSError(f"{self.key}: tile {k} can't be read")
        if self.deflated:
            data = zlib.decompress(data)
        a = np.frombuffer(data, self.stored, math.prod(self.tile) * self.bands).reshape(*self.tile, self.bands)
        a = a.transpose(2, 0, 1) if self.bands > 1 else a[:, :, 0]
        return a[part].astype(a.dtype.newbyteorder("="))


def _crs(tags: Tags) -> int | None:
    keys = tags.get(GEOKEYS) or []
    found = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    return next((found[k] for k in (3072, 2048) if found.get(k) and found[k] != 32767), None)


def _affine(tags: Tags) -> tuple[list, list] | tuple[None, None]:
    """Scale and translation of (y, x); coordinates are the pixels' centres."""
    if m := tags.get(MATRIX):
        sx, sy, x, y = m[0], m[5], m[3], m[7]
    elif (s := tags.get(SCALE)) and (t := tags.get(TIEPOINT)):
        sx, sy, x, y = s[0], -s[1], t[3] - t[0] * s[0], t[4] + t[1] * s[1]
    else:
        return None, None
    return [sy, sx], [y + sy / 2, x + sx / 2]


def open_cog(uri: str, store: Store, key: str = "") -> ArrayInfo | None:
    tags = read_tags(store, key)
    if tags is None:
        return None
    bands = tags.one(SAMPLES, 1)
    if bands > 1 and tags.one(PLANAR, 1) != 1:
        raise ValueError("bands in planes of their own aren't supported")
    compression = tags.one(COMPRESSION, 1)
    if compression not in (1, 8, 32946):
        raise ValueError(f"compression {compression} isn't supported")
    if tags.one(PREDICTOR, 1) != 1:
        raise ValueError("predictors aren't supported")
    width, height, tw, th = (tags.get(t) for t in (WIDTH, HEIGHT, TILE_WIDTH, TILE_HEIGHT))
    if not (tw and th):
        raise ValueError("the image isn't tiled")
    bits = tags.get(BITS) or [32]
    sample = (tags.get(FORMAT) or [1])[0]
    if len(set(bits)) > 1 or sample not in FORMATS or bits[0] not in (8, 16, 32, 64) or (sample == 3 and bits[0] < 32):
        raise ValueError(f"unsupported samples: format {sample}, {bits} bits")
    dtype = f"{FORMATS[sample]}{bits[0]}"
    epsg = _crs(tags)
    dims = ["lat", "lon"] if epsg == 4326 else ["y", "x"]
    scale, translation = _affine(tags)
    shape, chunk = [height[0], width[0]], [th[0], tw[0]]
    reader = TileReader(
        store, key, np.array(tags.get(TILE_OFFSETS), np.uint64), np.array(tags.get(TILE_COUNTS), np.uint64), -(-width[0] // tw[0]),
        (th[0], tw[0]), bands, np.dtype(dtype).newbyteorder(tags.order).str, compression != 1,
    )
    if bands > 1:
        dims, shape, chunk = ["band", *dims], [bands, *shape], [bands, *chunk]
        if scale:
            scale, translation = [None, *scale], [None, *translation]
    fill = None
    text = tags.get(NODATA)
    if isinstance(text, str) and text.strip():
        value = float(text)
        if dtype.startswith("float"):
            fill = np.dtype(dtype).type(value)
        elif math.isfinite(value):
            fill = np.dtype(dtype).type(int(value)) if np.iinfo(dtype).min <= value <= np.iinfo(dtype).max else None
    return ArrayInfo(uri, shape, chunk, dtype, dims, reader, {}, scale, translation, fill, f"EPSG:{epsg}" if epsg else None).validate()


def write_cog(path: str, image: np.ndarray, scale: tuple[float, float], origin: tuple[float, float], epsg: int, tile: int = 16, deflate: bool = False, nodata: float | None = None, big: bool = False) -> None:
    """A tiled GeoTIFF of (y, x) or (band, y, x); ``scale`` (x, y) and ``origin`` (x, y) are those of its corner."""
    image = image if image.ndim == 3 else image[None]
    bands, height, width = image.shape
    across, down = -(-width // tile), -(-height // tile)
    padded = np.zeros((bands, down * tile, across * tile), image.dtype)
    padded[:, :height, :width] = image
    tiles = []
    for y in range(down):
        for x in range(across):
            raw = np.ascontiguousarray(padded[:, y * tile : (y + 1) * tile, x * tile : (x + 1) * tile].transpose(1, 2, 0)).astype(image.dtype.newbyteorder("<")).tobytes()
            tiles.append(zlib.compress(raw) if deflate else raw)
    size = image.dtype.itemsize * 8
    kind = {"u": 1, "i": 2, "f": 3}[image.dtype.kind]
    model = 2 if epsg == 4326 else 1
    keys = [1, 1, 0, 3, 1024, 0, 1, model, 1025, 0, 1, 1, 2048 if model == 2 else 3072, 0, 1, epsg]
    word = 16 if big else 4
    fields = [
        (WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [size] * bands), (COMPRESSION, 3, [8 if deflate else 1]), (262, 3, [1]),
        (SAMPLES, 3, [bands]), (PLANAR, 3, [1]), (TILE_WIDTH, 4, [tile]), (TILE_HEIGHT, 4, [tile]),
        (TILE_OFFSETS, word, [0] * len(tiles)), (TILE_COUNTS, word, [len(t) for t in tiles]), (FORMAT, 3, [kind] * bands),
        (SCALE, 12, [scale[0], scale[1], 0.0]), (TIEPOINT, 12, [0.0, 0.0, 0.0, origin[0], origin[1], 0.0]), (GEOKEYS, 3, keys),
    ]
    if nodata is not None:
        fields.append((NODATA, 2, f"{nodata:g}\0"))
    head, step, slot = (16, 20, 8) if big else (8, 12, 4)
    after = head + (8 if big else 2) + step * len(fields) + slot
    packed = []
    for tag, code, values in fields:
        raw = values.encode() if isinstance(values, str) else struct.pack(f"<{len(values)}{TYPE_CODES[code]}", *values)
        packed.append([tag, code, len(values), raw, None])
    for f in packed:
        if len(f[3]) > slot:
            f[4], after = after, after + len(f[3])
    at, offsets = after, []
    for t in tiles:
        offsets.append(at)
        at += len(t)
    for f in packed:
        if f[0] == TILE_OFFSETS:
            f[3] = struct.pack(f"<{len(offsets)}{TYPE_CODES[word]}", *offsets)
    with open(path, "wb") as out:
        out.write(b"II" + (struct.pack("<HHHQ", 43, 8, 0, head) if big else struct.pack("<HI", 42, head)))
        out.write(struct.pack("<Q" if big else "<H", len(packed)))
        for tag, code, n, raw, place in packed:
            out.write(struct.pack("<HHQ" if big else "<HHI", tag, code, n))
            out.write(raw.ljust(slot, b"\0") if place is None else struct.pack("<Q" if big else "<I", place))
        out.write(b"\0" * slot)
        for f in packed:
            if f[4] is not None:
                out.write(f[3])
        out.write(b"".join(tiles))
