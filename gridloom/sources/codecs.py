"""Chunk codecs: what turns stored bytes into arrays and back."""

from __future__ import annotations

import gzip
import struct
import zlib
from functools import cache, lru_cache

import numpy as np


@cache
def _crc_table() -> np.ndarray:
    """Castagnoli's polynomial, bits reversed."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0x82F63B78), t >> 1).astype(np.uint32)
    return t


def _crc_step(state: np.ndarray, column: np.ndarray) -> np.ndarray:
    return _crc_table()[(state ^ column) & 0xFF] ^ (state >> 8)


@lru_cache(maxsize=64)
def _shift_tables(n: int) -> np.ndarray:
    """What n zero bytes do to each byte of a state: the checksum is linear."""
    lanes = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    zero = np.zeros(lanes.size, np.uint32)
    for _ in range(n):
        lanes = _crc_step(lanes, zero)
    return lanes.reshape(4, 256)


def crc32c(data: bytes) -> int:
    """CRC-32C.  Equal blocks are run side by side, then joined in order."""
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    width = max(1, int(raw.size**0.5))
    blocks = raw.size // width
    state = np.uint32(0xFFFFFFFF)
    if blocks > 1:
        grid = raw[: blocks * width].reshape(blocks, width)
        each = np.zeros(blocks, np.uint32)
        for k in range(width):
            each = _crc_step(each, grid[:, k])
        tables = _shift_tables(width)
        for part in each:
            state = tables[0][state & 255] ^ tables[1][(state >> 8) & 255] ^ tables[2][(state >> 16) & 255] ^ tables[3][state >> 24] ^ part
        raw = raw[blocks * width :]
    for b in raw:
        state = _crc_step(state, b)
    return int(state) ^ 0xFFFFFFFF


def _lz4(data: bytes, size: int) -> bytes:
    import pyarrow as pa

    return pa.Codec("lz4_raw").decompress(data, size, asbytes=True)


def _zstd(data: bytes, size: int = 0) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj().decompress(data)


def _snappy(data: bytes, size: int) -> bytes:
    import pyarrow as pa

    return pa.Codec("snappy").decompress(data, size, asbytes=True)


def _blosclz(data: bytes, size: int) -> bytes:
    """Literal runs and back references, in the layout of the fastest level of its family."""
    out = bytearray()
    i, n = 0, len(data)
    control = data[0] & 31
    i = 1
    while True:
        if control >= 32:
            length, distance = (control >> 5) - 1, (control & 31) << 8
            if length == 6:
                while True:
                    length += data[i]
                    i += 1
                    if data[i - 1] != 255:
                        break
            distance += data[i]
            i += 1
            if distance == 0x1FFF:  # a far match has two bytes of its own
                distance = 0x1FFF + (data[i] << 8) + data[i + 1]
                i += 2
            at = len(out) - distance - 1
            for k in range(length + 3):
                out.append(out[at + k])
        else:
            out += data[i : i + control + 1]
            i += control + 1
        if i >= n or len(out) >= size:
            break
        control = data[i]
        i += 1
    return bytes(out[:size])


_INNER = {0: _blosclz, 1: _lz4, 2: _snappy, 3: lambda d, n: zlib.decompress(d), 4: _zstd}


def _unshuffle_bytes(block: bytes, width: int) -> bytes:
    n = len(block) // width * width
    a = np.frombuffer(block, np.uint8, n).reshape(width, -1)
    return a.T.tobytes() + block[n:]


def _unshuffle_bits(block: bytes, width: int) -> bytes:
    count = len(block) // width // 8 * 8  # whole groups of eight elements
    n = count * width
    bits = np.unpackbits(np.frombuffer(block, np.uint8, n), bitorder="little").reshape(width * 8, count)
    return np.packbits(bits.T, axis=1, bitorder="little").tobytes() + block[n:]


def blosc_decode(data: bytes) -> bytes:
    """A Blosc 1 frame: header, block starts, and blocks of one or more streams."""
    _, _, flags, width = data[:4]
    size, block, _ = struct.unpack("<III", data[4:16])
    if flags & 2:  # stored as it is
        return data[16 : 16 + size]
    shuffle, bits, together, inner = flags & 1, flags & 4, flags & 16, _INNER.get(flags >> 5)
    if inner is None:
        raise ValueError(f"Blosc: no inner codec {flags >> 5}")
    blocks = -(-size // block) if size else 0
    starts = struct.unpack(f"<{blocks}I", data[16 : 16 + 4 * blocks])
    out = []
    for k, at in enumerate(starts):
        this = min(block, size - k * block)
        streams = 1 if together or this < block or this % width else width
        parts = []
        for _ in range(streams):
            (n,) = struct.unpack_from("<i", data, at)
            at += 4
            piece = data[at : at + n]
            at += n
            parts.append(piece if n == this // streams else inner(piece, this // streams))
        joined = b"".join(parts)
        if shuffle and width > 1:
            joined = _unshuffle_bytes(joined, width)
        elif bits:
            joined = _unshuffle_bits(joined, width)
        out.append(joined)
    return b"".join(out)


def blosc_encode(data: bytes, width: int = 1, shuffle: bool = True, block: int = 1 << 16) -> bytes:
    """A frame with Zstandard blocks of a single stream each."""
    import zstandard

    press = zstandard.ZstdCompressor(level=3)
    block = max(width, block // width * width)
    parts = []
    for at in range(0, len(data), block):
        raw = data[at : at + block]
        if shuffle and width > 1:
            n = len(raw) // width * width
            raw = np.frombuffer(raw, np.uint8, n).reshape(-1, width).T.tobytes() + raw[n:]
        packed = press.compress(raw)
        parts.append(packed if len(packed) < len(raw) else raw)
    starts, at = [], 16 + 4 * len(parts)
    for p in parts:
        starts.append(at)
        at += 4 + len(p)
    flags = (1 if shuffle and width > 1 else 0) | 16 | (4 << 5)
    head = bytes([2, 1, flags, width]) + struct.pack("<III", len(data), block, at)
    return head + struct.pack(f"<{len(starts)}I", *starts) + b"".join(struct.pack("<i", len(p)) + p for p in parts)


def decompress(name: str, data: bytes) -> bytes:
    if name == "gzip":
        return gzip.decompress(data)
    if name == "zlib":
        return zlib.decompress(data)
    if name == "zstd":
        return _zstd(data)
    if name == "blosc":
        return blosc_decode(data)
    if name == "lz4":  # a size before the block
        return _lz4(data[4:], struct.unpack("<I", data[:4])[0])
    if name == "crc32c":
        body, want = data[:-4], struct.unpack("<I", data[-4:])[0]
        if crc32c(body) != want:
            raise ValueError("crc32c: the checksum doesn't match")
        return body
    raise ValueError(f"no codec {name!r}")


def compress(name: str, data: bytes, level: int = 5, width: int = 1) -> bytes:
    if name == "gzip":
        return gzip.compress(data, level, mtime=0)
    if name == "zlib":
        return zlib.compress(data, level)
    if name == "zstd":
        import zstandard

        return zstandard.ZstdCompressor(level=level).compress(data)
    if name == "blosc":
        return blosc_encode(data, width)
    if name == "crc32c":
        return data + struct.pack("<I", crc32c(data))
    raise ValueError(f"no codec {name!r}")


def decode_strings(data: bytes) -> np.ndarray:
    """Variable-length UTF-8: a count, then each string after its length."""
    (n,) = struct.unpack_from("<I", data)
    out, at = np.empty(n, object), 4
    for k in range(n):
        (size,) = struct.unpack_from("<I", data, at)
        out[k] = data[at + 4 : at + 4 + size].decode()
        at += 4 + size
    return out


def encode_strings(values: np.ndarray) -> bytes:
    raw = [str(v).encode() for v in values.ravel()]
    return struct.pack("<I", len(raw)) + b"".join(struct.pack("<I", len(r)) + r for r in raw)
