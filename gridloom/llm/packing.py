"""Best-two-fit packing of token pieces into sequences of a fixed capacity.

Pieces only differ by length, and there are at most ``capacity`` lengths.  The
packing is therefore planned on the histogram of lengths: a plan is a list of
bin patterns with multiplicities, whose size depends on the capacity alone.
Pieces then find their place by their rank within their length, which comes
from distributed prefix sums.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, settle, slices, table
from .tokens import Encoder, vocabulary_path


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Best-two-fit on a histogram of lengths: (number of bins, lengths in each).

    The replacement uses up short lengths early.  Where that takes more bins in
    the end than filling greedily alone, the bins are as they were without it.
    """
    plans = [filled(histogram, capacity, replace) for replace in (True, False)]
    return min(plans, key=lambda patterns: sum(times for times, _ in patterns))


def filled(histogram: dict[int, int], capacity: int, replace: bool) -> list[tuple[int, dict[int, int]]]:
    """Bin patterns and how often each is used.

    A bin opens with the longest length left and takes, again and again, the
    longest that fits.  Then its smallest member is taken out and, if two
    lengths left fill the wider gap more tightly, they take its place.  As long
    as no length runs out, the next bin would be the same one, so the pattern
    is used as often as the histogram allows: a pattern ends only when some
    length drops below its use in it, so there are few.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    out: list[tuple[int, dict[int, int]]] = []
    while (there := np.flatnonzero(left)).size:
        used: Counter = Counter()
        gap = capacity
        fit = there
        while fit.size:
            length = int(fit[-1])
            take = min(int(left[length]) - used[length], gap // length)
            used[length] += take
            gap -= take * length
            fit = fit[: np.searchsorted(fit, min(gap, length - 1), "right")]
        if replace and gap and sum(used.values()) > 1:
            two(used, left, gap, there)
        times = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * times
        out.append((times, dict(used)))
    return out


def two(used: Counter, left: np.ndarray, gap: int, there: np.ndarray) -> None:
    """Replace the smallest member by the two that fit its gap most tightly, if any do better."""
    small = min(used)
    room = gap + small
    free = left[there] - np.array([used[int(x)] for x in there])
    lengths, free = there[free > 0], free[free > 0]
    keep = lengths < room
    lengths, free = lengths[keep], free[keep]
    if not lengths.size:
        return
    # For each first length the longest second one, no longer than the first.
    second = np.minimum(room - lengths, lengths)
    at = np.searchsorted(lengths, second, "right") - 1
    same = (at >= 0) & (at == np.arange(lengths.size)) & (free < 2)
    at = np.where(same, at - 1, at)
    total = np.where(at >= 0, lengths + lengths[np.maximum(at, 0)], 0)
    best = int(np.argmax(total))
    if total[best] > small:
        used[small] -= 1
        if not used[small]:
            del used[small]
        used[int(lengths[best])] += 1
        used[int(lengths[at[best]])] += 1


class Places:
    """Where the r-th piece of each length goes: sequence and offset."""

    def __init__(self, patterns: list[tuple[int, dict[int, int]]], capacity: int):
        self.capacity = capacity
        parts: dict[int, list[tuple[int, int, int, int]]] = {}
        done: Counter = Counter()
        base = 0
        for times, used in patterns:
            offset = 0
            for length, n in sorted(used.items(), reverse=True):
                parts.setdefault(length, []).append((done[length], n, base, offset))
                done[length] += n * times
                offset += n * length
            base += times
        self.sequences = base
        self.parts = {length: np.array(rows, np.int64).T for length, rows in parts.items()}

    def __call__(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(lengths.size, np.int64), np.empty(lengths.size, np.int64)
        order = np.argsort(lengths, kind="stable")
        for chunk in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
            if not chunk.size:
                continue
            length = int(lengths[chunk[0]])
            first, n, base, start = self.parts[length]
            at = np.searchsorted(first, ranks[chunk], "right") - 1
            r = ranks[chunk] - first[at]
            sequence[chunk] = base[at] + r // n[at]
            offset[chunk] = start[at] + r % n[at] * length
        return sequence, offset


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of each text with their number (lrank) among those of that length in the task (block)."""
    schema = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "block", "lrank")]
    )
    end = np.array([end_id], "<u4").tobytes()

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, block, counts = Encoder.load(path), TaskContext.get().partitionId(), Counter()
        step = 4 * capacity
        for batch in slices(batches, "text"):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                ids = b"".join(encoder.packed(encoder.words(text or b""))) + end
                for k, at in enumerate(range(0, len(ids), step)):
                    piece = ids[at : at + step]
                    n = len(piece) // 4
                    rows.append((doc_id, k, at // 4, n, zlib.crc32(piece), block, counts[n]))
                    counts[n] += 1
            yield table(schema, list(zip(*rows, strict=True)))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        part, "doc_id long, piece long, start long, length long, ids_crc32 long, block long, lrank long"
    )


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    capacity: int = 2048,
    end_id: int = 0,
) -> DataFrame:
    """Pack all texts into few sequences of at most ``capacity`` tokens.

    A text's ids are the library's, then ``end_id``; only longer ones are cut,
    into pieces of ``capacity`` ids, the last of which may be shorter.  Returns
    a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset.

    A null or empty text is the one id ``end_id``; a very long one becomes as
    many pieces as it needs.  A null id stays null, repeated rows are packed
    each, extra columns are left out, whatever their names, an empty table
    gives an empty result.
    """
    path = path or vocabulary_path()
    docs = pick(df, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    pieces = settle(token_pieces(docs, path, capacity, end_id))

    # Counted twice from the settled pieces: settling the counts, too, would write two files a shuffle partition,
    # and without its native library Hadoop starts a process (chmod) for each.
    # At most one row for each length: bounded by the capacity.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    sizes = pieces.groupBy("block", "length").agg(F.count("*").alias("n"))
    places = df.sparkSession.sparkContext.broadcast(Places(plan(histogram, capacity), capacity))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    schema = pa.schema([(c, pa.int64()) for c in names])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            sequence, offset = places.value(got["length"].to_numpy(), got["rank"].to_numpy())
            yield table(schema, [*(got[c] for c in names[:5]), pa.array(sequence), pa.array(offset)])

    return (
        pieces.join(bases, ["block", "length"])
        .select(*names[:5], (F.col("base") + F.col("lrank")).alias("rank"))
        .mapInArrow(place, ", ".join(f"{c} long" for c in names))
    )
