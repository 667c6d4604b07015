"""SimHash fingerprints and a search within a Hamming radius.

A text's terms are its distinct three-word shingles (A-Z in lower case); each
votes on every bit with its count.  The share of equal bits
estimates the angle between two texts, so likeness is that angle's cosine,
at least 0.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hold, look_up, partitions, pick, settle, slices, table

BITS = 128
WORDS = 3
#: Bits within which another fingerprint is near.
RADIUS = 3
#: Classes that are broadcast to the rows at most; more are joined by a shuffle.
FEW = 100_000
#: Words whose hashes a worker keeps: about 20 MB.
HASHED = 100_000


class WordHashes(dict):
    """64-bit hashes of words, kept for a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) > HASHED:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h


HASHES = WordHashes()


def word_hashes(text: bytes) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-word shingles; fewer words are one shingle as a whole."""
    if not words.size:
        return words
    k = min(k, words.size)
    n = words.size - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = mixed(out + words[i : i + n] + np.uint64(i + 1))
    return out


def simhash(text: bytes, bits: int = BITS, k: int = WORDS) -> bytes:
    """The fingerprint; all zero for a text without words."""
    terms, counts = np.unique(shingles(word_hashes(text), k), return_counts=True)
    votes = np.zeros(bits, np.float32)
    weights = counts.astype(np.float32)
    for a in range(0, terms.size, 4096):
        h = terms[a : a + 4096]
        lanes = np.stack([mixed(h + np.uint64(0x9E3779B97F4A7C15 * (i + 1) % 2**64)) for i in range(bits // 64)], axis=1)
        planes = np.unpackbits(lanes.view(np.uint8), axis=1).astype(np.float32)
        votes += weights[a : a + 4096] @ planes
    return np.packbits(2 * votes > weights.sum()).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    if a == b:
        return 1.0
    apart = (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / (8 * len(a))
    return max(0.0, math.cos(math.pi * apart))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, k: int = WORDS) -> DataFrame:
    """doc_id and the SimHash of each whole text as a hex string; a null text counts as empty."""
    docs = pick(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            yield table(schema, [batch.column(0), [simhash(t or b"", bits, k).hex() for t in texts]])

    return docs.mapInArrow(part, "doc_id long, fingerprint string")


class Tables:
    """Permuted block tables: which fingerprints to compare to find all within a Hamming radius.

    The bits are cut into radius + agree blocks, so two fingerprints within the
    radius agree on ``agree`` whole blocks at least.  There is a table for each
    choice of so many blocks; its buckets hold what agrees on them.
    """

    def __init__(self, radius: int, bits: int, agree: int):
        self.radius, self.bits = radius, bits
        n = radius + agree
        self.edges = [round(i * bits / n) for i in range(n + 1)]
        self.choices = np.array(list(combinations(range(n), agree)))

    def blocks(self, words: np.ndarray) -> np.ndarray:
        """The blocks' values, a column for each, of rows of 64-bit words."""
        out = np.zeros((len(words), len(self.edges) - 1), np.uint64)
        for k, (start, stop) in enumerate(zip(self.edges[:-1], self.edges[1:], strict=True)):
            for w in range(start // 64, (stop - 1) // 64 + 1):
                low, high = max(start, 64 * w), min(stop, 64 * w + 64)
                width = high - low
                mask = np.uint64((1 << width) - 1)
                part = (words[:, w] >> np.uint64(64 * w + 64 - high)) & mask
                out[:, k] = (out[:, k] << np.uint64(width) if width < 64 else 0) | part
        return out

    def keys(self, words: np.ndarray) -> np.ndarray:
        """A hash of the chosen blocks, a column for each table."""
        blocks = self.blocks(words)
        keys = np.zeros((len(words), len(self.choices)), np.uint64)
        for t, choice in enumerate(self.choices):
            keys[:, t] = t + 1
            for k in choice:
                keys[:, t] = mixed(keys[:, t] * np.uint64(0x9E3779B97F4A7C15) + blocks[:, k])
        return keys

    def near(self, t: int, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places in a and in b, and distances, of different ones within the radius; each pair in one table only."""
        for start in range(0, len(a), 256):
            some = a[start : start + 256]
            apart = sum(np.bitwise_count(some[:, None, w] ^ b[None, :, w]).astype(np.uint8) for w in range(a.shape[1]))
            i, j = np.nonzero((apart <= self.radius) & (apart > 0))
            if not i.size:
                continue
            # Of all tables that a pair shares, that of the first blocks on which it agrees reports it.
            agrees = self.blocks(some[i] ^ b[j]) == 0
            first = (agrees & (np.cumsum(agrees, axis=1) <= self.choices.shape[1])).nonzero()[1].reshape(-1, self.choices.shape[1])
            mine = (first == self.choices[t]).all(axis=1)
            yield i[mine] + start, j[mine], apart[i[mine], j[mine]]


#: Fingerprints of a bucket that a task compares with as many others at a time.
COMPARED = 4096


def words_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(column.to_pylist())), ">u8").astype(np.uint64).reshape(len(column), -1)


def compared(classes: DataFrame, tables: Tables, found, schema: pa.Schema, ddl: str) -> DataFrame:
    """``found(t, asked, held)`` of blocks of each bucket, over (fingerprint, n), a row for each fingerprint.

    A bucket's members are cut into parts, and each pair of parts is a group of
    its own, so a task never holds more than two parts.
    """
    width = tables.bits // 64
    entries = pa.schema([("t", pa.int32()), ("key", pa.int64()), *[(f"w{i}", pa.int64()) for i in range(width)], ("n", pa.int64())])

    def spread_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("fingerprints", HASHES.clear)
        for batch in batches:
            if not batch.num_rows:
                continue
            words, n = words_of(batch.column(0)), batch.column(1).to_numpy()
            keys, m = tables.keys(words), len(tables.choices)
            yield table(entries, [np.tile(np.arange(m, dtype=np.int32), len(words)), keys.ravel().view(np.int64), *[np.repeat(words[:, i], m).view(np.int64) for i in range(width)], np.repeat(n, m)])

    names = [f"w{i}" for i in range(width)]
    rows = classes.select("fingerprint", "n").mapInArrow(spread_out, "t int, key long, " + ", ".join(f"{w} long" for w in names) + ", n long")
    rows = settle(rows)
    sizes = settle(rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    sized = sizes.withColumn("parts", F.ceil(F.col("n") / COMPARED).cast("int"))
    members = look_up(rows.withColumnRenamed("n", "weight"), sized, ["t", "key"], total)
    part = F.pmod(F.xxhash64(*names), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    held = members.select("t", "key", every.alias("row"), part.alias("col"), F.lit(0).alias("role"), *names, "weight")
    asked = members.select("t", "key", part.alias("row"), every.alias("col"), F.lit(1).alias("role"), *names, "weight")
    place = ["t", "key", "row", "col"]
    dealt = held.unionByName(asked).repartition(*place).sortWithinPartitions(*place, "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("fingerprints", HASHES.clear)
        here, parts = None, ([], [])

        def finish():
            if here is not None and parts[0] and parts[1]:
                block, questions = (np.concatenate(p) for p in parts)
                yield from found(int(here[0]), questions, block)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(5)])
            values = np.stack([batch.column(5 + i).to_numpy() for i in range(width + 1)], axis=1).view(np.uint64)
            cuts = np.flatnonzero(np.append(True, (np.diff(keys, axis=1) != 0).any(axis=0)))
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                if here is None or (keys[:4, a] != here).any():
                    yield from finish()
                    here, parts = keys[:4, a], ([], [])
                parts[keys[4, a]].append(values[a:b])
        yield from finish()

    return dealt.mapInArrow(compare, ddl)


def near_pairs(prints: DataFrame, radius: int = 6, bits: int = BITS, agree: int = 2) -> DataFrame:
    """All pairs of different fingerprints at most ``radius`` bits apart: a, b, distance.

    ``prints`` has a hex column fingerprint; null ones are left out.  Equal
    ones are one class, so copies aren't expanded; membership is the input
    itself.  Only pairs within the radius become rows.
    """
    tables = Tables(radius, bits, agree)
    schema = pa.schema([("a", pa.string()), ("b", pa.string()), ("distance", pa.int32())])

    def found(t: int, asked: np.ndarray, held: np.ndarray) -> Iterator[pa.RecordBatch]:
        text = lambda rows: [r.astype(">u8").tobytes().hex() for r in rows[:, :-1]]
        for i, j, apart in tables.near(t, asked[:, :-1], held[:, :-1]):
            a, b = text(asked[i]), text(held[j])
            once = [k for k in range(len(a)) if a[k] < b[k]]
            if once:
                yield table(schema, [[a[k] for k in once], [b[k] for k in once], apart[once]])

    distinct = prints.where("fingerprint IS NOT NULL").groupBy("fingerprint").agg(F.count("*").alias("n"))
    return compared(distinct, tables, found, schema, "a string, b string, distance int")


def near_counts(classes: DataFrame, radius: int, bits: int = BITS, agree: int = 1) -> DataFrame:
    """fingerprint and n_near, the rows of other fingerprints within the radius, of those that have any; of (fingerprint, n)."""
    tables = Tables(radius, bits, agree)
    schema = pa.schema([("fingerprint", pa.string()), ("n_near", pa.int64())])

    def found(t: int, asked: np.ndarray, held: np.ndarray) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(asked), np.int64)
        for i, j, _ in tables.near(t, asked[:, :-1], held[:, :-1]):
            np.add.at(total, i, held[j, -1].view(np.int64))
        some = np.flatnonzero(total)
        if some.size:
            yield table(schema, [[r.astype(">u8").tobytes().hex() for r in asked[some, :-1]], total[some]])

    parts = compared(classes, tables, found, schema, "fingerprint string, n_near long")
    return parts.groupBy("fingerprint").agg(F.sum("n_near").alias("n_near"))


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
SCHEMA = pa.schema(
    [(c, pa.int64()) for c in NAMES[:2]] + [(c, pa.string()) for c in NAMES[2:5]] + [(c, pa.float64()) for c in NAMES[5:]]
)
DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


class _Doc:
    def __init__(self, doc_id, text):
        self.doc_id, self.text = doc_id, text or ""
        self.print = simhash(self.text.encode("utf-8", "surrogatepass"))

    def row(self, following: _Doc) -> tuple:
        n = len(self.text)
        edited = (self.text[: n - n // 4] + following.text[: n // 4]).encode("utf-8", "surrogatepass")
        p = simhash(edited)
        sha = hashlib.sha256(edited).hexdigest()
        return (self.doc_id, n, sha, self.print.hex(), p.hex(), likeness(self.print, p), likeness(self.print, following.print))


def edit_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """Fingerprints of each text, of an edited text, and how alike they are.

    The edited text has its last quarter (code points, rounded down) replaced
    by as many from the start of the next document by id; the first follows
    the last.  Documents are sorted over range partitions, so the next one is
    the next row; only the rows at the partitions' ends meet by a join.

    The search within ``radius`` bits adds n_equal and n_near, how many other
    documents have the same fingerprint and one that is near, and class_id,
    the least id with the same fingerprint.  All are found, none are listed.

    Null ids come last, rows of equal id are ordered by a hash of their text,
    a null or empty text has the fingerprint of no words, a very long one is
    taken whole, repeated rows each give a row, a single row follows itself,
    extra columns are left out, an empty table gives an empty result.
    """
    docs = pick(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keys = [F.col("doc_id").asc_nulls_last(), F.col("tie"), F.col("row")]
    docs = docs.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    docs = docs.repartitionByRange(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    ends = pa.schema([*SCHEMA, ("part", pa.int32()), ("kind", pa.string()), ("text", pa.string())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("fingerprints", HASHES.clear)
        part, last = TaskContext.get().partitionId(), None
        for batch in slices(batches, "text"):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc = _Doc(doc_id, text)
                if last is None:
                    rows.append((doc_id, *[None] * 6, part, "first", doc.text))
                else:
                    rows.append((*last.row(doc), part, "whole", None))
                last = doc
            yield table(ends, list(zip(*rows, strict=True)))
        if last is not None:
            yield table(ends, [[x] for x in (last.doc_id, *[None] * 6, part, "last", last.text)])

    rows = settle(docs.mapInArrow(stream, f"{DDL}, part int, kind string, text string"))
    # A row for each partition that has any: their number, not the data's.
    first = rows.where("kind = 'first'")
    order = Window.partitionBy(F.lit(0)).orderBy("part")
    follows = first.select("part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("next_part"))
    last = rows.where("kind = 'last'").select("doc_id", "text", "part")
    pairs = last.join(follows, "part").join(first.select(F.col("part").alias("next_part"), F.col("text").alias("next_text")), "next_part")

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            triples = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            yield table(SCHEMA, list(zip(*[_Doc(i, t).row(_Doc(None, n)) for i, t, n in triples], strict=True)))

    stitched = pairs.select("doc_id", "text", "next_text").mapInArrow(stitch, DDL)
    return with_near(rows.where("kind = 'whole'").select(*NAMES).unionByName(settle(stitched)), radius)


def with_near(rows: DataFrame, radius: int) -> DataFrame:
    """Adds class_id, n_equal and n_near to rows of doc_id and fingerprint."""
    total = rows.count()
    classes = settle(rows.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("doc_id").alias("class_id")))
    near = near_counts(classes, radius)
    # What is alone keeps its defaults, so only the others are looked up.
    found = classes.join(near, "fingerprint", "left").where("n > 1 OR n_near > 0")
    found = settle(found.select("fingerprint", "n", F.col("n").alias("size"), F.col("class_id"), F.coalesce("n_near", F.lit(0)).alias("n_near")))
    defaults = [F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_equal"), F.lit(0).cast("long").alias("n_near")]
    values = [F.col("class_id"), (F.col("size") - 1).alias("n_equal"), F.col("n_near")]
    if found.count() <= FEW:
        joined = rows.join(F.broadcast(found.drop("n")), "fingerprint", "left")
        mine = F.col("size").isNotNull()
        return joined.select(*NAMES, F.when(mine, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.coalesce(F.col("size") - 1, F.lit(0)).alias("n_equal"), F.coalesce("n_near", F.lit(0)).alias("n_near"))
    alone = rows.join(found.select("fingerprint"), "fingerprint", "left_anti").select(*NAMES, *defaults)
    return look_up(rows, found, ["fingerprint"], total).select(*NAMES, *values).unionByName(alone)
