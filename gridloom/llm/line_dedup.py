"""Repeated runs of lines, found by prefix doubling over line-ID sequences.

Each document is a sequence of line ids (lines without words are left out of
it).  Prefix doubling names the runs of 1, 2, 4 ... lines that start at each
position: two runs of equal length have the same name if and only if they are
equal.  A name is the first position, in document order, where its run stands;
it takes the place of the sorted rank, and suffixes with a common prefix are
the same intervals under either.  Positions whose run occurs once drop out, so
each round only carries what repeats.

An interval of suffixes that share a prefix of at least ``min_words`` words is
a repeated run; all but its first position are later copies.  Every maximal
repeated run is the union of the shortest such runs that start or end at its
lines, so the doubling stops at the longest of those, and deleting the lines of
all later copies deletes the maximal runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, beside, hold, let, look_up, partitions, pick, restored, settle_round, slices, table, tidy

MIN_WORDS = 50
#: Deletions of up to so many documents and lines are broadcast to the texts; more are joined by a shuffle.
FEW_ROWS, FEW_LINES = 100_000, 1_000_000


def shortest_runs(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line the length of the shortest run of ``least`` words that starts, or ends, there; 0 if none."""
    n = words.size
    sums = np.concatenate([[0], np.cumsum(words)])
    ends = np.searchsorted(sums, sums[:-1] + least)
    from_here = np.where(ends <= n, ends - np.arange(n), 0)
    begins = np.searchsorted(sums, sums[1:] - least, "right") - 1
    to_here = np.where(begins >= 0, np.arange(1, n + 1) - begins, 0)
    return from_here, to_here


NAMES = ["doc", "tie", "i", "line", "h1", "h2", "ahead", "back"]
LONGS = ("doc", "tie", "h1", "h2", "pos")


def ddl(names: list[str]) -> str:
    return ", ".join(f"{c} {'long' if c in LONGS else 'int'}" for c in names)


def fields(names: list[str]) -> pa.Schema:
    return pa.schema([(c, pa.int64() if c in LONGS else pa.int32()) for c in names])


def keyed(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds doc and tie, by which rows of equal id and text are one document."""
    return df.withColumn("doc", F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))).withColumn("tie", F.xxhash64(text))


def line_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """A row per line with words, of (doc, tie, text).

    i counts such lines, line all lines of the text; ``ahead`` and ``back`` are
    the lengths of the shortest runs of enough words that start and end here.
    """
    schema = fields(NAMES)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("lines")
        for batch in slices(batches, "text"):
            cols: list[list] = [[] for _ in NAMES]
            for doc, tie, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                raws = [x.encode("utf-8", "surrogatepass") for x in (text or "").split("\n")]
                lines = [(k, raw, n) for k, raw in enumerate(raws) if (n := len(raw.split()))]
                if not lines:
                    continue
                at, kept, words = zip(*lines, strict=True)
                ahead, back = shortest_runs(np.array(words), min_words)
                hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, kept)), np.int64).reshape(len(kept), 2)
                values = ([doc] * len(at), [tie] * len(at), range(len(at)), at, hashes[:, 0], hashes[:, 1], ahead, back)
                for column, more in zip(cols, values, strict=True):
                    column.extend(more)
            if cols[0]:
                yield table(schema, cols)

    return docs.select("doc", "tie", "text").mapInArrow(part, ddl(NAMES))


def numbered(lines: DataFrame) -> DataFrame:
    """Adds pos, which rises in document order; repeats of a document are dropped.

    Sorted over range partitions; a position is its partition's number and its
    place there.
    """
    names = [*NAMES, "pos"]
    schema = fields(names)
    keys = ["doc", "tie", "i"]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pos, last = TaskContext.get().partitionId() << 33, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
            fresh = np.ones(batch.num_rows, bool)
            fresh[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
            fresh[0] = last is None or (key[:, 0] != last).any()
            last = key[:, -1]
            kept = batch.filter(pa.array(fresh))
            yield table(schema, [*kept.columns, np.arange(pos, pos + kept.num_rows)])
            pos += kept.num_rows

    ranged = lines.repartitionByRange(partitions(lines.sparkSession), *keys).sortWithinPartitions(*keys)
    return ranged.mapInArrow(part, ddl(names))


def named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The (settled) rows whose key repeats, with the key's first position as name."""
    repeated = settle_round(rows.groupBy(*keys).agg(F.min("pos").alias("name"), F.count("*").alias("n")).where("n > 1"))
    total = repeated.agg(F.sum("n")).first()[0] or 0
    return settle_round(look_up(rows, repeated, keys, total).drop(*keys), total)


def later_runs(lines: DataFrame) -> DataFrame:
    """doc, tie, i, length of the shortest runs with enough words that also stand at an earlier position."""
    at = ["doc", "tie", "i"]
    level = named(lines.select(*at, "pos", "h1", "h2"), ["h1", "h2"])
    # A run that ends at a line is wanted where it starts.
    ends = lines.where("back > 0").select("doc", "tie", (F.col("i") - F.col("back") + 1).alias("i"), F.col("back").alias("length"))
    starts = lines.where("ahead > 0").select(*at, F.col("ahead").alias("length"))
    wanted = settle_round(level.join(starts.unionByName(ends).distinct(), at).select(*at, "length"))
    out: list[DataFrame] = []
    size = 1
    while True:
        # Runs of size to 2 * size - 1 lines are named by the two of this level with which they start and end.
        runs = wanted.where(F.col("length") < 2 * size).join(level, at)
        last = level.select("doc", "tie", F.col("i").alias("end"), F.col("name").alias("end_name"))
        runs = runs.withColumn("end", F.col("i") + F.col("length") - size).join(last, ["doc", "tie", "end"])
        runs = settle_round(runs.select(*at, "pos", "length", "length", "name", "end_name").toDF(*at, "pos", "length", "k", "first", "second"))
        out.append(named(runs, ["k", "first", "second"]).where("pos > name").select(*at, "length"))
        wanted = wanted.where(F.col("length") >= 2 * size)
        if not wanted.head(1):
            break
        second = level.select("doc", "tie", (F.col("i") - size).alias("i"), F.col("name").alias("second"))
        pairs = level.withColumnRenamed("name", "first").join(second, at)
        level = named(settle_round(pairs), ["first", "second"])
        tidy(lines.sparkSession)
        size *= 2
    return reduce(DataFrame.unionByName, out)


def deleted_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """doc, tie and the lines (places in the text) that are in a later copy of a run; settled."""
    lines = settle_round(numbered(line_rows(docs, min_words)))
    found = later_runs(lines).select("doc", "tie", F.explode(F.sequence("i", F.col("i") + F.col("length") - 1)).alias("i")).distinct()
    places = lines.select("doc", "tie", "i", "line").join(found, ["doc", "tie", "i"])
    return settle_round(places.groupBy("doc", "tie").agg(F.sort_array(F.collect_list("line")).alias("deleted")))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Texts without later copies of line runs: doc_id, text, n_lines, n_deleted.

    A run of whole lines with ``min_words`` words or more that also stands
    earlier, in the order of (doc_id, text's hash, line), is deleted; shorter
    repeats stay.  n_lines counts all lines.

    A null text stays null and has no lines; an empty one has one line; a very
    long one is a sequence like any other; null ids come first in the order;
    rows that repeat both id and text are one document, so they keep or lose
    the same lines; lines without words are no part of a run and stay; extra
    columns are left out, whatever their names; an empty table gives an empty
    result.
    """
    docs = keyed(pick(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    return without_deleted(docs, min_words).select(
        "doc_id", "text", F.coalesce(F.col("n_lines"), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size("deleted"), F.lit(0)).cast("long").alias("n_deleted")
    )


def without_deleted(docs: DataFrame, min_words: int) -> DataFrame:
    """Applies the deletions to the text of rows with doc and tie; adds n_lines and deleted."""
    found = deleted_lines(docs, min_words)
    size = found.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("deleted")), F.lit(0)).alias("lines")).first()
    near = F.broadcast(found) if size["rows"] <= FEW_ROWS and size["lines"] <= FEW_LINES else found
    split = F.split("text", "\n")
    kept = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("deleted"))
    left = let(split, lambda lines: F.array_join(F.transform(kept(lines), lambda i: F.get(lines, i)), "\n"))
    joined = docs.join(near, ["doc", "tie"], "left").withColumn("n_lines", F.size(split))
    return joined.withColumn("text", F.when(F.col("deleted").isNull(), F.col("text")).otherwise(left))


def deduped_documents(df: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows with all their columns, less the deleted lines; a text that loses its last word goes.

    Null, empty and wordless texts have no run and stay; very long texts are
    taken whole; null ids come first in the order of copies; rows that repeat
    id and text keep or lose the same lines; an empty table gives an empty
    result.  Columns keep their places, whatever their names.
    """
    rows = without_deleted(keyed(beside(df, doc_id="doc_id", text="text").withColumn("text", F.col("text").cast("string"))), min_words)
    gone = F.col("deleted").isNotNull() & ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    rows = rows.where(~gone).withColumn("n_chars", F.char_length("text").cast("long"))
    return restored(rows, df, text="text", n_chars="n_chars")
