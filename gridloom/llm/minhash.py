"""Near-duplicates by circulant MinHash, banding and exact verification.

One permutation scatters the shingles over a fixed universe, a second one,
circularly shifted by k, gives the k-th signature coordinate.  Documents with
the same shingle set are one class from then on.  Classes that share a band
are candidates; a link is confirmed on the full sets.

Groups of copies can be large, so a band's bucket isn't expanded into all its
pairs.  Each bucket has a hub that its members are compared with.  Where some
stay apart from its largest component, all those and the bucket's other members
are compared by their sketches, a byte for each coordinate, in blocks: first each
with the one most alike, then, when that gives no more links, all that are alike
enough are verified.  Members that are already connected need no
comparison; a link between components is lost only where banding or the sketch
misses it.  Band keys, hubs and components may be hot: they are looked up by
``look_up``, and hubs' members are dealt out in parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import beside, hold, look_up, pick, restored, settle_round, slices, table, tidy
from .fingerprints import HASHES, mixed, shingles, word_hashes

WORDS = 5
SIMILARITY = 75  # per cent
BANDS, ROWS = 32, 4
UNIVERSE = 1 << 22
#: Coordinates of a signature at most.
SHIFTS = 4096
#: Candidate tables of so many narrow rows are broadcast to the texts; larger ones are joined by a shuffle.
FEW = 100_000
#: Members of a bucket that a task compares with as many others at a time.
BLOCK = 4096
SKETCH = 512
#: Pairs whose estimated similarity is so much below the least one aren't verified: four standard deviations of the sketch.
MARGIN = 0.08
#: Shingle sets in a file of theirs, about.
SETS = 4000
#: A hub's members are dealt out in parts of about so many.
PART = 256


def shingle_set(text: bytes, k: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    return np.unique(shingles(word_hashes(text), k))


@cache
def circle() -> np.ndarray:
    """The second permutation, and its beginning once more: 16 MB, once in a worker."""
    pi = np.arange(UNIVERSE, dtype=np.uint32)
    np.random.default_rng(75).shuffle(pi)
    return np.concatenate([pi, pi[:SHIFTS]])


def shifted(k: int) -> np.ndarray:
    """The second permutation at each place and the k - 1 after it, around the circle."""
    return np.lib.stride_tricks.sliding_window_view(circle()[: UNIVERSE + k - 1], k)


def forget() -> None:
    circle.cache_clear()
    HASHES.clear()


def signature(items: np.ndarray, k: int) -> np.ndarray:
    windows = shifted(k)
    first = (mixed(items ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(64 - 22)).astype(np.int64)
    out = np.full(k, UNIVERSE, np.uint32)
    for a in range(0, first.size, 1024):
        np.minimum(out, windows[first[a : a + 1024]].min(axis=0), out=out)
    return out


def sketch(items: np.ndarray, bands: int, rows: int) -> bytes:
    """A byte of each of more coordinates than the bands have, then 32 bits of each band's key."""
    sig = signature(items, max(SKETCH, bands * rows))
    some = (sig[:SKETCH] * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)
    return some.tobytes() + band_keys(sig[: bands * rows], bands, rows).astype(np.uint32).tobytes()


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    sig = sig.reshape(bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, j] + np.uint64(1))
    return key.view(np.int64)


def digest(items: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(hashlib.blake2b(items.tobytes(), digest_size=16).digest(), np.int64).tolist())


def signed_rows(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, d1 and d2 (a digest of the set), bands (null without words)."""
    schema = pa.schema([*[(c, pa.int64()) for c in ("doc_id", "n_shingles", "d1", "d2")], ("bands", pa.list_(pa.int64()))])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("minhash", forget)
        for batch in slices(batches, "text"):
            cols: list[list] = [[], [], [], []]
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                items = shingle_set(text or b"", k)
                values: tuple = (0, None, None, None)
                if items.size:
                    values = (items.size, *digest(items), band_keys(signature(items, bands * rows), bands, rows))
                for column, value in zip(cols, values, strict=True):
                    column.append(value)
            yield table(schema, [batch.column(0), *cols])

    return docs.mapInArrow(part, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>")


def class_sets(docs: DataFrame, wanted: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """cid, its packed shingle set and its sketch, for the classes (cid, rep, d1, d2) wanted."""
    near = F.broadcast(wanted) if wanted.count() <= FEW else wanted
    schema = pa.schema([("cid", pa.int64()), ("items", pa.binary()), ("sketch", pa.binary())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("minhash", forget)
        for batch in slices(batches, "text"):
            cids, packed, sketches = [], [], []
            for text, cid, d1, d2 in zip(batch.column(0).cast(pa.binary()).to_pylist(), *(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                items = shingle_set(text or b"", k)
                # A repeated id may stand for other texts too.
                if items.size and digest(items) == (d1, d2):
                    cids.append(cid)
                    packed.append(items.tobytes())
                    sketches.append(sketch(items, bands, rows))
            yield table(schema, [cids, packed, sketches])

    texts = docs.join(near, docs["doc_id"] == wanted["rep"]).select("text", "cid", "d1", "d2")
    return texts.mapInArrow(part, "cid long, items binary, sketch binary").groupBy("cid").agg(F.first("items").alias("items"), F.first("sketch").alias("sketch"))


def verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    The members b of a hub a are dealt out in parts; each part gets the hub's
    set once, first in order, and its members' sets then stream past it.
    """
    sets = sets.select("cid", "items")
    hubs = settle_round(pairs.groupBy("a").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")), pairs.count())
    part_of = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")
    members = pairs.join(hubs, "a").select("a", part_of, F.col("b").alias("cid")).join(sets, "cid")
    members = members.select("a", "part", F.lit(1).alias("kind"), "cid", "items")
    firsts = hubs.withColumnRenamed("a", "cid").join(sets, "cid").select(F.col("cid").alias("a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "cid", "items")
    rows = members.unionByName(firsts).repartition("a", "part").sortWithinPartitions("a", "part", "kind")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = items = None
        for batch in slices(batches, "items"):
            a_out, b_out = [], []
            for a, kind, cid, packed in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                these = np.frombuffer(packed, np.uint64)
                if kind == 0:
                    hub, items = a, these
                elif a == hub:
                    at = np.searchsorted(items, these)
                    at[at == items.size] = 0
                    both = int((items[at] == these).sum())
                    if 100 * both >= similarity * (items.size + these.size - both):
                        a_out.append(a)
                        b_out.append(cid)
            yield table(schema, [a_out, b_out])

    return rows.mapInArrow(part, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """cid and comp, its least reachable cid, of all ends of (a, b).

    Each round a node takes the least label of its neighbours and itself, then
    the label that its label has come to.  Labels only ever get less, so it ends.
    """
    ends = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = settle_round(ends.union(ends.select("a", F.col("a").alias("b"))).distinct(), 4 * edges.count())
    total = both.count()
    # Neighbours are mutual, so a node's rows as a are as many as those as b.
    labels = both.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("comp"), F.count("*").alias("n"))
    while True:
        met = look_up(both, labels, ["b"], total)
        heard = settle_round(met.groupBy("a").agg(F.min("comp").alias("new"), F.max(F.when(F.col("a") == F.col("b"), F.col("comp"))).alias("old"), F.count("*").alias("n")), total)
        sizes = heard.groupBy("new").agg(F.count("*").alias("__n"))
        far = heard.select(F.col("a").alias("new"), F.col("new").alias("far")).join(sizes, "new").withColumnRenamed("__n", "n")
        jumped = look_up(heard.withColumnRenamed("n", "degree"), settle_round(far, total), ["new"], total)
        jumped = settle_round(jumped.select("a", "old", F.col("far").alias("new"), "degree"), total)
        labels = jumped.select(F.col("a").alias("b"), F.col("new").alias("comp"), F.col("degree").alias("n"))
        tidy(edges.sparkSession)
        if not jumped.where("old <> new").head(1):
            return labels.select(F.col("b").alias("cid"), "comp")


def apart_pairs(now: DataFrame, sketches: DataFrame, least: float, best: bool) -> DataFrame | None:
    """Pairs (a, b) of a bucket's members in different components whose sketches are alike enough.

    None if all members of each bucket are in one component.  With ``best`` only
    the most alike one of each member that is outside, in one bucket of four: a
    first look, which a call without it must follow.

    ``now`` has key, cid and comp.  Members outside of a bucket's largest
    component meet all its members, block by block: a block's sketches fit in
    a task however large the bucket is, and only pairs that pass become rows.
    """
    if best:
        now = now.where(F.pmod("key", F.lit(4)) == 0)
    counts = now.groupBy("key", "comp").agg(F.count("*").alias("n"))
    split = counts.groupBy("key").agg(F.sum("n").alias("n"), F.max("n").alias("largest"), F.max_by("comp", "n").alias("main")).where("n > largest")
    split = settle_round(split, now.count())
    if not split.head(1):
        return None
    now = now.join(split, "key").join(sketches, "cid").withColumn("outside", F.col("comp") != F.col("main"))
    across, down = F.ceil(F.col("n") / BLOCK).cast("int"), F.ceil((F.col("n") - F.col("largest")) / BLOCK).cast("int")
    now = now.withColumn("col", F.pmod(F.xxhash64("cid"), across).cast("int")).withColumn("row", F.pmod(F.xxhash64(F.lit(1), "cid"), down).cast("int"))
    every = lambda count: F.explode(F.sequence(F.lit(0), count - 1))
    held = now.select("key", every(down).alias("row"), "col", F.lit(0).alias("role"), "cid", "comp", "outside", "sketch")
    asked = now.where("outside").select("key", "row", every(across).alias("col"), F.lit(1).alias("role"), "cid", "comp", "outside", "sketch")
    rows = held.unionByName(asked).repartition("key", "row", "col").sortWithinPartitions("key", "row", "col", "role")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def alike(key: int, block: list, asked: list) -> tuple[np.ndarray, np.ndarray]:
        raw, own = (np.frombuffer(b"".join(r[3] for r in x), np.uint8).reshape(len(x), -1) for x in (block, asked))
        have, want = raw[:, :SKETCH], own[:, :SKETCH]
        bands, own_bands = (np.ascontiguousarray(x[:, SKETCH:]).view(np.uint32) for x in (raw, own))
        here = int(np.argmax(own_bands[0] == np.uint32(key & 0xFFFFFFFF)))
        cids, comps, outside = (np.array([r[i] for r in block]) for i in (0, 1, 2))
        a, b = [], []
        for k, (cid, comp, _, _) in enumerate(asked):
            equal = (have == want[k]).mean(axis=1)
            pairs = ((equal - 1 / 256) / (1 - 1 / 256) >= least) & (comps != comp)
            if not best:
                pairs &= ~outside | (cids > cid)  # of two members outside, one asks
            at = np.flatnonzero(pairs)
            if best and at.size:
                at = at[[np.argmax(equal[at])]]
            if not best:
                # Of all the bands that a pair shares, the first one's bucket reports it.
                at = at[(bands[at] == own_bands[k]).argmax(axis=1) == here]
            a.append(np.minimum(cids[at], cid))
            b.append(np.maximum(cids[at], cid))
        return np.concatenate(a), np.concatenate(b)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, block, waiting = None, [], []
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for key, row, col, role, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, row, col) != place:
                    if block and waiting:
                        found.append(alike(place[0], block, waiting))
                    place, block, waiting = (key, row, col), [], []
                (waiting if role else block).append(rest)
            if found:
                yield table(schema, [np.concatenate(x) for x in zip(*found, strict=True)])
                found = []
        if block and waiting:
            yield table(schema, list(alike(place[0], block, waiting)))

    return rows.mapInArrow(part, "a long, b long")


def linked_classes(docs: DataFrame, classes: DataFrame, k: int, similarity: int, bands: int, rows: int) -> DataFrame | None:
    """cid and comp of the classes that have links, from (cid, rep, d1, d2, bands)."""
    keyed = classes.select("cid", F.explode("bands").alias("key"))
    bands_of = bands * classes.count()
    hubs = settle_round(keyed.groupBy("key").agg(F.min("cid").alias("hub"), F.count("*").alias("n")).where("n > 1"), bands_of)
    total = hubs.agg(F.sum("n")).first()[0] or 0
    members = settle_round(look_up(keyed, hubs, ["key"], total).select("key", "cid", "hub"), bands_of)
    wanted = settle_round(members.select("cid").distinct().join(classes.select("cid", "rep", "d1", "d2"), "cid"), total)
    count = wanted.count()
    if not count:
        return None
    sets = settle_round(class_sets(docs, wanted, k, bands, rows), count, SETS)
    tidy(docs.sparkSession)

    # Each member meets the hub with which it shares most buckets.
    shared = members.where("cid <> hub").groupBy("cid", "hub").agg(F.count("*").alias("n"))
    hub_of = shared.groupBy("cid").agg(F.max(F.struct("n", (-F.col("hub")).alias("h"))).alias("m"))
    tested = settle_round(hub_of.select((-F.col("m.h")).alias("a"), F.col("cid").alias("b")), count)
    edges = settle_round(verified(tested, sets, similarity), count, costly=True)
    tidy(docs.sparkSession)
    linked = components(edges)
    sketches, least = sets.select("cid", "sketch"), similarity / 100 - MARGIN
    best = True
    while True:
        now = settle_round(members.select("key", "cid").join(linked, "cid", "left").withColumn("comp", F.coalesce("comp", "cid")), total)
        # In a tested pair the lesser one is a.
        pairs = apart_pairs(now, sketches, least, best)
        found = False
        if pairs is not None:
            pairs = settle_round(pairs.distinct().join(tested, ["a", "b"], "left_anti"))
            fresh = settle_round(verified(pairs, sets, similarity), n, costly=True) if (n := pairs.count()) else None
            found = fresh is not None and bool(fresh.head(1))
            tested = settle_round(tested.union(pairs), tested.count() + n)
        tidy(docs.sparkSession)
        if found:
            edges = settle_round(edges.union(fresh), edges.count() + n)
            linked = components(edges)
        if not best:
            return linked
        # Once the most alike pairs give no more links, all others are compared.
        best = found


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: int = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Components of near-duplicates: doc_id, n_shingles, component_id, kept.

    A document's set is its distinct ``words``-word shingles (A-Z in lower
    case); a shorter one is one shingle as a whole.  Documents are linked if
    their sets' Jaccard index is at least ``similarity`` per cent.  With 32
    bands of 4 rows a pair at 75 per cent is missed by banding with probability
    5.2e-6; one that only the sketches compare also by their estimate, with
    probability 2.4e-5, so by either with 2.9e-5 at most (coordinates taken as
    independent).

    Texts that are null or have no words have an empty set and no link; a very
    long text's set is that of the whole text.  A row of a null id is in no
    component (null) and kept.  Rows that repeat an id are one node, so what
    either is linked with is linked.  Extra columns are left out, whatever
    their names.  An empty table gives an empty result.
    """
    docs = pick(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = settle_round(signed_rows(docs, words, bands, rows))
    n = signed.count()
    least = signed.where("d1 IS NOT NULL AND doc_id IS NOT NULL").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.count("*").alias("n"))
    classes = settle_round(least.select(F.monotonically_increasing_id().alias("cid"), "rep", "d1", "d2", "bands", "n"), n, 40_000)
    linked = linked_classes(docs, classes, words, similarity, bands, rows)

    found = classes.select("cid", "rep", "d1", "d2", "n").withColumn("component_id", F.col("rep"))
    if linked is not None:
        least = found.join(linked, "cid").groupBy("comp").agg(F.min("rep").alias("least"))
        of = linked.join(least, "comp").select("cid", "least")
        found = found.join(of, "cid", "left").withColumn("component_id", F.least("rep", "least"))
    found = settle_round(found.select("d1", "d2", "component_id", "n"), n)
    # Copies of one text may be a large share of all rows.
    own = signed.where("d1 IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "n_shingles", "d1", "d2")
    placed = look_up(own, found, ["d1", "d2"], n).select("doc_id", "n_shingles", "component_id")
    others = signed.where("d1 IS NULL OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    placed = settle_round(placed.unionByName(others), n)
    placed = one_node(placed)
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_node(placed: DataFrame) -> DataFrame:
    """Join the components in which one repeated id stands."""
    many = placed.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("component_id").alias("a"), F.max("component_id").alias("b")).where("a < b")
    many = settle_round(many, placed.count())
    if not many.head(1):
        return placed
    # All components of such an id, each an edge to the least of them.
    edges = placed.join(many.select("doc_id", "a"), "doc_id").select("a", F.col("component_id").alias("b")).where("a <> b").distinct()
    merged = settle_round(components(settle_round(edges)).select(F.col("cid").alias("component_id"), "comp"))
    return placed.join(merged, "component_id", "left").withColumn("component_id", F.coalesce("comp", "component_id"))


def without_copies(df: DataFrame, **options) -> DataFrame:
    """One row for each component, with all its columns: the first by id.

    Of rows that repeat that id, the one with the least hash of its columns
    stays.  Rows of null ids stay, and so do null, empty and wordless texts, a
    row for each id; very long texts are compared whole; an empty table gives an
    empty result.  Columns keep their places, whatever their names.
    """
    found = near_duplicates(df, **options).where("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"))
    found = settle_round(found.select(F.col("doc_id").alias("kept_id"), "n"), df.count())
    near = F.broadcast(found) if found.count() <= FEW else found
    rows = beside(df, doc_id="doc_id").withColumn("doc_id", F.col("doc_id").cast("long"))
    kept = rows.where(F.col("doc_id").isNotNull()).join(near, F.col("doc_id") == F.col("kept_id"), "left_semi")
    if found.where("n > 1").head(1):
        order = F.xxhash64(*[F.col(c) for c in rows.columns])
        kept = kept.groupBy("doc_id").agg(F.min(F.struct(order.alias("order"), *rows.columns[:-1])).alias("row")).select("row.*", "doc_id").drop("order")
    return restored(kept.unionByName(rows.where(F.col("doc_id").isNull())), df)
