"""Toxicity: a linear classifier over character n-grams with naive Bayes ratios.

Features say whether a hashed n-gram occurs in the whole text.  Each is scaled
by its naive Bayes log-count ratio and a logistic regression is fitted to the
scaled features (NB-SVM's scheme).  The model keeps the n-grams whose rates
differ most between the classes, so scoring a text is a table lookup for each
of its positions.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import beside, hold, pick, restored, settle, slices, table, tidy

ORDERS = (3, 4, 5, 6)
SLOTS = 1 << 20
#: Lower case for A-Z, one kind of white space, no NUL: that marks where texts end.
FOLD = bytes(32 if b in (0, 9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in range(256))
GAP = b" \0 "
#: Positions that are hashed at a time, and findings after which repeats are dropped.
BLOCK, MANY = 1 << 17, 1 << 21
#: Bytes of texts that are looked at together.
SLICE = 1 << 18
#: The fit ends at a gradient of this norm, or with a warning after so many steps.
GRADIENT, MOST_STEPS = 2e-5, 100
#: Labelled texts of a class that the fit, with a matrix of all pairs of them, may be given; features multiplied at a time.
MOST_BOUND, COLUMNS = 4000, 512


def grams(joined: np.ndarray, n: int) -> np.ndarray:
    """Slot of the n-gram at each position."""
    h = np.full(joined.size - n + 1, n, np.uint32)
    for i in range(n):
        h = (h + joined[i : i + h.size]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA77)
    return h >> np.uint32(32 - SLOTS.bit_length() + 1)


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts folded in one array, and where each begins."""
    parts = [GAP + t.translate(FOLD) for t in texts]
    starts = np.cumsum([0] + [len(p) for p in parts])
    return np.frombuffer(b"".join([*parts, GAP, b"\0" * 8]), np.uint8), starts


def present(texts: list[bytes], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) of the n-grams that occur and whose slot is wanted, each once."""
    joined, starts = join_texts(texts)
    ends = np.flatnonzero(joined == 0)
    found, waiting = [np.empty(0, np.int64)], 0
    for n in ORDERS:
        for a in range(0, joined.size - n + 1, BLOCK):
            slots = grams(joined[a : a + BLOCK + n - 1], n)
            at = np.flatnonzero(wanted[slots])
            slots = slots[at]
            at += a
            # An n-gram must not reach over the mark between two texts.
            whole = ends[np.searchsorted(ends, at)] >= at + n
            found.append(np.unique((np.searchsorted(starts, at[whole], "right") - 1) * SLOTS + slots[whole]))
            waiting += found[-1].size
            if waiting > MANY:
                found, waiting = [np.unique(np.concatenate(found))], 0
    both = np.unique(np.concatenate(found))
    return both // SLOTS, both % SLOTS


@dataclass
class Model:
    slots: np.ndarray  # of the n-grams in use, rising
    values: np.ndarray
    bias: float

    @cached_property
    def weights(self) -> np.ndarray:
        """By slot; 0 for all that it doesn't use."""
        out = np.zeros(SLOTS)
        out[self.slots] = self.values
        return out

    @cached_property
    def wanted(self) -> np.ndarray:
        return self.weights != 0

    def __getstate__(self):
        return {"slots": self.slots, "values": self.values, "bias": self.bias}

    def scores(self, texts: list[bytes]) -> np.ndarray:
        text, slot = present(texts, self.wanted)
        total = self.bias + np.bincount(text, self.weights[slot], len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


@dataclass
class Counts:
    """How many texts of each class have each slot, and how many texts there are."""

    with_toxic: np.ndarray
    with_clean: np.ndarray
    toxic: int
    clean: int

    def ratio(self, alpha: float) -> np.ndarray:
        """Naive Bayes log-count ratio of each slot."""
        return np.log((self.with_toxic + alpha) / (self.toxic + 2 * alpha)) - np.log((self.with_clean + alpha) / (self.clean + 2 * alpha))

    def chosen(self, most: int) -> np.ndarray:
        """The slots whose rates differ most, in order; each by three standard errors at least."""
        n1, n0 = self.toxic, self.clean
        if not n1 or not n0:
            return np.empty(0, np.int64)
        rate = (self.with_toxic + self.with_clean + 1) / (n1 + n0 + 2)
        z = np.abs(self.with_toxic / n1 - self.with_clean / n0) / np.sqrt(rate * (1 - rate) * (1 / n1 + 1 / n0))
        z[self.with_toxic + self.with_clean < 3] = 0
        best = np.argsort(-z, kind="stable")[:most]
        return np.sort(best[z[best] > 3])


def gram_matrix(rows: list[np.ndarray], scale: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Products of all pairs of scaled rows, summed over columns a block at a time; 4 bytes for each pair of texts."""
    out = np.zeros((len(rows), len(rows)), np.float32)
    columns = [np.searchsorted(chosen, r) for r in rows]
    for a in range(0, chosen.size, COLUMNS):
        block = np.zeros((len(rows), min(COLUMNS, chosen.size - a)), np.float32)
        for i, c in enumerate(columns):
            block[i, c[np.searchsorted(c, a) : np.searchsorted(c, a + COLUMNS)] - a] = 1
        block *= scale[a : a + COLUMNS].astype(np.float32)
        # Some texts' products at a time, so that nothing else is as large as the result.
        for i in range(0, len(rows), COLUMNS):
            out[i : i + COLUMNS] += block[i : i + COLUMNS] @ block.T
    return out


def solved(apply, right: np.ndarray, most: int = 1000) -> np.ndarray:
    """The solution of a positive definite system, by conjugate gradients."""
    x, r = np.zeros_like(right), right.copy()
    d, rr = r.copy(), float(r @ r)
    least = 1e-16 * rr
    for _ in range(most):
        if rr <= least:
            break
        ad = apply(d)
        step = rr / float(d @ ad)
        x += step * d
        r -= step * ad
        rr, before = float(r @ r), rr
        d = r + rr / before * d
    return x


def fit(rows: list[np.ndarray], toxic: np.ndarray, counts: Counts, chosen: np.ndarray, prior: float, alpha: float = 1.0, decay: float = 1e-3) -> Model:
    """Fit to the chosen slots of each text; ``prior`` is the toxic share among all labelled texts.

    The best weights are a combination of the texts, of which there are far
    fewer than features: Newton steps find its factors (and the bias), each by
    a system with a row per text.
    """
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    if not chosen.size:
        return Model(chosen, np.empty(0), float(np.log(prior / (1 - prior))))
    ratio = counts.ratio(alpha)[chosen]
    y, n = toxic.astype(float), len(rows)
    matrix = gram_matrix(rows, ratio, chosen)
    products = lambda v: (matrix @ v.astype(np.float32)).astype(float)
    factors, b = np.zeros(n), 0.0

    def loss(factors: np.ndarray, b: float) -> tuple[float, np.ndarray]:
        said = products(factors)
        return float(np.logaddexp(0, said + b).mean() - (y * (said + b)).mean() + decay / 2 * factors @ said), said + b

    now, margin = loss(factors, b)
    for _ in range(MOST_STEPS):
        p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
        # In terms of the factors the gradient is products(g), and the bias's is the mean of p - y.
        g = (p - y) / n + decay * factors
        if g @ products(g) + (p - y).mean() ** 2 <= GRADIENT**2:
            break
        # Newton's step solves curvature * products(d) + decay * d + curvature * db = -g, with sum(curvature * (products(d) + db)) = -sum(p - y) / n;
        # with d = root * e the first is a symmetric system for e.
        curvature = np.maximum(p * (1 - p), 1e-9) / n
        root = np.sqrt(curvature)
        system = lambda e, root=root: root * products(root * e) + decay * e
        one, two = (root * solved(system, v / root) for v in (-g, -curvature))
        db = float((-(p - y).sum() / n - curvature @ products(one)) / (curvature.sum() + curvature @ products(two)))
        d, step = one + db * two, 1.0
        while (new := loss(factors + step * d, b + step * db))[0] > now and step > 1e-6:
            step /= 2
        factors, b, now, margin = factors + step * d, b + step * db, *new
    else:
        warnings.warn(f"the fit's gradient is above {GRADIENT} after {MOST_STEPS} steps", stacklevel=2)
    w = np.zeros(chosen.size)
    for r, f in zip(rows, factors, strict=True):
        w[np.searchsorted(chosen, r)] += f
    # The sample may be balanced; the scores are for the labelled share.
    return Model(chosen, ratio * ratio * w, b + float(np.log(prior / (1 - prior)) - np.log(counts.toxic / counts.clean)))


def sampled_texts(docs: DataFrame, marked: DataFrame, bound: int) -> tuple[DataFrame, float]:
    """(doc_id, text, toxic) of about ``bound`` labelled texts per class at most, by a hash of the id; the toxic share of all."""
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    chosen = F.lit(False)
    for toxic, n in counts.items():
        least = 1 << 30 if n <= bound else int(0.95 * bound / n * (1 << 30))
        chosen |= (F.col("toxic") == toxic) & (F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30)) < least)
    # About twice the bound of narrow rows, so this side may be broadcast.
    sample = F.broadcast(marked.where(chosen).select("doc_id", "toxic").limit(3 * bound))
    total = sum(counts.values())
    # One text for each id, the least by its hash, so that rows that repeat an id don't add to the sample.
    text = F.min(F.struct(F.xxhash64("text"), "text"))["text"]
    texts = docs.join(sample, "doc_id").groupBy("doc_id", "toxic").agg(text.alias("text"))
    return settle(texts.select("doc_id", "text", "toxic")), counts.get(True, 0) / total if total else 0.0


def slot_counts(sample: DataFrame) -> Counts:
    """Counted where the texts are; the driver gets a row per slot at most."""
    schema = pa.schema([("slot", pa.int32()), ("n1", pa.int64()), ("n0", pa.int64())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("toxicity")
        every = np.ones(SLOTS, bool)
        n1, n0 = np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
        for batch in slices(batches, "text", SLICE):
            text, slot = present([t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()], every)
            toxic = np.array(batch.column(1).to_pylist(), bool)[text]
            n1 += np.bincount(slot[toxic], minlength=SLOTS).astype(np.int32)
            n0 += np.bincount(slot[~toxic], minlength=SLOTS).astype(np.int32)
        there = np.flatnonzero(n1 + n0)
        for a in range(0, there.size, BLOCK):
            some = there[a : a + BLOCK]
            yield table(schema, [some, n1[some], n0[some]])

    got = sample.select("text", "toxic").mapInArrow(part, "slot int, n1 long, n0 long").groupBy("slot").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).toArrow()
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    both = [np.zeros(SLOTS), np.zeros(SLOTS)]
    for k, counts in enumerate(both):
        counts[got.column(0).to_numpy()] = got.column(k + 1).to_numpy()
    return Counts(*both, n.get(True, 0), n.get(False, 0))


def chosen_rows(sample: DataFrame, chosen: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The chosen slots of each sampled text, and whether it is toxic."""
    wanted = np.zeros(SLOTS, bool)
    wanted[chosen] = True
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.bool_()), ("slots", pa.binary())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("toxicity")
        for batch in slices(batches, "text", SLICE):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield table(schema, [batch.column(0), batch.column(2), [present([t], wanted)[1].astype("<u4").tobytes() for t in texts]])

    got = sample.mapInArrow(part, "doc_id long, toxic boolean, slots binary").toArrow().sort_by("doc_id")
    return [np.frombuffer(x, "<u4").astype(np.int64) for x in got.column("slots").to_pylist()], np.array(got.column("toxic").to_pylist(), bool)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", bound: int = 1500, held_out: bool = True, most: int = 20_000) -> Model:
    """Learn from labelled texts; with ``held_out`` not from ids whose crc32 is a multiple of 5."""
    if bound > MOST_BOUND:
        raise ValueError(f"a bound of {bound} labelled texts a class; {MOST_BOUND} at most")
    marked = pick(labels, doc_id=id_col, label=label_col).where("doc_id IS NOT NULL AND label IS NOT NULL")
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("label") > 0).alias("toxic"))
    if held_out:
        marked = marked.where(~is_held_out())
    sample, prior = sampled_texts(docs, settle(marked), bound)
    counts = slot_counts(sample)
    chosen = counts.chosen(most)
    return fit(*chosen_rows(sample, chosen), counts, chosen, prior)


def is_held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def toxicity(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    bound: int = 1500,
) -> DataFrame:
    """Scores of every whole text: doc_id, held_out, score, predicted.

    The model learns from about ``bound`` labelled texts of either class at
    most, none of them held out; it sees texts only.  A null text is empty
    and scores what the bias says; a very long text is scored whole, in
    blocks; null ids are never held out; repeated rows score alike, and the
    model learns from one of them; labels of null ids or values are ignored
    and, of several, the highest counts; extra columns are left out, whatever
    their names; an empty table gives an empty result.
    """
    docs = pick(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = score_texts(docs, train(docs, labels, id_col, label_col, bound))
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("toxicity")
        for batch in slices(batches, "text", SLICE):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield table(schema, [batch.column(0), shared.value.scores(texts)])

    return docs.mapInArrow(part, "doc_id long, score double")


def without_toxic(df: DataFrame, labels: DataFrame, threshold: float = 0.5, bound: int = 1500) -> DataFrame:
    """The rows, with all their columns, whose text scores below ``threshold``.

    All labels may be learned from: nothing is evaluated here.  Null and empty
    texts score what the bias says; very long ones are scored whole; rows that
    repeat go or stay alike; a null id is as good as any; without labels all
    rows stay; an empty table gives an empty result.  Columns keep their
    places, whatever their names.
    """
    docs = pick(df, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    trained = train(docs, labels, bound=bound, held_out=False)
    tidy(df.sparkSession)  # of the fit's matrix and texts
    if not trained.slots.size:
        return df
    model = df.sparkSession.sparkContext.broadcast(trained)
    rows = beside(df, text="text").withColumn("text", F.col("text").cast("string"))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("toxicity")
        for batch in slices(batches, "text", SLICE):
            texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
            kept = batch.filter(pa.array(model.value.scores([t or b"" for t in texts]) < threshold))
            if kept.num_rows:
                yield kept

    return restored(rows.mapInArrow(part, rows.schema), df)
