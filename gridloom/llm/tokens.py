"""Token counts without token ids, and the word-wise encoder that packing uses.

A *pre-token* here is a run without ASCII white space, with A-Z in lower case
where the vocabulary ignores case.  The vocabulary's own pre-tokenizer drops
white space and never merges across it, so a text's tokens are those of its
runs, one after the other.  ``Encoder`` probes this and otherwise takes whole
texts as single runs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hold, pick, settle, slices, table

#: Pre-tokens looked up in a broadcast table at most, and their bytes; the rest are joined.
COMMON, COMMON_BYTES = 300_000, 16 << 20
#: Bytes of an entry of that table besides the pre-token's own.
ENTRY = 32
#: Longer pre-tokens are never cached.
LONG = 64
#: Pre-tokens in each of the cache's two generations: about 50 MB each.
CACHED = 300_000
ENDS = (b".", b",")


def letter_before_end(word: bytes) -> bool:
    """Whether a letter or digit, of those whose class is beyond doubt, stands before the last byte."""
    if len(word) < 2 or b"<" in word:
        return False
    c = word[-2]
    if c < 128:
        return 48 <= c <= 57 or 97 <= c <= 122
    # The letters from 00C0 to 00FF, without the signs for times and divided by.
    return len(word) > 2 and word[-3] == 0xC3 and c not in (0x97, 0xB7)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Young(dict):
    """The cache's younger generation: takes over from the older one, and notes what neither has."""

    def __init__(self, old: dict[bytes, bytes]):
        super().__init__()
        self.old = old
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> bytes | None:
        ids = self.old.get(word)
        if ids is None:
            self.fresh.append(word)
        else:
            self[word] = ids
        return ids


class Known(dict):
    """Pieces of common pre-tokens; counts the others.  A worker has one of it, however many tasks it runs."""

    other: Counter

    def __missing__(self, word):
        self.other[word] += 1
        return 0


class Encoder:
    """The library's tokenizer, applied once per distinct pre-token."""

    _loaded: dict[str, Encoder] = {}

    def __init__(self, path: str, capacity: int = CACHED):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.capacity = capacity
        self.old: dict[bytes, bytes] = {}
        self.young = Young(self.old)
        one = lambda t: self.library.encode(t, add_special_tokens=False).ids
        probes = ["a b", "a\x0bb", "a \n\tb.", "1  2\r3", "x , .y", "it 's\x0ct"]
        self.by_word = all(one(p) == [i for w in p.encode().split() for i in one(w.decode())] for p in probes)
        self.caseless = one("Ab CD eF") == one("ab cd ef")
        self.ends = {e: np.array(one(e.decode()), "<u4").tobytes() for e in ENDS}
        self.by_word &= all(one(f"{x}{e.decode()}") == one(f"{x} {e.decode()}") for x in ("a", "7", "é", "ß") for e in ENDS)

    @classmethod
    def load(cls, path: str) -> Encoder:
        """One per Python worker, until the worker turns to another kind of task."""
        hold("tokens", cls._loaded.clear)
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def words(self, text: bytes) -> list[bytes]:
        if not self.by_word:
            return [text] if text else []
        # Strings of added tokens are matched as they stand, so their case counts.
        if self.caseless and b"<" not in text:
            text = text.lower()
        return text.split()

    def ids(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word; all are encoded in one go where that is exact."""
        texts = [w.decode("utf-8", "surrogatepass") for w in words]
        if not self.by_word:
            return [np.array(self.library.encode(t, add_special_tokens=False).ids, "<u4") for t in texts]
        out: list[np.ndarray] = []
        for i in range(0, len(texts), 2000):
            part = texts[i : i + 2000]
            got = self.library.encode(" ".join(part), add_special_tokens=False)
            starts = np.cumsum([0] + [len(t) + 1 for t in part])
            at = np.fromiter((o[0] for o in got.offsets), np.int64, len(got.ids))
            cuts = np.searchsorted(at, starts)
            all_ids = np.array(got.ids, "<u4")
            out += [all_ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    def packed(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word.  A word is looked up once; the cache is bounded, in two generations."""
        if len(self.young) > self.capacity:
            self.old, self.young.old = self.young, {}
            self.young = Young(self.old)
        young = self.young
        young.fresh = []
        got = list(map(young.__getitem__, words))
        if not young.fresh:
            return got
        new, missing = self._new(set(young.fresh)), iter(young.fresh)
        return [ids if ids is not None else new[next(missing)] for ids in got]

    def _new(self, fresh: set[bytes]) -> dict[bytes, bytes]:
        """Packed ids of words that aren't in the cache, where all but the longest go."""
        out: dict[bytes, bytes] = {}
        ended: list[bytes] = []
        todo: set[bytes] = set()
        for w in fresh:
            if self.by_word and w[-1:] in ENDS and letter_before_end(w):
                ended.append(w)
                ids = self.young.get(w[:-1], self.old.get(w[:-1]))
                if ids is None:
                    todo.add(w[:-1])
                else:
                    out[w[:-1]] = ids
            else:
                todo.add(w)
        words = list(todo)
        out.update((w, ids.tobytes()) for w, ids in zip(words, self.ids(words), strict=True))
        # A full stop or comma after a letter is a pre-token of the vocabulary's own.
        for w in ended:
            out[w] = out[w[:-1]] + self.ends[w[-1:]]
        self.young.update((w, ids) for w, ids in out.items() if len(w) <= LONG)
        return out

    def known(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Packed ids by word."""
        words = list(words)
        return dict(zip(words, self.packed(words), strict=True))


def count_words(docs: DataFrame, path: str) -> DataFrame:
    """Distinct pre-tokens of all texts and how often they occur: word, n."""

    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = Encoder.load(path), Counter()
        for batch in slices(batches, "text"):
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                if text:
                    seen.update(encoder.words(text))
            if len(seen) > 250_000:
                yield table(schema, [list(seen.keys()), list(seen.values())])
                seen = Counter()
        if seen:
            yield table(schema, [list(seen.keys()), list(seen.values())])

    return docs.select("text").mapInArrow(part, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def piece_counts(words: DataFrame, path: str) -> DataFrame:
    """Adds the number of pieces, each distinct pre-token being encoded once."""

    schema = pa.schema([("word", pa.binary()), ("n", pa.int64()), ("pieces", pa.int64())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.load(path)
        for batch in slices(batches, "word"):
            ids = encoder.ids(batch.column(0).to_pylist())
            yield table(schema, [batch.column(0), batch.column(1), [len(i) for i in ids]])

    return words.mapInArrow(part, "word binary, n long, pieces long")


def token_counts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    limit: int = 2048,
    common: int = COMMON,
) -> DataFrame:
    """Tokens of each whole text: doc_id, n_bytes, n_tokens, over_limit.

    Pieces are counted once per distinct pre-token of the corpus; the counts
    meet the documents' pre-token frequencies and are summed.  At most
    ``common`` frequent pre-tokens, of COMMON_BYTES together, reach the
    documents by a broadcast; a long one must be more frequent than a short
    one.  All others are joined.

    A null text counts as empty: no bytes, no tokens.  A null id stays null.
    Repeated rows each give a row.  A very long text is a slice of its own and
    counted whole; a very long pre-token is encoded once.  Extra columns are
    left out, whatever their names.  An empty table gives an empty result.
    """
    path = path or vocabulary_path()
    docs = pick(df, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    vocabulary = settle(piece_counts(count_words(docs, path), path))

    # What a broadcast saves grows with the frequency and costs by the byte: levels of n ** 2 / bytes by powers of
    # 2 ** (1/4), at most 700 rows.  A pre-token in a large share of the rows is far above any that isn't, however long.
    worth = F.floor(4 * F.log2(F.col("n").cast("double") * F.col("n") / (F.octet_length("word") + ENTRY)))
    size = F.sum(F.octet_length("word").cast("long"))
    levels = sorted(vocabulary.groupBy(worth.alias("level")).agg(F.count("*").alias("words"), size.alias("bytes")).collect(), key=lambda r: -r["level"])
    total = held = 0
    least = None
    for row in levels:
        total, held = total + row["words"], held + row["bytes"]
        if total > common or held > COMMON_BYTES:
            break
        least = row["level"]
    known, rest = Known(), vocabulary
    if least is not None:
        got = vocabulary.where(worth >= F.lit(least)).select("word", "pieces").toArrow()
        known.update(zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True))
        rest = vocabulary.where(worth < F.lit(least))
    shared = df.sparkSession.sparkContext.broadcast(known)

    # A text's own row carries what is known; its key can't be a pre-token.
    schema = pa.schema(
        [("rid", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("base", pa.int64()), ("word", pa.binary()), ("n", pa.int64())]
    )

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pieces = Encoder.load(path), shared.value
        pieces.other = Counter()
        rid = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text"):
            cols: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                text = text or b""
                base = sum(map(pieces.__getitem__, encoder.words(text)))
                other, pieces.other = pieces.other, Counter()
                k = len(other)
                cols[0] += [rid] * (k + 1)
                cols[1] += [doc_id] + [None] * k
                cols[2] += [len(text)] + [None] * k
                cols[3] += [base] + [None] * k
                cols[4] += [b" %d" % rid, *other.keys()]
                cols[5] += [None, *other.values()]
                rid += 1
            yield table(schema, cols)

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        part, "rid long, doc_id long, n_bytes long, base long, word binary, n long"
    )
    summed = (
        rows.join(rest.select("word", "pieces"), "word", "left")
        .groupBy("rid")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_bytes").alias("n_bytes"),
            F.sum(F.coalesce("base", F.col("n") * F.col("pieces"))).alias("n_tokens"),
        )
    )
    return summed.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
