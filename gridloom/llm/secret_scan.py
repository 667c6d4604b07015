"""Secrets: fixed patterns, and formats inferred from what those label.

What the patterns find are labelled credentials.  Per kind, a prefix tree of
their character classes is folded by merging statistically compatible states
into a probabilistic automaton.  Every other candidate (a long run of the
letters that labelled credentials have, or a part of it between dots and equals
signs) is scored under each automaton; it is a secret if its likelihood per
symbol reaches what held-out credentials of that kind have.  The labelled ones
are scored as well, so a finding says how far it looks like others of its kind.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, settle, slices, table

# Fixed values of the base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ["assign", "access", "hex"]
#: The letters of ASSIGN's second group.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
#: Sentences, paths and queries put dots and equals signs around a credential too.
PIECE = re.compile(r"[A-Za-z0-9+/_-]+")
LEAST = 12
#: A part of a run has so many pieces at most; the whole run is scored however many it has.
PIECES = 16


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's place, end, credential) of the base findings, in order."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    # Runs are maximal, so those of 16 or more are the ones that a shorter minimum finds and a filter keeps.
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """Long runs; of one that meets base spans, what its pieces outside of them make up."""
    out, k = [], 0
    for m in CANDIDATE.finditer(text):
        while k < len(taken) and taken[k][2] <= m.start():
            k += 1
        if k == len(taken) or taken[k][0] >= m.end():
            out.append((m.start(), m.end(), m[0]))
            continue
        start, at = None, k
        for p in PIECE.finditer(text, m.start(), m.end()):
            while at < len(taken) and taken[at][2] <= p.start():
                at += 1
            # Spans are by start and those before this one are over, so no other can meet the piece if this doesn't.
            limit = taken[at][0] if at < len(taken) else m.end()
            if limit < p.end():
                start = None
                continue
            if start is None or limit != until:
                start, until = p.start(), limit
                out.append((start, p.end(), ""))
            stop = p.end()
            while stop < min(until, m.end()) and text[stop] == "=":
                stop += 1
            out[-1] = (start, stop, text[start:stop])
    return [c for c in out if c[1] - c[0] >= LEAST]


def parts(word: str) -> Iterator[tuple[int, list[int]]]:
    """Starts of a run's parts, each with its stops: the run, and pieces in a row with or without padding."""
    pieces = [m.span() for m in PIECE.finditer(word)]
    if not pieces or pieces[0][0] > 0:
        yield 0, [len(word)]
    # The padding is two equals signs at most.
    stops = [(e, e + len(word[e : e + 2]) - len(word[e : e + 2].lstrip("="))) for _, e in pieces]
    for i, (s, _) in enumerate(pieces):
        ends = {e for both in stops[i : i + PIECES] for e in both}
        if i == 0:
            ends |= {pieces[-1][1]} if s else {pieces[-1][1], len(word)}
        yield s, sorted(e for e in ends if e - s >= LEAST)


def symbols(text: str) -> str:
    """Character classes: digit, hex letter, other lower, upper; the rest stand for themselves."""
    return "".join("0" if c.isdigit() else "a" if c in "abcdef" else "z" if c.islower() else "A" if c.isupper() else c for c in text)


class Automaton:
    """A probabilistic automaton by state merging over a prefix tree."""

    END = ""

    def __init__(self, words: Iterable[str], alpha: float = 0.05):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [defaultdict(int)]
        for word in words:
            self._add(symbols(word))
        self._fold(math.sqrt(0.5 * math.log(2 / alpha)))

    def _add(self, word: str) -> None:
        at = 0
        for c in word:
            self.count[at][c] += 1
            if c not in self.next[at]:
                self.next[at][c] = len(self.next)
                self.next.append({})
                self.count.append(defaultdict(int))
            at = self.next[at][c]
        self.count[at][self.END] += 1

    def _compatible(self, a: int, b: int, bound: float) -> bool:
        """Whether Hoeffding's bound lets both states, and those after them, be the same."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = sum(self.count[a].values()), sum(self.count[b].values())
            if not n or not m:
                continue
            most = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if most < 1:
                for c in self.count[a].keys() | self.count[b].keys():
                    if abs(self.count[a].get(c, 0) / n - self.count[b].get(c, 0) / m) > most:
                        return False
                todo += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys() if self.next[a][c] != self.next[b][c]]
            # Else both are too rare to tell apart, and so is all after the rarer one.
        return True

    def _merge(self, a: int, b: int, into: dict[int, int]) -> None:
        """Fold the tree below b into a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            into[b] = a
            for c, n in self.count[b].items():
                self.count[a][c] += n
            for c, child in self.next[b].items():
                if c in self.next[a]:
                    if self.next[a][c] != child:
                        todo.append((self.next[a][c], child))
                else:
                    self.next[a][c] = child

    def _fold(self, bound: float) -> None:
        red, into = [0], {}
        while True:
            blue = next(((r, c, b) for r in red for c, b in self.next[r].items() if b not in red), None)
            if blue is None:
                break
            parent, c, b = blue
            for r in red:
                if self._compatible(r, b, bound):
                    self.next[parent][c] = r
                    self._merge(r, b, into)
                    break
            else:
                red.append(b)
        self.states = len(red)
        total = {r: sum(self.count[r].values()) for r in red}
        self.log = {r: {c: math.log(n / total[r]) for c, n in self.count[r].items() if n} for r in red}
        self.next = [self.next[r] if r in total else {} for r in range(max(red) + 1)]
        del self.count

    def scores(self, word: str, start: int, stops: list[int]) -> Iterator[tuple[int, float]]:
        """For rising stops, the mean log likelihood of the symbols (of ``symbols``) up to there and the end, where it can be."""
        at, total, i = 0, 0.0, start
        for stop in stops:
            while i < stop:
                p = self.log[at].get(word[i])
                if p is None:
                    return
                total += p
                at = self.next[at][word[i]]
                i += 1
            p = self.log[at].get(self.END)
            if p is not None:
                yield stop, (total + p) / (stop - start + 1)

    def score(self, word: str) -> float:
        """Mean log likelihood of the word's symbols and its end; -inf if it can't be."""
        return next((score for _, score in self.scores(symbols(word), 0, [len(word)])), -math.inf)


def learn(credentials: dict[str, list[str]], share: float = 0.95, alpha: float = 0.05) -> dict[str, tuple[Automaton, float]]:
    """Per kind an automaton and the score that ``share`` of held-out credentials reach."""
    out = {}
    for kind, words in credentials.items():
        words = sorted(words, key=lambda w: hashlib.sha256(w.encode()).digest())
        fit, held = words[len(words) // 3 :], words[: len(words) // 3]
        if len(held) < 5:
            continue
        automaton = Automaton(fit, alpha)
        scores = sorted((automaton.score(w) for w in held), reverse=True)
        least = scores[min(len(scores) - 1, int(share * len(scores)))]
        finite = [s for s in scores if s > -math.inf]
        if finite:
            out[kind] = (automaton, max(least, finite[-1]))
    return out


def formatted(word: str, models: list[tuple[Automaton, float]]) -> list[tuple[int, int, float]]:
    """(start, stop, excess) of the parts of a run that pass a format: longer ones first, those that overlap them left out."""
    classes = symbols(word)
    # By how much a part passes the format that suits it best.
    best: dict[tuple[int, int], float] = {}
    for start, stops in parts(word):
        for automaton, least in models:
            for stop, score in automaton.scores(classes, start, stops):
                if score >= least:
                    best[start, stop] = max(best.get((start, stop), 0.0), score - least)
    kept: list[tuple[int, int, float]] = []
    free = bytearray(b"\1") * len(word) if len(best) > 1 else None
    for start, stop in sorted(best, key=lambda p: (p[0] - p[1], p[0])):
        # Kept parts are no shorter, so one that overlaps covers an end.
        if free is None or (free[start] and free[stop - 1]):
            kept.append((start, stop, best[start, stop]))
            if free is not None:
                free[start:stop] = bytes(stop - start)
    return sorted(kept)


def best_score(word: str, models: list[tuple[Automaton, float]]) -> float | None:
    """By how much a credential passes the format that suits it best, below 0 if it passes none; None if no format can make it."""
    scores = [automaton.score(word) - least for automaton, least in models]
    best = max(scores, default=-math.inf)
    return best if best > -math.inf else None


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = 1000, longest: int = 1024) -> DataFrame:
    """Secrets of each whole text.

    Returns doc_id, n_assign, n_access, n_hex, base_spans and extra_spans
    (strings of kind:start:end in code points, end exclusive), and for each of
    both the excess of its likelihood over the least of the format that suits
    it best: base_scores (null where no format can make it) and extra_scores.
    The automata learn from about ``bound`` different base findings per kind at
    most, chosen by a hash, of at most ``longest`` letters; all base findings
    and every other candidate are scored, however long they are.

    A null text is empty; a very long one is scanned whole; a null id stays
    null; repeated rows each give a row; extra columns are left out, whatever
    their names; with too few base findings nothing is added; an empty table
    gives an empty result.
    """
    docs = pick(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("word", pa.string())]))
    schema = pa.schema([("doc_id", pa.int64()), ("base", found), ("more", found)])
    ddl = "array<struct<kind:int,start:long,stop:long,word:string>>"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            base, more = [], []
            for text in batch.column(1).to_pylist():
                spans = base_spans(text or "")
                base.append([{"kind": k, "start": s, "stop": e, "word": w} for s, k, e, w in spans])
                more.append([{"kind": 3, "start": s, "stop": e, "word": w} for s, e, w in candidates(text or "", spans)])
            yield table(schema, [batch.column(0), base, more])

    rows = settle(docs.mapInArrow(scan, f"doc_id long, base {ddl}, more {ddl}"))

    words = rows.select(F.explode("base").alias("f")).select("f.kind", "f.word").where(F.length("word") <= longest).distinct()
    words = settle(words)
    # Three kinds, so three counts.
    counts = {r["kind"]: r["count"] for r in words.groupBy("kind").count().collect()}
    within = F.lit(False)
    for kind, n in counts.items():
        least = (1 << 30) if n <= bound else int(0.9 * bound / n * (1 << 30))
        within |= (F.col("kind") == kind) & (F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < least)
    credentials: dict[str, list[str]] = defaultdict(list)
    for r in words.where(within).collect():
        credentials[KINDS[r["kind"]]].append(r["word"])
    formats = learn(credentials)
    shared = df.sparkSession.sparkContext.broadcast(formats)

    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "extra_spans", "base_scores", "extra_scores"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.list_(pa.float64())] * 2
    out = pa.schema(list(zip(names, kinds, strict=True)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = list(shared.value.values())
        for batch in batches:
            got: list[list] = [[] for _ in range(7)]
            for base, more in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                kept, scores = [], []
                for c in more:
                    for start, stop, excess in formatted(c["word"], models):
                        kept.append(f"format:{c['start'] + start}:{c['start'] + stop}")
                        scores.append(excess)
                n = [sum(b["kind"] == k for b in base) for k in range(3)]
                spans = ",".join(f"{KINDS[b['kind']]}:{b['start']}:{b['stop']}" for b in base)
                likely = [best_score(b["word"], models) for b in base]
                for column, value in zip(got, [*n, spans, ",".join(kept), likely, scores], strict=True):
                    column.append(value)
            yield table(out, [batch.column(0), *got])

    return rows.mapInArrow(score, ", ".join(f"{c} long" for c in names[:4]) + ", base_spans string, extra_spans string, base_scores array<double>, extra_scores array<double>")


def secret_digests(df: DataFrame, **columns: str) -> DataFrame:
    """``find_secrets`` as doc_id, counts, base_sha256, spans (all, by start, then kind), and what the formats say.

    n_likely counts the base findings that pass a format, base_scores and
    format_scores have the excess of each base and each added span.
    """
    found = find_secrets(df, **columns)
    order = F.array(*[F.lit(k) for k in [*KINDS, "format"]])
    parts = F.split(F.concat_ws(",", F.nullif("base_spans", F.lit("")), F.nullif("extra_spans", F.lit(""))), ",")
    keyed = F.transform(
        F.filter(parts, lambda s: s != ""),
        lambda s: F.struct(
            F.split_part(s, F.lit(":"), F.lit(2)).cast("long").alias("start"),
            F.array_position(order, F.split_part(s, F.lit(":"), F.lit(1))).alias("kind"),
            s.alias("span"),
        ),
    )
    spans = F.array_join(F.transform(F.array_sort(keyed), lambda s: s["span"]), ",")
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans"), 256).alias("base_sha256"), spans.alias("spans"),
        F.size(F.filter("base_scores", lambda x: x >= 0)).cast("long").alias("n_likely"), "base_scores", F.col("extra_scores").alias("format_scores"),
    )
