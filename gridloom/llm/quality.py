"""Quality rules: a learned decision list over text statistics.

Sequential covering grows one conjunction of thresholds after the other on two
thirds of the labelled rows, prunes it on the rest, and stops when no further
rule is precise enough.  The list becomes one ordered Spark conditional
expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, settle, slices, table
from .fingerprints import shingles

SYMBOLS = b"#*$%&|<>"
BLANKS = bytes([32, *range(9, 14)])
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct"]
#: Features that rules may use, as expressions of the counts.
FEATURES = {
    "symbols_per_word": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "upper_share": "n_upper / word_chars",
    "digit_share": "n_digits / word_chars",
    "marks_per_word": "n_marks / n_words",
    "mean_word_chars": "word_chars / n_words",
    "distinct_share": "n_distinct / n_words",
    "words_per_line": "n_words / n_lines",
}


def statistics(text: str) -> tuple[int, ...]:
    """The counts of one whole text, in the order of COUNTS."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    bytes_of = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = len(text) - int(bytes_of[list(BLANKS)].sum())
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            lines += 1
            dup += line in seen
            seen.add(line)
    repeated = 0
    if n >= 5:
        hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
        _, at, count = np.unique(shingles(hashes, 5), return_inverse=True, return_counts=True)
        again = count[at] > 1
        if again.any():
            edge = np.zeros(n + 1, np.int32)
            edge[: again.size] += again
            edge[5 : 5 + again.size] -= again
            repeated = int((np.cumsum(edge)[:n] > 0).sum())
    upper, digits = int(bytes_of[65:91].sum()), int(bytes_of[48:58].sum())
    return (n, chars, int(bytes_of[list(SYMBOLS)].sum()), dup, repeated, lines, upper, digits, int(bytes_of[33]), len(set(words)))


def text_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and COUNTS of each whole text; a null text has no words."""
    docs = pick(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", *COUNTS)])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [statistics(t or "") for t in batch.column(1).to_pylist()]
            yield table(schema, [batch.column(0), *zip(*rows, strict=True)])

    return docs.mapInArrow(part, ", ".join(f"{c} long" for c in ("doc_id", *COUNTS)))


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def on(self, values: np.ndarray) -> np.ndarray:
        return values >= self.threshold if self.above else values <= self.threshold

    def sql(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold!r}D"


Rule = tuple[Test, ...]


def covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(next(iter(x.values())).size, bool)
    for t in rule:
        out &= t.on(x[t.feature])
    return out


def grow(x: dict[str, np.ndarray], bad: np.ndarray, longest: int) -> Rule:
    """Add the test of the highest information gain until no good row is covered."""
    rule: list[Test] = []
    inside = np.ones(bad.size, bool)
    while len(rule) < longest and (inside & ~bad).any() and (inside & bad).any():
        p0, n0 = int((inside & bad).sum()), int(inside.sum())
        best, top = None, 1e-9
        for name, values in x.items():
            v, b = values[inside], bad[inside]
            order = np.argsort(v, kind="stable")
            v, b = v[order], b[order]
            cut = np.flatnonzero(np.diff(v)) + 1
            if not cut.size:
                continue
            below = np.cumsum(b)[cut - 1]
            middle = (v[cut - 1] + v[cut]) / 2
            for above, p, n in ((True, p0 - below, n0 - cut), (False, below, cut)):
                share = np.maximum(p, 1e-9) / n
                gain = p * (np.log2(share) - np.log2(p0 / n0))
                k = int(np.argmax(gain))
                if gain[k] > top:
                    best, top = Test(name, above, float(middle[k])), float(gain[k])
        if best is None:
            break
        rule.append(best)
        inside &= best.on(x[best.feature])
    return tuple(rule)


def prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Drop final tests while that doesn't lower (p - n) / (p + n) on other rows."""

    def worth(r: Rule) -> float:
        inside = covers(r, x)
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
        rule = rule[:-1]
    return rule


def learn(x: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.97, most: int = 16, longest: int = 4) -> list[Rule]:
    """An ordered list of conjunctions under which a text is bad."""
    rules: list[Rule] = []
    x, bad = dict(x), bad.copy()
    for _ in range(most):
        if bad.sum() < 3:
            break
        held = np.arange(bad.size) % 3 == 0
        part = lambda m: {k: v[m] for k, v in x.items()}  # noqa: B023, E731
        rule = grow(part(~held), bad[~held], longest)
        if not rule:
            break
        rule = prune(rule, part(held), bad[held])
        inside = covers(rule, x)
        hit = int((inside & bad).sum())
        if hit < 3 or hit < precision * inside.sum():
            break
        rules.append(rule)
        x, bad = part(~inside), bad[~inside]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional expression: true keeps."""
    if not rules:
        return F.lit(True)
    out = None
    for rule in rules:
        test = F.expr(" AND ".join(t.sql() for t in rule))
        out = F.when(test, False) if out is None else out.when(test, False)
    return out.otherwise(True)


def hash_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of the key."""
    n = df.count()
    if n <= bound:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit(7), key), F.lit(1 << 30)) < int(0.97 * bound / n * (1 << 30)))


def quality_rules(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    bound: int = 20_000,
    precision: float = 0.97,
) -> DataFrame:
    """Statistics and verdict of each text.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, rule (number of the rule that rejects,
    from 1).  Rules are learned from at most about ``bound`` labelled rows
    (label 0: bad), chosen by a hash of their id; a rule must reach
    ``precision`` on them.  Without labels nothing but the base rule rejects.

    A null or empty text has no words and fails the base rule; a very long one
    is counted whole; ids may be null or repeat, and an id is learned from
    once; extra columns are left out, whatever their names; labels of null ids or values are ignored and, of several labels,
    the lowest counts; an empty table gives an empty result.
    """
    counts = settle(text_statistics(df, id_col, text_col))
    feature = lambda e: F.coalesce(F.expr("try_divide(" + e.replace("/", ",") + ")").cast("double"), F.lit(0.0))
    rows = counts.select("doc_id", *COUNTS, *[feature(e).alias(k) for k, e in FEATURES.items()])

    marked = pick(labels, doc_id=id_col, label=label_col).where("doc_id IS NOT NULL AND label IS NOT NULL")
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("label").alias("label"))
    sample = hash_sample(marked, "doc_id", bound).join(rows, "doc_id").where("n_words >= 10")
    # One row for each id, the least, so that rows that repeat an id don't add to the sample.
    one = sample.groupBy("doc_id", "label").agg(F.min(F.struct(*FEATURES)).alias("f")).select("doc_id", "label", "f.*")
    got = one.select("doc_id", "label", *FEATURES).toArrow().sort_by("doc_id")
    x = {k: got.column(k).to_numpy() for k in FEATURES}
    rules = learn(x, got.column("label").to_numpy() == 0, precision) if got.num_rows else []

    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    number = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        number = F.when(F.expr(" AND ".join(t.sql() for t in rule)), i).otherwise(number)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"), F.when(~failed, number).alias("rule"),
    )
