"""Licence notices by diagonal voting, with DataFrame operations only.

The rolling word 3-gram hashes of a text are joined to the positions at which
licence templates have them.  Hits of one template whose offset (place in the
text less place in the template) is the same lie on a diagonal; neighbouring
diagonals, which an inserted or missing word sets apart, are merged, and a
span counts if its verified words cover enough of the template.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let, pick, settle
from .license_texts import NOTICES, TEXTS

K = 3
#: A diagonal may shift by so many words within one span: a name for "the copyright holder", a version that has more.
SHIFT = 8
#: Share of a template's k-grams that a diagonal must have to count.
VOTES = 0.03
#: Bits of the table that tells which hashes no template has.
BITS = 18
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
PHRASES = [
    (("gnu", "general", "public", "license"), "gpl"),
    (("apache", "license"), "apache"),
    (("cc", "by"), "cc-by"),
    (("mit", "license"), "mit"),
]

#: Whole texts and short notices, as words.
TEMPLATES = [(re.findall(r"[a-z0-9]+", text.lower()), label) for text, label in TEXTS + NOTICES]


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, GAPS), "")


def gram(words: Column, i: Column) -> list[Column]:
    return [F.get(words, i + j) for j in range(K)]


def places(words: Column, count: Column, least: int, test) -> Column:
    """Positions, of ``count`` less ``least`` + 1, where the test holds."""
    none = F.array().cast("array<int>")
    return F.when(count >= least, F.filter(F.sequence(F.lit(0), count - least), test)).otherwise(none)


def template_positions(spark: SparkSession) -> DataFrame:
    """hash, words, template, tpos, grams (its number of k-grams), label: a constant table of a row for each word of the templates."""
    rows = []
    for t, (words, label) in enumerate(TEMPLATES):
        n = len(words) - K + 1
        rows += [(words[i : i + K], t, i, n, label) for i in range(n)]
    df = spark.createDataFrame(rows, "words array<string>, template int, tpos int, grams int, label string")
    return df.withColumn("hash", F.xxhash64(*[F.get("words", F.lit(j)) for j in range(K)]))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.6) -> DataFrame:
    """Licence notices of each whole text.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, spans.  Base phrases are found exactly; templates whose
    k-grams are covered by at least ``least`` add their labels.  The score is
    the best coverage, 1 for a base phrase.  spans lists (label, first_word,
    end_word, coverage) of the templates found.

    Templates are whole licence texts and short notices.  A span may lack or
    add words; it is one as long as neighbouring diagonals are no further
    apart than SHIFT.  Of spans that overlap, one goes if another template has
    more of itself there and as many words at least.

    A null text is empty: no words, no labels, score 0.  A very long text is
    scanned whole.  Null ids stay null, repeated rows each give a row, extra
    columns are left out, whatever their names, an empty table gives an empty
    result.
    """
    spark = df.sparkSession
    templates = template_positions(spark)
    # As many hashes as the templates have k-grams.
    bitmap = bytearray(1 << BITS)
    for r in templates.select("hash").distinct().collect():
        bitmap[r["hash"] % (1 << BITS)] = 1
    bits, one = F.lit(bytes(bitmap)), F.lit(b"\1")

    starts = "|".join(sorted({p[0] for p, _ in PHRASES}))
    nexts = "|".join(sorted({p[1] for p, _ in PHRASES}))
    maybe_base = f"({starts}){GAPS}({nexts})"

    def per_text(text: Column, words: Column, n: Column) -> Column:
        may_match = lambda i: F.substring(bits, (F.pmod(F.xxhash64(*gram(words, i)), F.lit(1 << BITS)) + 1).cast("int"), F.lit(1)) == one
        hits = F.transform(
            places(words, n, K, may_match), lambda i: F.struct(i.alias("pos"), F.array(*gram(words, i)).alias("words"))
        )

        def base_of(phrase: tuple[str, ...], label: str) -> Column:
            def test(i: Column) -> Column:
                out = F.get(words, i) == phrase[0]
                for j, w in enumerate(phrase[1:], 1):
                    out = out & (F.get(words, i + j) == w)
                return out

            return F.transform(places(words, n, len(phrase), test), lambda i: F.struct(i.alias("pos"), F.lit(label).alias("label")))

        base = F.concat(*[base_of(p, label) for p, label in PHRASES])
        base = F.when(text.rlike(maybe_base), base)
        return F.struct(n.alias("n_words"), base.alias("base"), hits.alias("hits"))

    docs = pick(df, doc_id=id_col, text=text_col)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = let(lowered(text), lambda t: let(split_words(t), lambda w: let(F.size(w), lambda n: per_text(t, w, n))))
    rows = settle(
        docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), found.alias("f")).select(
            "rid", "doc_id", "f.n_words", "f.base", "f.hits"
        )
    )

    hits = rows.select("rid", F.inline("hits")).withColumn("hash", F.xxhash64(*[F.get("words", F.lit(j)) for j in range(K)]))
    h, t = hits.alias("h"), F.broadcast(templates).alias("t")
    votes = h.join(t, (F.col("h.hash") == F.col("t.hash")) & (F.col("h.words") == F.col("t.words")))
    diagonals = (
        votes.select("rid", "template", "label", "grams", "pos", "tpos", (F.col("pos") - F.col("tpos")).alias("diagonal"))
        .groupBy("rid", "template", "label", "grams", "diagonal")
        .agg(F.collect_set("tpos").alias("tpos"), F.min("pos").alias("first"), F.max("pos").alias("last"))
        # A few chance votes don't tie diagonals together.
        .where(F.size("tpos") >= F.greatest(F.lit(1), F.floor(F.col("grams") * F.lit(VOTES))))
    )
    along = Window.partitionBy("rid", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > SHIFT, F.lit(True))
    spans = (
        diagonals.withColumn("apart", apart.cast("int"))
        .withColumn("span", F.sum("apart").over(along))
        .groupBy("rid", "template", "label", "grams", "span")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("tpos")))).alias("covered"), F.min("first").alias("first"), F.max("last").alias("last"))
        .withColumn("coverage", F.col("covered") / F.col("grams"))
        # A merged span can't be much longer than its template.
        .where((F.col("coverage") >= least) & (F.col("last") - F.col("first") < 2 * F.col("grams") + SHIFT))
    )
    span = F.struct("label", F.col("first").alias("first_word"), (F.col("last") + K).alias("end_word"), "coverage", "covered")
    every = spans.groupBy("rid").agg(F.sort_array(F.collect_list(span)).alias("every"))
    # Of licences that share their words, the one that has more of itself there stands.
    better = lambda o, s: (o["coverage"] > s["coverage"]) & (o["covered"] >= s["covered"]) & (o["first_word"] < s["end_word"]) & (s["first_word"] < o["end_word"])
    kept = F.filter("every", lambda s: ~F.exists("every", lambda o: better(o, s)))
    found = every.select("rid", F.transform(kept, lambda s: s.dropFields("covered")).alias("spans"))
    found = found.select("rid", "spans", F.array_distinct(F.transform("spans", lambda s: s["label"])).alias("found"), F.array_max(F.transform("spans", lambda s: s["coverage"])).alias("coverage"))
    none = F.array().cast("array<int>")
    return F.when(count >= least, F.filter(F.sequence(F.lit(0), count - least), test)).otherwise(none)


def template_positions(spark: SparkSession) -> DataFrame:
    """hash, words, template, tpos, grams (its number of k-grams), label: a constant table of a row for each word of the templates."""
    rows = []
    for t, (words, label) in enumerate(TEMPLATES):
        n = len(words) - K + 1
        rows += [(words[i : i + K], t, i, n, label) for i in range(n)]
    df = spark.createDataFrame(rows, "words array<string>, template int, tpos int, grams int, label string")
    return df.withColumn("hash", F.xxhash64(*[F.get("words", F.lit(j)) for j in range(K)]))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.6) -> DataFrame:
    """Licence notices of each whole text.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, spans.  Base phrases are found exactly; templates whose
    k-grams are covered by at least ``least`` add their labels.  The score is
    the best coverage, 1 for a base phrase.  spans lists (label, first_word,
    end_word, coverage) of the templates found.

    Templates are whole licence texts and short notices.  A span may lack or
    add words; it is one as long as neighbouring diagonals are no further
    apart than SHIFT.  Of spans that overlap, one goes if another template has
    more of itself there and as many words at least.

    A null text is empty: no words, no labels, score 0.  A very long text is
    scanned whole.  Null ids stay null, repeated rows each give a row, extra
    columns are left out, whatever their names, an empty table gives an empty
    result.
    """
    spark = df.sparkSession
    templates = template_positions(spark)
    # As many hashes as the templates have k-grams.
    bitmap = bytearray(1 << BITS)
    for r in templates.select("hash").distinct().collect():
        bitmap[r["hash"] % (1 << BITS)] = 1
    bits, one = F.lit(bytes(bitmap)), F.lit(b"\1")

    starts = "|".join(sorted({p[0] for p, _ in PHRASES}))
    nexts = "|".join(sorted({p[1] for p, _ in PHRASES}))
    maybe_base = f"({starts}){GAPS}({nexts})"

    def per_text(text: Column, words: Column, n: Column) -> Column:
        may_match = lambda i: F.substring(bits, (F.pmod(F.xxhash64(*gram(words, i)), F.lit(1 << BITS)) + 1).cast("int"), F.lit(1)) == one
        hits = F.transform(
            places(words, n, K, may_match), lambda i: F.struct(i.alias("pos"), F.array(*gram(words, i)).alias("words"))
        )

        def base_of(phrase: tuple[str, ...], label: str) -> Column:
            def test(i: Column) -> Column:
                out = F.get(words, i) == phrase[0]
                for j, w in enumerate(phrase[1:], 1):
                    out = out & (F.get(words, i + j) == w)
                return out

            return F.transform(places(words, n, len(phrase), test), lambda i: F.struct(i.alias("pos"), F.lit(label).alias("label")))

        base = F.concat(*[base_of(p, label) for p, label in PHRASES])
        base = F.when(text.rlike(maybe_base), base)
        return F.struct(n.alias("n_words"), base.alias("base"), hits.alias("hits"))

    docs = pick(df, doc_id=id_col, text=text_col)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = let(lowered(text), lambda t: let(split_words(t), lambda w: let(F.size(w), lambda n: per_text(t, w, n))))
    rows = settle(
        docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), found.alias("f")).select(
            "rid", "doc_id", "f.n_words", "f.base", "f.hits"
        )
    )

    hits = rows.select("rid", F.inline("hits")).withColumn("hash", F.xxhash64(*[F.get("words", F.lit(j)) for j in range(K)]))
    h, t = hits.alias("h"), F.broadcast(templates).alias("t")
    votes = h.join(t, (F.col("h.hash") == F.col("t.hash")) & (F.col("h.words") == F.col("t.words")))
    diagonals = (
        votes.select("rid", "template", "label", "grams", "pos", "tpos", (F.col("pos") - F.col("tpos")).alias("diagonal"))
        .groupBy("rid", "template", "label", "grams", "diagonal")
        .agg(F.collect_set("tpos").alias("tpos"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    )
    along = Window.partitionBy("rid", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > SHIFT, F.lit(True))
    spans = (
        diagonals.withColumn("apart", apart.cast("int"))
        .withColumn("span", F.sum("apart").over(along))
        .groupBy("rid", "template", "label", "grams", "span")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("tpos")))).alias("covered"), F.min("first").alias("first"), F.max("last").alias("last"))
        .withColumn("coverage", F.col("covered") / F.col("grams"))
        # A merged span can't be much longer than its template.
        .where((F.col("coverage") >= least) & (F.col("last") - F.col("first") < 2 * F.col("grams") + SHIFT))
    )
    found = spans.groupBy("rid").agg(
        F.collect_set("label").alias("found"),
        F.max("coverage").alias("coverage"),
        F.sort_array(F.collect_list(F.struct("label", F.col("first").alias("first_word"), (F.col("last") + K).alias("end_word"), "coverage"))).alias("spans"),
    )
    none = F.array().cast("array<string>")
    base = F.col("base")
    base_labels = F.coalesce(F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"]))), none)
    return rows.join(found, "rid", "left").select(
        "doc_id",
        F.col("n_words").cast("long"),
        F.coalesce(F.size(base), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["pos"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["pos"])).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, F.coalesce("found", none))), ",").alias("labels"),
        F.when(F.size(base) > 0, 1.0).otherwise(F.coalesce("coverage", F.lit(0.0))).alias("score"),
        "spans",
    )
