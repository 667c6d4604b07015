"""Mixing sources to target weights, with DataFrame operations only.

Each document gets a hash-random key.  Within each source the keys are cut
into ranges (the keys are uniform, so ranges of equal width are even), the
ranges' word sums are added up in order, and only the one range in which a
source's budget ends is sorted row by row.  What a document gives then follows
from its key and its source's cut, so no text is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, beside, pick, restored, settle

SEED = 20_240_229
#: Rows that a key range holds on average.
RANGE_ROWS = 8192
#: Source tables up to this many rows are broadcast.
FEW_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, text: Column, seed: int) -> Column:
    """63 bits that depend on the row alone, so reruns agree."""
    return F.xxhash64(F.lit(seed), doc_id, text).bitwiseAND(F.lit((1 << 63) - 1))


def targets(sources: DataFrame, weights: Sequence[float], cap: float, share: float) -> DataFrame:
    """Adds target and budget to (source, source_size).

    Weights repeat over the sources by code point, null last.  Targets stop at
    ``cap`` times their source's size; the excess goes to the others by weight
    until none is above.  In the order of size / weight the capped sources
    come first, so one pass with running sums finds the common level.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn + 1).cast("int"))
    rows = (
        sources.withColumn("weight", w)
        .withColumn("most", F.lit(float(cap)) * F.col("source_size"))
        .withColumn("goal", F.lit(float(share)) * F.sum("source_size").over(everything))
    )
    rising = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onwards = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = (
        rows.withColumn("capped_before", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("place", F.row_number().over(rising))
        .withColumn("level", (F.col("goal") - F.col("capped_before")) / F.sum("weight").over(onwards))
    )
    free = F.when(F.col("level") * F.col("weight") < F.col("most"), F.col("place"))
    rows = rows.withColumn("first_free", F.min(free).over(everything)).withColumn(
        "level", F.max(F.when(F.col("place") == F.col("first_free"), F.col("level"))).over(everything)
    )
    target = F.when(F.col("place") < F.coalesce("first_free", F.lit(1 << 30)), F.col("most")).otherwise(
        F.least(F.col("most"), F.col("level") * F.col("weight"))
    )
    return rows.select("source", "source_size", target.alias("target")).withColumn("budget", F.round("target").cast("long"))


def source_cuts(sized: DataFrame, weights: Sequence[float], cap: float, share: float) -> DataFrame:
    """Per source: target, whole epochs, and the key at which the last epoch is cut.

    ``sized`` (source, size, key) must be cheap to read more than once.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = targets(sources, weights, cap, share)
    size = F.col("source_size")
    sources = settle(
        sources.withColumn("epochs", F.when(size > 0, F.floor(F.col("budget") / size)).otherwise(0).cast("long")).withColumn(
            "rest", F.col("budget") - F.col("epochs") * size
        )
    )
    few = sources.count() <= FEW_SOURCES
    near = F.broadcast if few else lambda df: df

    bits = min(30, max(6, (sized.count() // RANGE_ROWS).bit_length()))
    ranged = sized.withColumn("range", F.shiftright("key", 63 - bits))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("range")
    sums = sums.withColumn("after", F.sum("words").over(running)).withColumn("before", F.col("after") - F.col("words"))
    s, c = sums.alias("s"), sources.where("rest > 0").select("source", "rest").alias("c")
    hits = s.join(near(c), F.col("s.source").eqNullSafe(F.col("c.source"))).where("before < rest AND rest <= after")
    hits = hits.select("s.source", "range", (F.col("rest") - F.col("before")).alias("rest"))

    # One range of a source: bounded by the range's width, whatever the source's size.
    r, h = ranged.alias("r"), hits.alias("h")
    inside = r.join(near(h), F.col("r.source").eqNullSafe(F.col("h.source")) & (F.col("r.range") == F.col("h.range")))
    keys = inside.groupBy("r.source", "key", "rest").agg(F.sum("size").alias("words"), F.count("*").alias("copies"))
    in_order = Window.partitionBy("source").orderBy("key")
    keys = keys.withColumn("after", F.sum("words").over(in_order)).withColumn("before", F.col("after") - F.col("words"))
    cut = keys.where("before < rest AND rest <= after").select(
        F.col("source"),
        F.col("key").alias("cut_key"),
        (F.floor((F.col("rest") - F.col("before")) / F.col("copies"))).cast("long").alias("cut_words"),
    )
    a, b = sources.alias("a"), cut.alias("b")
    return settle(
        a.join(near(b), F.col("a.source").eqNullSafe(F.col("b.source")), "left").select(
            "a.source", "source_size", "target", "epochs", "cut_key", "cut_words"
        )
    )


def with_taken(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Joins each row's cut; taken: the words that the mix takes of it."""
    near = F.broadcast if cuts.count() <= FEW_SOURCES else lambda df: df
    r, c = rows.alias("r"), near(cuts).alias("c")
    joined = r.join(c, F.col("r.source").eqNullSafe(F.col("c.source"))).drop(F.col("c.source"))
    partly = (
        F.when(F.col("cut_key").isNull() | (F.col("key") > F.col("cut_key")), F.lit(0))
        .when(F.col("key") == F.col("cut_key"), F.col("cut_words"))
        .otherwise(F.col("size"))
    )
    return joined.withColumn("taken", (F.col("epochs") * F.col("size") + partly).cast("long"))


def sized_rows(df: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    docs = pick(df, doc_id=id_col, text=text_col, source=source_col)
    text = F.col("text").cast("string")
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), word_count(text).alias("size"), random_key(F.col("doc_id"), text, seed).alias("key")
    )


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    cap: float = 3,
    share: float = 1.0,
    seed: int = SEED,
) -> DataFrame:
    """Words to take of each document: doc_id, size, source_size, target, taken.

    A source's documents are taken whole in the order of their random keys, in
    ``target / source_size`` epochs; the one at which the budget ends is taken
    in part.  Null and empty texts have size 0, a very long one is cut like any
    other, a null source is a source of its own (the last), rows of equal key
    (those that repeat id and text) are cut alike, extra columns are left out,
    whatever their names, an empty table gives an empty result.
    """
    sized = settle(sized_rows(df, id_col, text_col, source_col, seed))
    cuts = source_cuts(sized, weights, cap, share)
    return with_taken(sized, cuts).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(df: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3, share: float = 1.0, seed: int = SEED) -> DataFrame:
    """The mixed documents themselves, with the columns of ``documents``.

    A document taken more than once is repeated; one taken in part keeps its
    first words, joined by spaces.  Null, empty and wordless texts give nothing;
    very long ones are taken like others; a null source is the last source;
    rows that repeat id and text have one key, so they are cut alike; an empty
    table gives an empty result.  Columns keep their places, whatever their
    names.
    """
    sized = settle(sized_rows(df, "doc_id", "text", "source", seed))
    cuts = source_cuts(sized, weights, cap, share)
    rows = beside(df, doc_id="doc_id", text="text", source="source").withColumn("text", F.col("text").cast("string")).withColumn("source", F.col("source").cast("string"))
    rows = rows.withColumn("key", random_key(F.col("doc_id"), F.col("text"), seed)).withColumn("size", word_count(F.col("text")))
    rows = with_taken(rows, cuts).where("taken > 0")
    whole = F.floor(F.col("taken") / F.col("size"))
    part = F.col("taken") - whole * F.col("size")
    rows = rows.withColumn("whole", whole.cast("int")).withColumn("part", part.cast("int"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("whole") + F.when(F.col("part") > 0, 1).otherwise(0))))
    first = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("part")), " ")
    rows = rows.withColumn("text", F.when(F.col("copy") > F.col("whole"), first).otherwise(F.col("text")))
    return restored(rows.withColumn("n_chars", F.char_length("text").cast("long")), df, text="text", n_chars="n_chars")
