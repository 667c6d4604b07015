"""Toxicity, line dedup, near-dedup and the pipeline."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm.common import tidy
from gridloom.llm.line_dedup import dedup_lines, deduped_documents
from gridloom.llm.minhash import near_duplicates, without_copies
from gridloom.llm.toxicity import Counts, fit, present, toxicity, without_toxic

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# -- toxicity --


def test_features_stay_within_a_text():
    every = np.ones(1 << 20, bool)
    alone = [present([t], every)[1] for t in (b"Abc def", b"", b"ghi")]
    text, slot = present([b"Abc def", b"", b"ghi"], every)
    for k in range(3):
        assert sorted(slot[text == k]) == sorted(alone[k])
    assert sorted(present([b"ABC\tdef"], every)[1]) == sorted(alone[0])


def test_toxicity_learns(spark, odd, none):
    rng = np.random.default_rng(1)
    words = ["river", "stone", "cloud", "green", "walk", "seven", "letter", "morning"]
    rows, marks = [], []
    for k in range(600):
        text = list(rng.choice(words, 60))
        if toxic := k % 4 == 0:
            text[int(rng.integers(60))] = str(rng.choice(["nastyword", "Vileterm", "FOULNAME"]))
        rows.append((k, " ".join(text)))
        marks.append((k, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity(docs, labels).collect()}
    assert len(got) == 600 and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(r["predicted"], i % 4 == 0) for i, r in got.items() if r["held_out"]]
    assert np.mean([p == t for p, t in held]) > 0.97
    kept = {r["doc_id"] for r in without_toxic(docs, labels).collect()}
    assert np.mean([(i in kept) == (i % 4 != 0) for i in range(600)]) > 0.97
    scored = toxicity(odd, labels).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity(none, labels.limit(0)).count() == 0 and toxicity(odd, labels.limit(0)).count() == odd.count()


def test_fit_converges():
    """The gradient of the loss at the fitted weights, computed anew, is next to nothing."""
    rng = np.random.default_rng(4)
    rate = 0.4 / (1 + np.arange(3000) / 20)
    toxic = np.arange(1200) < 600
    has = rng.random((1200, 3000)) < rate * np.where(toxic[:, None] & (np.arange(3000) % 7 == 0), 2, 1)
    counts = Counts(has[toxic].sum(0).astype(float), has[~toxic].sum(0).astype(float), 600, 600)
    chosen = np.flatnonzero(has.sum(0) >= 3)
    model = fit([chosen[r[chosen]] for r in has], toxic, counts, chosen, 0.5)
    ratio = counts.ratio(1.0)[chosen]
    x, w = has[:, chosen] * ratio, np.divide(model.weights[chosen], ratio, out=np.zeros(chosen.size), where=ratio != 0)
    p = 1 / (1 + np.exp(-(x @ w + model.bias)))
    gradient = np.append(x.T @ (p - toxic) / 1200 + 1e-3 * w, (p - toxic).mean())
    assert np.linalg.norm(gradient) < 1.01e-4


# -- line dedup --


def brute_deletions(texts, least):
    """All runs of whole lines with enough words that stand earlier too."""
    seqs = [[(k, line, len(line.split())) for k, line in enumerate(t.split("\n")) if line.split()] for t in texts]
    runs = collections.defaultdict(list)
    for d, s in enumerate(seqs):
        for a in range(len(s)):
            for b in range(a, len(s)):
                if sum(x[2] for x in s[a : b + 1]) >= least:
                    runs[tuple(x[1] for x in s[a : b + 1])].append((d, a, b))
    gone = collections.defaultdict(set)
    for places in runs.values():
        for d, a, b in sorted(places)[1:]:
            gone[d].update(x[0] for x in seqs[d][a : b + 1])
    return ["\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d]) for d, t in enumerate(texts)]


@pytest.mark.parametrize("seed", range(3))
def test_lines_are_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    lines = ["a b c", "d e", "f", "g h i j k", "", "l m", "n o p q"]
    texts = ["\n".join(rng.choice(lines, rng.integers(1, 14))) for _ in range(25)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in dedup_lines(df, min_words=12).collect()}
    assert [got[k] for k in range(25)] == brute_deletions(texts, 12)


def test_passages_go_and_clean_texts_stay(spark, odd, none):
    passage = "\n".join(" ".join(f"p{i}w{j}" for j in range(20)) for i in range(3)) + "\nlast bit"
    rows = [(1, f"one start\n{passage}\none end"), (2, f"two start\n{passage}\ntwo end"), (3, "short line\nother"), (4, "short line\nother"), (5, passage)]
    got = {r["doc_id"]: r for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["text"] == rows[0][1] and got[2]["text"] == "two start\ntwo end" and got[2]["n_deleted"] == 4
    assert got[3]["text"] == got[4]["text"] == "short line\nother" and got[5]["text"] == ""
    out = dedup_lines(odd).collect()
    assert len(out) == odd.count() and dedup_lines(none).count() == 0
    full = spark.createDataFrame([(*r, "en", "s", 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = deduped_documents(full)
    assert left.columns == full.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 2, 3, 4]
    assert all(r["n_chars"] == len(r["text"]) for r in left.collect())


# -- near-duplicates --


def brute_components(texts):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = set(zip(*[w[k:] for k in range(5)], strict=False)) if len(w) >= 5 else {tuple(w)} if w else set()
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                comp[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def check_components(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(df).collect()}
    assert got == brute_components(texts)
    return df


def test_near_duplicates_are_brute_force(spark, docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    df = check_components(spark, texts)
    assert {r["doc_id"] for r in without_copies(df).collect()} == {i for i, (_, _, kept) in brute_components(texts).items() if kept}


def test_groups_of_near_copies(spark):
    """A large group whose members differ among themselves, chains, and copies of copies."""
    rng = np.random.default_rng(8)
    base = [f"w{k}" for k in range(120)]
    texts = {}
    for i in range(150):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 6), replace=False):
            words[at] = f"e{rng.integers(10**6)}"
        texts[i] = " ".join(words)
    texts |= {200 + i: " ".join(f"c{k}" for k in range(12 * i, 12 * i + 110)) for i in range(8)}
    texts |= {300: "", 301: " ", 302: "One two", 303: "one TWO", 304: "one two three", 305: None}
    check_components(spark, texts)


def test_near_duplicates_of_odd_rows(odd, none, spark):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count() and all(r["component_id"] is None and r["kept"] for r in rows if r["doc_id"] is None)
    assert near_duplicates(none).count() == 0
    left = [r["doc_id"] for r in without_copies(odd.select("doc_id", F.col("lang"), "source", "n_chars").withColumn("text", F.lit("same words for all of these"))).collect()]
    assert left.count(1) == 1 and set(left) == {1, None}
    # One id with two texts joins what either is like.
    long = [" ".join(f"{c}{k}" for k in range(30)) for c in "ab"]
    df = spark.createDataFrame([(1, long[0]), (2, long[0]), (2, long[1]), (3, long[1])], "doc_id long, text string")
    assert {r["component_id"] for r in near_duplicates(df).collect()} == {1}


def test_tidy_gives_the_drivers_heap_back(spark):
    """A heap that was large once stays no larger than what is in use asks for; the JVM's limit is as before."""
    jvm = spark.sparkContext._jvm
    management = jvm.java.lang.management.ManagementFactory
    options = management.getPlatformMXBean(jvm.java.lang.Class.forName("com.sun.management.HotSpotDiagnosticMXBean"))
    limit = options.getVMOption("MaxHeapFreeRatio").getValue()
    large = jvm.java.util.ArrayList()
    large.ensureCapacity(1 << 28)
    large.trimToSize()
    tidy(spark)
    heap = management.getMemoryMXBean().getHeapMemoryUsage()
    assert heap.getCommitted() < 2.5 * heap.getUsed()
    assert options.getVMOption("MaxHeapFreeRatio").getValue() == limit


# -- pipeline --


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = docs
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, k
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.count() and (k == 3 or docs.count() <= before.count())
    again = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    ids = {r["doc_id"] for r in rows}
    assert ids <= {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
