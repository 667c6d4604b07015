"""The pipeline's stages on odd rows, and the whole of it against a plain version; SQL of the text queries."""

import collections
import re
import zlib

import numpy as np
import pytest
from compare import database, differences

import corpus_pipeline
from gridloom.llm import queries as text_queries
from gridloom.llm.common import documents, labels
from gridloom.llm.line_dedup import deduped_documents
from gridloom.llm.minhash import without_copies
from gridloom.llm.mixing import mixed_documents
from gridloom.llm.packing import pack
from gridloom.llm.tokens import vocabulary_path
from gridloom.llm.toxicity import GAP, ORDERS, SLOTS, grams, toxicity, train, without_toxic

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, `KEY` string, score string, `__0` string, kept_id long, `tie` long"


@pytest.fixture(scope="module")
def marks(spark):
    return spark.createDataFrame([(k, 1, k % 2) for k in range(40)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def odd_documents(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, and clashing names."""
    base = [(k, f"text number {k} " + " ".join(f"w{k}x{j}" for j in range(30)) + (" nastyword" if k % 2 else ""), "en", f"s{k % 3}", 0) for k in range(40)]
    base += [(100, None, "en", "s0", None), (101, "", None, "s1", 0), (102, " \n\t ", "en", None, 3), (None, "no id here but " + "words " * 30, "en", "s0", 1)]
    base += [(103, "y" * 70_000 + " " + "z " * 30_000, "en", "s0", 5), (104, "same row twice, word for word, in both", "en", "s1", 1), (104, "same row twice, word for word, in both", "en", "s1", 1), (104, "the same id and another text", "de", "s2", 1)]
    return spark.createDataFrame([(*r, "X", "k", "s", "zero", -5, None) for r in base], SCHEMA)


STAGES = {
    "toxicity": lambda df, marks: without_toxic(df, marks),
    "lines": lambda df, marks: deduped_documents(df),
    "copies": lambda df, marks: without_copies(df),
    "mixing": lambda df, marks: mixed_documents(df),
}


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns_and_cope(spark, marks, name):
    df = odd_documents(spark)
    out = STAGES[name](df, marks)
    assert out.columns == df.columns and [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
    rows = out.collect()
    # What clashes in name comes through as it was.
    assert rows and all(tuple(r)[5:] == ("X", "k", "s", "zero", -5, None) for r in rows)
    ids = [r[0] for r in rows]
    if name == "toxicity":
        assert {100, 101, 102, 103, None} <= set(ids) and ids.count(104) == 3
    if name == "lines":
        assert sorted(map(str, ids)) == sorted(str(r[0]) for r in df.collect()) and [r[1] for r in rows if r[0] == 100] == [None]
    if name == "copies":
        assert ids.count(104) == 1 and ids.count(None) == 1 and {100, 101, 102, 103} <= set(ids)
    if name == "mixing":
        assert not {100, 101, 102} & set(ids) and None in ids and all(r[4] == len(r[1]) for r in rows)
    assert STAGES[name](df.limit(0), marks).count() == 0
    assert STAGES[name](df.limit(0), marks.limit(0)).columns == df.columns


def test_packing_copes(spark):
    rows = pack(odd_documents(spark)).collect()
    assert [(r["length"], r["offset"] >= 0) for r in rows if r["doc_id"] in (100, 101, 102)] == [(1, True)] * 3
    assert sum(r["doc_id"] == 104 for r in rows) == 3 and sum(r["doc_id"] is None for r in rows) == 1


def plain_score(model, text):
    """Distinct n-grams of one text, each looked up alone."""
    fold = bytes(32 if b in (0, 9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in text)
    marked = GAP + fold + GAP
    slots = set()
    for n in ORDERS:
        for i in range(len(marked) - n + 1):
            gram = marked[i : i + n]
            if b"\0" not in gram:
                slots.add(int(grams(np.frombuffer(gram, np.uint8), n)[0]))
    total = model.bias + sum(float(model.weights[s]) for s in slots)
    return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def test_toxicity_is_plain_lookups(spark):
    docs, marks = documents(spark, SF), labels(spark, SF)
    model = train(docs, marks)
    assert model.slots.size and model.slots.max() < SLOTS
    got = {r["doc_id"]: r for r in toxicity(docs, marks).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i in sorted(texts)[:25]:
        assert got[i]["score"] == pytest.approx(float(plain_score(model, (texts[i] or "").encode())), abs=1e-9)
    # A text that repeats its id, however often, is learned from once.
    often = docs.union(docs.where("doc_id % 3 = 0")).union(docs.where("doc_id % 3 = 0"))
    again = train(often, marks)
    assert (again.slots == model.slots).all() and again.values == pytest.approx(model.values, abs=1e-6)


@pytest.mark.parametrize("name", sorted(text_queries.oracle_sql()))
def test_text_query_is_its_sql(spark, name):
    assert differences(text_queries.queries()[name](spark, SF), database(SF), text_queries.oracle_sql()[name]) is None


# -- the pipeline in plain Python -------------------------------------------


def plain_lines(rows, least=50):
    runs, order = collections.defaultdict(list), sorted(rows)
    lines = {i: [(k, x, len(x.split())) for k, x in enumerate(rows[i].split("\n")) if re.search(WORD, x)] for i in order}
    for i in order:
        for a in range(len(lines[i])):
            total = 0
            for b in range(a, len(lines[i])):
                total += lines[i][b][2]
                if total >= least:
                    runs[tuple(x[1] for x in lines[i][a : b + 1])].append((i, a, b))
    gone = collections.defaultdict(set)
    for places in runs.values():
        for i, a, b in places[1:]:
            gone[i].update(x[0] for x in lines[i][a : b + 1])
    out = {}
    for i in order:
        text = "\n".join(x for k, x in enumerate(rows[i].split("\n")) if k not in gone[i])
        if not gone[i] or re.search(WORD, text):
            out[i] = text
    return out


def plain_copies(rows):
    sets = {}
    for i, t in rows.items():
        w = re.findall(WORD, t.translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(rows)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: t for i, t in rows.items() if find(i) == i}


def test_pipeline_is_plain(spark):
    """Every stage but the model's scores and the mix's random cut anew; those are held to what they must be."""
    from tokenizers import Tokenizer

    docs, marks = documents(spark, SF), labels(spark, SF)
    raw = {r["doc_id"]: r for r in docs.collect()}
    model = train(docs, marks, held_out=False)
    clean = {i: r["text"] for i, r in raw.items() if plain_score(model, r["text"].encode()[:400_000]) < 0.5}
    toxic = {r["doc_id"]: r["toxic"] for r in marks.collect()}
    assert np.mean([i in clean for i, t in toxic.items() if t == 0]) > 0.97 and np.mean([i not in clean for i, t in toxic.items() if t == 1]) > 0.8
    left = plain_copies(plain_lines(clean))
    rows = corpus_pipeline.run(spark, SF).collect()
    size = {i: len(re.findall(WORD, t)) for i, t in left.items()}
    by_source = collections.Counter()
    for i, n in size.items():
        by_source[raw[i]["source"]] += n
    # A source keeps a share of its words or takes them several times over.
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    fixed = {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = sum(by_source.values()) - sum(fixed.values())
        goal = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if goal[s] > 3 * by_source[s]]
        if not over:
            goal |= fixed
            break
        fixed |= {s: 3 * by_source[s] for s in over}
    library = Tokenizer.from_file(vocabulary_path())
    pieces = collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) <= set(left)
    taken = collections.Counter()
    for i, got in pieces.items():
        ids = library.encode(left[i], add_special_tokens=False).ids + [0]
        whole = [(k, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, p in enumerate(ids[a : a + 2048] for a in range(0, len(ids), 2048))]
        have = collections.Counter((r["piece"], r["length"], r["ids_crc32"]) for r in got)
        copies = min(have[w] for w in whole)
        rest = have - collections.Counter({w: copies for w in whole})
        # What is left over is one copy cut short, of the text's first words.
        part = 0
        if rest:
            words = re.findall(WORD, left[i])
            total = sum(n * length for (_, length, _), n in rest.items())
            part = next(k for k in range(1, len(words) + 1) if len(cut := library.encode(" ".join(words[:k]), add_special_tokens=False).ids) + 1 >= total)
            cut = cut + [0]
            assert rest == collections.Counter((k, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, p in enumerate(cut[a : a + 2048] for a in range(0, len(cut), 2048)))
        taken[raw[i]["source"]] += copies * size[i] + part
        assert copies <= 3 and (copies < 3 or not part)
    assert all(abs(taken[s] - goal[s]) <= 2 for s in names)
    places = collections.defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
