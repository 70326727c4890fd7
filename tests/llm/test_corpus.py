"""Operators over the whole corpus, against brute force on small fixtures."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import differences, sql_engine
from tidemark.llm import column_bwt, line_dedup, multi_index, odd_sketch, queries, toxicity

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, spans string, digest string, node int"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in zip(ids, texts)], SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows_as_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), sql_engine(FOLDER), queries.ORACLE[name]) == []


# Near duplicates


def brute_groups(docs, width):
    sets = {}
    for i, t in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        n = min(width, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    label = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sets, label


def assert_groups(df, docs, width):
    sets, label = brute_groups(docs, width)
    got = {r.doc_id: r for r in odd_sketch.near_duplicates(df, width).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), label[i], label[i] == i) for i in sets
    }


def test_near_duplicates_of_drifting_copies(spark):
    draw = random.Random(3)
    base = [f"w{draw.randrange(500)}" for _ in range(120)]
    texts, words = [None, "", " \n", "One", "one", "one TWO", "One two"], base
    for _ in range(60):  # each copy differs a little from the one before it, and much from the first
        words = list(words)
        for _ in range(2):
            words[draw.randrange(len(words))] = f"v{draw.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += [" ".join(base)] * 5 + [" ".join(draw.sample(base, 100)) for _ in range(20)]
    for width in (2, 5):
        assert_groups(frame(spark, texts), list(enumerate(texts)), width)


def test_blocks_and_rounds_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(odd_sketch, "BLOCK", 4)
    draw = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(80):
        words = list(base)
        for k in draw.sample(range(60), 4):
            words[k] = f"v{draw.randrange(40)}"
        texts.append(" ".join(words))
    assert_groups(frame(spark, texts), list(enumerate(texts)), 2)


def test_a_stray_in_a_crowded_bucket_makes_no_large_group(spark, monkeypatch, tmp_path):
    """Many copies of one component share their buckets with a class that is in none."""
    monkeypatch.setattr(odd_sketch, "BLOCK", 4)
    monkeypatch.setattr(odd_sketch, "TASK_ROWS", 50)
    whole = odd_sketch._promising

    def logged(task):
        with open(f"{tmp_path}/{task['task'].iloc[0]}", "w") as log:
            log.write(str(len(task)))
        return whole(task)

    monkeypatch.setattr(odd_sketch, "_promising", logged)
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base)] + [" ".join([*base[:k], f"v{k}-{j}", *base[k + 1 :]]) for k in range(10) for j in range(20)]
    texts.append(" ".join([*base[:80], *(f"u{i}" for i in range(20))]))
    assert_groups(frame(spark, texts), list(enumerate(texts)), 2)
    sizes = [int(f.read_text()) for f in tmp_path.iterdir()]
    assert sizes and max(sizes) <= 250


def test_near_duplicates_of_nulls_and_repeats(spark):
    long = " ".join(f"x{i}" for i in range(5000))
    df = frame(spark, ["a b c", "a b c", long, long + " y", "a b c"], [7, 7, 8, 9, None])
    got = sorted(map(tuple, odd_sketch.near_duplicates(df, 2).collect()), key=repr)
    assert got == sorted([(7, 2, 7, True)] * 2 + [(8, 4999, 8, True), (9, 5000, 8, False), (None, 2, None, True)], key=repr)
    assert odd_sketch.first_of_groups(df, 2).count() == 4
    assert odd_sketch.near_duplicates(spark.createDataFrame([], SCHEMA), 2).count() == 0


def test_components_of_a_long_path(spark, tmp_path):
    n = iter(range(10**6))

    def keep(df):
        path = f"{tmp_path}/{next(n)}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    order = list(range(40))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(39)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in odd_sketch.components(links, keep).collect()}
    assert got == {i: 0 for i in range(1, 40)} | {101: 100}


# Lines


def test_lines_keep_their_first_place(spark):
    long = "the same line of seven words here"
    texts = [f"{long}\nown text of the first one\n{long}", f"x\n  The SAME line of\tseven words here \ny\n{long}", "short\nshort", None, "", long + "\n" * 3000]
    got = {r.doc_id: r for r in line_dedup.without_repeats(frame(spark, texts)).collect()}
    assert got[0].text == f"{long}\nown text of the first one\n" and [tuple(s) for s in got[0].spans] == [(60, 93)]
    assert got[1].text == "x\ny\n" and [texts[1][a:b] for a, b in got[1].spans] == ["  The SAME line of\tseven words here \n", long]
    assert [got[i].text for i in (2, 3, 4)] == ["short\nshort", "", ""] and got[5].text == ""
    assert "digest" in got[0] and got[0].node == 1


def test_lines_of_repeats_and_nothing(spark):
    line = "one two three four five"
    df = frame(spark, [line, line, line], [1, 1, None])
    assert sorted((r.doc_id or 0, r.text) for r in line_dedup.without_repeats(df).collect()) == [(0, ""), (1, line), (1, line)]
    assert line_dedup.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_passages_within_lines_go_with_their_short_sentences(spark):
    passage = "A passage of some words here. Short. Yes! Another sentence of six words? "
    texts = [f"Own beginning one. {passage}Own end one.", f"Other start goes here {passage}and an end. Short. Yes! Own."]
    texts += ["Yes! Short. Own words here.", "第一句话在这里有很多很多的字没有空格而且还要更长一点点才行。短。", "别的话。第一句话在这里有很多很多的字没有空格而且还要更长一点点才行。短。尾。"]
    got = {r.doc_id: r for r in line_dedup.without_repeats(frame(spark, texts)).collect()}
    assert got[0].text == texts[0]
    # Its first sentence has other words before it here; the ones after it go, the short ones too.
    assert got[1].text == "Other start goes here A passage of some words here. and an end. Short. Yes! Own."
    assert got[2].text == texts[2] and got[3].text == texts[3] and got[4].text == "别的话。尾。"
    for i, text in enumerate(texts):
        edges = [0, *(x for s in got[i].spans for x in s), len(text)]
        assert "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) == got[i].text


# Substrings


def brute_substrings(docs):
    first, out = {}, {}
    for i, t in sorted(docs):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 49):
            if first.setdefault(data[k : k + 50], i) < i:
                gone[k : k + 50] = b"\x01" * 50
        out[i] = bytes(c for c, g in zip(data, gone) if not g)
    return out


def test_substrings_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(column_bwt, "PACKED", 500)
    monkeypatch.setattr(column_bwt, "COLLECTION", 50)
    monkeypatch.setattr(column_bwt, "RANGE_BYTES", 4000)
    draw = random.Random(2)
    word = lambda: "".join(draw.choice("abé ") for _ in range(draw.randrange(2, 9)))
    parts = [" ".join(word() for _ in range(draw.randrange(5, 40))) for _ in range(12)]
    texts = [None, "", "x" * 49, "x" * 50, "x" * 51, "y" * 400, "y" * 300] + ["".join(draw.choices(parts, k=4)) + word() for _ in range(40)]
    texts += [texts[8], texts[8][10:], "ab" * 5000]
    got = {r.doc_id: r for r in column_bwt.without_repeats(frame(spark, texts)).collect()}
    want = brute_substrings(list(enumerate(texts)))
    for i, t in enumerate(texts):
        data, spans = (t or "").encode(), got[i].spans
        assert bytes(got[i].kept) == want[i] and got[i].n_bytes == len(data)
        assert sum(b - a for a, b in spans) == len(data) - len(want[i])
        assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_substrings_of_repeats_and_nothing(spark):
    text = "".join(map(str, range(100)))
    got = column_bwt.without_repeats(frame(spark, [text, text, text, text], [1, 1, 2, None])).collect()
    assert sorted(((r.doc_id or 0), len(r.kept)) for r in got) == [(0, 190), (1, 190), (1, 190), (2, 0)]
    assert column_bwt.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_substrings_of_an_id_with_several_texts(spark):
    """A span of one text of an id does not cut the other, and neither misses a match."""
    draw = random.Random(5)
    a, b, c = ("".join(draw.choices("abcdefgh ", k=200)) for _ in range(3))
    rows = [(a, 1), (a, 5), (b, 5), (c, 5), (c, 7), (b + a, 9), ("z" + b, -3)]
    docs = frame(spark, [t for t, _ in rows], [i for _, i in rows])
    got = sorted((r.doc_id, bytes(r.kept).decode()) for r in column_bwt.without_repeats(docs).collect())
    assert got == sorted([(1, a), (5, ""), (5, ""), (5, c), (7, ""), (9, ""), (-3, "z" + b)])


def test_collection_is_the_transform():
    pieces = [b"banana", b"ananas", b"an", b"banana\x00\xff"]
    collection = column_bwt.Collection(pieces)
    suffixes = sorted(
        ((tuple(c + 1 for c in p[len(p) - n :]), i) for i, p in enumerate(pieces) for n in range(len(p) + 1)), key=lambda s: s
    )
    got = [(tuple(c + 1 for c in pieces[t][len(pieces[t]) - n :]), int(t)) for t, n in zip(collection.text, collection.length)]
    assert [s for s, _ in got] == [s for s, _ in suffixes]
    assert [int(s) for s in collection.symbols] == [
        0 if n == len(pieces[t]) else pieces[t][len(pieces[t]) - n - 1] + 1 for t, n in zip(collection.text, collection.length)
    ]


# Search


def test_search_with_copies_nulls_and_ties(spark):
    draw = np.random.default_rng(4)
    vectors = [[float(x) for x in v] for v in draw.normal(size=(300, 64))] + [[1.0] * 64] * 40
    rows = [(i, v) for i, v in enumerate(vectors)] + [(None, vectors[0]), (1000, None), (1001, [1.0]), (3, vectors[3])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in multi_index.top_k(df, df.filter("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.distance, r.neighbor_id))
    signs = {i: np.array([x > 0 for x in v] if len(v) == 64 else [False] * 63 + [True]) for i, v in enumerate(vectors)}
    signs[1001] = np.array([False] * 63 + [True])
    for q in range(0, 340, 20):
        want = sorted((int((signs[q] != s).sum()), i) for i, s in signs.items() if i != q)[:10]
        assert got[q] == want
    assert multi_index.top_k(df.limit(0), df.limit(0)).count() == 0


# Toxicity


def test_matches_are_those_of_the_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i] + [0] * len(b) if False else _row(row, i, x, b)
        return row[-1]

    def _row(old, i, x, b):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(old[j] + 1, new[-1] + 1, old[j - 1] + (x != y)))
        return new

    draw = random.Random(6)
    words = ["".join(draw.choices("abc", k=draw.randrange(3, 11))) for _ in range(30)]
    matcher = toxicity.Matcher(toxicity.Model(words={w: 1.0 for w in words}, stems={"cab": 1.0}))
    for _ in range(3000):
        word = "".join(draw.choices("abcd", k=draw.randrange(1, 12)))
        near = min((distance(word, w), w) for w in words if distance(word, w) <= toxicity.allowed(w)) if any(
            distance(word, w) <= toxicity.allowed(w) for w in words
        ) else None
        got = matcher.match(word)
        if near and near[0] == 0:
            assert got == (word, 0, False)
        elif word.startswith("cab"):
            assert got == ("cab", 0, True)
        else:
            assert (None if got is None else (got[1], got[0])) == near


def test_quotation_is_told_from_abuse():
    matcher = toxicity.Matcher(toxicity.Model(words={"idiot": 5.0}))
    names = dict(zip(toxicity.FEATURES, toxicity.figures("You idiot, go away", matcher)))
    assert names["any"] == 5.0 and names["quoted"] == 0
    for text in ('He wrote "you idiot" to her', "Er schrieb „du idiot“ an sie", "il a dit « idiot » hier"):
        names = dict(zip(toxicity.FEATURES, toxicity.figures(text, matcher)))
        assert names["quoted"] > 0 and names["any"] == 0, text
    assert toxicity.figures("nothing here", matcher) is None


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(8)
    mild = [f"calm{i}" for i in range(200)]
    bad = ["horribleword", "nastyword", "wickedword"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = draw.choices(mild, k=30) + (draw.choices(bad, k=2) if toxic else [])
        draw.shuffle(words)
        rows.append((i, " ".join(words), "x", "y", 1))
        labels.append((i, 1 - int(toxic), int(toxic)))
    labels += [(None, 1, 1), (9999, 1, None), (3, 1, 0)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    model = toxicity.learn(docs, labels)
    assert {"horribleword", "nastyword", "wickedword"} <= set(model.words)
    got = toxicity.scored(docs, model).filter("crc32(cast(doc_id AS string)) % 3 = 1").collect()
    assert len(got) > 150 and all((r.score >= 0.7) == (r.doc_id % 4 == 0) for r in got)
    odd = frame(spark, [None, "", " ", "calm1 " * 20000, "horribleword calm1 nastyword calm2"])
    scores = [r.score for r in toxicity.scored(odd, model).orderBy("doc_id").collect()]
    assert scores[0] == scores[1] == scores[2] < 0.5 and scores[3] < 0.5 and scores[4] > 0.7
    assert toxicity.without_toxic(odd, model).columns == odd.columns and toxicity.without_toxic(odd, model).count() == 4


def test_toxicity_without_labels(spark, corpus):
    docs, labels = corpus
    model = toxicity.learn(docs, labels.limit(0))
    assert toxicity.without_toxic(docs, model).count() == docs.count()
    assert toxicity.scored(docs.limit(0), model).count() == 0


# The pipeline


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, part int"
    line = "a line of six different words"
    rows = [
        (1, f"{line}\nfirst own words are here", "en", "s", 0, 0.0, 1),
        (2, f"{line}\nsecond has other words and password=hunter22", None, None, None, None, None),
        (3, None, "en", "s", 0, 0.0, 1),
        (4, "", "en", "s", 0, 0.0, 1),
        (None, "no id at all here", "en", "s", 0, 0.0, 1),
        (5, f"{line}\nfirst own words are here", "en", "s", 0, 0.0, 1),
        (5, f"{line}\nfirst own words are here", "en", "s", 0, 0.0, 1),
    ]
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert result.columns == docs.columns and result.dtypes == docs.dtypes
        result.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs
    assert seen["near_duplicates"].count() == 5
    texts = {r.doc_id: r.text for r in seen["secrets"].collect()}
    assert texts == {1: rows[0][1], 2: "second has other words and [secret]", 3: None, 4: "", None: "no id at all here"}
    assert {r.doc_id: r.n_chars for r in seen["secrets"].collect()}[2] == len(texts[2])
    assert {r.doc_id for r in seen["packing"].collect()} == {1, 2, 3, 4, None}
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_pipeline_runs_on_the_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    packed = corpus_pipeline.run(spark, FOLDER)
    assert packed.count() > 0
    assert packed.join(docs, "doc_id", "left_anti").count() == 0
