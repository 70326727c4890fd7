"""Alignments against both libraries on whole texts, and a plain reading of the contract."""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import queries, token_alignment

FOLDER = "/root/testdata/sf0.001"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, block long, Pairs string"
NOTHING = dict(n_a=0, n_b=0, n_groups=0, n_links=0, n_best=0, count_sum=0, groups_sha256="")
ODD = [
    None, "", " ", "  ", "\n", "a", "a ", " a", "  a  b \n\n c\t d\r\n e", "it's 'S  's　x　 y\x1c \x1dz \x85 \x85w", "low▁line", "▁",
    "é à é naïve 日本語 mixed123abc!!! ...\n \n", "<s> <unk> <0x41> <|endoftext|>", "\x00\x01", "\U0001f600 \U0001f600\U0001f600",
    "the the the\nthe", "the the the\nthe", "=" * 3000 + " " * 300 + "x", "word " * 3000, "x\n y \nz", "  a  b  c",
]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def tokens_of(text, tokenizers):
    """(id, bytes) of both sides of a whole text, or nothing."""
    a, b = tokenizers
    if not text:
        return [], []
    byte_of = token_alignment._byte_level()
    left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    same = b"".join(t for _, t in left) == b"".join(t for _, t in right) == (" " + text).encode()
    return (left, right) if same else ([], [])


def groups_of(left, right):
    ends = []
    for side in (left, right):
        at, own = 0, []
        for _, token in side:
            at += len(token)
            own.append(at)
        ends.append(own)
    common = sorted(set(ends[0]) & set(ends[1]))
    groups, i, j = [], 0, 0
    for end in common:
        k, m = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
        groups.append(([t for t, _ in left[i:k]], [t for t, _ in right[j:m]]))
        i, j = k, m
    return groups


def brute(texts, tokenizers):
    whole = [groups_of(*tokens_of(t, tokenizers)) for t in texts]
    held = Counter(pair for groups in whole for pair in {(a, b) for g in groups for a in g[0] for b in g[1]})
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    rows = []
    for groups in whole:
        links = [(a, b) for g in groups for a in g[0] for b in g[1]]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append(dict(
            n_a=sum(len(g[0]) for g in groups), n_b=sum(len(g[1]) for g in groups), n_groups=len(groups), n_links=len(links),
            n_best=sum(held[p] == best[p[0]] for p in links), count_sum=sum(held[p] for p in links),
            groups_sha256=hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return rows


def figures(row):
    return {name: row[name] for name in NOTHING}


def test_odd_texts(spark, tokenizers):
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in enumerate(ODD)], SCHEMA).repartition(3)
    got = {r.doc_id: figures(r) for r in token_alignment.aligned(docs, *PATHS).collect()}
    want = brute(ODD, tokenizers)
    for i, row in enumerate(want):
        assert got[i] == row, repr(ODD[i])
    assert want[0] == want[1] == want[10] == NOTHING
    assert token_alignment.aligned(docs.limit(0), *PATHS).count() == 0


def test_blocks_and_memo_change_nothing(spark, tokenizers, monkeypatch):
    """Small blocks on the driver's side of the function; tasks import the module anew."""
    use = token_alignment.Sides(*PATHS)
    monkeypatch.setattr(token_alignment, "MEMO", 200)
    texts = [t for t in ODD if t] + [f"text {i} of many\nlines, é{i} " for i in range(40)]
    for at in range(0, len(texts), 7):
        lot = texts[at : at + 7]
        rows = pa.RecordBatch.from_arrays([pa.array(range(len(lot))), pa.array(lot)], ["doc_id", "text"])
        made = token_alignment._block(use, rows, True)["docs"]
        for text, written in zip(lot, made["groups"].to_pylist()):
            want = groups_of(*tokens_of(text, tokenizers))
            assert written == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in want)


def test_overlaps_are_the_tokens_that_share_bytes(spark, tokenizers):
    texts = ["unbelievably tokenised words", "naïve übergroß \U0001f600", "a b"]
    docs = spark.createDataFrame([(i, t, 0, "") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in token_alignment.aligned(docs, *PATHS, with_groups=True).collect()}
    for i, text in enumerate(texts):
        spans = []
        for side in tokens_of(text, tokenizers):
            at, own = 0, []
            for _, token in side:
                own.append((at, at := at + len(token)))
            spans.append(own)
        assert got[i].n_overlaps == sum(a < d and c < b for a, b in spans[0] for c, d in spans[1])
        assert hashlib.sha256(got[i].groups.encode()).hexdigest() == got[i].groups_sha256


def test_a_repeated_id_is_two_documents(spark, tokenizers):
    texts = ["one two", "one", "one two"]
    docs = spark.createDataFrame([(1, texts[0], 0, ""), (1, texts[1], 0, ""), (None, texts[2], 0, "")], SCHEMA)
    got = sorted((r.n_a, r.count_sum) for r in token_alignment.aligned(docs, *PATHS).collect())
    assert got == sorted((r["n_a"], r["count_sum"]) for r in brute(texts, tokenizers))


def test_query_on_the_whole_table(spark, tokenizers):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op12_token_alignment(spark, FOLDER)
    kinds = dict(rows.dtypes)
    assert all(kinds[c] == "bigint" for c in NOTHING if c != "groups_sha256") and kinds["groups_sha256"] == "string"
    got = {r.doc_id: figures(r) for r in rows.collect()}
    assert got == dict(zip([d.doc_id for d in docs], brute([d.text for d in docs], tokenizers)))
