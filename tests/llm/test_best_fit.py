"""Bin completion against exhaustive search, and the pieces it places against the tokenizer."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import best_fit, packing, queries

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, part int, Length string, n double"


@pytest.fixture(scope="module")
def tokenizer():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer


def fewest(items, capacity):
    """The least number of sequences, by trying every placing."""
    items, best = sorted(items, reverse=True), len(items)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= items[i]:
                at = rooms.index(room)
                go(i + 1, rooms[:at] + [room - items[i]] + rooms[at + 1 :])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best


def counted(items):
    return {int(k): int(n) for k, n in zip(*np.unique(items, return_counts=True))}


def test_search_finds_the_fewest_sequences():
    draw, gained = random.Random(3), 0
    for _ in range(300):
        capacity = draw.choice([10, 20, 50, 100])
        items = [
            draw.randint(1, capacity) if draw.random() < 0.3 else draw.randint(max(1, capacity // 5), capacity // 2)
            for _ in range(draw.randint(1, 10))
        ]
        counts = counted(items)
        found, first = best_fit.bin_completion(counts, capacity), best_fit.best_fit(counts, capacity)
        used: dict[int, int] = {}
        for filling, times in found:
            assert times > 0 and sum(length * copies for length, copies in filling) <= capacity
            for length, copies in filling:
                used[length] = used.get(length, 0) + copies * times
        n = sum(times for _, times in found)
        assert used == counts
        assert best_fit.least_sequences(counts, capacity) <= n == fewest(items, capacity)
        gained += n < sum(times for _, times in first)
    assert gained > 0


def test_patterns_do_not_grow_with_the_pieces():
    draw = np.random.default_rng(1)
    counts = counted(draw.integers(1, 513, 20_000))
    packing_of = {n: best_fit.bin_completion({k: c * n for k, c in counts.items()}, 512, 3) for n in (1, 1000)}
    assert len(packing_of[1000]) <= 3 * 512
    assert sum(t for _, t in packing_of[1000]) <= 1000 * sum(t for _, t in packing_of[1])


def test_bad_lengths_are_an_error():
    assert best_fit.bin_completion({}, 10) == [] and best_fit.bin_completion({4: 0}, 10) == []
    for counts in ({11: 1}, {0: 1}):
        with pytest.raises(ValueError):
            best_fit.bin_completion(counts, 10)


def check_pieces(rows, ids_of, capacity, crc=False):
    """Every id once, no more cuts than needed, sequences without gaps; gives their number."""
    documents, sequences = {}, {}
    for r in rows:
        documents.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for doc_id, ids in ids_of.items():
        got = sorted(documents.pop(doc_id), key=lambda r: r.piece)
        cuts = range(0, len(ids), capacity)
        assert [(r.piece, r.start, r.length) for r in got] == [(i, a, min(capacity, len(ids) - a)) for i, a in enumerate(cuts)]
        for r, a in zip(got, cuts):
            data = np.array(ids[a : a + capacity], "<u4").tobytes()
            assert (r.ids_crc32 == zlib.crc32(data)) if crc else (bytes(r.ids) == data)
    assert not documents
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in parts])
        assert [r.offset for r in parts] == [0, *ends[:-1].tolist()] and ends[-1] <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [7, 64, 4096])
def test_pieces_of_odd_texts(spark, tokenizer, capacity):
    texts = [None, "", " ", "a", "same words here", "same words here", "word " * 9000, "=" * 5000, "ßİ क़.", "日本 x\x1cy"]
    texts += [f"some text number {i} " * (i % 9) for i in range(60)]
    rows = [(i, t, i, "x", None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = best_fit.packed(docs, PATH, capacity).collect()
    ids_of = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t, *_ in rows}
    n = check_pieces(got, ids_of, capacity)
    lengths = [min(capacity, len(ids) - a) for ids in ids_of.values() for a in range(0, len(ids), capacity)]
    assert best_fit.least_sequences(counted(lengths), capacity) <= n
    assert n <= sum(t for _, t in best_fit.best_fit(counted(lengths), capacity))


def test_a_repeated_id_is_two_documents(spark):
    docs = spark.createDataFrame([(1, "one two", 0, "", 0.0), (1, "three", 0, "", 0.0), (None, "four", 0, "", 0.0)], SCHEMA)
    got = best_fit.packed(docs, PATH).collect()
    assert len(got) == 3 and len({(r.sequence_id, r.offset) for r in got}) == 3
    assert best_fit.packed(docs.limit(0), PATH).count() == 0


def test_query_packs_the_whole_table(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op13_best_fit(spark, FOLDER)
    assert dict(rows.dtypes) == {
        "doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
        "sequence_id": "bigint", "offset": "bigint",
    }
    ids_of = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in texts.items()}
    n = check_pieces(rows.collect(), ids_of, best_fit.CAPACITY, crc=True)
    assert n <= -(-sum(map(len, ids_of.values())) // best_fit.CAPACITY) + 1


def test_every_letter_is_encoded_as_by_the_tokenizer(tokenizer):
    """Alone, before a mark, within a word, twice with a comma, and after a capital."""
    use = packing.Pieces(PATH)
    letters = [c for c in map(chr, range(0x30000)) if not 0xD800 <= ord(c) < 0xE000]
    for form in ("{}", "{}́", "ab{}cd", "{0}{0},", "H{}."):
        texts = [form.format(c) for c in letters]
        ids, n = use.encode(pa.array(texts))
        want = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        assert n.tolist() == list(map(len, want)) and ids.tolist() == [i for one in want for i in one]


def test_a_small_memo_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 50)
    use = packing.Pieces(PATH)
    for i in range(5):
        texts = [f"Words, number{i} of many; {'long' * 40} é{i}", None, "again Words,"]
        ids, n = use.encode(pa.array(texts), 1)
        want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
        assert n.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])
