"""Runs against brute force over all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import periodic_runs, queries

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, runs string, Words int"


def smallest_period(words):
    """By the border array."""
    border, k = [0] * len(words), 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = border[k - 1]
        k += words[i] == words[k]
        border[i] = k
    return len(words) - border[-1]


def brute(words):
    words, found = list(words), []
    n = len(words)
    numbers = np.array([{w: i for i, w in enumerate(dict.fromkeys(words))}[w] for w in words])
    for p in range(1, n // 3 + 1):
        equal = np.append(np.append(0, numbers[:-p] == numbers[p:]), 0).astype(int)
        begins, ends = np.flatnonzero(np.diff(equal) == 1), np.flatnonzero(np.diff(equal) == -1)
        for a, b in zip(begins.tolist(), ends.tolist()):
            if b - a + p >= max(24, 3 * p) and smallest_period(words[a : b + p]) == p:
                found.append((a, b - a + p, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def found(texts):
    """All texts searched as one step."""
    words = [list(t) for t in texts]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(w for t in words for w in t))}
    rows = periodic_runs.runs_of(np.array([numbers[w] for t in words for w in t], "int32"), np.array([len(t) for t in words], "int64"))
    return [[tuple(r[1:]) for r in rows.tolist() if r[0] == i] for i in range(len(texts))]


def shapes(draw):
    """Texts rich in repeats: powers, powers in powers, near misses, Fibonacci words, two letters at random."""
    for _ in range(60):
        unit = draw.choices("ab", k=draw.randint(1, 6))
        inner = unit * draw.randint(1, 9) + draw.choices("abc", k=draw.randint(0, 9))
        outer = inner * draw.randint(1, 6)
        text = draw.choices("abc", k=draw.randint(0, 9)) + outer + inner[: draw.randint(0, len(inner))] + draw.choices("abc", k=draw.randint(0, 9))
        yield text
        for _ in range(draw.randint(1, 3)):
            text = list(text)
            text[draw.randrange(len(text))] = draw.choice("abc")
        yield text
    for p in (1, 2, 3, 7, 8, 9, 15, 16, 17, 23, 24, 31, 32, 33, 47, 63, 64, 65, 100, 127, 128, 130):
        distinct = [f"w{i}" for i in range(p)]
        runny = ["a"] * (p - 1) + ["b"]
        half = ["a"] * (p // 2) + ["b"] * (p - p // 2)
        for unit in (distinct, runny, half, draw.choices("ab", k=p)):
            for extra in (-1, 0, 1, p - 1):
                yield ["x"] + (unit * 6)[: max(24, 3 * p) + extra] + ["y"]
    a, b = ["a"], ["a", "b"]
    for _ in range(12):
        a, b = b, b + a
    yield b
    yield ["a"] * 500
    for _ in range(30):
        yield draw.choices("ab", k=draw.randint(20, 400))
    yield from ([], ["a"], ["a"] * 23, ["a"] * 24)


def test_all_runs_of_many_shapes():
    texts = list(shapes(random.Random(5)))
    got = found(texts)
    n = 0
    for text, runs in zip(texts, got):
        assert runs == brute(text), " ".join(text)
        n += len(runs)
    assert n > 300


def test_every_text_alone_gives_the_same():
    texts = list(shapes(random.Random(6)))
    assert found(texts) == [found([t])[0] for t in texts]


def test_long_period_in_a_long_text():
    draw = random.Random(7)
    unit = [str(draw.randrange(50)) for _ in range(3000)]
    text = unit[:100][::-1] + (unit * 4)[:9500] + ["end"]
    (runs,) = found([text])
    assert max(r[2] for r in runs) == 3000 and all(smallest_period(text[a : a + n]) == p for a, n, p in runs)


def rows_of(doc_id, text, plant=False):
    """The contract read plainly."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if plant and h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    return (
        len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def test_odd_texts(spark):
    texts = [None, "", " \n", "a " * 24, "a " * 23, "\x1ca \x85b " * 20, "  é\tü\x0bö " * 12 + "end", "word " * 20000, "x " * 30 + "y " * 30, "x " * 30]
    texts.append("x " * 30)
    docs = spark.createDataFrame([(i, t, "r", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(docs).collect()}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = brute(words) if len(words) < 1000 else [(0, 20000, 1)]
        assert got[i].n_words == len(words) and [tuple(r) for r in got[i].runs] == runs
    assert got[0].collapsed == got[2].collapsed == "" and got[3].collapsed == "a" and got[8].collapsed == "x y"
    assert got[9].runs == got[10].runs and got[6].collapsed == "é ü ö end"
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


@pytest.mark.parametrize("folder", [FOLDER])
def test_query_on_the_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op11_periodic_runs(spark, folder)
    assert rows.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert all(kind == "bigint" for name, kind in rows.dtypes if not name.endswith("sha256"))
    got = {r.doc_id: tuple(r[1:]) for r in rows.collect()}
    assert len(got) == len(docs)
    for d in docs:
        assert got[d.doc_id] == rows_of(d.doc_id, d.text, plant=True), d.doc_id
    assert sum(r[0] > 0 for r in got.values()) > 5
