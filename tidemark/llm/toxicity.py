"""Toxicity by a learned lexicon, misspellings included, with context windows.

The lexicon (words, and stems that stand for all words they begin) is learned from labelled rows.
Words of a text are run through the product of the lexicon's trie and the Levenshtein automata of
its entries; its states are made deterministic when they are first reached and kept, so a word
costs a dictionary step per character and most words end after a few. Around each match a window of
characters tells a quoted mention from abuse. A logistic model over a handful of figures of these
matches gives the score.

Labelled rows are used up to a bounded sample, ``SAMPLE``: a share of their ids by hash. Two thirds
of it give the lexicon, one third the weights, so that entries which only fit their own rows weigh
little. Everything else runs over all rows.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fresh

THRESHOLD = 0.7
# Labelled rows that are fitted to, at most (in expectation; the share is taken by hash).
SAMPLE = 20_000
# Entries of the lexicon, best first.
LEXICON = 5_000
# Words near to an entry that clean rows use, most frequent first.
HARMLESS = 50_000
STEMS = range(4, 8)
WINDOW = 40
STATES = 20_000
MEMO = 300_000

WORD = re.compile(r"\w+(?:[@$!*'’-]\w+)*")
OPENING, CLOSING = "„«‹“", "”»›“"
FEATURES = ["any", "exact", "strength", "near", "quoted", "dense"]


def allowed(entry: str) -> int:
    """Edits that a misspelling of ``entry`` may have."""
    return 0 if len(entry) < 5 else 1 if len(entry) < 9 else 2


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    harmless: frozenset[str] = frozenset()
    weights: list[float] = field(default_factory=lambda: [0.0] * len(FEATURES))
    bias: float = 0.0
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


class Matcher:
    """The lexicon's trie intersected with the Levenshtein automata of its entries."""

    def __init__(self, model: Model) -> None:
        self.model = model
        # A node: its children, the word that ends there, the stem that ends there, the edits that
        # some word below it allows.
        self.children: list[dict[str, int]] = [{}]
        self.word: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.edits: list[int] = [0]
        for entry in model.words:
            self.word[self._node(entry, allowed(entry))] = entry
        for entry in model.stems:
            self.stem[self._node(entry, 0)] = entry
        self._reset()

    def _node(self, entry: str, edits: int) -> int:
        node = 0
        self.edits[0] = max(self.edits[0], edits)
        for c in entry:
            following = self.children[node].get(c)
            if following is None:
                following = self.children[node][c] = len(self.children)
                self.children.append({})
                self.word.append(None)
                self.stem.append(None)
                self.edits.append(0)
            node = following
            self.edits[node] = max(self.edits[node], edits)
        return node

    def _reset(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.found: list[tuple[str, int, bool] | None] = []
        self.memo: dict[str, tuple[str, int, bool] | None] = {}
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """The state with these (node, edits), entries that skip letters of the lexicon added."""
        best: dict[int, int] = {}
        todo = list(pairs)
        while todo:
            node, edits = todo.pop()
            if edits > self.edits[node] or best.get(node, 9) <= edits:
                continue
            best[node] = edits
            todo += [(child, edits + 1) for child in self.children[node].values()]
        key = frozenset(best.items())
        known = self.ids.get(key)
        if known is None:
            known = self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            ends = [
                (edits, self.word[node])
                for node, edits in best.items()
                if self.word[node] is not None and edits <= allowed(self.word[node])
            ]
            self.found.append((min(ends)[1], min(ends)[0], False) if ends else None)
        return known

    def _step(self, state: int, c: str) -> int:
        after: set[tuple[int, int]] = set()
        for node, edits in self.sets[state]:
            after.add((node, edits + 1))
            for letter, child in self.children[node].items():
                after.add((child, edits + (letter != c)))
        following = self.steps[state][c] = self._state(after)
        return following

    def match(self, word: str) -> tuple[str, int, bool] | None:
        """Entry, edits and whether it is a stem; the exact ones first, null without a match."""
        known = self.memo.get(word, self)
        if known is not self:
            return known
        if len(self.memo) > MEMO or len(self.sets) > STATES:
            self._reset()
        state, steps, found = self.start, self.steps, None
        node, alive = 0, True
        for c in word:
            if alive:  # stems are matched without edits
                node = self.children[node].get(c, -1)
                alive = node >= 0
                if alive and self.stem[node] is not None:
                    found = (self.stem[node], 0, True)
            following = steps[state].get(c)
            state = self._step(state, c) if following is None else following
            if not self.sets[state] and not alive:
                break
        else:
            whole = self.found[state]
            if whole is not None and (found is None or whole[1] == 0):
                found = whole
        self.memo[word] = found
        return found


def _quoted(text: str, start: int, end: int) -> bool:
    """Whether a quotation opens in the window before a match and closes in the one after it."""
    before, after = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    if before.count('"') % 2 == 1 and '"' in after:
        return True
    opened, closed = (max(map(before.rfind, marks)) for marks in (OPENING, CLOSING))
    return opened > closed and any(mark in after for mark in CLOSING)


def figures(text: str, matcher: Matcher) -> list[float] | None:
    """The features of a text; None if no word matches."""
    lower = text.lower()
    words = set(WORD.findall(lower))
    hits = {w: m for w in words if (m := matcher.match(w)) is not None}
    if not hits:
        return None
    model = matcher.model
    exact = strength = near = quoted = 0.0
    top = 0.0
    for found in WORD.finditer(lower):
        match = hits.get(found.group())
        if match is None:
            continue
        entry, edits, stem = match
        weight = (model.stems if stem else model.words)[entry]
        if edits and found.group() in model.harmless:
            continue
        if _quoted(lower, found.start(), found.end()):
            quoted += 1
        elif edits:
            near += 1
        else:
            exact += 1
            strength += weight
            top = max(top, weight)
    return [top, math.log1p(exact), min(strength, 50.0) / 10, math.log1p(near), math.log1p(quoted), 100 * exact / (len(words) + 20)]


_MATCHERS: dict[str, Matcher] = {}


def matcher_of(model: Model) -> Matcher:
    """One matcher for each worker and model."""
    if model.key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[model.key] = Matcher(model)
    return _MATCHERS[model.key]


def score_of(features: list[float] | None, model: Model) -> float:
    z = model.bias + (sum(w * x for w, x in zip(model.weights, features)) if features else 0.0)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def scorer(model: Model):
    """Column of texts to their score; null and empty texts score as texts without a match."""

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        use = matcher_of(model)
        return pd.Series([score_of(figures(t, use) if t else None, model) for t in texts], dtype="float64")

    return score


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text, toxic, fold of the rows that are fitted to: those whose crc32(doc_id) mod 3 is not 1.

    Labels that are null, or of ids that are null, are left out; an id with several labels is toxic
    if one of them says so.
    """
    usable = (
        labels.select(F.col("doc_id").alias("labelled_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("labelled_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(F.crc32(F.col("labelled_id").cast("string")) % 3 != 1)
        .groupBy("labelled_id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("draw", F.pmod(F.xxhash64("labelled_id"), F.lit(1_000_000)))
    )
    share = min(1.0, sample / max(usable.count(), 1))
    drawn = usable.filter(F.col("draw") < share * 1_000_000)
    # Bounded by ``sample``, whatever the size of the corpus.
    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(drawn), F.col("doc_id") == F.col("labelled_id"))
        .select(
            F.coalesce("text", F.lit("")).alias("text"),
            "toxic",
            F.pmod(F.xxhash64("labelled_id", F.lit(1)), F.lit(3)).alias("fold"),
        )
    )


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The different words of each text, with its label."""
    for batch in batches:
        sets = [sorted(set(WORD.findall(text.lower()))) for text in batch["text"]]
        yield pd.DataFrame(
            {"word": list(chain.from_iterable(sets)), "toxic": np.repeat(batch["toxic"].to_numpy(), list(map(len, sets)))}
        )


def _weight(toxic, clean, all_toxic: int, all_clean: int):
    """Log odds of an entry, less what so few rows leave open."""
    odds = F.log((toxic + 0.5) / (all_toxic + 1)) - F.log((clean + 0.5) / (all_clean + 1))
    return odds - 2 / F.sqrt(toxic)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit a model. Without rows of both labels it knows no word and scores the rate of the label."""
    rows = labelled(docs, labels, sample).cache()
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    rate = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
    model = Model(bias=math.log(rate / (1 - rate)) if n_toxic + n_clean else -5.0)
    if n_toxic and n_clean:
        _learn_lexicon(rows.filter("fold > 0"), model, 2 * n_toxic // 3, 2 * n_clean // 3)
        _learn_weights(rows.filter("fold = 0"), model)
    rows.unpersist()
    return model


def _learn_lexicon(rows: DataFrame, model: Model, n_toxic: int, n_clean: int) -> None:
    # Exact copies would make any of their words look telling.
    counts = (
        rows.dropDuplicates(["text"])
        .select("text", "toxic")
        .mapInPandas(_words, "word string, toxic int")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
        .cache()
    )
    prefixes = (
        counts.select("toxic", "clean", "word", F.explode(F.array(*[F.lit(n) for n in STEMS])).alias("n"))
        .filter(F.length("word") > F.col("n"))
        .groupBy(F.expr("substring(word, 1, n)").alias("entry"))
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count_if(F.col("toxic") > 0).alias("forms"))
        .filter("forms >= 4 AND clean * 50 <= toxic")
    )
    words = counts.select(F.col("word").alias("entry"), "toxic", "clean").filter("toxic >= 3 AND clean * 20 <= toxic")
    for frame, into in ((words, model.words), (prefixes, model.stems)):
        best = (
            frame.withColumn("weight", _weight(F.col("toxic"), F.col("clean"), n_toxic, n_clean))
            .filter("weight > 1")
            .orderBy(F.desc("weight"), "entry")
            .limit(LEXICON)
            .collect()
        )
        into.update({r["entry"]: r["weight"] for r in best})
    # A stem below another stem adds nothing.
    for stem in list(model.stems):
        if any(stem[:n] in model.stems for n in range(STEMS[0], len(stem))):
            del model.stems[stem]
    lexicon = Model(words=model.words, stems=model.stems)

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = matcher_of(lexicon)
        for batch in batches:
            hit = [(m := use.match(w)) is not None and m[1] > 0 for w in batch["word"]]
            yield batch[hit]

    clean = counts.filter("clean > 0").select("word", "clean").mapInPandas(near, "word string, clean long")
    model.harmless = frozenset(r["word"] for r in clean.orderBy(F.desc("clean"), "word").limit(HARMLESS).collect())
    counts.unpersist()


def _learn_weights(rows: DataFrame, model: Model, ridge: float = 0.05) -> None:
    """Newton steps of a ridge logistic model; the rows are a third of the bounded sample."""
    schema = "toxic int, " + ", ".join(f"f_{name} double" for name in FEATURES)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = matcher_of(model)
        for batch in batches:
            found = [figures(t, use) or [0.0] * len(FEATURES) for t in batch["text"]]
            yield pd.DataFrame(
                {"toxic": batch["toxic"].values, **{f"f_{n}": [f[i] for f in found] for i, n in enumerate(FEATURES)}}
            )

    data = rows.select("text", "toxic").mapInPandas(measure, schema).toPandas()
    if not len(data):
        return
    x = np.column_stack([np.ones(len(data)), data[[f"f_{n}" for n in FEATURES]].to_numpy()])
    y, w = data["toxic"].to_numpy(dtype=float), np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * len(FEATURES))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty @ w
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    model.bias, model.weights = float(w[0]), [float(v) for v in w[1:]]


def scored(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a column ``score`` (replaced if it is there); rows in, rows out."""
    return docs.withColumn(score, scorer(model)(F.col(text)))


def without_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, columns as they were."""
    (score,) = fresh(docs, "score")
    return scored(docs, model, text, score).filter(F.col(score) < threshold).drop(score)
