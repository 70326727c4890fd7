"""Runs of words that repeat with a period, by string synchronising sets.

A run is a stretch of words that equals itself shifted by its smallest period, at least three times as
long as the period, and that no neighbouring word extends. Periods are looked for at dyadic scales. At
scale t, for periods from t to below 2t, a position is in the synchronising set if its context, the t
words from it on, has the least hash of some t neighbouring positions: a choice that depends on nothing
but the words around, so it recurs one period on. Equal contexts of the set, t to 2t apart, propose a
period; comparing the words themselves confirms it and gives both ends of the run.

Contexts that repeat within a third of themselves would fill the set, and are left out of it. They lie in
highly periodic regions: those with periods below the first scale are found by comparing each word
with the few that follow it, the others are the runs of the scales before. What is left recurs more than
a third of t apart, so a position has at most five partners and no group of equal contexts is paired out.

Why nothing is missed: take a run of period p, t <= p < 2t. The positions of its first p words have
their contexts in it, and so have those one period on. If all contexts of a window among them were left
out, their region would have a period of t / 3 at most, and by the periodicity lemma p would not be the
smallest. Else the least of the window is in the set, and so is the position p words on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import spread, steps

# A run has at least so many words, and so many periods.
LEAST = 24
REPEATS = 3
# The first scale; smaller periods are found directly.
SCALE = 8
# Equal contexts of the set are more than a third of the scale apart: so many lie within two scales.
PARTNERS = 5
# Bytes of text that are searched at a time, but for single longer texts.
STEP = 4_000_000
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes (the finaliser of splitmix64)."""
    x = values + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shifted(values: np.ndarray, by: int, fill) -> np.ndarray:
    """What stands ``by`` places further on, ``fill`` beyond the end."""
    out = np.full(len(values), fill, values.dtype)
    if by < len(values):
        out[: len(values) - by] = values[by:]
    return out


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of the ``width`` (a power of two) values from each place on."""
    done = 1
    while done < width:
        values = np.minimum(values, _shifted(values, done, NONE))
        done *= 2
    return values


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of true values."""
    edges = np.diff(np.concatenate([[0], flags.astype("int8"), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


class _Words:
    """Numbers of the words of several documents, one after the other."""

    def __init__(self, words: np.ndarray, n: np.ndarray) -> None:
        self.words = words
        self.ends = np.cumsum(n)
        self.begins = self.ends - n
        self.doc = np.repeat(np.arange(len(n)), n)
        self.runs: list[tuple[int, int, int]] = []

    def extended(self, at: int, period: int) -> tuple[int, int]:
        """Begin and end of the stretch around ``at`` in which words ``period`` apart are equal."""
        words, doc = self.words, self.doc[at]
        first, last = int(self.begins[doc]), int(self.ends[doc]) - period
        end, step = at, 64
        while end < last:
            stop = min(end + step, last)
            unequal = np.flatnonzero(words[end:stop] != words[end + period : stop + period])
            if len(unequal):
                end += int(unequal[0])
                break
            end, step = stop, step * 2
        begin, step = at, 64
        while begin > first:
            stop = max(begin - step, first)
            unequal = np.flatnonzero(words[stop:begin] != words[stop + period : begin + period])
            if len(unequal):
                begin = stop + int(unequal[-1]) + 1
                break
            begin, step = stop, step * 2
        return begin, end + period

    def take(self, begin: int, end: int, period: int) -> None:
        """Keeps a stretch that is long enough and has no smaller period."""
        if end - begin < max(LEAST, REPEATS * period):
            return
        words = self.words[begin:end]
        # By the periodicity lemma a smaller period of so long a stretch would divide this one.
        for part in range(2, period + 1):
            if period % part == 0 and all(part % d for d in range(2, int(part**0.5) + 1)):
                shift = period // part
                if np.array_equal(words[shift : shift + period], words[:period]) and np.array_equal(words[shift:], words[:-shift]):
                    return
        self.runs.append((begin, end, period))

    def direct(self) -> dict[int, np.ndarray]:
        """Runs of periods below the first scale; also where contexts of the first scales are highly periodic."""
        n = len(self.words)
        dense = {SCALE: np.zeros(n, bool), 2 * SCALE: np.zeros(n, bool)}
        for period in range(1, SCALE):
            equal = np.zeros(n, bool)
            if period < n:
                equal[:-period] = (self.words[:-period] == self.words[period:]) & (self.doc[:-period] == self.doc[period:])
            begins, ends = _stretches(equal)
            long = ends - begins >= LEAST - period
            for begin, end in zip(begins[long].tolist(), ends[long].tolist()):
                self.take(begin, end + period, period)
            for scale, flags in dense.items():
                if REPEATS * period <= scale:
                    fits = ends - begins >= scale - period
                    size = (ends - begins - (scale - period) + 1)[fits]
                    flags[spread(begins[fits], size)] = True
        return dense

    def at_scale(self, scale: int, hashes: np.ndarray, places: np.ndarray, dense: np.ndarray | None) -> None:
        """Runs of periods from ``scale`` to below twice that.

        ``places`` are the places of all words of the documents long enough, ``hashes`` those of the
        contexts from there on.
        """
        left = self.ends[self.doc[places]] - places
        keys = np.where(left >= scale, hashes, NONE)
        if dense is None:
            dense = np.zeros(len(self.words), bool)
            for begin, end, period in self.runs:
                if REPEATS * period <= scale <= end - begin:
                    dense[begin : end - scale + 1] = True
        keys[dense[places]] = NONE
        least = np.where(left >= 2 * scale - 1, _least_of(keys, scale), 0)
        # The greatest least of the windows that hold a place: as _least_of, upside down and backwards.
        greatest = ~_least_of(~least[::-1], scale)[::-1]
        chosen = np.flatnonzero((keys == greatest) & (keys != NONE))
        order = chosen[np.argsort(keys[chosen], kind="stable")]
        keys, at = keys[order], places[order]
        pairs = []
        for k in range(1, PARTNERS + 1):
            apart = at[k:] - at[:-k]
            near = (keys[k:] == keys[:-k]) & (apart >= scale) & (apart < 2 * scale) & (self.doc[at[k:]] == self.doc[at[:-k]])
            pairs.append(np.stack([apart[near], at[:-k][near]]))
        found = np.concatenate(pairs, axis=1)
        period_before, covered = 0, -1
        for i in np.lexsort(found[::-1]).tolist():
            period, place = int(found[0, i]), int(found[1, i])
            if period == period_before and place < covered:
                continue
            begin, end = self.extended(place, period)
            period_before, covered = period, end - period
            self.take(begin, end, period)


def runs_of(words: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rows of document, start, length, period of all runs, in that order; ``n`` words a document."""
    whole = _Words(words, n)
    dense: dict[int, np.ndarray | None] = whole.direct()
    places = np.flatnonzero(np.repeat(n >= max(LEAST, REPEATS * SCALE), n))
    hashes, width, scale = _mixed(words[places].astype("uint64")), 1, SCALE
    while len(places):
        while width < scale:
            # Across the end of a document these are no contexts, and are not used.
            hashes = _mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + _shifted(hashes, width, 0))
            width *= 2
        whole.at_scale(scale, hashes, places, dense.get(scale))
        scale *= 2
        longer = n[whole.doc[places]] >= REPEATS * scale
        places, hashes = places[longer], hashes[longer]
    if not whole.runs:
        return np.zeros((0, 4), "int64")
    begin, end, period = np.array(whole.runs, "int64").T
    doc = whole.doc[begin]
    rows = np.stack([doc, begin - whole.begins[doc], end - begin, period], axis=1)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words between blanks, and how many each text has; none for null."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = parts.flatten()
    real = pc.not_equal(words, "")
    before = np.append(0, np.cumsum(real.to_numpy(zero_copy_only=False)))
    bounds = parts.offsets.to_numpy()
    return words.filter(real), np.diff(before[bounds - bounds[0]])


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period, by start and period), collapsed.

    ``collapsed`` are the words, joined by one space, without those that a run holds after its first
    period. A null, empty or blank text has no words and no runs, and '' is left of it. Very long texts are
    searched whole. Rows that repeat an id or a text are searched each for itself; runs that overlap
    or begin together are all given. An empty table gives no rows; extra columns are not looked at.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
            T.StructField("collapsed", T.StringType()),
        ]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in steps(batch, "text", STEP):
                words, n = split_words(rows.column("text"))
                runs = runs_of(words.dictionary_encode().indices.to_numpy(), n)
                doc, start, length, period = runs.T
                begins = (np.cumsum(n) - n)[doc] + start
                # One more for each run that covers a word after its first period.
                covers = np.bincount(begins + period, minlength=len(words) + 1) - np.bincount(begins + length, minlength=len(words) + 1)
                kept = np.cumsum(covers)[:-1] == 0
                ends = np.append(0, np.cumsum(n))
                bounds = np.append(0, np.cumsum(kept))[ends]
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype("int32")), words.filter(pa.array(kept)))
                inner = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in (start, length, period)], ["start", "length", "period"])
                of_doc = np.append(0, np.cumsum(np.bincount(doc, minlength=len(n)))).astype("int32")
                columns = [rows.column("doc_id"), pa.array(n.astype("int64")), pa.ListArray.from_arrays(pa.array(of_doc), inner), pc.binary_join(lists, " ")]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(search, schema)
