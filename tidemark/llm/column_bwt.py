"""Substring dedup on the Burrows-Wheeler transform of a collection, built column by column.

A byte goes if a 50-byte string over it also starts in a document with a smaller id. To bring equal
strings of different documents together without one transform over everything:

1. Each 50-byte string has an anchor, the least hash among its 25-byte strings; equal strings have
   equal anchors. Neighbouring strings with the same anchor form one piece of 50 to 75 bytes. Map
   tasks pack (anchor, size and checksum of the piece, document, place) by ranges of the anchor's
   hash. Of equal pieces only the least document's is asked about: the others go as they stand. That
   holds within a map task already, so a hot passage sends one row from each.
2. What is left is one document for each different piece. Where an anchor has pieces of several
   documents, they are cut from the texts and dealt out by anchor.
3. Each group of anchors is a collection of different pieces. Its transform is built from the last
   column to the first: each round inserts one symbol of every piece at the place that the symbols
   of the round before give it (``Collection``). In the finished order strings of a common prefix
   are neighbours; the least document of each run of common 50-byte prefixes decides for all.
4. The strings that go are joined back to the documents as spans. A span carries the checksum of its
   bytes, so that it is only applied to those texts of an id that have these bytes there.

Groups are sized by the input on average: the different pieces of one anchor are in one group. The
files that a single machine would read and write in each round are these groups' arrays.
"""

from __future__ import annotations

import gc
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import steps
from tidemark.session import checkpoint_root

LENGTH = 50
GRAM = 25
# Places that a map task packs at a time, and bytes of input for each range of hashes and each bucket of documents.
PACKED = 125_000
RANGE_BYTES = 3_000_000
# Bytes of text that a map task looks at together.
LOT = 1_000_000
# Pieces for each collection.
COLLECTION = 10_000
STEP = 1 << 17
LOW = np.uint64((1 << 20) - 1)
FACTOR = 0x9DDFEA08EB382D69
# A piece's kind: checksum above, size in the low bits.
SIZE_BITS = 7
COLUMNS = {"anchors": np.uint64, "kinds": np.int64, "docs": np.int64, "starts": np.int64}
MESSAGE = "place int, sure boolean, anchors binary, kinds binary, docs binary, starts binary"
SPAN_KEYS = ["kinds", "docs", "starts"]
FORM = pa.schema([("place", pa.int32()), ("sure", pa.bool_()), *[(c, pa.binary()) for c in COLUMNS]])
# While a step is written: its shuffle files go when it is done, few texts are sent to
# Python at a time, and a task holds and writes little of what it has fetched.
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def _power(n: int) -> np.uint64:
    return np.uint64(pow(FACTOR, n, 1 << 64))


def _grams(data: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM-byte strings, by doubling: 25 = 16 + 8 + 1."""
    h1 = data.astype(np.uint64) + np.uint64(1)
    h2 = h1[:-1] * _power(1) + h1[1:]
    h4 = h2[:-2] * _power(2) + h2[2:]
    h8 = h4[:-4] * _power(4) + h4[4:]
    h16 = h8[:-8] * _power(8) + h8[8:]
    n = len(data) - GRAM + 1
    x = h16[:n] * _power(9) + h8[16 : 16 + n] * _power(1) + h1[24 : 24 + n]
    return _mixed(x)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of another factor and of its inverse, n at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        factor = FACTOR ^ 0x5851F42D4C957F2C
        values = (factor, pow(factor, -1, 1 << 64))
        _POWERS[:] = [np.cumprod(np.append(np.ones(1, np.uint64), np.full(n, f, np.uint64)), dtype=np.uint64) for f in values]
    return _POWERS


def kinds(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Checksum and size of parts of a text, whatever their place in it."""
    up, down = _powers(len(data) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)))
    check = _mixed((total[start + size] - total[start]) * down[start]) >> np.uint64(32)
    return (check.astype(np.int64) << SIZE_BITS) | size


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, kind and first byte of each piece of a text."""
    data = np.frombuffer(text, dtype=np.uint8)
    total = len(data) - LENGTH + 1
    found = []
    for at in range(0, max(total, 0), STEP):
        part = data[at : at + STEP + LENGTH - 1]
        grams = _grams(part)
        # The place in the low bits makes the first of equal hashes the least.
        least = (grams & ~LOW) | np.arange(len(grams), dtype=np.uint64)
        for shift in (1, 2, 4, 8, 10):
            least = np.minimum(least[:-shift], least[shift:])
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        size = np.diff(np.append(first, len(least))) + LENGTH - 1
        found.append((grams[(least[first] & LOW).astype(np.int64)], kinds(part, first, size), first + at))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _starts(*keys: np.ndarray) -> np.ndarray:
    """First places of the runs of equal keys."""
    new = np.zeros(max(len(keys[0]) - 1, 0), dtype=bool)
    for key in keys:
        new |= key[1:] != key[:-1]
    return np.flatnonzero(np.concatenate((np.ones(min(len(keys[0]), 1), dtype=bool), new)))


def _messages(to: np.ndarray, sure: bool, values: dict[str, np.ndarray]) -> list[tuple]:
    """One row for each place; equal bytes of the numbers stand together, since most are zero."""
    order = np.argsort(to, kind="stable")
    to, values = to[order], {c: v[order] for c, v in values.items()}
    cuts = [*_starts(to).tolist(), len(to)]

    def planes(column: str, a: int, b: int) -> bytes:
        return values[column][a:b].view(np.uint8).reshape(-1, 8).T.tobytes() if column in values else b""

    return [(int(to[a]), sure, *[planes(c, a, b) for c in COLUMNS]) for a, b in zip(cuts, cuts[1:])]


def _released(result):
    """Memory that Arrow holds for later use goes back, since idle workers keep theirs."""
    pa.default_memory_pool().release_unused()
    return result


def _table(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * len(FORM)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FORM)], schema=FORM)


def _read(rows: pa.Table, column: str) -> np.ndarray:
    kind = COLUMNS[column]
    parts = [np.frombuffer(x.as_buffer(), np.uint8).reshape(8, -1).T.copy().view(kind).ravel() for x in rows[column]]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _divided(anchor: np.ndarray, kind: np.ndarray, doc: np.ndarray, start: np.ndarray):
    """Places whose piece is also in a smaller document, and the others, by anchor and kind."""
    order = np.lexsort((doc, kind, anchor))
    anchor, kind, doc, start = anchor[order], kind[order], doc[order], start[order]
    first = _starts(anchor, kind)
    goes = doc > np.repeat(doc[first], np.diff(np.append(first, len(doc))))
    return (kind[goes], doc[goes], start[goes]), (anchor[~goes], kind[~goes], doc[~goes], start[~goes])


def _packed(n_ranges: int):
    def flush(held: list) -> list[pa.RecordBatch]:
        sure, asks = _divided(*(np.concatenate(x) for x in zip(*held)))
        # Evenly, not by anchor: nothing is asked of these any more.
        spread = np.arange(len(sure[0])) * n_ranges // max(len(sure[0]), 1)
        # By the low bits: an anchor is a least hash, so its high bits crowd near zero.
        place = (asks[0] & np.uint64(0xFFFFFFFF)) * np.uint64(n_ranges) >> np.uint64(32)
        rows = _messages(spread, True, dict(zip(SPAN_KEYS, sure))) + _messages(place, False, dict(zip(COLUMNS, asks)))
        return _released(_table(rows).to_batches())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for lot in (x for batch in batches for x in steps(batch, "text", LOT)):
            for doc, text in zip(lot["doc_id"].to_pylist(), lot["text"].to_pylist()):
                anchor, kind, start = anchors(text)
                held.append((anchor, kind, np.full(len(anchor), doc, dtype=np.int64), start))
                n += len(anchor)
                if n >= PACKED:
                    yield from flush(held)
                    held, n = [], 0
        if n:
            yield from flush(held)

    return run


def _bucket_of(doc: np.ndarray, n_buckets: int) -> np.ndarray:
    return np.mod(doc ^ (doc >> 20), n_buckets)


def _bucket(doc: Column, text: Column, n_buckets: int) -> Column:
    """The same in Spark; rows without an id are spread by their text."""
    mixed = F.coalesce(doc.bitwiseXOR(F.shiftright(doc, 20)), F.xxhash64(text))
    return F.pmod(mixed, F.lit(n_buckets)).cast("int").alias("place")


def _answers(n_buckets: int):
    """By bucket of documents: pieces that go, and those that must be compared with others of their anchor."""

    def run(group: pa.Table) -> pa.Table:
        told, asked = group.filter(group["sure"]), group.filter(pc.invert(group["sure"]))
        goes, rest = _divided(*(_read(asked, c) for c in COLUMNS))
        goes = [np.concatenate((_read(told, c), x)) for c, x in zip(SPAN_KEYS, goes)]
        anchor, doc = rest[0], rest[2]
        if len(anchor):
            first = _starts(anchor)
            several = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
            keep = np.repeat(several, np.diff(np.append(first, len(anchor))))
            rest = tuple(x[keep] for x in rest)
        rows = _messages(_bucket_of(goes[1], n_buckets), True, dict(zip(SPAN_KEYS, goes)))
        rows += _messages(_bucket_of(rest[2], n_buckets), False, dict(zip(COLUMNS, rest)))
        return _released(_table(rows))

    return run


def _texts_of(docs: pa.Table) -> dict[int, list[bytes]]:
    """Different texts of each id."""
    texts: dict[int, list[bytes]] = defaultdict(list)
    for doc, text in zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist()):
        if doc is not None and text not in texts[doc]:
            texts[doc].append(text)
    return texts


def _holds(text: bytes, start: int, kind: int) -> bool:
    """Whether a text has the bytes of a kind at a place."""
    size = kind & ((1 << SIZE_BITS) - 1)
    part = np.frombuffer(text[start : start + size], dtype=np.uint8)
    return len(part) == size and int(kinds(part, np.zeros(1, np.int64), np.array([size]))[0]) == kind


def _pieces(n_collections: int):
    def run(docs: pa.Table, rows: pa.Table) -> pa.Table:
        texts = _texts_of(docs)
        anchor, kind, doc, start = (_read(rows, c) for c in COLUMNS)
        held: dict[tuple[int, bytes], list] = defaultdict(list)
        groups = (anchor % np.uint64(n_collections)).tolist()
        sizes = (kind & ((1 << SIZE_BITS) - 1)).tolist()
        for group, size, k, d, at in zip(groups, sizes, kind.tolist(), doc.tolist(), start.tolist()):
            of_id = texts[d]
            text = of_id[0] if len(of_id) == 1 else next(t for t in of_id if _holds(t, at, k))
            held[group, text[at : at + size]] += (d, at)
        return pa.table(
            {
                "collection": pa.array([group for group, _ in held], pa.int64()),
                "piece": pa.array([piece for _, piece in held], pa.binary()),
                # Document and first byte in turn.
                "places": pa.array([np.array(p, dtype=np.int64).tobytes() for p in held.values()], pa.binary()),
            }
        )

    return run


class Collection:
    """The transform of a collection of byte strings (without zero bytes at odds: symbols are shifted by one).

    ``symbols`` is the transform, ``text`` and ``length`` tell the suffix at each place.
    """

    def __init__(self, pieces: list[bytes]) -> None:
        n = len(pieces)
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=n)
        self.width = int(sizes.max(initial=0))
        # Right-aligned; zero stands before the first symbol, and no symbol is zero.
        columns = np.zeros((n, self.width + 1), dtype=np.uint16)
        for i, piece in enumerate(pieces):
            columns[i, self.width + 1 - len(piece) :] = np.frombuffer(piece, dtype=np.uint8)
            columns[i, self.width + 1 - len(piece) :] += 1
        self.columns = columns
        self.text = np.arange(n, dtype=np.int32)
        self.length = np.zeros(n, dtype=np.uint8)
        self.symbols = columns[:, self.width].copy()
        active, place = np.arange(n), np.arange(n)
        for done in range(1, self.width + 1):
            more = sizes[active] >= done
            active, place = active[more], place[more]
            # The order of the suffixes that start with a symbol is that of the symbol's places.
            order = np.argsort(self.symbols, kind="stable")
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            ended = int(np.count_nonzero(self.symbols == 0))
            place = n + rank[place] - ended
            old = np.ones(len(self.symbols) + len(active), dtype=bool)
            old[place] = False
            self.symbols = self._inserted(self.symbols, old, place, columns[active, self.width - done])
            self.text = self._inserted(self.text, old, place, active)
            self.length = self._inserted(self.length, old, place, done)

    @staticmethod
    def _inserted(held: np.ndarray, old: np.ndarray, place: np.ndarray, new) -> np.ndarray:
        both = np.empty(len(old), dtype=held.dtype)
        both[old] = held
        both[place] = new
        return both

    def runs(self, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, offset from its end, and run of every suffix of at least ``prefix`` symbols; suffixes
        of one run begin with the same ``prefix`` symbols."""
        long = np.flatnonzero(self.length >= prefix)
        text, length = self.text[long].astype(np.int64), self.length[long].astype(np.int64)
        start = text * (self.width + 1) + self.width + 1 - length
        flat, new = self.columns.ravel(), np.ones(len(long), dtype=bool)
        for at in range(0, len(long) - 1, 50_000):
            a, b = start[at : at + 50_000], start[at + 1 : at + 50_001]
            a = a[: len(b)]
            same = np.ones(len(b), dtype=bool)
            for j in range(prefix):
                same &= flat[a + j] == flat[b + j]
            new[at + 1 : at + 1 + len(b)] = ~same
        return text, length, np.cumsum(new) - 1


def _judged(n_buckets: int):
    """The strings that go, neighbours of a piece as one, by bucket of documents."""

    def run(group: pa.Table) -> pa.Table:
        numbers: dict[bytes, int] = {}
        number = np.array([numbers.setdefault(p, len(numbers)) for p in group["piece"].to_pylist()], dtype=np.int64)
        packed = group["places"].to_pylist()
        counts = np.array([len(p) // 16 for p in packed], dtype=np.int64)
        places = np.frombuffer(b"".join(packed), dtype=np.int64).reshape(-1, 2)
        doc, start, piece = places[:, 0], places[:, 1], np.repeat(number, counts)
        least = np.full(len(numbers), np.iinfo(np.int64).max)
        np.minimum.at(least, piece, doc)
        text, length, run = Collection(list(numbers)).runs(LENGTH)
        first = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
        smallest = np.minimum.reduceat(least[text], first)[run]
        # By piece and then by place in it: a string for each place that has LENGTH bytes.
        order = np.lexsort((-length, text))
        smallest = smallest[order]
        strings = np.bincount(text, minlength=len(numbers))
        begin = np.concatenate(([0], np.cumsum(strings)[:-1]))
        n = strings[piece]
        row = np.repeat(np.arange(len(piece)), n)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        goes = smallest[begin[piece[row]] + offset] < doc[row]
        row, offset = row[goes], offset[goes]
        if not len(row):
            return _table([])
        starts = np.concatenate(([True], (row[1:] != row[:-1]) | (offset[1:] != offset[:-1] + 1)))
        ends = np.concatenate((starts[1:], [True]))
        row, offset, size = row[starts], offset[starts], offset[ends] - offset[starts] + LENGTH
        before = np.concatenate(([0], np.cumsum([len(p) for p in numbers])[:-1]))
        kind = kinds(np.frombuffer(b"".join(numbers), dtype=np.uint8), before[piece[row]] + offset, size)
        spans = {"kinds": kind, "docs": doc[row], "starts": start[row] + offset}
        return _released(_table(_messages(_bucket_of(doc[row], n_buckets), True, spans)))

    return run


def _merged(text: bytes, starts: list[int], of_kind: list[int], check: bool) -> list[list[int]]:
    merged: list[list[int]] = []
    for start, kind in zip(starts, of_kind):
        if check and not _holds(text, start, kind):
            continue
        end = start + (kind & ((1 << SIZE_BITS) - 1))
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    return merged


def _cut(docs: pa.Table, rows: pa.Table) -> pa.Table:
    kind, doc, start = (_read(rows, c) for c in SPAN_KEYS)
    order = np.lexsort((start, doc))
    kind, doc, start = kind[order], doc[order], start[order]
    several = {d for d, texts in _texts_of(docs).items() if len(texts) > 1}
    kept, spans, sizes = [], [], []
    for d, data in zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist()):
        a, b = (0, 0) if d is None else (np.searchsorted(doc, d, side) for side in ("left", "right"))
        merged = _merged(data, start[a:b].tolist(), kind[a:b].tolist(), d in several)
        parts, done = [], 0
        for first, end in merged:
            parts.append(data[done:first])
            done = end
        kept.append(b"".join(parts) + data[done:])
        spans.append(merged)
        sizes.append(len(data))
    return _released(pa.table(
        {
            "doc_id": docs["doc_id"].cast(pa.int64()),
            "n_bytes": pa.array(sizes, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))),
            "kept": pa.array(kept, pa.binary()),
        }
    ))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (first byte and end of each removed run) and kept (bytes) of every row.

    Null and empty texts have no bytes. Rows that repeat an id are not held against each other; each
    keeps its own spans, whether their texts are equal or not. Rows without an id are not compared.
    doc_id must be an integer; extra columns are not looked at; an empty table gives no rows; a very
    long text is hashed in steps, but cut as a whole.
    """
    spark = docs.sparkSession
    folder = f"{checkpoint_root(spark)}/bwt-{uuid.uuid4().hex}"

    def keep(df: DataFrame, step: str) -> DataFrame:
        before = {name: spark.conf.get(name, None) for name in WRITING}
        for name, value in WRITING.items():
            spark.conf.set(name, value)
        try:
            df.write.parquet(f"{folder}/{step}")
        finally:
            for name, value in before.items():
                spark.conf.unset(name) if value is None else spark.conf.set(name, value)
        gc.collect()
        return spark.read.schema(df.schema).parquet(f"{folder}/{step}")

    whole = F.coalesce(F.col(text), F.lit("")).cast("string")
    named = docs.filter(F.col(doc_id).isNotNull())
    n_bytes = named.agg(F.sum(F.octet_length(whole))).first()[0] or 0
    n_ranges = int(n_bytes // RANGE_BYTES) + 1
    n_buckets = n_ranges | 1
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole.alias("text")).select(
        "doc_id", F.col("text").cast("binary").alias("text"), _bucket(F.col("doc_id"), F.col("text"), n_buckets)
    )
    named = texts.filter("doc_id IS NOT NULL")
    asked = named.select("doc_id", "text").mapInArrow(_packed(n_ranges), MESSAGE)
    told = keep(asked.groupBy("place").applyInArrow(_answers(n_buckets), MESSAGE), "told")
    sure, open_ = told.filter("sure"), told.filter("NOT sure")
    n_open = open_.agg(F.sum(F.octet_length("docs"))).first()[0] or 0
    pieces = (
        named.groupBy("place").cogroup(open_.groupBy("place"))
        .applyInArrow(_pieces(n_open // 8 // COLLECTION + 1), "collection long, piece binary, places binary")
    )
    judged = keep(pieces.groupBy("collection").applyInArrow(_judged(n_buckets), MESSAGE), "judged")
    spans = sure.unionByName(judged).select("place", *SPAN_KEYS)
    return texts.groupBy("place").cogroup(spans.groupBy("place")).applyInArrow(
        _cut, "doc_id long, n_bytes long, spans array<array<long>>, kept binary"
    )
