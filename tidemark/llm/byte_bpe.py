"""Byte-level BPE by published ranks: encoding of texts and decoding of ids.

Tier one resolves a pre-token that is a vocabulary entry as a whole, through a minimal perfect hash
over the vocabulary (one slot per entry, so a lookup is one hash, one displacement and one compare).
Tier two merges the bytes of the others: bytes are linked both ways, and a heap gives the next pair
by rank and then by place. Texts are cut at white space first, which no pre-token but a leading
space crosses; what a piece encodes to is remembered in each worker, up to ``MEMO`` characters of
pieces of at most ``LONGEST``.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SPACE, steps

MEMO = 16_000_000
LONGEST = 64
# Bytes of text that are encoded at a time, but for single longer texts.
STEP = 1_000_000
PIECE = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")


class PerfectHash:
    """Places of ``keys`` (distinct bytes) in a table without gaps; other keys give None."""

    def __init__(self, keys: list[bytes]) -> None:
        self.size = max(len(keys), 1)
        self.n_buckets = self.size // 2 + 1
        self.slots: list[int] = [-1] * self.size
        self.keys = keys
        # Zero or more: the displacement of the bucket. Below: the slot of its only key.
        self.shift = [0] * self.n_buckets
        buckets: list[list[int]] = [[] for _ in range(self.n_buckets)]
        hashes = [self._hash(key) for key in keys]
        for place, (first, _) in enumerate(hashes):
            buckets[first % self.n_buckets].append(place)
        order = sorted(range(self.n_buckets), key=lambda b: -len(buckets[b]))
        free = 0
        for bucket in order:
            members = buckets[bucket]
            if len(members) > 1:
                shift = 0
                while not self._fits(members, hashes, shift):
                    shift += 1
                self.shift[bucket] = shift
            elif members:
                while self.slots[free] >= 0:
                    free += 1
                self.slots[free] = members[0]
                self.shift[bucket] = -free - 1

    @staticmethod
    def _hash(key: bytes) -> tuple[int, int]:
        both = xxhash.xxh3_128_intdigest(key)
        return both >> 64, both & 0xFFFFFFFFFFFFFFFF

    def _slot(self, first: int, second: int, shift: int) -> int:
        mixed = ((second ^ shift * 0x9E3779B97F4A7C15) * (first | 1)) & 0xFFFFFFFFFFFFFFFF
        return (mixed >> 32) % self.size

    def _fits(self, members: list[int], hashes: list[tuple[int, int]], shift: int) -> bool:
        taken = [self._slot(*hashes[m], shift) for m in members]
        if len(set(taken)) < len(taken) or any(self.slots[t] >= 0 for t in taken):
            return False
        for place, member in zip(taken, members):
            self.slots[place] = member
        return True

    def get(self, key: bytes) -> int | None:
        first, second = self._hash(key)
        shift = self.shift[first % self.n_buckets]
        slot = -shift - 1 if shift < 0 else self._slot(first, second, shift)
        place = self.slots[slot]
        return place if place >= 0 and self.keys[place] == key else None


def merged(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token by its merges; of equal ranks the leftmost pair goes first."""
    n = len(token)
    parts: list[bytes | None] = [token[i : i + 1] for i in range(n)]
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get(token[i : i + 2])
        if rank is not None:
            heap.append((rank, i, 2))
    heapq.heapify(heap)
    while heap:
        _, left, length = heapq.heappop(heap)
        right = after[left]
        # Stale entries: the left part is gone, or the pair has other parts by now.
        if parts[left] is None or right >= n or len(parts[left]) + len(parts[right]) != length:
            continue
        whole = parts[left] + parts[right]
        parts[left], parts[right] = whole, None
        following = after[left] = after[right]
        if following < n:
            before[following] = left
            rank = ranks.get(whole + parts[following])
            if rank is not None:
                heapq.heappush(heap, (rank, left, length + len(parts[following])))
        previous = before[left]
        if previous >= 0:
            rank = ranks.get(parts[previous] + whole)
            if rank is not None:
                heapq.heappush(heap, (rank, previous, len(parts[previous]) + length))
    return [ranks[part] for part in parts if part is not None]


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        tokens = list(self.ranks)
        self.whole = PerfectHash(tokens)
        self.rank_of = [self.ranks[token] for token in tokens]
        self.names = {rank: str(rank) for rank in self.rank_of}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.memo: dict[str, bytes] = {}
        self.held = 0

    def _piece(self, piece: str) -> bytes:
        ids: list[int] = []
        for match in self.pattern.findall(piece):
            token = match.encode()
            place = self.whole.get(token)
            if place is None:
                ids += merged(token, self.ranks)
            else:
                ids.append(self.rank_of[place])
        return np.array(ids, dtype="<i4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        pieces = PIECE.findall(text)
        if self.held > MEMO:
            self.memo.clear()
            self.held = 0
        memo = self.memo
        found = list(map(memo.get, pieces))
        if None in found:
            for place, piece in enumerate(pieces):
                if found[place] is None:
                    known = memo.get(piece)
                    if known is None:
                        known = self._piece(piece)
                        if len(piece) <= LONGEST:
                            memo[piece] = known
                            self.held += len(piece)
                    found[place] = known
        return np.frombuffer(b"".join(found), dtype="<i4")

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encoder(path: str, pattern: str) -> Callable[[Column], Column]:
    """Column of texts to array<int>; a null text has no ids, as an empty one."""

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        use = codec(path, pattern)
        return pd.Series([use.encode(text) if text else np.array([], dtype="<i4") for text in texts], dtype=object)

    return encode


def decoder(path: str, pattern: str) -> Callable[[Column], Column]:
    """Column of array<int> to the bytes they stand for; null stays null, an unknown id is an error."""

    @F.pandas_udf("binary")
    def decode(ids: pd.Series) -> pd.Series:
        use = codec(path, pattern)
        return pd.Series([None if one is None else use.decode(one) for one in ids], dtype=object)

    return decode


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids in decimal, joined by commas), decoded_sha256.

    Every text is encoded once, and what is decoded are those ids; neither leaves the task. A null text
    has no ids, as an empty one; very long texts are encoded whole. Rows that repeat an id are documents of
    their own. An empty table gives no rows; extra columns are not looked at.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(path, pattern)
        for batch in batches:
            for rows in steps(batch, "text", STEP):
                found = []
                for one in rows.column("text"):
                    ids = use.encode(one.as_py() or "")
                    joined = ",".join(map(use.names.__getitem__, ids.tolist()))
                    found.append((len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(use.decode(ids)).hexdigest()))
                n, of_ids, of_bytes = (list(c) for c in zip(*found))
                columns = [rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_bytes)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(encode, schema)
