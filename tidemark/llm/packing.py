"""Packing: concatenate all documents and cut at fixed places.

Pass one tokenises every text once, ends it with ``end_id`` and writes the ids to the shared folder
with the place of each document in its part (the tokens of the part before it). Pass two sums the
tokens per part, turns the totals into the first global place of each part (prefix sums in two
levels, over parts within blocks of parts and over blocks), and cuts the stream at every multiple
of the sequence length. A document that lies across a cut has a boundary record, a piece, on either
side. Only the very last sequence is short.
"""

from __future__ import annotations

import os
import re
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import Growing, steps
from tidemark.session import checkpoint_root

SEQUENCE = 2048
END_ID = 1
# Characters of pieces a worker remembers, and the longest piece it does remember.
MEMO = 16_000_000
LONGEST = 64
BLOCK = 1024
# Parts (tasks of pass one) whose first places may be broadcast; a row takes 16 bytes.
BROADCAST_PARTS = 1_000_000
# Marks that may follow a word; none is a letter or a number.
MARKS = ".,;:!?|)\""
# New words that are encoded as one text.
JOINED = 500
# Characters of text that are tokenised at a time, but for single longer texts.
STEP = 4_000_000
# Letters are looked for below this code point: nothing there joins with the letter before it.
LATIN = 0x250


class Pieces:
    """Ids of texts by a tokenizer file whose pre-tokens never cross white space.

    Normalising, splitting and merging then happen within the pieces between white space, so a batch
    of texts is split, its different pieces are looked up once each, and their ids are gathered by
    place. Pieces are remembered, up to ``MEMO`` characters. Letters and the marks after them are
    different pre-tokens and case does not count, so a new piece of Latin letters, each of which the
    tokenizer takes to one letter, is put together from its word in lower case and its marks; any other
    piece is encoded as it stands.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        normal = self.tokenizer.normalizer.normalize_str
        letters = "".join(c for c in map(chr, range(LATIN)) if c.isalpha() and len(c.lower()) == 1 and normal(c) == c.lower())
        self.plain = re.compile(f"([{letters}]+)([{re.escape(MARKS)}]*)")
        # For words that need no normalising; an id that ends a pre-token ends a word.
        self.words = Tokenizer.from_file(path)
        self.words.normalizer = normalizers.Sequence([])
        whole_words = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        self.words.pre_tokenizer = pre_tokenizers.Sequence(whole_words)
        vocabulary = self.tokenizer.get_vocab()
        suffix = self.tokenizer.model.end_of_word_suffix
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.parts: dict[str, bytes] = {"": b""}
        self.held = 0
        self.starts, self.lengths, self.ids = Growing("int64"), Growing("int64"), Growing("uint32")

    def _encoded(self, new: list[str]) -> list[bytes]:
        """Ids of pieces, each different, as 32-bit numbers."""
        parts, match = self.parts, self.plain.fullmatch
        parted = [(m[1].lower(), m[2]) if (m := match(piece)) else None for piece in new]
        both = list(filter(None, parted))
        self._learn_words(list({word for word, _ in both}.difference(parts)))
        marks = list({mark for _, mark in both}.difference(parts))
        loose = [*marks, *(piece for piece, found in zip(new, parted) if found is None)]
        ids = [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(loose, add_special_tokens=False)]
        parts.update(zip(marks, ids))
        whole = iter(ids[len(marks) :])
        return [parts[found[0]] + parts[found[1]] if found else next(whole) for found in parted]

    def _learn_words(self, words: list[str]) -> None:
        """Words of plain letters in lower case are a pre-token each, so many can be encoded as one text."""
        for at in range(0, len(words), JOINED):
            lot = words[at : at + JOINED]
            (encoding,) = self.words.encode_batch_fast([" ".join(lot)], add_special_tokens=False)
            ids = np.array(encoding.ids, "uint32")
            ends = ((np.flatnonzero(self.is_end[ids]) + 1) * 4).tolist()
            data = ids.tobytes()
            self.parts.update(zip(lot, (data[a:b] for a, b in zip([0, *ends], ends)), strict=True))
        self.held += sum(map(len, words))

    def _add(self, new: list[str]) -> np.ndarray:
        """Places of new pieces in the table of ids."""
        encoded = self._encoded(new)
        lengths = np.fromiter(map(len, encoded), "int64", len(encoded)) // 4
        first = len(self.lengths)
        self.starts.add(len(self.ids) + np.cumsum(lengths) - lengths)
        self.lengths.add(lengths)
        self.ids.add(np.frombuffer(b"".join(encoded), "uint32"))
        return np.arange(first, len(self.lengths))

    def _looked_up(self, pieces: list[str]) -> np.ndarray:
        found = np.fromiter((self.places.get(p, -1) for p in pieces), "int64", len(pieces))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [pieces[i] for i in missing.tolist()]
            places = self._add(new)
            found[missing] = places
            short = [(p, i) for p, i in zip(new, places.tolist()) if len(p) <= LONGEST]
            self.places.update(short)
            self.held += sum(len(p) for p, _ in short)
        return found

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has; ``end_id`` ends every text."""
        # No piece stays known by the place it had, so forgetting is safe between texts only.
        if self.held > MEMO or len(self.ids) > MEMO:
            self._forget()
        split = pc.ascii_split_whitespace(texts)
        bounds = split.offsets.to_numpy().astype("int64")
        words = split.flatten().dictionary_encode()
        places = self._looked_up(words.dictionary.to_pylist())[words.indices.to_numpy()]
        lengths = self.lengths[places]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        bounds = bounds - bounds[0]
        at = np.repeat(self.starts[places] - ends[:-1], lengths)
        ids = self.ids[at + np.arange(len(at))]
        last = ends[bounds[1:]]
        n = np.diff(ends[bounds])
        if end_id is not None:
            ids, n = np.insert(ids, last, end_id), n + 1
        return ids, n


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def as_binary(values: np.ndarray, n: np.ndarray) -> pa.Array:
    """Consecutive runs of ``n`` 32-bit numbers as one binary value each."""
    bounds = np.concatenate([[0], np.cumsum(n * 4)]).astype("int32")
    data = np.ascontiguousarray(values.astype("<u4", copy=False))
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def tokenised(docs: DataFrame, path: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """part, before, doc_id, n, ids of every row, from a table written to the shared folder."""
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("before", T.LongType()),
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("n", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, part, before = pieces(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in steps(batch, "text", STEP):
                ids, n = use.encode(rows.column("text"), end_id)
                starts = before + np.cumsum(n) - n
                before += int(n.sum())
                columns = [pa.array(np.full(len(n), part, "int32")), pa.array(starts), rows.column("doc_id"), pa.array(n.astype("int32")), as_binary(ids, n)]
                yield pa.RecordBatch.from_arrays(columns, ["part", "before", "doc_id", "n", "ids"])

    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    target = f"{checkpoint_root(spark)}/tokens-{uuid.uuid4().hex}"
    rows.mapInArrow(encode, schema).write.option("compression", "zstd").parquet(target)
    return spark.read.schema(schema).parquet(target)


def first_places(tokens: DataFrame) -> DataFrame:
    """part, base: tokens of all parts before it."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("tokens")).withColumn("block", F.floor(F.col("part") / BLOCK))
    before = (Window.unboundedPreceding, -1)
    blocks = (
        totals.groupBy("block")
        .agg(F.sum("tokens").alias("tokens"))
        .select("block", F.coalesce(F.sum("tokens").over(Window.orderBy("block").rowsBetween(*before)), F.lit(0)).alias("first"))
    )
    within = F.sum("tokens").over(Window.partitionBy("block").orderBy("part").rowsBetween(*before))
    return totals.withColumn("within", F.coalesce(within, F.lit(0))).join(blocks, "block").select(
        "part", (F.col("first") + F.col("within")).alias("base")
    )


def packed(
    docs: DataFrame,
    path: str,
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset of all pieces.

    A null or empty text is its end id alone. Rows that repeat an id are documents of their own; an
    empty table gives no pieces; extra columns are not looked at.
    """
    tokens = tokenised(docs, path, end_id, doc_id, text)
    base = first_places(tokens)
    if base.count() <= BROADCAST_PARTS:
        base = F.broadcast(base)
    placed = tokens.join(base, "part").select("doc_id", "n", "ids", (F.col("base") + F.col("before")).alias("at"))
    last = F.floor((F.col("at") + F.col("n") - 1) / sequence)
    cut = placed.select("*", F.explode(F.sequence(F.floor(F.col("at") / sequence), last)).alias("sequence_id"))
    begin = F.greatest(F.col("sequence_id") * sequence, F.col("at"))
    end = F.least((F.col("sequence_id") + 1) * sequence, F.col("at") + F.col("n"))
    return cut.select(
        "doc_id",
        (begin - F.col("at")).alias("start"),
        (end - begin).alias("length"),
        F.substring("ids", ((begin - F.col("at")) * 4 + 1).cast("int"), ((end - begin) * 4).cast("int")).alias("ids"),
        F.col("n").cast("long").alias("doc_tokens"),
        "sequence_id",
        (begin - F.col("sequence_id") * sequence).alias("offset"),
    )
