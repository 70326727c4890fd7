"""Alignment of the tokens of two tokenizers over the same bytes.

Both sides read a space and then the text. Neither joins bytes across a place where a blank or a line
feed follows something else, so a document is cut there, and each different piece of a batch is encoded
and aligned once. In the batch, keyed by piece, ``merge_asof`` gives each token start the other side's
covering token; the union of both directions are the overlaps, and equal ends cut pieces into groups.
Every token of one side is linked with every token of the other in its group.

How many documents hold a linked pair of ids takes a second look at the links. A step of documents is
one block: a row with its different pairs, the pairs of its pieces, and the pieces of its documents. Pairs
are counted per block first, so a frequent pair has one row a block and not one a document. The counts
go back to the blocks, where a document's sums follow from its pieces.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import Growing, spread, steps
from tidemark.session import checkpoint_root

# Bytes of text to a block, but for single longer texts.
BLOCK = 2_000_000
# Bytes of pieces a worker remembers, and of the longest piece it does remember.
MEMO = 2_500_000
LONGEST = 64
# Bytes of new pieces that are encoded as one text.
JOINED = 20_000
PAIR_BITS = 32
# Documents whose pairs are laid out at a time.
LOT = 128
# White space beyond ASCII, by its bytes in UTF-8.
WIDE_BLANKS = tuple(chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
LOW_LINE = "▁"

FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")


def _byte_level() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable ones are themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace(LOW_LINE, " ").encode()


def _sizes(tokens: dict[int, bytes]) -> np.ndarray:
    sizes = np.zeros(max(tokens) + 1, "int64")
    sizes[list(tokens)] = [len(t) for t in tokens.values()]
    return sizes


def _spelled(tokens: dict[int, bytes]) -> np.ndarray:
    """The bytes of all tokens by id, one after the other."""
    return np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), "uint8")


def _ends_within(ends: np.ndarray, others: np.ndarray) -> bool:
    """All of ``ends`` are among ``others``; both ascend and end alike."""
    return bool((others[np.searchsorted(others, ends)] == ends).all())


class Sides:
    """Both tokenizers, and what is known of the pieces met so far."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of, vocabulary = _byte_level(), json.loads(self.a.to_str())["model"]["vocab"]
        self.bytes_a = {i: bytes(byte_of[c] for c in token) for token, i in vocabulary.items() if all(c in byte_of for c in token)}
        self.bytes_b = {i: _piece_bytes(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())}
        self.sizes_a, self.sizes_b = _sizes(self.bytes_a), _sizes(self.bytes_b)
        self.spelled_a, self.spelled_b = _spelled(self.bytes_a), _spelled(self.bytes_b)
        self.names = pa.array([str(i) for i in range(max(len(self.sizes_a), len(self.sizes_b)))])
        self._forget()

    def _forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.groups: list[str] = []
        self.held = 0
        self.valid = Growing(bool)
        self.figures = {name: Growing("int64") for name in FIGURES}
        # Pairs of ids of a piece: where they begin, how many, and how often each is linked.
        self.first, self.n_pairs, self.pairs, self.times = (Growing("int64") for _ in range(4))

    # Encoding

    def _encode_one(self, piece: bytes) -> tuple[list[int], list[int]] | None:
        """Ids of both sides, or None where a side's bytes are not the piece's."""
        text = piece.decode()
        ids_a = self.a.encode(text, add_special_tokens=False).ids
        if text.startswith(" "):
            ids_b = self.b.encode(text[1:]) if len(text) > 1 else [self.b.piece_to_id(LOW_LINE)]
        else:
            # The space that the model puts first stays alone before a line feed.
            ids_b = self.b.encode(text)[1:]
        same = b"".join(self.bytes_a[i] for i in ids_a) == b"".join(self.bytes_b[i] for i in ids_b) == piece
        return (ids_a, ids_b) if same else None

    def _encode_lot(self, lot: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides of pieces that follow each other, or None if they don't end together."""
        text = b"".join(lot)
        (found,) = self.a.encode_batch_fast([text.decode()], add_special_tokens=False)
        ids_a = np.array(found.ids, "int64")
        ids_b = np.array(self.b.encode(text.decode()[1:]), "int64")
        ends = np.cumsum([len(piece) for piece in lot])
        for ids, sizes, spelled in ((ids_a, self.sizes_a, self.spelled_a), (ids_b, self.sizes_b, self.spelled_b)):
            own = sizes[ids]
            letters = spelled[spread((np.cumsum(sizes) - sizes)[ids], own)]
            if letters.tobytes() != text or not _ends_within(ends, np.cumsum(own)):
                return None
        return ids_a, ids_b

    def _encoded(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides of all pieces, one after the other, and which pieces have any."""
        valid = np.ones(len(new), bool)
        ids_a, ids_b = [], []
        lots: list[list[int]] = []
        size = 0
        low_line = LOW_LINE.encode()
        for i, piece in enumerate(new):
            # What ends in white space or may not be told from a space is encoded by itself.
            alone = piece[-1] in b" \t\n\x0b\x0c\r" or piece.endswith(WIDE_BLANKS) or low_line in piece
            new_lot = size > JOINED or not lots or lots[-1][0] < 0
            alone |= new_lot and not piece.startswith(b" ")
            if alone or new_lot:
                lots.append([])
                size = 0
            lots[-1].append(-i - 1 if alone else i)
            size += len(piece)
        for lot in lots:
            found = self._encode_lot([new[i] for i in lot]) if lot[0] >= 0 else None
            if found:
                ids_a.append(found[0])
                ids_b.append(found[1])
                continue
            for i in (i if i >= 0 else -i - 1 for i in lot):
                one = self._encode_one(new[i])
                valid[i] = one is not None
                for ids, own in zip((ids_a, ids_b), one or ((), ())):
                    ids.append(np.array(own, "int64"))
        return np.concatenate(ids_a), np.concatenate(ids_b), valid

    # Alignment

    def _learn(self, new: list[bytes]) -> np.ndarray:
        """Places of new pieces: encodes and aligns them."""
        ids_a, ids_b, valid = self._encoded(new)
        ends = np.cumsum(np.where(valid, [len(piece) for piece in new], 0))
        ends_a, ends_b = np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b])
        n = len(new)
        # A piece that has no tokens has no bytes here either, and no token ends after it began.
        piece_a, piece_b = np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b)
        a = pd.DataFrame({"start": ends_a - self.sizes_a[ids_a], "piece": piece_a, "a": np.arange(len(ids_a))})
        b = pd.DataFrame({"start": ends_b - self.sizes_b[ids_b], "piece": piece_b, "b": np.arange(len(ids_b))})
        at_a = pd.merge_asof(a, b, on="start", by="piece")
        at_b = pd.merge_asof(b, a, on="start", by="piece")
        # Both directions give the tokens that start together; the others come from one of them.
        later = at_b[a["start"].to_numpy()[at_b["a"].to_numpy()] < at_b["start"].to_numpy()]
        overlaps = pd.concat([at_a[["a", "b"]], later[["a", "b"]]])
        common = ends_a[ends_b[np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)] == ends_a] if len(ends_a) else ends_a
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        piece_of = np.searchsorted(ends, common)
        own_a, own_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        links = own_a * own_b
        figures = {
            "n_a": np.bincount(piece_a, minlength=n),
            "n_b": np.bincount(piece_b, minlength=n),
            "n_groups": np.bincount(piece_of, minlength=n),
            "n_links": np.bincount(piece_of, links, minlength=n).astype("int64"),
            "n_overlaps": np.bincount(piece_a[overlaps["a"]], minlength=n),
        }
        for name, values in figures.items():
            self.figures[name].add(values)
        # All pairs within a group: its A tokens, each as often as it has B tokens.
        group = np.repeat(np.arange(len(common)), links)
        turn = np.arange(len(group)) - np.repeat(np.cumsum(links) - links, links)
        first_a, first_b = np.cumsum(own_a) - own_a, np.cumsum(own_b) - own_b
        pair = (ids_a[first_a[group] + turn // own_b[group]] << PAIR_BITS) + ids_b[first_b[group] + turn % own_b[group]]
        piece = piece_of[group]
        order = np.lexsort((pair, piece))
        pair, piece = pair[order], piece[order]
        new_pair = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (piece[1:] != piece[:-1]))) if len(pair) else order
        n_pairs = np.bincount(piece[new_pair], minlength=n)
        self.first.add(len(self.pairs) + np.cumsum(n_pairs) - n_pairs)
        self.n_pairs.add(n_pairs)
        self.times.add(np.diff(np.append(new_pair, len(pair))))
        self.pairs.add(pair[new_pair])
        self.groups += self._written(ids_a, ids_b, group_a, group_b, own_a, own_b, piece_of, n)
        self.valid.add(valid)
        return np.arange(len(self.valid) - n, len(self.valid))

    def _written(self, ids_a, ids_b, group_a, group_b, own_a, own_b, piece_of, n) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each piece."""
        side = np.repeat([0, 1], [len(ids_a), len(ids_b)])
        group = np.concatenate([group_a, group_b])
        order = np.lexsort((side, group))
        group, side = group[order], side[order]
        marks = np.zeros(len(order), "int64")
        # After the last token of a side in its group: the other side, or the next group.
        ends = np.cumsum(own_a + own_b)
        marks[ends - own_b - 1] = 1
        marks[ends - 1] = 2
        last = np.append(piece_of[1:] != piece_of[:-1], True) if len(piece_of) else np.zeros(0, bool)
        marks[ends[last] - 1] = 3
        names = self.names.take(pa.array(np.concatenate([ids_a, ids_b])[order]))
        parts = pc.binary_join_element_wise(names, pa.array([",", "|", ";", ""]).take(pa.array(marks)), "")
        token_ends = np.cumsum(np.bincount(piece_of, own_a + own_b, minlength=n).astype("int64"))
        bounds = np.frombuffer(parts.buffers()[1], "int32")[parts.offset : parts.offset + len(parts) + 1]
        cuts = np.ascontiguousarray(bounds[np.append(0, token_ends)])
        return pa.StringArray.from_buffers(n, pa.py_buffer(cuts), parts.buffers()[2]).to_pylist()

    def looked_up(self, pieces: list[bytes]) -> np.ndarray:
        found = np.fromiter((self.places.get(p, -1) for p in pieces), "int64", len(pieces))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [pieces[i] for i in missing.tolist()]
            places = self._learn(new)
            found[missing] = places
            self.places.update((p, i) for p, i in zip(new, places.tolist()) if len(p) <= LONGEST)
            self.held += sum(map(len, new))
        return found

    def start_block(self) -> None:
        """Between blocks nothing refers to a place, so what is known can be forgotten."""
        if self.held > MEMO:
            self._forget()


def cut_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Pieces of a space and each text, and how many each text has.

    A piece begins at a blank or a line feed after anything that is no white space.
    """
    spaced = pc.binary_join_element_wise(pa.scalar(" "), texts, "")
    bounds = np.frombuffer(spaced.buffers()[1], "int32")[: len(spaced) + 1].astype("int64")
    data = np.frombuffer(spaced.buffers()[2], "uint8")[: bounds[-1]]
    here = (data == 32) | (data == 10)
    before = np.append(np.uint8(32), data[:-1])
    cuts = np.flatnonzero(here & (before != 32) & ((before < 9) | (before > 13)))
    wide = cuts[(before[cuts] & 0xC0) == 0x80]
    if len(wide):
        two = data[wide - 2].astype("int64") << 8 | data[wide - 1]
        three = data[np.maximum(wide - 3, 0)].astype("int64") << 16 | two
        blank = np.isin(two, [int.from_bytes(w, "big") for w in WIDE_BLANKS if len(w) == 2])
        blank |= np.isin(three, [int.from_bytes(w, "big") for w in WIDE_BLANKS if len(w) == 3])
        cuts = np.setdiff1d(cuts, wide[blank], assume_unique=True)
    cuts = np.union1d(cuts, bounds)
    pieces = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype("int32")), spaced.buffers()[2]])
    return pieces, np.diff(np.searchsorted(cuts, bounds))


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> Sides:
    return Sides(path_a, path_b)


def _packed(values: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _block(use: Sides, rows: pa.RecordBatch, with_groups: bool) -> dict:
    """The columns of a block: compressed arrays of 32-bit numbers (pairs: 64-bit)."""
    use.start_block()
    texts = rows.column("text")
    pieces, n = cut_pieces(pc.fill_null(texts, ""))
    words = pieces.dictionary_encode()
    places = use.looked_up(words.dictionary.to_pylist())
    words = words.indices.to_numpy().astype("int64")
    doc = np.repeat(np.arange(len(n)), n)
    none = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) == 0
    none |= np.bincount(doc, ~use.valid[places[words]], minlength=len(n)) > 0
    kept = ~none[doc]
    words, doc = words[kept], doc[kept]
    # The pairs of the pieces, numbered within the block.
    n_pairs = use.n_pairs[places]
    at = spread(use.first[places], n_pairs)
    pairs, numbers = np.unique(use.pairs[at], return_inverse=True)
    # How many documents hold each pair: each piece of a document counts once, then each pair.
    bounds = np.append(0, np.cumsum(n_pairs))
    doc_bounds = np.searchsorted(doc, np.arange(len(n) + 1))
    held = np.zeros(len(pairs), "int64")
    for first in range(0, len(n), LOT):
        lot = slice(doc_bounds[first], doc_bounds[min(first + LOT, len(n))])
        own, word = np.divmod(pd.unique(doc[lot] * len(places) + words[lot]), max(len(places), 1))
        mine = pd.unique(np.repeat(own, n_pairs[word]) * len(pairs) + numbers[spread(bounds[word], n_pairs[word])])
        held += np.bincount(mine % max(len(pairs), 1), minlength=len(pairs))
    sums = {
        name: np.diff(np.append(0, np.cumsum(use.figures[name][places[words]]))[doc_bounds]) for name in FIGURES
    }
    listed, groups = places[words].tolist(), use.groups
    written = [";".join([groups[p] for p in listed[a:b]]) for a, b in zip(doc_bounds[:-1].tolist(), doc_bounds[1:].tolist())]
    digests = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written]
    return {
        "pairs": _packed(pairs, "<i8"),
        "held": _packed(held, "<i4"),
        "bounds": _packed(bounds, "<i4"),
        "numbers": _packed(numbers, "<i4"),
        "times": _packed(use.times[at], "<i4"),
        "words": _packed(words, "<i4"),
        "docs": {
            "doc_id": rows.column("doc_id"),
            **{name: pa.array(sums[name].astype("int64")) for name in FIGURES},
            "groups_sha256": pa.array(digests, pa.string()),
            "groups": pa.array(written if with_groups else [None] * len(written), pa.string()),
            "end": pa.array(doc_bounds[1:].astype("int64")),
        },
    }


def blocks(docs: DataFrame, path_a: str, path_b: str, doc_id: str, text: str, with_groups: bool) -> DataFrame:
    """One row for each step of documents, from a table written to the shared folder."""
    row = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            *[T.StructField(name, T.LongType()) for name in FIGURES],
            T.StructField("groups_sha256", T.StringType()),
            T.StructField("groups", T.StringType()),
            T.StructField("end", T.LongType()),
        ]
    )
    arrays = ("pairs", "held", "bounds", "numbers", "times", "words")
    schema = T.StructType(
        [T.StructField("block", T.LongType()), *[T.StructField(name, T.BinaryType()) for name in arrays], T.StructField("docs", T.ArrayType(row))]
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, number = sides(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows in steps(batch, "text", BLOCK):
                made = _block(use, rows, with_groups)
                inner = pa.StructArray.from_arrays(list(made["docs"].values()), list(made["docs"]))
                columns = [pa.array([number]), *[pa.array([made[name]], pa.binary()) for name in arrays], pa.ListArray.from_arrays([0, len(inner)], inner)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)
                number += 1

    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    target = f"{checkpoint_root(spark)}/blocks-{uuid.uuid4().hex}"
    rows.mapInArrow(build, schema).write.option("compression", "zstd").parquet(target)
    return spark.read.schema(schema).parquet(target)


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, pairs, held in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "held"))):
            pairs, held = _unpacked(pairs, "<i8"), _unpacked(held, "<i4")
            columns = [np.full(len(pairs), block), np.arange(len(pairs), dtype="int32"), pairs, held.astype("int64")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "number", "pair", "held"])


def _summed(block: pa.Table, scores: pa.Table) -> pa.Table:
    """Rows of the documents of one block, with the sums over their links."""
    if not block.num_rows:
        raise ValueError("pairs without their block")
    row = block.slice(0, 1)
    numbers, times, bounds, words = (_unpacked(row.column(c)[0].as_py(), "<i4").astype("int64") for c in ("numbers", "times", "bounds", "words"))
    count, best = np.zeros(scores.num_rows, "int64"), np.zeros(scores.num_rows, bool)
    place = scores.column("number").to_numpy()
    count[place], best[place] = scores.column("count").to_numpy(), scores.column("best").to_numpy(zero_copy_only=False)
    docs = row.column("docs").combine_chunks().flatten()
    ends = np.append(0, docs.field("end").to_numpy())
    sums = []
    for values in (best[numbers], count[numbers]):
        of_word = np.diff(np.append(0, np.cumsum(times * values))[bounds])
        sums.append(pa.array(np.diff(np.append(0, np.cumsum(of_word[words]))[ends])))
    names = [docs.type.field(i).name for i in range(docs.type.num_fields - 1)]
    return pa.Table.from_arrays([*(docs.field(name) for name in names), *sums], [*names, "n_best", "count_sum"])


def aligned(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    doc_id: str = "doc_id",
    text: str = "text",
    with_groups: bool = False,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_overlaps, groups_sha256, groups, n_best, count_sum.

    ``path_a`` is a byte-level file, ``path_b`` a piece model. ``groups`` is the alignment itself, only
    ``with_groups``. A null or empty text, and one whose bytes a side can't give back, has no tokens: zeros
    and ''. Very long texts are a block of their own. Rows that repeat an id or a text are documents of
    their own, each counted. Ties for the best partner of an id are all best. An empty table gives no rows;
    extra columns are not looked at.
    """
    spark = docs.sparkSession
    whole = blocks(docs, path_a, path_b, doc_id, text, with_groups)
    pairs = whole.select("block", "pairs", "held").mapInArrow(_pair_rows, "block long, number int, pair long, held long")
    counts = pairs.groupBy("pair").agg(F.sum("held").alias("count"))
    # An id of A has at most as many partners as B has ids.
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", PAIR_BITS)))
    target = f"{checkpoint_root(spark)}/pairs-{uuid.uuid4().hex}"
    counts.select("pair", "count", (F.col("count") == most).alias("best")).write.parquet(target)
    scores = spark.read.schema("pair long, count long, best boolean").parquet(target)
    scored = pairs.select("block", "number", "pair").join(scores, "pair").select("block", "number", "count", "best")
    row = whole.schema["docs"].dataType.elementType
    schema = T.StructType([*row.fields[:-1], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    parts = whole.select("block", "bounds", "numbers", "times", "words", "docs")
    return parts.groupBy("block").cogroup(scored.groupBy("block")).applyInArrow(_summed, schema)
