"""Best-fit packing: whole documents into as few sequences as possible, by bin completion.

Only a document longer than a sequence is cut. How well pieces can be packed depends on nothing but
their lengths, so Spark counts the pieces per length, and the search runs on those counts, at most
``capacity`` numbers however many documents there are. Sequences of equal filling are one pattern with
a multiplicity.

The search is bin completion: around the longest piece left it lists the undominated fillings, those in
which no pieces can be exchanged for a piece that takes at least their room and still fits, drops the
ones whose waste a better packing could not afford, and branches over the rest. At every node the
best-fit packing of what is left completes an incumbent; a bound on the sequences needed ends the
search as soon as the incumbent meets it. ``nodes`` bounds the search: beyond it the best incumbent
stands, with every piece in its place.

The plan gives each length ranges of numbers. Pieces are numbered per length: within their part by a
window, over parts by prefix sums of (part, length) counts. No length, however frequent, meets in one
task, and no sequence is built in one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import fresh
from tidemark.llm.packing import END_ID, tokenised

CAPACITY = 4096
# Nodes of the search, and fillings listed at a node.
NODES = 100
FILLINGS = 64
# Bits for a number within a length.
RANK_BITS = 44

# A filling is ((length, copies), ...), longest first; a packing is a list of (filling, sequences).
Filling = tuple[tuple[int, int], ...]
Packing = list[tuple[Filling, int]]


def best_fit(counts: dict[int, int], capacity: int) -> Packing:
    """Best-fit decreasing on counts: each piece goes where it leaves the least room.

    Sequences filled alike move together, so the steps depend on the lengths and not on the pieces.
    """
    rooms: dict[int, list[list]] = {}
    open_rooms: list[int] = []

    def put(filling: Filling, times: int, room: int) -> None:
        if room not in rooms:
            rooms[room] = []
            open_rooms.append(room)
        rooms[room].append([filling, times])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in open_rooms if r >= length), default=None)
            if room is None:
                filling, times, room = (), left, capacity
            else:
                filling, times = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                    open_rooms.remove(room)
            copies = room // length
            full = min(times, left // copies)
            rest = left - full * copies if full < times else 0
            if full:
                put((*filling, (length, copies)), full, room - copies * length)
            if rest:
                put((*filling, (length, rest)), 1, room - rest * length)
            unused = times - full - (1 if rest else 0)
            if unused and filling:
                put(filling, unused, room)
            left -= full * copies + rest
    return [(tuple(filling), times) for groups in rooms.values() for filling, times in groups]


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """A bound no packing can beat: pieces over half a sequence never meet, so the room they leave counts
    only as far as shorter pieces of at least ``k`` fit it; the best ``k`` is taken."""
    if not counts:
        return 0
    number = np.zeros(capacity + 1, "int64")
    number[list(counts)] = list(counts.values())
    n_up, room_up = np.cumsum(number), np.cumsum(number * np.arange(capacity + 1))
    half = capacity // 2
    k = np.arange(1, half + 1)
    spare = (n_up[capacity - k] - n_up[half]) * capacity - (room_up[capacity - k] - room_up[half])
    short = room_up[half] - room_up[k - 1]
    extra = np.maximum(-((spare - short) // capacity), 0)
    # Pieces of more than half a sequence are alone or with short ones; those over capacity - k are alone.
    return max(-(-int(room_up[-1]) // capacity), int(n_up[-1] - n_up[half]) + int(extra.max(initial=0)))


def _upto(bits: int, more: int) -> int:
    """The numbers of a bit set and those up to ``more`` beyond one of them."""
    done = 0
    while done < more:
        step = min(done + 1, more - done)
        bits |= bits << step
        done += step
    return bits


def fillings(counts: dict[int, int], room: int, least: int, most: int = FILLINGS) -> list[tuple[int, Filling]]:
    """Undominated ways to fill ``room`` with at least ``least``, as (filled, filling), fullest first."""
    lengths = sorted((length for length in counts if length <= room), reverse=True)
    found: list[tuple[int, Filling]] = []
    # What all pieces from a place on add up to: too little is given up early.
    reach = [0]
    for length in reversed(lengths):
        reach.append(reach[-1] + length * counts[length])
    reach.reverse()
    steps = 0

    every = sum(1 << length for length in lengths)

    def undominated(chosen: dict[int, int], spare: int) -> bool:
        """No other piece may replace some of the chosen ones and use their room at least as well."""
        # Bit sets of lengths: sums of one chosen piece, of several, and the pieces not chosen.
        one = several = 0
        others = every
        for length, copies in chosen.items():
            for _ in range(copies):
                several |= (several | one) << length
                one |= 1 << length
            if counts[length] == copies:
                others ^= 1 << length
        return not (_upto(several, spare) | (_upto(one << 1, spare - 1) if spare else 0)) & others

    def search(place: int, spare: int, chosen: dict[int, int]) -> None:
        nonlocal steps
        steps += 1
        if len(found) >= most or steps > 50 * most:
            return
        while place < len(lengths) and lengths[place] > spare:
            place += 1
        if place == len(lengths):
            if room - spare >= least and undominated(chosen, spare):
                found.append((room - spare, tuple(chosen.items())))
            return
        if room - spare + reach[place] < least:
            return
        length = lengths[place]
        for copies in range(min(spare // length, counts[length]), -1, -1):
            search(place + 1, spare - copies * length, {**chosen, length: copies} if copies else chosen)

    search(0, room, {})
    return sorted(found, key=lambda f: (-f[0], len(f[1])))


@dataclass
class _Best:
    n: int
    packing: Packing


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> Packing:
    """A packing of ``counts`` pieces per length, with as few sequences as ``nodes`` nodes find.

    It never needs more than best-fit decreasing, and the fewest possible if the search ends by itself.
    """
    counts = {int(length): int(n) for length, n in counts.items() if n}
    if not counts:
        return []
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError("a piece has 1 to capacity tokens")
    first = best_fit(counts, capacity)
    best = _Best(sum(times for _, times in first), first)
    bound = least_sequences(counts, capacity)
    # Nodes still to visit, the last one first: pieces left, sequences closed, their fillings.
    stack: list[tuple[dict[int, int], int, Packing]] = [(counts, 0, [])]
    while stack and nodes and best.n > bound:
        left, n, closed = stack.pop()
        nodes -= 1
        if n + least_sequences(left, capacity) >= best.n:
            continue
        rest = best_fit(left, capacity)
        total = n + sum(times for _, times in rest)
        if total < best.n:
            best = _Best(total, closed + rest)
            continue
        longest = max(left)
        others = {**left, longest: left[longest] - 1}
        others = {length: c for length, c in others.items() if c}
        # A better packing has so much room to spare in all its sequences.
        spare = (best.n - 1 - n) * capacity - sum(length * c for length, c in left.items())
        branches = []
        for _, filling in fillings(others, capacity - longest, capacity - longest - spare):
            taken = dict(filling)
            taken[longest] = taken.get(longest, 0) + 1
            most = min(left[length] // copies for length, copies in taken.items())
            # As often as it goes, and once: the fillings after it may need some of its pieces.
            for times in dict.fromkeys((most, 1)):
                after = {length: c - times * taken.get(length, 0) for length, c in left.items()}
                whole = tuple(sorted(taken.items(), reverse=True))
                branches.append(({length: c for length, c in after.items() if c}, n + times, [*closed, (whole, times)]))
        stack.extend(reversed(branches))
    return best.packing


def plan(packing: Packing) -> dict[str, np.ndarray]:
    """Arrays sorted by (length, first): the pieces of a length from number ``first`` on go to sequences
    from ``sequence`` on, ``copies`` in each, at ``offset`` and after."""
    rows, used, sequence = [], {}, 0
    for filling, times in packing:
        offset = 0
        for length, copies in filling:
            rows.append((length, used.get(length, 0), copies, sequence, offset))
            used[length] = used.get(length, 0) + copies * times
            offset += copies * length
        sequence += times
    table = np.array(sorted(rows), dtype="int64").reshape(-1, 5)
    names = ("length", "first", "copies", "sequence", "offset")
    return {name: table[:, i] for i, name in enumerate(names)}


def pieces(tokens: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """part, before, doc_id, piece, start, length, ids of tokenised documents cut at ``capacity``."""
    last = F.expr(f"(n - 1) div {int(capacity)}")
    start = F.col("piece") * capacity
    length = F.least(F.lit(capacity), F.col("n") - start)
    return tokens.withColumn("piece", F.explode(F.sequence(F.lit(0), last.cast("int")))).select(
        "part",
        "before",
        "doc_id",
        "piece",
        start.cast("long").alias("start"),
        length.cast("long").alias("length"),
        F.substring("ids", (start * 4 + 1).cast("int"), (length * 4).cast("int")).alias("ids"),
    )


def assigned(parted: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Pieces with sequence_id and offset; ``part``, ``before`` (their order, within a part) go.

    ``parted`` is read three times, so it should come from a table.
    """
    spark = parted.sparkSession
    sizes = parted.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # At most ``capacity`` rows, whatever the corpus.
    totals = sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()
    places = plan(bin_completion({r["length"]: r["n"] for r in totals}, capacity, nodes))
    shared = spark.sparkContext.broadcast({**places, "key": (places["length"] << RANK_BITS) + places["first"]})

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    part, length = fresh(parted, "_part", "_length")
    bases = sizes.select(
        F.col("part").alias(part), F.col("length").alias(length), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    own = Window.partitionBy("part", "length").orderBy("before", "piece")
    numbered = (
        parted.withColumn("number", F.row_number().over(own) - 1)
        .join(bases, (F.col("part") == F.col(part)) & (F.col("length") == F.col(length)))
        .withColumn("number", F.col("number") + F.col("base"))
    )
    kept = [c for c in parted.columns if c not in ("part", "before")]
    rows = numbered.select(*kept, "number")
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            lengths, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            row = np.searchsorted(table["key"], (lengths << RANK_BITS) + number, "right") - 1
            turn, copy = np.divmod(number - table["first"][row], table["copies"][row])
            columns = [*batch.columns[:-1], pa.array(table["sequence"][row] + turn), pa.array(table["offset"][row] + copy * lengths)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(place, schema)


def packed(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
    nodes: int = NODES,
) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian 32-bit), sequence_id, offset of all pieces.

    A null or empty text is its end id alone; a long one is cut into pieces of ``capacity``, the last of
    which may be shorter. Rows that repeat an id or a text are documents of their own; pieces of one length
    are exchangeable, so ties do not change how many sequences there are. An empty table gives no pieces;
    extra columns are not looked at, whatever their names.
    """
    return assigned(pieces(tokenised(docs, path, end_id, doc_id, text), capacity), capacity, nodes)
