"""Near-duplicate groups: MinHash bands for candidates, odd sketches to verify them, full sets to confirm.

1. Each text becomes its set of word shingles, the set's digest, band keys over MinHash samples, and
   an odd sketch: the samples folded into a bitmap where a bit is the parity of the samples that
   fall on it. The population count of two sketches' XOR estimates how many samples differ, most
   precisely where few do.
2. Texts of equal sets are one class, held by its smallest doc_id. Only classes go on.
3. Classes that share a band key are candidates. They are not paired with each other: round one
   pairs each with the smallest class of its bucket. Round two takes only buckets that still hold
   several components. The classes outside a bucket's largest component meet each other and that
   component, in blocks of ``BLOCK`` classes; groups of blocks are sized by the rows they hold. It
   compares sketches, fetches the sets of the classes that are in a possible pair of different
   components at all, and puts out only links that join components, fewer than the classes of the
   block.
4. Links are confirmed on the full sets, and make components by alternating star contractions, each
   step a table in the shared folder.

With 25 bands of 4 samples a pair of similarity 0.8 shares no band with probability 2e-6; the sketch
threshold lies five standard deviations below 0.8.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import checkpoint_root

BANDS, ROWS = 25, 4
SAMPLES = BANDS * ROWS
BITS = 512
BLOCK = 1024
# Similarity as a fraction, so that confirming needs integers only.
SIMILAR = (80, 100)
# Rows of crowded buckets that one group of a task holds, and shingles of the sets it confirms on.
TASK_ROWS = 4_000
TASK_SHINGLES = 2_000_000
# The estimate below which a pair is not confirmed: 0.8 less five standard deviations of SAMPLES.
LEAST_ESTIMATE = 0.8 - 5 * (0.8 * 0.2 / SAMPLES) ** 0.5
# The XOR population count that stands for it: of 2 * SAMPLES * (1 - J) differing samples.
MOST_BITS = int(BITS / 2 * (1 - np.exp(-2 * (2 * SAMPLES * (1 - LEAST_ESTIMATE)) / BITS))) + 1

_DRAW = np.random.default_rng(20)
FACTORS = _DRAW.integers(1, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _DRAW.integers(0, 2**63, SAMPLES, dtype=np.uint64)
PLACES = np.arange(SAMPLES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; bytes.lower and bytes.split know ASCII only, as asked."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    span = min(width, len(words))
    total = np.full(len(words) - span + 1, span, dtype=np.uint64)
    for j in range(span):
        total = total * np.uint64(0x9DDFEA08EB382D69) + hashed[j : len(words) - span + 1 + j]
    return np.unique(_mixed(total))


def samples(values: np.ndarray) -> np.ndarray:
    """MinHash samples of a set that is not empty."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(values), 2048):
        hashed = values[at : at + 2048, None] * FACTORS
        hashed += SHIFTS
        np.minimum(least, hashed.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = (least ^ PLACES).reshape(BANDS, ROWS)
    key = np.zeros(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        key = _mixed(key + rows[:, j])
    return key.view(np.int64)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    places = _mixed(least ^ PLACES) % np.uint64(BITS)
    parity = (np.bincount(places.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def _measured(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size, digest, keys, sketch = [], [], [], []
            for text in batch["text"]:
                values = shingles(text, width)
                size.append(len(values))
                if len(values):
                    least = samples(values)
                    digest.append(xxhash.xxh3_128_digest(values.tobytes()))
                    keys.append(band_keys(least))
                    sketch.append(odd_sketch(least))
                else:
                    digest.append(None)
                    keys.append(None)
                    sketch.append(None)
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "n_shingles": size, "digest": digest, "keys": keys, "sketch": sketch}
            )

    return run


def _sets(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(text, width).view(np.int64) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "members": sets})

    return run


class _Folder:
    """Tables of one run in the shared folder."""

    def __init__(self, spark) -> None:
        self.spark, self.path, self.n = spark, f"{checkpoint_root(spark)}/near-{uuid.uuid4().hex}", 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.path}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame, keep) -> DataFrame:
    """node, component (its smallest reachable node) of every node in ``links`` (a, b).

    Large stars and small stars in turn (each node hands its larger, then its smaller neighbours to
    its smallest one) until nothing changes; a hub costs one row per link.
    """

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    edges = keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lows = least(both).withColumn("m", F.least("m", "u"))
        large = both.join(lows, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lows = least(large)
        small = large.join(lows, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = keep(small.unionByName(lows.select("u", F.col("m").alias("v"))).filter("u > v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.sum("v")).first()
        if now == state:
            break
        state = now
    # Stars by now: every node but the centres has one edge, to its component.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _blocks(task: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The blocks of buckets that a task holds, one after the other."""
    task = task.sort_values(["key", "lower", "upper"], ignore_index=True)
    names = task[["key", "lower", "upper"]].to_numpy()
    cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(task)]):
        yield task.iloc[start:end]


def _pairs(block: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a block in pairs, with the bits that differ: pairs of different components that sizes
    and sketches let pass, and whose first common band is the one of this bucket (so that no pair
    is looked at in several buckets)."""
    size, component, side = (block[c].to_numpy() for c in ("n", "component", "side"))
    sketch, keys = (np.stack(block[c].to_numpy()) for c in ("sketch", "keys"))
    sketch, band = sketch.view(np.uint64), int(np.flatnonzero(keys[0] == block["key"].iloc[0])[0])
    same = bool(block["same"].iloc[0])
    right = np.arange(len(block)) if same else np.flatnonzero(side == 1)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in range(len(block)) if same else np.flatnonzero(side == 0):
        near = right[right > i] if same else right
        near = near[component[near] != component[i]]
        near = near[(SIMILAR[1] * size[near] >= SIMILAR[0] * size[i]) & (SIMILAR[1] * size[i] >= SIMILAR[0] * size[near])]
        bits = np.bitwise_count(sketch[near] ^ sketch[i]).sum(axis=1)
        near, bits = near[bits <= MOST_BITS], bits[bits <= MOST_BITS]
        first = (keys[near] == keys[i]).argmax(axis=1) == band
        if first.any():
            found.append((np.full(int(first.sum()), i), near[first], bits[first]))
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _promising(task: pd.DataFrame) -> pd.DataFrame:
    """The rows that are in a pair at all: only their sets are fetched."""
    kept = []
    for block in _blocks(task):
        if block["component"].nunique() > 1:
            left, right, _ = _pairs(block)
            kept.append(block.iloc[np.union1d(left, right)])
    return pd.concat(kept) if kept else task.iloc[:0]


def _linked(task: pd.DataFrame) -> pd.DataFrame:
    """Links that join components, at most one less than a block has rows: pairs are confirmed on
    the full sets, the likeliest first, and skipped once other links have joined them."""
    links: list[tuple[int, int]] = []
    for block in _blocks(task):
        left, right, bits = _pairs(block)
        node, members = block["node"].to_numpy(), block["members"].to_numpy()
        root = {c: c for c in block["component"]}

        def top(c: int, root=root) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        component = block["component"].to_numpy()
        for at in np.argsort(bits, kind="stable"):
            i, j = left[at], right[at]
            a, b = top(component[i]), top(component[j])
            if a == b:
                continue
            x, y = members[i].view(np.uint64), members[j].view(np.uint64)
            places = np.minimum(np.searchsorted(x, y), len(x) - 1)
            shared = int(np.count_nonzero(x[places] == y))
            if SIMILAR[1] * shared >= SIMILAR[0] * (len(x) + len(y) - shared):
                root[max(a, b)] = min(a, b)
                links.append((int(min(node[i], node[j])), int(max(node[i], node[j]))))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def near_duplicates(docs: DataFrame, width: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``.

    Documents are linked when the sets of their ``width``-word shingles (ASCII letters in lower
    case; the whole sequence where there are fewer words) have a similarity of 0.8 or more.
    ``component_id`` is the smallest doc_id that links lead to, ``kept`` whether it is the
    document's own. Null, empty and blank texts have an empty set and are linked with nothing. Rows
    that repeat an id stand for the same document. Rows without an id take no part: their
    component_id is null and they are kept. doc_id must be an integer.
    """
    spark = docs.sparkSession
    folder = _Folder(spark)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    measured = folder.keep(
        texts.mapInPandas(
            _measured(width), "doc_id long, n_shingles long, digest binary, keys array<long>, sketch array<long>"
        )
    )
    usable = measured.filter("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = folder.keep(
        usable.groupBy("digest").agg(
            F.min("doc_id").alias("node"),
            F.first("n_shingles").alias("n"),
            F.first("keys").alias("keys"),
            F.first("sketch").alias("sketch"),
        )
    )
    keyed = classes.select("node", F.explode("keys").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("crowd")).filter("crowd > 1")
    bucketed = folder.keep(keyed.join(hubs.select("key", "hub"), "key"))
    parts = classes.select("node", "n", "sketch")
    members = folder.keep(
        texts.join(bucketed.select(F.col("node").alias("doc_id")).distinct(), "doc_id").mapInPandas(
            _sets(width), T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("members", T.ArrayType(T.LongType()))])
        )
    )

    def sided(name: str) -> DataFrame:
        return parts.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        a, b = (members.select(F.col("doc_id").alias(x), F.col("members").alias(f"m_{x}")) for x in ("a", "b"))
        shared = F.size(F.array_intersect("m_a", "m_b"))
        union = F.size("m_a") + F.size("m_b") - shared
        return folder.keep(
            pairs.join(a, "a").join(b, "b").filter(SIMILAR[1] * shared >= SIMILAR[0] * union).select("a", "b").distinct()
        )

    # Round one: stars.
    stars = bucketed.filter("node > hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    stars = stars.join(sided("a"), "a").join(sided("b"), "b")
    differ = sum(
        (F.bit_count(F.get("s_a", F.lit(i)).bitwiseXOR(F.get("s_b", F.lit(i)))) for i in range(BITS // 64)), F.lit(0)
    )
    near = (
        (SIMILAR[1] * F.col("n_a") >= SIMILAR[0] * F.col("n_b"))
        & (SIMILAR[1] * F.col("n_b") >= SIMILAR[0] * F.col("n_a"))
        & (differ <= MOST_BITS)
    )
    links = confirmed(stars.filter(near).select("a", "b"))
    joined = components(links, folder.keep)

    # Round two: what is left in buckets of several components.
    placed = bucketed.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_keys = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    left = folder.keep(placed.join(open_keys.select("key"), "key").select("key", "node", "component"))
    # Pairs within one component are no use: the classes outside a bucket's largest component meet
    # each other and that component, whose own blocks do not meet.
    held = left.groupBy("key", "component").agg(F.count(F.lit(1)).alias("held"))
    largest = held.groupBy("key").agg(F.sum("held").alias("crowd"), F.max(F.struct("held", "component")).alias("largest"))
    n_inside = F.ceil(F.col("largest.held") / BLOCK).cast("int")
    n_outside = F.ceil((F.col("crowd") - F.col("largest.held")) / BLOCK).cast("int")
    split = largest.select("key", F.col("largest.component").alias("main"), n_inside.alias("n_in"), n_outside.alias("n_out"))
    inside = F.col("component") == F.col("main")
    # The blocks of the others come first.
    sided_left = left.join(split, "key").select(
        "key",
        "node",
        "component",
        F.when(inside, F.col("n_out") + F.pmod(F.xxhash64("node"), "n_in"))
        .otherwise(F.pmod(F.xxhash64("node"), "n_out"))
        .cast("int")
        .alias("block"),
        F.when(inside, F.col("n_out")).otherwise(F.col("n_out") + F.col("n_in")).alias("n_others"),
    )
    # Many small buckets make one group of rows, counted as they are once each meets its others.
    n_rows = held.join(split, "key").agg(
        F.sum(F.col("held") * F.when(inside, F.col("n_out")).otherwise(F.col("n_out") + F.col("n_in")))
    )
    n_tasks = (n_rows.first()[0] or 0) // TASK_ROWS + 1
    blocks = (
        sided_left.join(classes.select("node", "n", "sketch", "keys"), "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_others") - 1)))
        .select(
            "key",
            F.least("block", "other").alias("lower"),
            F.greatest("block", "other").alias("upper"),
            (F.col("block") > F.col("other")).cast("int").alias("side"),
            (F.col("block") == F.col("other")).alias("same"),
            "node",
            "component",
            "n",
            "sketch",
            "keys",
        )
    )
    spread = blocks.withColumn("task", F.pmod(F.xxhash64("key", "lower", "upper"), F.lit(n_tasks)))
    promising = folder.keep(spread.groupBy("task").applyInPandas(_promising, spread.schema))
    # Dealt anew by the size of the sets.
    n_tasks = (promising.agg(F.sum("n")).first()[0] or 0) // TASK_SHINGLES + 1
    again = promising.withColumn("task", F.pmod(F.xxhash64("key", "lower", "upper"), F.lit(n_tasks)))
    with_sets = again.join(members.select(F.col("doc_id").alias("node"), "members"), "node")
    more = folder.keep(with_sets.groupBy("task").applyInPandas(_linked, "a long, b long"))
    joined = components(links.unionByName(more), folder.keep)

    named = classes.join(joined, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    result = measured.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return result.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def first_of_groups(docs: DataFrame, width: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its group, columns as they were."""
    gone = near_duplicates(docs, width, doc_id, text).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone.distinct(), F.col(doc_id) == F.col("gone_id"), "left_anti")
