"""Exact top-k search on binary codes by incremental multi-index hashing.

A vector's code has one bit per dimension, its sign. Equal codes are one entry of the index, which
carries the smallest ids (k and one more suffice, however many copies there are). The index is cut
into blocks of bounded size, each with a table per segment of the code; the stated queries, in
blocks too, are held against every block. In a block a query probes, segment after segment, all
values that differ from its own in r bits, r = 0, 1, 2, ...; every code found is verified on all
bits. A code not yet found differs in more than r bits in the segments probed at r and in r or more
in the others, so the search ends as soon as the kth verified distance is below that sum: ties
included, nothing outside can enter. The blocks' answers are merged by distance and id.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K = 10
BITS = 64
SEGMENTS = 4
WIDTH = BITS // SEGMENTS
# Codes in a block of the index, queries in a block of queries.
INDEX_BLOCK = 50_000
QUERY_BLOCK = 4_000


def sign_code(vector: Column) -> Column:
    """Signs of the first BITS dimensions as a long; missing dimensions count as not positive."""
    return F.aggregate(
        F.slice(vector, 1, BITS),
        F.lit(0).cast("long"),
        lambda code, v: F.shiftleft(code, 1).bitwiseOR(F.when(v > 0, 1).otherwise(0).cast("long")),
    )


@lru_cache(maxsize=WIDTH + 1)
def masks(radius: int) -> np.ndarray:
    """All WIDTH-bit numbers with ``radius`` ones."""
    return np.array([sum(1 << b for b in bits) for bits in combinations(range(WIDTH), radius)], dtype=np.int64)


class Index:
    """Codes of a block with a table per segment: order by value, and where each value begins."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.tables = []
        for s in range(SEGMENTS):
            values = self.segment(codes, s)
            order = np.argsort(values, kind="stable")
            begins = np.searchsorted(values[order], np.arange((1 << WIDTH) + 1))
            self.tables.append((order, begins))

    @staticmethod
    def segment(codes, s: int):
        return ((codes >> np.uint64(s * WIDTH)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)

    def search(self, query: np.uint64, weights: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of the codes that hold the ``wanted`` nearest ids (ties included);
        ``weights`` are the ids of each code."""
        found = np.zeros(0, dtype=np.int64)
        distance = np.zeros(0, dtype=np.int64)
        seen = np.zeros(len(self.codes), dtype=bool)
        for radius in range(WIDTH + 1):
            for s, (order, begins) in enumerate(self.tables):
                probes = self.segment(query, s) ^ masks(radius)
                first, n = begins[probes], begins[probes + 1] - begins[probes]
                hit = n > 0
                first, n = first[hit], n[hit]
                at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                new = order[at]
                new = new[~seen[new]]
                seen[new] = True
                found = np.concatenate((found, new))
                distance = np.concatenate((distance, np.bitwise_count(self.codes[new] ^ query).astype(np.int64)))
                # No code outside ``found`` is nearer than this.
                outside = SEGMENTS * radius + s + 1
                if int(weights[found[distance < outside]].sum()) >= wanted:
                    near = distance < outside
                    return found[near], distance[near]
        return found, distance


def _searched(k: int):
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple[int, int, int]] = []
        if len(index) and len(queries):
            codes = index["code"].to_numpy(dtype=np.int64).view(np.uint64)
            ids = index["ids"].to_numpy()
            weights = np.array([len(i) for i in ids], dtype=np.int64)
            table = Index(codes)
            answers: dict[int, list[tuple[int, int]]] = {}
            for query, code in zip(queries["query_id"], queries["code"]):
                if code not in answers:
                    # One more than k, for the query may be among them.
                    places, distances = table.search(np.int64(code).view(np.uint64), weights, k + 1)
                    near = [(int(d), int(i)) for p, d in zip(places, distances) for i in ids[p]]
                    answers[code] = sorted(near)[: k + 1]
                rows += [(query, i, d) for d, i in answers[code] if i != query][:k]
        return pd.DataFrame(rows, columns=["query_id", "neighbor_id", "distance"], dtype="int64")

    return run


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), neighbor_id, distance: the k nearest rows of ``vectors`` to each row of
    ``queries`` by Hamming distance of their codes, ties by id, the query itself left out.

    Rows without an id or a vector are neither found nor ask. Rows that repeat an id are found once
    for each different code; a query that repeats with the same code asks once. Fewer than k other
    rows give fewer neighbours, an empty table none.
    """

    def coded(df: DataFrame) -> DataFrame:
        known = df.filter(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull())
        return known.select(F.col(vec_id).cast("long").alias("id"), sign_code(F.col(embedding)).alias("code")).distinct()

    # The limit on the row number is applied before the shuffle too, so a common code costs each
    # map task k + 1 rows.
    by_code = Window.partitionBy("code").orderBy("id")
    index = (
        coded(vectors)
        .withColumn("place", F.row_number().over(by_code))
        .filter(F.col("place") <= k + 1)
        .groupBy("code")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    asked = coded(queries).select(F.col("id").alias("query_id"), "code")
    n_index = index.count() // INDEX_BLOCK + 1
    n_asked = asked.count() // QUERY_BLOCK + 1
    index_side = index.select(
        F.pmod(F.xxhash64("code"), F.lit(n_index)).alias("i"), F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))).alias("q"), "code", "ids"
    )
    asked_side = asked.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_index - 1).cast("long"))).alias("i"),
        F.pmod(F.xxhash64("query_id"), F.lit(n_asked)).cast("int").alias("q"),
        "query_id",
        "code",
    )
    found = (
        index_side.groupBy("i", "q")
        .cogroup(asked_side.groupBy("i", "q"))
        .applyInPandas(_searched(k), "query_id long, neighbor_id long, distance long")
    )
    nearest = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(nearest))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "neighbor_id", "distance")
    )
