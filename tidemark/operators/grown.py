"""Random forests grown and scored by tasks; the driver never holds a tree.

Spark ML grows a forest on the driver, at most of a kilobyte per node, and without
a depth limit its nodes grow with the rows times the trees.  Here the rows are
binned once, a byte per feature; a task reads them, grows a lot of the trees and
gives the sum of their probabilities per row.  The forest is the one Spark ML
describes: Poisson bootstrap, ``maxBins`` bins, a subset of the features per node,
Gini impurity, ``minInstancesPerNode``, ``minInfoGain`` and ``maxDepth``, leaves of
one prediction merged, probabilities averaged over trees.  Draws depend on the row,
the tree and the node only, so lots and tasks do not change them; they are not
Spark ML's own draws.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage_table

# Nodes of a forest that Spark ML may grow on the driver: some 90 MB.
DRIVER_NODES = 100_000
# Trees of a task.
LOT = 20
# Cells of the arrays a task works on at a time.
CELLS = 1 << 20
# Probabilities are summed as whole numbers of this unit: the order of the lots leaves no trace.
UNIT = 2.0**-40
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


def subset_size(strategy: str, n_features: int, n_trees: int) -> int:
    """Features tried per node, as Spark ML reads its ``featureSubsetStrategy``."""
    if strategy == "auto":
        strategy = "all" if n_trees == 1 else "sqrt"
    named = {
        "all": n_features,
        "sqrt": math.ceil(math.sqrt(n_features)),
        "log2": max(1, math.ceil(math.log2(n_features))),
        "onethird": math.ceil(n_features / 3),
    }
    if strategy in named:
        return named[strategy]
    return min(int(strategy), n_features) if strategy.isdigit() else math.ceil(float(strategy) * n_features)


def is_large(estimator: Estimator, train: DataFrame, n_rows: int) -> bool:
    """Whether the forest may have more nodes than the driver should hold; other settings are left to Spark ML."""
    if not isinstance(estimator, RandomForestClassifier):
        return False
    plain = (
        estimator.getImpurity() == "gini"
        and estimator.getBootstrap()
        and estimator.getSubsamplingRate() == 1.0
        and estimator.getMinWeightFractionPerNode() == 0.0
        and estimator.getMaxBins() <= 256
        and not estimator.isDefined(estimator.weightCol)
        and "ml_attr" not in train.schema[estimator.getFeaturesCol()].metadata
    )
    per_tree = min(2 ** (estimator.getMaxDepth() + 1), 2 * n_rows // estimator.getMinInstancesPerNode())
    return plain and estimator.getNumTrees() * per_tree > DRIVER_NODES


def thresholds(train: DataFrame, n_features: int, n_bins: int) -> list[np.ndarray]:
    """Cuts of every feature: between all its values where they are at most ``n_bins``, else its quantiles."""
    array = vector_to_array("features")
    columns = [f"_{i}" for i in range(n_features)]
    wide = train.select(*[array[i].alias(c) for i, c in enumerate(columns)])
    about = wide.agg(*[F.approx_count_distinct(c) for c in columns]).first()
    few = [c for c, n in zip(columns, about) if n <= 2 * n_bins]
    sets = wide.agg(*[F.collect_set(c).alias(c) for c in few]).first().asDict() if few else {}
    sets = {c: np.sort(values) for c, values in sets.items() if len(values) <= n_bins}
    many = [c for c in columns if c not in sets]
    steps = [i / n_bins for i in range(1, n_bins)]
    found = dict(zip(many, wide.approxQuantile(many, steps, 0.002) if many else []))
    return [
        (sets[c][1:] + sets[c][:-1]) / 2 if c in sets else np.unique(np.asarray(found[c], dtype=float)) for c in columns
    ]


def binned(both: DataFrame, cuts: Sequence[np.ndarray]) -> DataFrame:
    """``_row, split, label, bins`` of ``both``, written once; byte ``j`` counts the cuts of feature ``j`` below its value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, n = batch.column("x"), batch.num_rows
            values = vectors.flatten().to_numpy(zero_copy_only=False)
            if vectors.null_count or len(values) != n * len(cuts):
                raise ValueError(f"every row needs a vector of {len(cuts)} features")
            values, out = values.reshape(n, len(cuts)), np.empty((n, len(cuts)), dtype=np.uint8)
            for j, cut in enumerate(cuts):
                out[:, j] = np.searchsorted(cut, values[:, j], side="left")
            fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(cuts)), n, [None, pa.py_buffer(out.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("_row", "split", "label")), fixed.cast(pa.binary())],
                names=["_row", "split", "label", "bins"],
            )

    rows = both.select(
        F.monotonically_increasing_id().alias("_row"), "split", F.col("label").cast("double"),
        vector_to_array("features").alias("x"),
    )
    return stage_table(rows.mapInArrow(run, "_row long, split string, label double, bins binary"), "binned")


def mixed(a: np.ndarray, b) -> np.ndarray:
    """Hash of two whole numbers, element by element."""
    x = np.asarray(a, dtype=np.uint64) + (np.atleast_1d(b).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(key: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How often each row is in a bootstrap sample: Poisson with mean 1."""
    return np.searchsorted(POISSON, (mixed(key, rows) >> np.uint64(11)) * 2.0**-53, side="right")


@dataclass
class Shape:
    """What a tree is grown under."""

    n_features: int
    n_classes: int
    n_bins: int
    tried: int
    depth: int
    least: int
    gain: float


@dataclass
class Tree:
    """Nodes level by level, the root first: ``left`` is the left child, the right one follows it; -1 is a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    counts: np.ndarray

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        node = np.zeros(len(bins), dtype=np.int64)
        rows = np.arange(len(bins)) if self.left[0] >= 0 else np.arange(0)
        while len(rows):
            at = node[rows]
            at = self.left[at] + (bins[rows, self.feature[at]] > self.cut[at])
            node[rows] = at
            rows = rows[self.left[at] >= 0]
        return node

    def share(self, of_class: int = 1) -> np.ndarray:
        """Share of a class in each node."""
        total = self.counts.sum(axis=1)
        return np.divide(self.counts[:, of_class], total, out=np.zeros(len(total)), where=total > 0)


def _best(bins, y, w, at, counts, features, shape: Shape):
    """Gain, feature, cut and left counts of the best split of each node; ``at`` is the node of each row."""
    n, tried = features.shape
    cells = (n, tried, shape.n_bins)
    size, within = math.prod(cells), np.arange(tried) * shape.n_bins
    found, step = np.zeros(shape.n_classes * size), max(1, CELLS // tried)
    for i in range(0, len(y), step):
        some = slice(i, i + step)
        slot = np.take_along_axis(bins[some], features[at[some]], axis=1) + within
        slot += (y[some] * size + at[some] * (tried * shape.n_bins))[:, None]
        found += np.bincount(slot.ravel(), np.repeat(w[some], tried), len(found))
    # Classes come first: sums over them run along whole arrays.
    left = found.reshape(shape.n_classes, *cells).cumsum(axis=3)[..., :-1]
    right = counts.T[:, :, None, None] - left
    n_left, n_right = left.sum(axis=0), right.sum(axis=0)
    bad = (n_left < shape.least) | (n_right < shape.least)
    n_left[bad] = n_right[bad] = 1.0
    score = np.einsum("k...,k...->...", left, left) / n_left + np.einsum("k...,k...->...", right, right) / n_right
    score[bad] = -np.inf
    score = score.reshape(n, -1)
    best = score.argmax(axis=1)
    rank, cut = np.divmod(best, shape.n_bins - 1)
    every, total = np.arange(n), counts.sum(axis=1)
    gain = score[every, best] / total - (counts * counts).sum(axis=1) / (total * total)
    return gain, features[every, rank], cut, left[:, every, rank, cut].T


def _subsets(key: np.ndarray, path: np.ndarray, shape: Shape) -> np.ndarray:
    """The features each node tries."""
    if shape.tried >= shape.n_features:
        return np.broadcast_to(np.arange(shape.n_features), (len(path), shape.n_features))
    order = mixed(mixed(key, path)[:, None], np.arange(shape.n_features))
    return np.sort(np.argpartition(order, shape.tried - 1, axis=1)[:, : shape.tried], axis=1)


def _lots(sizes: np.ndarray, shape: Shape) -> Iterator[tuple[int, int]]:
    """Runs of nodes whose rows and slots stay within ``CELLS``; a node at least."""
    slots, begin = shape.tried * shape.n_bins * shape.n_classes, 0
    ends = np.cumsum(sizes)
    while begin < len(sizes):
        done = ends[begin - 1] if begin else 0
        end = min(int(np.searchsorted(ends, done + CELLS // shape.tried, side="right")), begin + CELLS // slots)
        end = max(begin + 1, end)
        yield begin, end
        begin = end


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, key: np.ndarray, shape: Shape) -> Tree:
    """A tree on the rows with a weight ``w``, level by level."""
    rows = np.flatnonzero(w)
    at = np.zeros(len(rows), dtype=np.int64)
    counts, path = np.bincount(y, w, shape.n_classes)[None, :], np.ones(1, dtype=np.uint64)
    levels, first = [], 0
    while len(counts):
        n, level = len(counts), len(levels)
        feature, cut, left = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
        first += n
        levels.append((feature, cut, left, counts))
        mixed_classes = (counts > 0).sum(axis=1) > 1
        split = np.flatnonzero(mixed_classes & (counts.sum(axis=1) >= 2 * shape.least) & (level < shape.depth))
        # Rows stand by node: only those of nodes that may be split stay.
        rank = np.full(n, -1)
        rank[split] = np.arange(len(split))
        stay = rank[at] >= 0
        rows, at = rows[stay], rank[at[stay]]
        sizes = np.bincount(at, minlength=len(split))
        ends = np.cumsum(sizes)
        gains, lefts = np.zeros(len(split)), np.zeros((len(split), shape.n_classes))
        for begin, end in _lots(sizes, shape):
            part, nodes = slice(ends[begin] - sizes[begin], ends[end - 1]), split[begin:end]
            own = rows[part]
            gains[begin:end], feature[nodes], cut[nodes], lefts[begin:end] = _best(
                bins[own], y[own], w[own], at[part] - begin, counts[nodes], _subsets(key, path[nodes], shape), shape
            )
        better = (gains > 1e-12) & (gains >= shape.gain)
        kept = split[better]
        left[kept] = first + 2 * np.arange(len(kept))
        rank = np.full(len(split), -1)
        rank[better] = np.arange(len(kept))
        stay = rank[at] >= 0
        rows, node = rows[stay], split[at[stay]]
        at = 2 * rank[at[stay]] + (bins[rows, feature[node]] > cut[node])
        order = np.argsort(at, kind="stable")
        rows, at = rows[order], at[order]
        counts = np.stack([lefts[better], counts[kept] - lefts[better]], axis=1).reshape(-1, shape.n_classes)
        path = np.stack([2 * path[kept], 2 * path[kept] + np.uint64(1)], axis=1).reshape(-1)
    tree = Tree(*(np.concatenate(parts) for parts in zip(*levels)))
    _merge(tree, [len(level[0]) for level in levels])
    return tree


def _merge(tree: Tree, sizes: Sequence[int]) -> None:
    """Two leaves of one prediction become one, from the lowest level up."""
    predicted, end = tree.counts.argmax(axis=1), len(tree.left)
    for size in reversed(sizes):
        node = np.arange(end - size, end)
        node = node[tree.left[node] >= 0]
        a, b = tree.left[node], tree.left[node] + 1
        same = (tree.left[a] < 0) & (tree.left[b] < 0) & (predicted[a] == predicted[b])
        tree.left[node[same]] = -1
        end -= size


def prepared(
    estimators: Sequence[Estimator], train: DataFrame, both: DataFrame
) -> dict[int, Callable[[Sequence[int]], DataFrame]]:
    """For the position of each estimator to be grown by tasks, :func:`scored` as a function of the sizes.

    ``both`` has the rows of ``train`` under the split 'train', and others to score.
    """
    if not any(isinstance(e, RandomForestClassifier) for e in estimators):
        return {}
    n_rows = train.count()
    large = [i for i, e in enumerate(estimators) if is_large(e, train, n_rows)]
    if not large:
        return {}
    # A stump: Spark ML checks the rows and tells the classes.
    stump = estimators[large[0]].copy().setNumTrees(1).setMaxDepth(0).fit(train)
    if stump.numClasses < 2:
        return {}
    rows = {}
    for n_bins in {estimators[i].getMaxBins() for i in large}:
        rows[n_bins] = binned(both, thresholds(train, stump.numFeatures, n_bins))
    shape = (stump.numFeatures, stump.numClasses)
    return {i: partial(scored, rows[estimators[i].getMaxBins()], estimators[i], *shape) for i in large}


def scored(rows: DataFrame, forest: RandomForestClassifier, n_features: int, n_classes: int, sizes: Sequence[int]) -> DataFrame:
    """``split, label`` and, per size ``n``, ``_n``: the probability of class 1 by the first ``n`` trees.

    ``rows`` are those of :func:`binned`; the forest is grown on their training part.
    """
    n_trees, seed = forest.getNumTrees(), forest.getSeed()
    shape = Shape(
        n_features, n_classes, forest.getMaxBins(),
        subset_size(forest.getFeatureSubsetStrategy(), n_features, n_trees),
        forest.getMaxDepth(), forest.getMinInstancesPerNode(), forest.getMinInfoGain(),
    )
    names = [f"_{n}" for n in sizes]

    def of_lot(lot: int, batches: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(batches)
        flat = [c.cast(pa.binary(n_features)) for c in table.column("bins").chunks]
        flat = [np.frombuffer(c.buffers()[1], np.uint8, len(c) * n_features, c.offset * n_features) for c in flat]
        bins, ids = np.concatenate(flat).reshape(-1, n_features), table.column("_row").to_numpy()
        fitted = table.column("split").to_numpy() == "train"
        inner, numbers = bins[fitted], ids[fitted]
        y = table.column("label").to_numpy()[fitted].astype(np.int64)
        sums = np.zeros((len(sizes), len(ids)), dtype=np.int64)
        for number in range(lot * LOT, min((lot + 1) * LOT, n_trees)):
            key = mixed(np.array([seed], dtype=np.int64).astype(np.uint64), number)
            tree = grow(inner, y, drawn(key, numbers), mixed(key, 1), shape)
            votes = np.rint(tree.share() / UNIT).astype(np.int64)[tree.leaves(bins)]
            for i, n in enumerate(sizes):
                if number < n:
                    sums[i] += votes
        kept = [table.column(c).combine_chunks() for c in ("_row", "split", "label")]
        return pa.Table.from_arrays([*kept, *map(pa.array, sums)], names=["_row", "split", "label", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lots: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            lot = batch.column("_lot").to_numpy()
            for value in np.unique(lot):
                lots.setdefault(int(value), []).append(batch.filter(pa.array(lot == value)))
        for value in sorted(lots):
            yield from of_lot(value, lots.pop(value)).to_batches(max_chunksize=10_000)

    n_lots = -(-n_trees // LOT)
    every = F.explode(F.array(*[F.lit(i) for i in range(n_lots)]))
    dealt = rows.withColumn("_lot", every).repartitionById(n_lots, "_lot")
    kinds = ", ".join(["_row long", "split string", "label double", *(f"{c} long" for c in names)])
    sums = dealt.mapInArrow(run, kinds).groupBy("_row", "split", "label").agg(*[F.sum(c).alias(c) for c in names])
    return sums.select("split", "label", *[(F.col(c) * (UNIT / n)).alias(c) for c, n in zip(names, sizes)])
