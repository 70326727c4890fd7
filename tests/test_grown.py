from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.operators import evaluate, grown, models, staged

SETTING = {"max_depth": None, "max_features": 2, "min_samples_split": 2}


def frame(spark, x, y):
    rows = [(i, float(label), [float(v) for v in row]) for i, (row, label) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, label double, x array<double>")
    return df.withColumn("features", array_to_vector("x")).drop("x").coalesce(2).cache()


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 4))
    return frame(spark, x, x[:, 0] - x[:, 1] + rng.normal(size=900) > 0)


def one_tree(x, y, **shape):
    default = dict(n_features=x.shape[1], n_classes=2, n_bins=32, tried=x.shape[1], depth=30, least=1, gain=0.0)
    return grown.grow(x, y, np.ones(len(y), dtype=np.int64), np.array([1], np.uint64), grown.Shape(**{**default, **shape}))


def test_forest_with_many_nodes_is_not_fitted_on_the_driver(spark, data, monkeypatch):
    """600 rows and 100 trees of any depth are 120,000 nodes at most: 100,000 is what the driver may hold."""
    train, holdout = data.filter("id % 3 > 0"), data.filter("id % 3 = 0")
    plain = RandomForestClassifier._fit
    fitted = []

    def noted(self, df):
        fitted.append((self.getNumTrees(), self.getMaxDepth()))
        return plain(self, df)

    grid = {"n_estimators": [50, 100], **{name: [value] for name, value in SETTING.items()}}
    with monkeypatch.context() as m:
        m.setattr(RandomForestClassifier, "_fit", noted)
        long = staged.staged_scores(models.forest, grid, train, holdout)
        ranked = staged.ranked_grid(long)
        again = staged.refitted(models.forest, grid, ranked, train, holdout)
        assert fitted == [(1, 0)] * 2  # stumps that check the rows
    count = {(r[0], r[1]): r[2] for r in long.groupBy("model", "split").count().collect()}
    names = [staged.setting_name({"n_estimators": n, **SETTING}) for n in (50, 100)]
    assert count == {(name, part): n for name in names for part, n in (("train", 600), ("holdout", 300))}
    assert [r["model"] for r in again.select("model").distinct().collect()] == [ranked.filter("rank = 0").first()["model"]]
    # As good as Spark ML's forest.
    theirs = models.long_scores(models.forest(50, 2).fit(train), "theirs", train, holdout)
    area = {(r[0], r[1]): r[2] for r in evaluate.auc(long.unionByName(theirs), ["model", "split"]).select("model", "split", "auc").collect()}
    for part in ("train", "holdout"):
        assert area[names[0], part] == pytest.approx(area["theirs", part], abs=0.02)


def test_small_forest_stays_with_spark(data):
    boosting, small, large = models.boosting(5), models.forest(3, 2), models.forest(100, 2)
    assert not grown.prepared([boosting, small], data, data)
    both = data.withColumn("split", F.lit("train"))
    assert list(grown.prepared([boosting, small, large], data, both)) == [2]
    assert not grown.is_large(large.copy().setWeightCol("weight"), data, 900)


@pytest.mark.parametrize("depth,least", [(4, 1), (6, 12)])
def test_tree_is_that_of_spark(spark, depth, least):
    """Few values, so both have the same cuts; one class is rare, so leaves of one prediction merge."""
    rng = np.random.default_rng(depth)
    x = rng.integers(0, 12, size=(700, 3)).astype(np.uint8)
    y = (rng.random(700) < np.where(x[:, 0] > 8, 0.6, 0.1)).astype(np.int64)
    df = frame(spark, x, y)
    theirs = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=least).fit(df)
    expected = [r["score"] for r in models.model_scores(theirs, df, ["id"]).orderBy("id").collect()]
    tree = one_tree(x, y, depth=depth, least=least)
    np.testing.assert_allclose(tree.share()[tree.leaves(x)], expected, atol=1e-12)
    assert len(np.unique(tree.leaves(x))) < (tree.counts.sum(axis=1) > 0).sum()


def test_limits_of_a_tree(monkeypatch):
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 32, size=(500, 6)).astype(np.uint8), rng.integers(0, 2, size=500)
    full = one_tree(x, y)
    leaf = full.leaves(x)
    for node in np.unique(leaf):
        np.testing.assert_array_equal(full.counts[node], np.bincount(y[leaf == node], minlength=2))
    np.testing.assert_array_equal(full.share()[leaf], y)  # no two rows are alike
    least = one_tree(x, y, least=40)
    assert np.bincount(least.leaves(x))[np.unique(least.leaves(x))].min() >= 40
    assert len(one_tree(x, y, depth=0).left) == 1 and len(one_tree(x, np.zeros_like(y)).left) == 1
    # Nodes and rows in small runs.
    monkeypatch.setattr(grown, "CELLS", 200)
    np.testing.assert_array_equal(one_tree(x, y).leaves(x), leaf)


def test_draws():
    key, rows = np.array([7], np.uint64), np.arange(100_000)
    times = grown.drawn(key, rows)
    assert times.mean() == pytest.approx(1, abs=0.02) and times.var() == pytest.approx(1, abs=0.03)
    np.testing.assert_array_equal(grown.drawn(key, rows[::-1])[::-1], times)
    assert abs(np.corrcoef(times, grown.drawn(grown.mixed(key, 1), rows))[0, 1]) < 0.02
    shape = grown.Shape(10, 2, 32, 3, 30, 1, 0.0)
    tried = grown._subsets(key, np.arange(20_000, dtype=np.uint64), shape)
    assert all(len(set(row)) == 3 for row in tried[:50].tolist())
    np.testing.assert_allclose(np.bincount(tried.ravel()) / 6_000, 1, atol=0.06)
    for name, n in (("all", 64), ("sqrt", 8), ("auto", 8), ("log2", 6), ("onethird", 22), ("5", 5), ("70", 64), ("0.1", 7)):
        assert grown.subset_size(name, 64, 10) == n


def test_lots_leave_no_trace(data, monkeypatch):
    both = data.withColumn("split", F.when(F.col("id") % 3 > 0, "train").otherwise("holdout"))
    both = both.withColumn("label", F.when(F.col("id") % 30 > 0, F.col("label")))  # some held out rows have no label
    train = both.filter("split = 'train'")
    monkeypatch.setattr(grown, "DRIVER_NODES", 0)
    found = []
    for lot in (1, 3, 20):
        monkeypatch.setattr(grown, "LOT", lot)
        scored = grown.prepared([models.forest(7, 2, 5)], train, both)[0]([3, 7])
        found.append(sorted(map(repr, scored.collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) == 900
    assert sum("label=None" in r for r in found[0]) == 30


def test_cuts_and_bins(spark):
    values = [[0.0, float(i)] for i in range(400)] + [[1.0, 5.0], [3.0, 5.0]]
    df = frame(spark, values, [0] * len(values))
    few, many = grown.thresholds(df, 2, 32)
    assert few.tolist() == [0.5, 2.0] and len(many) == 31 and many[15] == pytest.approx(200, abs=5)
    rows = grown.binned(df.withColumn("split", F.lit("train")), [few, many]).orderBy("_row").collect()
    assert [r["bins"][0] for r in rows[-3:]] == [0, 1, 2] and len({r["_row"] for r in rows}) == 402
    assert [r["bins"][1] for r in rows[:400]] == [int((many < i).sum()) for i in range(400)]
    short = spark.createDataFrame([(1.0, [0.0])], "label double, x array<double>").withColumn("features", array_to_vector("x"))
    with pytest.raises(Exception, match="every row needs a vector of 2 features"):
        grown.binned(short.withColumn("split", F.lit("train")), [few, many])
