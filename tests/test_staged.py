from __future__ import annotations

import threading

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import models, staged


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    y = (x[:, 0] - x[:, 1] + rng.normal(size=300) > 0).astype(float)
    frame = [(i, float(label), Vectors.dense(row)) for i, (row, label) in enumerate(zip(x, y))]
    return spark.createDataFrame(frame, ["id", "label", "features"]).coalesce(1).cache()


def scores(model, df):
    return [r["score"] for r in models.model_scores(model, df, ["id", "label"]).orderBy("id").collect()]


def test_first_trees_of_boosting_are_the_shorter_fit(data):
    long, short = (models.boosting(n, 0.3, 2).fit(data) for n in (6, 3))
    np.testing.assert_allclose(scores(staged.first_trees(long, 3), data), scores(short, data), atol=1e-12)
    np.testing.assert_allclose(scores(staged.first_trees(long, 6), data), scores(long, data), atol=1e-12)


def test_first_trees_of_a_forest_are_the_mean_of_those_trees(data):
    model = models.forest(5, 2, 4).fit(data)
    each = [scores(tree, data) for tree in model.trees[:2]]
    np.testing.assert_allclose(scores(staged.first_trees(model, 2), data), np.mean(each, axis=0), atol=1e-12)
    for n in (0, 6):
        with pytest.raises(ValueError):
            staged.first_trees(model, n)


def test_grid_is_fitted_once_per_size(data, monkeypatch):
    grid = {"n_estimators": [1, 3], "max_depth": [1, 2]}
    built = []

    def build(**setting):
        built.append(setting)
        return models.forest(**setting)

    train, holdout = data.filter("id % 3 > 0"), data.filter("id % 3 = 0")
    long = staged.staged_scores(build, grid, train, holdout)
    assert built == [{"n_estimators": 3, "max_depth": 1}, {"n_estimators": 3, "max_depth": 2}]
    assert {(r[0], r[1]): r[2] for r in long.groupBy("model", "split").count().collect()} == {
        (staged.setting_name(s), part): n for s in staged.every_setting(grid) for part, n in (("train", 200), ("holdout", 100))
    }
    ranked = staged.ranked_grid(long).collect()
    assert [r["rank"] for r in ranked] == [0, 1, 2, 3]
    assert all(a["holdout_auc"] >= b["holdout_auc"] for a, b in zip(ranked, ranked[1:]))
    again = staged.refitted(models.forest, grid, staged.ranked_grid(long), train, holdout, 3)
    assert {r["model"] for r in again.select("model").distinct().collect()} == {ranked[0]["model"], ranked[3]["model"]}
    alone = staged.staged_scores(models.forest, {"n_estimators": [1], "max_depth": [1]}, train, holdout.limit(0))
    assert alone.filter(F.col("split") == "holdout").count() == 0 and alone.count() == 200


def test_fits_run_side_by_side(data):
    grid = {"n_estimators": [1], "max_depth": [1, 2]}
    together = threading.Barrier(2)

    class Meeting:
        def __init__(self, **setting):
            self.forest = models.forest(**setting)

        def fit(self, df):
            together.wait(120)
            return self.forest.fit(df)

    names = [staged.setting_name(s) for s in staged.every_setting(grid)]
    ranked = data.sparkSession.createDataFrame([(5 * i, name) for i, name in enumerate(names)], "rank int, model string")
    for long in (staged.staged_scores(Meeting, grid, data, data), staged.refitted(Meeting, grid, ranked, data, data)):
        assert {r["model"] for r in long.select("model").distinct().collect()} == set(names)
