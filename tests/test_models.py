from __future__ import annotations

import tracemalloc

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import discriminant, evaluate, models
from tidemark.operators.random_features import RandomFourierFeatures, lifted_rows


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(7)
    y = (rng.random(400) < 0.35).astype(float)
    x = rng.normal(size=(400, 3)) * [1.0, 2.0, 0.5] + np.outer(y, [1.0, -1.0, 0.3])
    x = np.column_stack([x, (rng.random(400) < 0.3 + 0.4 * y).astype(float)])
    return x, y


@pytest.fixture(scope="module")
def data(spark, points):
    x, y = points
    frame = [(i, float(label), Vectors.dense(row)) for i, (row, label) in enumerate(zip(x, y))]
    return spark.createDataFrame(frame, ["id", "label", "features"]).repartition(4).cache()


def auc(model, df):
    return evaluate.auc(models.model_scores(model, df)).first()["auc"]


def test_balanced_weights(spark, data, points):
    _, y = points
    got = dict(rows(models.balanced_weights(data).select("label", "weight").distinct()))
    assert got[1.0] == pytest.approx(400 / (2 * y.sum())) and got[0.0] == pytest.approx(400 / (2 * (400 - y.sum())))


def test_logistic_matches_newton_steps(data, points):
    x, y = points
    strength = 0.05
    design = np.column_stack([np.ones(len(y)), x])
    penalty = np.diag([0.0] + [1.0] * x.shape[1])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        grad = strength * design.T @ (y - p) - penalty @ beta
        hess = strength * (design * (p * (1 - p))[:, None]).T @ design + penalty
        beta += np.linalg.solve(hess, grad)
    model = models.logistic(400, strength, "l2").fit(data)
    np.testing.assert_allclose([model.intercept, *model.coefficients], beta, atol=1e-4)


def test_logistic_variants_rank_above_chance(data):
    weighted = models.balanced_weights(data)
    for penalty in ("l1", "l2"):
        for flag in (False, True):
            assert auc(models.logistic(400, 1.0, penalty, flag).fit(weighted), weighted) > 0.75


def test_naive_bayes_on_parts_and_stack(data):
    flags = models.binary_slots(data)
    assert flags == [False, False, False, True]
    first, second = models.naive_bayes("bernoulli", [3]), models.naive_bayes("gaussian", [0, 1, 2])
    stack = models.fit_stack(data, first, second, 400)
    assert auc(stack, data) >= auc(first.fit(data), data)
    assert stack.transform(data).count() == 400
    assert auc(models.naive_bayes("gaussian").fit(data), data) > 0.75


def test_trees_and_margins(data):
    weighted = models.balanced_weights(data)
    assert auc(models.forest(10, 2, 5).fit(data), data) > 0.8
    assert auc(models.boosting(5, 0.5, 3).fit(data), data) > 0.8
    assert auc(models.linear_svm(400, weighted=True).fit(weighted), weighted) > 0.75
    assert models.forest().getMaxDepth() == 30 and models.forest(min_samples_split=150).getMinInstancesPerNode() == 75


def test_random_features_approach_the_radial_kernel(spark, data, points):
    x, _ = points
    lift = RandomFourierFeatures(gamma=0.2, components=4000, dimension=4, seed=1)
    z = np.array([r[0].toArray() for r in lift.transform(data).orderBy("id").select("lifted").limit(40).collect()])
    distance = ((x[:40, None] - x[None, :40]) ** 2).sum(axis=2)
    np.testing.assert_allclose(z @ z.T, np.exp(-0.2 * distance), atol=0.1)


def test_random_features_of_a_batch_take_one_array():
    rng = np.random.default_rng(5)
    x, weights, shift = rng.normal(size=(10_000, 8)), rng.normal(size=(8, 64)), rng.uniform(size=64)
    tracemalloc.start()
    z = lifted_rows(x, weights, shift)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 1.2 * z.nbytes
    np.testing.assert_array_equal(z, np.sqrt(2 / 64) * np.cos(x @ weights + shift))


def test_radial_svm_solves_a_ring(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 2))
    y = ((x**2).sum(axis=1) > 1.4).astype(float)
    df = spark.createDataFrame([(float(a), Vectors.dense(b)) for a, b in zip(y, x)], ["label", "features"])
    df = models.balanced_weights(df)
    assert auc(models.radial_svm(400, 2, gamma=0.5, components=100, C=10.0).fit(df), df) > 0.97
    assert auc(models.linear_svm(400, weighted=True).fit(df), df) < 0.75


def test_class_stats(data, points):
    x, y = points
    stats = discriminant.class_stats(data)
    for k in (0, 1):
        part = x[y == k]
        assert stats.sizes[k] == len(part)
        np.testing.assert_allclose(stats.means[k], part.mean(axis=0))
        np.testing.assert_allclose(stats.scatter[k], np.cov(part.T, bias=True) * len(part), atol=1e-9)


def test_lda_matches_the_closed_form(data, points):
    x, y = points
    pooled = sum(np.cov(x[y == k].T) * ((y == k).sum() - 1) for k in (0, 1)) / (len(y) - 2)
    m0, m1 = x[y == 0].mean(axis=0), x[y == 1].mean(axis=0)
    w = np.linalg.solve(pooled, m1 - m0)
    b = np.log(y.mean() / (1 - y.mean())) - w @ (m0 + m1) / 2
    model = discriminant.fit_lda(data)
    np.testing.assert_allclose(model.coefficients, w, rtol=1e-8)
    assert model.intercept == pytest.approx(b)
    got = [r[0] for r in models.with_score(model.transform(data)).orderBy("id").select("score").collect()]
    np.testing.assert_allclose(got, 1 / (1 + np.exp(-(x @ w + b))), rtol=1e-8)


def test_lda_ignores_a_constant_column(spark, points):
    x, y = points
    wide = [(float(a), Vectors.dense([*b, 3.0])) for a, b in zip(y, x)]
    model = discriminant.fit_lda(spark.createDataFrame(wide, ["label", "features"]))
    assert model.coefficients[-1] == 0.0


def test_qda_matches_the_densities(data, points):
    x, y = points
    logs = []
    for k in (0, 1):
        part = x[y == k]
        values, vectors = np.linalg.eigh(np.cov(part.T))
        cov = vectors @ np.diag(0.9 * values + 0.1) @ vectors.T
        gap = x - part.mean(axis=0)
        logs.append(np.log(len(part) / len(y)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (gap @ np.linalg.inv(cov) * gap).sum(axis=1))
    want = 1 / (1 + np.exp(logs[0] - logs[1]))
    scored = models.with_score(discriminant.fit_qda(data, reg_param=0.1).transform(data))
    got = scored.orderBy("id").select("score", "prediction").collect()
    np.testing.assert_allclose([r[0] for r in got], want, rtol=1e-7)
    assert [r[1] for r in got] == list((want > 0.5).astype(float))


def test_projection_is_centred(data, points):
    x, _ = points
    model = discriminant.projection(2).fit(data)
    centred = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    got = np.array([r[0].toArray() for r in model.transform(data).orderBy("id").select("projected").collect()])
    np.testing.assert_allclose(np.abs(got), np.abs(centred @ vt[:2].T), atol=1e-8)
    np.testing.assert_allclose(discriminant.explained_variance(model), (s**2 / (s**2).sum())[:2])


def test_folds_are_stratified_and_repeatable(data):
    one = models.stratified_folds(data, ["id"], 5, seed=30)
    sizes = {}
    for label, fold, n in rows(one.groupBy("label", "fold").count()):
        sizes.setdefault(label, []).append(n)
    assert all(len(s) == 5 and max(s) - min(s) <= 1 for s in sizes.values())
    assert rows(one, "id", "fold") == rows(models.stratified_folds(data.repartition(9), ["id"], 5, seed=30), "id", "fold")


def test_grids_and_refits(spark, data):
    folded = models.stratified_folds(data, ["id"], 3).cache()
    base = models.logistic(400)
    grid = models.logistic_grid(base, 400, {"C": [0.1, 10.0], "penalty": ["l1", "l2"]})
    result = models.cross_validated(base, folded, grid, k=3)
    table = models.settings_table(spark, result).orderBy("rank").collect()
    assert len(table) == 4 and table[0]["cv_auc"] == max(result.avgMetrics)
    scored = models.refit_every(base, result, folded.filter("fold > 0"), folded.filter("fold = 0"), step=3)
    areas = evaluate.auc(scored, ["model", "split"])
    assert {(r[0], r[1]) for r in rows(areas)} == {(f"rank_{i}", s) for i in (0, 3) for s in ("train", "holdout")}
    assert 0.7 < models.cross_validated(base, folded, k=3).avgMetrics[0] <= 1.0
    assert len(models.forest_grid(models.forest())) == 36 and len(models.boosting_grid(models.boosting())) == 27


def test_weights_table_and_predicted_counts(spark, data):
    names = ["a", "b", "c", "d"]
    fitted = models.standardised(models.logistic(400)).fit(data)
    top = models.top_weights(spark, fitted.stages[-1], names, 2).collect()
    assert len(top) == 2 and top[0]["magnitude"] >= top[1]["magnitude"]
    forest = models.forest(5, 2, 3).fit(data)
    assert sum(r["weight"] for r in models.top_weights(spark, forest, names).collect()) == pytest.approx(1.0)
    shares = models.predicted_counts(forest.transform(data))
    assert shares.agg(F.sum("share")).first()[0] == pytest.approx(1.0)
