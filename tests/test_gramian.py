from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import discriminant, gramian


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(11)
    x = np.where(rng.random((300, 6)) < 0.4, rng.normal(2.0, 3.0, (300, 6)), 0.0)
    x[:, 5] = 0.0
    y = (rng.random(300) < 1 / (1 + np.exp(-(x[:, 0] - 0.5 * x[:, 1])))).astype(float)
    w = rng.random(300) + 0.5
    return x, y, w


@pytest.fixture(scope="module")
def data(spark, points):
    rows = [(Vectors.dense(a) if i % 2 else Vectors.sparse(6, dict((j, v) for j, v in enumerate(a) if v)), float(b), float(c)) for i, (a, b, c) in enumerate(zip(*points))]
    return spark.createDataFrame(rows, ["features", "label", "weight"]).repartition(3).cache()


def test_sums_are_those_of_the_matrix_product(data, points):
    x, y, w = points
    rows = data.withColumn("x", gramian.as_array(data, "features"))
    got = gramian.matrix(gramian.pair_sums(rows, "x", F.col("weight")).collect(), 6)
    np.testing.assert_allclose(got, (x * w[:, None]).T @ x, atol=1e-9)
    by = gramian.pair_sums(rows, "x", by=["label"]).collect()
    for value in (0.0, 1.0):
        own = gramian.matrix([r for r in by if r["label"] == value], 6)
        np.testing.assert_allclose(own, x[y == value].T @ x[y == value], atol=1e-9)


@pytest.mark.parametrize(("weighted", "ridge"), [(False, 0.0), (True, 0.0), (False, 4.0), (True, 4.0)])
def test_newton_meets_the_optimality_conditions(data, points, weighted, ridge):
    x, y, w = points
    fit = gramian.fit_newton(data, weight="weight" if weighted else None, ridge=ridge, steps=12)
    p = 1 / (1 + np.exp(-(fit.intercept + x @ fit.coefficients)))
    rest = (w if weighted else 1.0) * (y - p)
    assert abs(rest.sum()) < 1e-6 and fit.coefficients[5] == pytest.approx(0.0, abs=1e-9)
    np.testing.assert_allclose(x.T @ rest, ridge * fit.coefficients, atol=1e-6)
    scored = data.select(fit.probability(gramian.as_array(data, "features")).alias("p"), "label").collect()
    assert sum(r.p for r in scored) == pytest.approx(p.sum())


def test_components_are_those_of_the_covariance(data, points):
    x = points[0][:, :5]
    rows = data.select(F.slice(gramian.as_array(data, "features"), 1, 5).alias("features"))
    model = gramian.fit_components(rows, components=3)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    np.testing.assert_allclose(model.variances, values[::-1][:3], rtol=1e-9)
    assert sum(model.shares()) < 1 and (np.abs(model.axes).max(axis=0) == model.axes.max(axis=0)).all()
    got = np.array([r[0] for r in rows.select(model.project(F.col("features"))).collect()])
    np.testing.assert_allclose(got.var(axis=0, ddof=1), model.variances, rtol=1e-9)
    np.testing.assert_allclose(np.abs(model.axes), np.abs(vectors[:, ::-1][:, :3]), atol=1e-9)


def test_nothing_to_fit(spark):
    empty = spark.createDataFrame([], "features array<double>, label double")
    with pytest.raises(ValueError):
        gramian.fit_newton(empty)
    with pytest.raises(ValueError):
        gramian.fit_components(empty)


def test_rows_without_label_or_features_take_no_part(spark):
    rows = [([float(i % 3)], float(i % 2)) for i in range(30)] + [(None, 1.0), ([9.0], None)]
    fit = gramian.fit_newton(spark.createDataFrame(rows, "features array<double>, label double"))
    assert abs(fit.intercept) < 1e-9 and abs(fit.coefficients[0]) < 1e-9


def test_fitting_needs_no_python_in_tasks(data):
    """The scatter of the classes is a plain aggregate."""
    rows = data.withColumn("x", gramian.as_array(data, "features"))
    plan = gramian.pair_sums(rows, "x", by=["label"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Python" not in plan and "Pandas" not in plan
    assert discriminant.fit_lda(data.select("label", F.col("features"))).coefficients.shape == (6,)
