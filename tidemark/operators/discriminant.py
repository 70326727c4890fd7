"""Linear and quadratic discriminant analysis, and the projection before them.

Fitting is two passes over the rows: class sizes and means, then the products of features by class, from
which the scatter around the means follows.  Only sums of model size come back.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.gramian import as_array, matrix, pair_sums


@dataclass
class ClassStats:
    """Per class: rows, mean, and scatter matrix around the mean."""

    labels: list[float]
    sizes: np.ndarray
    means: np.ndarray
    scatter: np.ndarray


def class_stats(df: DataFrame, features: str = "features", label: str = "label") -> ClassStats:
    moments = (
        df.groupBy(F.col(label).cast("double").alias("label"))
        .agg(Summarizer.metrics("count", "mean").summary(F.col(features)).alias("s"))
        .select("label", "s.count", "s.mean")
        .orderBy("label")
        .collect()
    )
    labels = [r["label"] for r in moments]
    means = np.array([r["mean"].toArray() for r in moments])
    sizes = np.array([r["count"] for r in moments], dtype=float)
    rows = df.select(F.col(label).cast("double").alias("label"), as_array(df, features).alias("x"))
    sums = pair_sums(rows, "x", by=["label"], size=means.shape[1]).collect()
    result = np.zeros((len(labels), means.shape[1], means.shape[1]))
    for k, value in enumerate(labels):
        whole = matrix([r for r in sums if r["label"] == value], means.shape[1])
        centred = whole - sizes[k] * np.outer(means[k], means[k])
        # What is left of a feature that does not vary within the class is rounding.
        constant = centred.diagonal() <= 1e-12 * whole.diagonal()
        centred[constant, :] = centred[:, constant] = 0.0
        result[k] = centred
    return ClassStats(labels, sizes, means, result)


@dataclass
class LinearDiscriminant:
    """Two-class model: probability of class 1 is the logistic of a linear score."""

    coefficients: np.ndarray
    intercept: float

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        weights, intercept = self.coefficients, self.intercept

        @F.pandas_udf("double")
        def margin(batch: pd.Series) -> pd.Series:
            if batch.empty:
                return pd.Series(dtype=float)
            return pd.Series(np.stack(batch.to_numpy()) @ weights + intercept)

        return _with_probability(df, margin(vector_to_array(features)))


def fit_lda(df: DataFrame, features: str = "features", label: str = "label", tolerance: float = 1e-4) -> LinearDiscriminant:
    """Common covariance; directions without spread inside the classes are left out."""
    stats = class_stats(df, features, label)
    total, classes = stats.sizes.sum(), len(stats.labels)
    pooled = stats.scatter.sum(axis=0) / (total - classes)
    spread = np.sqrt(stats.scatter.sum(axis=0).diagonal() / total)
    spread[spread == 0] = 1.0
    values, vectors = np.linalg.eigh(pooled / np.outer(spread, spread))
    kept = values > tolerance**2
    half = (vectors[:, kept] / np.sqrt(values[kept])).T / spread
    gap = half @ (stats.means[1] - stats.means[0])
    weights = half.T @ gap
    middle = (stats.means[0] + stats.means[1]) / 2
    prior = np.log(stats.sizes[1] / stats.sizes[0])
    return LinearDiscriminant(weights, float(prior - middle @ weights))


@dataclass
class QuadraticDiscriminant:
    """Per class: mean, axes with their spreads, and the constant of the log density."""

    means: np.ndarray
    axes: list[np.ndarray]
    constants: np.ndarray

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        means, axes, constants = self.means, self.axes, self.constants

        @F.pandas_udf("double")
        def margin(batch: pd.Series) -> pd.Series:
            if batch.empty:
                return pd.Series(dtype=float)
            x = np.stack(batch.to_numpy())
            density = [c - 0.5 * (((x - m) @ a) ** 2).sum(axis=1) for m, a, c in zip(means, axes, constants)]
            return pd.Series(density[1] - density[0])

        return _with_probability(df, margin(vector_to_array(features)))


def fit_qda(df: DataFrame, features: str = "features", label: str = "label", reg_param: float = 0.0) -> QuadraticDiscriminant:
    """A covariance per class, its spreads drawn towards one by ``reg_param``."""
    stats = class_stats(df, features, label)
    axes, constants = [], []
    for k in range(len(stats.labels)):
        values, vectors = np.linalg.eigh(stats.scatter[k] / (stats.sizes[k] - 1))
        values = (1 - reg_param) * np.clip(values, 0.0, None) + reg_param
        if (values <= 0).any():
            raise ValueError("a class has no spread in some direction: give a reg_param above 0")
        axes.append(vectors / np.sqrt(values))
        constants.append(np.log(stats.sizes[k] / stats.sizes.sum()) - 0.5 * np.log(values).sum())
    return QuadraticDiscriminant(stats.means, axes, np.array(constants))


def _with_probability(df: DataFrame, margin) -> DataFrame:
    scored = df.withColumn("_margin", margin)
    one = 1 / (1 + F.exp(-F.col("_margin")))
    return scored.withColumns(
        {
            "rawPrediction": array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))),
            "probability": array_to_vector(F.array(1 - one, one)),
            "prediction": (F.col("_margin") > 0).cast("double"),
        }
    ).drop("_margin")


def projection(components: int, output: str = "projected") -> Pipeline:
    """Principal components of the centred features; Spark's PCA alone does not centre its output."""
    return Pipeline(
        stages=[
            StandardScaler(inputCol="features", outputCol="centred", withMean=True, withStd=False),
            PCA(k=components, inputCol="centred", outputCol=output),
        ]
    )


def explained_variance(model: PipelineModel) -> list[float]:
    return [float(v) for v in model.stages[-1].explainedVariance.toArray()]
