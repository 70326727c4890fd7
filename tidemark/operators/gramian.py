"""Sums of products of features, and what follows from them: Newton steps and principal components.

A row puts out one number for each pair of its non-zero features; the sums by pair are plain aggregates with
a map-side combine. No task holds a matrix, and features that are mostly zero cost what their non-zeros do.
Only sums of model size reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The place of the linear sums among the pairs.
LINEAR = -1
# Up to so many features each pair is a column of its own sum, beyond it a row.
FEW = 8


def as_array(df: DataFrame, features: str) -> Column:
    """A vector or array column as array<double>."""
    if isinstance(df.schema[features].dataType, VectorUDT):
        return vector_to_array(features)
    return F.col(features).cast("array<double>")


def pair_sums(
    df: DataFrame, values: str, weight: Column | None = None, linear: Column | None = None, by: Sequence[str] = (), size: int = FEW + 1
) -> DataFrame:
    """by, i, j, total: sums of ``weight * x[i] * x[j]`` for j <= i, and of ``linear * x[i]`` at j = -1.

    ``values`` is an array column, with ``size`` entries where that is known; pairs that no row has both of
    may be left out.
    """
    if size <= FEW:
        return _few_sums(df, values, weight, linear, by, size)
    slots = F.transform(values, lambda v, i: F.struct(i.alias("i"), v.alias("v")))
    rows = df.select(
        *by,
        F.filter(slots, lambda s: s["v"] != 0).alias("_x"),
        (F.lit(1.0) if weight is None else weight).alias("_w"),
        (F.lit(None).cast("double") if linear is None else linear).alias("_l"),
    )
    one = rows.select("*", F.explode("_x").alias("_a"))
    partners = F.filter("_x", lambda s: s["i"] <= F.col("_a.i"))
    if linear is not None:
        partners = F.concat(partners, F.array(F.struct(F.lit(LINEAR).alias("i"), F.col("_l").alias("v"))))
    two = one.select(*by, "_w", "_a", F.explode(partners).alias("_b"))
    product = F.when(F.col("_b.i") == LINEAR, F.col("_a.v") * F.col("_b.v")).otherwise(F.col("_w") * F.col("_a.v") * F.col("_b.v"))
    return two.groupBy(*by, F.col("_a.i").alias("i"), F.col("_b.i").alias("j")).agg(F.sum(product).alias("total"))


def _few_sums(df: DataFrame, values: str, weight: Column | None, linear: Column | None, by: Sequence[str], size: int) -> DataFrame:
    x = [F.get(F.col(values), F.lit(i)) for i in range(size)]
    products = {(i, j): x[i] * x[j] if weight is None else weight * x[i] * x[j] for i in range(size) for j in range(i + 1)}
    if linear is not None:
        products |= {(i, LINEAR): linear * x[i] for i in range(size)}
    sums = df.groupBy(*by).agg(*[F.sum(p).alias(f"_s{k}") for k, p in enumerate(products.values())])
    rows = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"_s{k}").alias("total")) for k, (i, j) in enumerate(products)]
    return sums.select(*by, F.inline(F.array(*rows))).filter("total IS NOT NULL")


def matrix(sums: list, size: int) -> np.ndarray:
    """Collected pair sums as a symmetric matrix."""
    out = np.zeros((size, size))
    for r in sums:
        if r["j"] != LINEAR:
            out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["total"]
    return out


def dot(values: Column, weights: Sequence[float]) -> Column:
    """Sum of products of an array column with given weights."""
    products = F.zip_with(values, F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


@dataclass
class Logistic:
    """Probability of class 1: the logistic of ``intercept + coefficients . x``."""

    intercept: float
    coefficients: np.ndarray

    def probability(self, values: Column) -> Column:
        return 1 / (1 + F.exp(-(F.lit(self.intercept) + dot(values, self.coefficients))))


def fit_newton(
    df: DataFrame, features: str = "features", label: str = "label", weight: str | None = None, ridge: float = 0.0, steps: int = 8
) -> Logistic:
    """Logistic regression by Newton steps from zero, one aggregate a step.

    ``ridge`` is the weight of half the squared coefficients, without the intercept, against the summed
    (weighted) loss. Rows without features or label take no part. Read once a step: stage a dear ``df``.
    """
    rows = df.select(
        F.concat(F.array(F.lit(1.0)), as_array(df, features)).alias("x"),
        F.col(label).cast("double").alias("y"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"),
    ).dropna()
    first = rows.select(F.size("x").alias("n")).first()
    if first is None:
        raise ValueError("no rows to fit")
    size = first["n"]
    beta, penalty = np.zeros(size), np.diag([0.0] + [ridge] * (size - 1))
    for _ in range(steps):
        p = 1 / (1 + F.exp(-dot(F.col("x"), beta)))
        scored = rows.withColumn("p", p)
        weights = F.col("w") * F.col("p") * (1 - F.col("p"))
        sums = pair_sums(scored, "x", weights, F.col("w") * (F.col("y") - F.col("p")), size=size).collect()
        slope = np.zeros(size)
        for r in sums:
            if r["j"] == LINEAR:
                slope[r["i"]] = r["total"]
        # Features that never vary have no curvature of their own: the shortest step leaves them at zero.
        beta = beta + np.linalg.lstsq(matrix(sums, size) + penalty, slope - penalty @ beta, rcond=None)[0]
    return Logistic(float(beta[0]), beta[1:])


@dataclass
class Components:
    """Principal components: means, axes in columns by falling variance, and their variances."""

    means: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    total: float

    def shares(self) -> list[float]:
        return [float(v) for v in self.variances / self.total]

    def project(self, values: Column) -> Column:
        """Array of the centred values along each axis."""
        return F.array(*[dot(values, axis) - F.lit(float(self.means @ axis)) for axis in self.axes.T])


def fit_components(df: DataFrame, features: str = "features", components: int = 2) -> Components:
    """Axes of the sample covariance; of each, the entry of the greatest size is positive."""
    rows = df.select(F.concat(F.array(F.lit(1.0)), as_array(df, features)).alias("x")).dropna()
    first = rows.select(F.size("x").alias("n")).first()
    size = first["n"] if first else 1
    whole = matrix(pair_sums(rows, "x", size=size).collect(), size)
    # The products with the leading one are the sums, and its own product is the count.
    n = whole[0, 0]
    if n < 2:
        raise ValueError("components need two rows")
    means = whole[0, 1:] / n
    spread = (whole[1:, 1:] - n * np.outer(means, means)) / (n - 1)
    values, vectors = np.linalg.eigh(spread)
    order = np.argsort(-values, kind="stable")[:components]
    axes = vectors[:, order]
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))])
    return Components(means, axes * np.where(signs == 0, 1.0, signs), values[order], float(np.trace(spread)))
