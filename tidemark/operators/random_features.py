"""Random Fourier features: a linear stand-in for the radial kernel."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lifted_rows(rows: np.ndarray, weights: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """One array of the result's size is made and worked on in place: no objects per row, no copies."""
    out = rows @ weights
    out += shift
    np.cos(out, out=out)
    out *= np.sqrt(2.0 / len(shift))
    return out


class RandomFourierFeatures(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """``sqrt(2/D) * cos(x W + b)`` with W ~ N(0, 2 gamma) and b ~ U(0, 2 pi) (Rahimi and Recht, 2007)."""

    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    components = Param(Params._dummy(), "components", "output size", TypeConverters.toInt)
    dimension = Param(Params._dummy(), "dimension", "input size", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the draw", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, gamma=1.0, components=256, dimension=None, seed=30, inputCol="features", outputCol="lifted"):
        super().__init__()
        self._setDefault(gamma=1.0, components=256, seed=30, inputCol="features", outputCol="lifted")
        self._set(**self._input_kwargs)

    def draw(self) -> tuple[np.ndarray, np.ndarray]:
        size = self.getOrDefault(self.components)
        rng = np.random.default_rng(self.getOrDefault(self.seed))
        scale = np.sqrt(2.0 * self.getOrDefault(self.gamma))
        return (
            rng.normal(0.0, scale, (self.getOrDefault(self.dimension), size)),
            rng.uniform(0.0, 2.0 * np.pi, size),
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights, shift = self.draw()

        @F.arrow_udf("array<double>")
        def lift(batch: pa.Array) -> pa.Array:
            rows = batch.flatten().to_numpy().reshape(len(batch), len(weights))
            ends = np.arange(len(batch) + 1, dtype="int32") * len(shift)
            return pa.ListArray.from_arrays(ends, lifted_rows(rows, weights, shift).reshape(-1))

        lifted = array_to_vector(lift(vector_to_array(F.col(self.getInputCol()))))
        return dataset.withColumn(self.getOutputCol(), lifted)
