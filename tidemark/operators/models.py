"""Binary classifiers on Spark ML, their tuning and their scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cumulate import numbered
from tidemark.operators.random_features import RandomFourierFeatures

# The settings the comparison grids run over.
LOGISTIC_GRID = {"C": [0.001, 0.1, 10.0], "penalty": ["l1", "l2"]}
FOREST_GRID = {
    "n_estimators": [50, 100],
    "max_depth": [10, None],
    "max_features": [5, 10, 20],
    "min_samples_split": [2, 100, 500],
}
BOOSTING_GRID = {
    "n_estimators": [100, 250, 500],
    "learning_rate": [0.001, 0.1, 0.5],
    "max_depth": [3, 10, None],
}
DEEPEST = 30


def balanced_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Weight ``rows / (2 * rows of the class)`` on each row."""
    sizes = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    total = sum(sizes.values())
    weight = F.lit(None).cast("double")
    for value, size in sizes.items():
        weight = F.when(F.col(label) == value, F.lit(total / (len(sizes) * size))).otherwise(weight)
    return df.withColumn(name, weight)


def logistic(n_rows: int, C: float = 1.0, penalty: str = "l2", weighted: bool = False, **extra) -> LogisticRegression:
    """Logistic regression whose penalty matches an inverse strength ``C`` on ``n_rows`` rows."""
    return LogisticRegression(
        regParam=1.0 / (C * n_rows),
        elasticNetParam=1.0 if penalty == "l1" else 0.0,
        standardization=False,
        maxIter=100,
        **({"weightCol": "weight"} if weighted else {}),
        **extra,
    )


def forest(
    n_estimators: int = 10,
    max_features: int | str = "sqrt",
    max_depth: int | None = None,
    min_samples_split: int = 2,
    seed: int = 30,
) -> RandomForestClassifier:
    """Random forest; no depth limit means the deepest tree Spark grows."""
    return RandomForestClassifier(
        numTrees=n_estimators,
        featureSubsetStrategy=str(max_features),
        maxDepth=min(max_depth or DEEPEST, DEEPEST),
        minInstancesPerNode=max(1, min_samples_split // 2),
        cacheNodeIds=True,
        checkpointInterval=10,
        maxMemoryInMB=512,
        seed=seed,
    )


def boosting(
    n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int | None = 3, seed: int = 30
) -> GBTClassifier:
    return GBTClassifier(
        maxIter=n_estimators,
        stepSize=learning_rate,
        maxDepth=min(max_depth or DEEPEST, DEEPEST),
        checkpointInterval=10,
        seed=seed,
    )


def linear_svm(n_rows: int, C: float = 1.0, weighted: bool = False) -> LinearSVC:
    return LinearSVC(
        regParam=1.0 / (C * n_rows), standardization=False, **({"weightCol": "weight"} if weighted else {})
    )


def radial_svm(
    n_rows: int, n_features: int, gamma: float | None = None, components: int = 256, C: float = 1.0,
    weighted: bool = True, seed: int = 30,
) -> Pipeline:
    """Radial kernel by random Fourier features, then a linear SVM on all rows."""
    lift = RandomFourierFeatures(
        gamma=gamma or 1.0 / n_features, components=components, dimension=n_features, seed=seed,
        inputCol="features", outputCol="lifted",
    )
    return Pipeline(stages=[lift, linear_svm(n_rows, C, weighted).setFeaturesCol("lifted")])


def standardised(model: Estimator) -> Pipeline:
    """Zero mean, unit variance, then ``model``."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    return Pipeline(stages=[scaler, model.copy().setFeaturesCol("scaled")])


def binary_slots(df: DataFrame, column: str = "features") -> list[bool]:
    """Which slots of a vector column run exactly from 0 to 1: one pass over the vectors."""
    stats = df.select(
        Summarizer.metrics("min", "max").summary(F.col(column)).alias("s")
    ).select("s.min", "s.max").first()
    return [bool(lo == 0 and hi == 1) for lo, hi in zip(stats[0].toArray(), stats[1].toArray())]


def slots(indices: Sequence[int], output: str) -> VectorSlicer:
    return VectorSlicer(inputCol="features", outputCol=output, indices=list(indices))


def naive_bayes(kind: str, indices: Sequence[int] | None = None) -> Pipeline:
    """Gaussian or Bernoulli naive Bayes on all slots or the given ones."""
    part = f"{kind}_slots"
    model = NaiveBayes(modelType=kind, featuresCol=part if indices is not None else "features")
    stages = [slots(indices, part)] if indices is not None else []
    return Pipeline(stages=[*stages, model])


def with_score(scored: DataFrame, name: str = "score", of_class: int = 1) -> DataFrame:
    """Adds the probability of a class as a plain column; margin models give their margin."""
    if "probability" in scored.columns:
        return scored.withColumn(name, F.get(vector_to_array("probability"), F.lit(of_class)))
    return scored.withColumn(name, F.get(vector_to_array("rawPrediction"), F.lit(of_class)))


def model_scores(model: Model, df: DataFrame, keep: Sequence[str] = ("label",), name: str = "score") -> DataFrame:
    return with_score(model.transform(df), name).select(*keep, name)


def long_scores(model: Model, name: str, train: DataFrame, holdout: DataFrame) -> DataFrame:
    """``model, split, label, score`` rows of both parts."""
    parts = [("train", train), ("holdout", holdout)]
    frames = [
        model_scores(model, df).select(F.lit(name).alias("model"), F.lit(part).alias("split"), "label", "score")
        for part, df in parts
    ]
    return frames[0].unionByName(frames[1])


def predicted_counts(scored: DataFrame) -> DataFrame:
    """Rows and share per predicted class."""
    counts = scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("share", F.col("count") / counts.agg(F.sum("count")).scalar())


@dataclass
class Stack:
    """Two fitted models and a logistic regression over their probabilities."""

    first: PipelineModel
    second: PipelineModel
    blend: Model
    classes: tuple[int, int] = field(default=(1, 0))

    def features(self, df: DataFrame) -> DataFrame:
        drop = ("probability", "rawPrediction", "prediction")
        one = with_score(self.first.transform(df), "p1", self.classes[0]).drop(*drop)
        two = with_score(self.second.transform(one), "p2", self.classes[1]).drop(*drop)
        return VectorAssembler(inputCols=["p1", "p2"], outputCol="stacked").transform(two)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.blend.transform(self.features(df))


def fit_stack(train: DataFrame, first: Estimator, second: Estimator, n_rows: int) -> Stack:
    """Both probabilities are columns of one frame, so rows never have to be matched up."""
    stack = Stack(first.fit(train), second.fit(train), None)
    blend = logistic(n_rows).setFeaturesCol("stacked")
    stack.blend = blend.fit(stack.features(train).select("label", "stacked"))
    return stack


def stratified_folds(df: DataFrame, ids: Sequence[str], k: int = 5, seed: int = 30, label: str = "label") -> DataFrame:
    """``fold`` 0..k-1: rows of each class dealt out in hash order, sizes differ by one at most."""
    dealt = numbered(df, [label], F.xxhash64(*ids, F.lit(seed)), "_number")
    return dealt.withColumn("fold", F.pmod(F.col("_number"), F.lit(k)).cast("int")).drop("_number")


def cross_validated(
    estimator: Estimator, folded: DataFrame, grid: list | None = None, k: int = 5, parallelism: int = 3
) -> CrossValidatorModel:
    """AUC by fold; a grid of one setting gives a plain cross-validated score."""
    return CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid or [{}],
        evaluator=BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0),
        numFolds=k,
        foldCol="fold",
        parallelism=parallelism,
    ).fit(folded)


def logistic_grid(model: LogisticRegression, n_rows: int, settings: dict = LOGISTIC_GRID) -> list:
    return (
        ParamGridBuilder()
        .addGrid(model.regParam, [1.0 / (c * n_rows) for c in settings["C"]])
        .addGrid(model.elasticNetParam, [1.0 if p == "l1" else 0.0 for p in settings["penalty"]])
        .build()
    )


def forest_grid(model: RandomForestClassifier, settings: dict = FOREST_GRID) -> list:
    return (
        ParamGridBuilder()
        .addGrid(model.numTrees, settings["n_estimators"])
        .addGrid(model.maxDepth, [min(d or DEEPEST, DEEPEST) for d in settings["max_depth"]])
        .addGrid(model.featureSubsetStrategy, [str(f) for f in settings["max_features"]])
        .addGrid(model.minInstancesPerNode, [max(1, s // 2) for s in settings["min_samples_split"]])
        .build()
    )


def boosting_grid(model: GBTClassifier, settings: dict = BOOSTING_GRID) -> list:
    return (
        ParamGridBuilder()
        .addGrid(model.maxIter, settings["n_estimators"])
        .addGrid(model.stepSize, settings["learning_rate"])
        .addGrid(model.maxDepth, [min(d or DEEPEST, DEEPEST) for d in settings["max_depth"]])
        .build()
    )


def ranked_settings(result: CrossValidatorModel) -> list[tuple[float, dict]]:
    """Mean AUC and setting, best first."""
    pairs = zip(result.avgMetrics, result.getEstimatorParamMaps())
    return sorted(pairs, key=lambda pair: -pair[0])


def settings_table(spark, result: CrossValidatorModel) -> DataFrame:
    rows = [
        (i, ", ".join(sorted(f"{p.name}={v}" for p, v in setting.items())), float(score))
        for i, (score, setting) in enumerate(ranked_settings(result))
    ]
    return spark.createDataFrame(rows, "rank int, setting string, cv_auc double")


def refit_every(
    estimator: Estimator, result: CrossValidatorModel, train: DataFrame, holdout: DataFrame, step: int = 5
) -> DataFrame:
    """Long scores of every ``step``-th ranked setting, refitted on all training rows."""
    scored = None
    for position, (_, setting) in list(enumerate(ranked_settings(result)))[::step]:
        part = long_scores(estimator.copy(setting).fit(train), f"rank_{position}", train, holdout)
        scored = part if scored is None else scored.unionByName(part)
    return scored


def top_weights(spark, model: Model, names: Sequence[str], n: int = 20) -> DataFrame:
    """Largest coefficients by absolute value, or importances, with feature names."""
    if hasattr(model, "coefficients"):
        values = model.coefficients.toArray()
    else:
        values = model.featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(names, values)]
    table = spark.createDataFrame(rows, "feature string, weight double")
    return table.withColumn("magnitude", F.abs("weight")).orderBy(F.desc("magnitude"), "feature").limit(n)


def feature_vector(df: DataFrame, array: str, name: str = "features") -> DataFrame:
    """Array column as an ML vector."""
    return df.withColumn(name, array_to_vector(F.col(array).cast("array<double>")))
