"""Grids of tree ensembles in which settings that differ in size only share one fit.

Boosting grows its trees one after the other, so the first ``n`` trees of a long
fit are the fit of ``n`` rounds.  The trees of a forest are drawn alike and apart
from each other, so its first ``n`` trees are a forest of ``n``.  A fit of the
largest size therefore gives every smaller one, and its rows are read once to be
scored by all sizes.  Fits of different settings share nothing, so some run side
by side: a fit's jobs are many and short, and one alone leaves most cores idle.
A forest that may have more nodes than the driver should hold is grown by tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tidemark.operators import evaluate, grown
from tidemark.operators.models import with_score
from tidemark.session import checkpoint_root

SIZE = "n_estimators"
SCORES = "model string, split string, label double, score double"
# Fits at a time; the driver holds the trees of as many ensembles of at most ``grown.DRIVER_NODES`` nodes.
FITS = 4


def every_setting(grid: dict) -> list[dict]:
    """All combinations, the last name of the grid changing fastest."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def setting_name(setting: dict) -> str:
    return ", ".join(f"{name}={setting[name]}" for name in sorted(setting))


def first_trees(model: Model, n: int) -> Model:
    """The model made of the first ``n`` trees of a fitted ensemble."""
    fitted = model._java_obj
    trees = fitted.trees()
    if not 1 <= n <= len(trees):
        raise ValueError(f"no first {n} of {len(trees)} trees")
    context = SparkContext._active_spark_context
    jvm, new_array = context._jvm, context._gateway.new_array
    ensembles = jvm.org.apache.spark.ml
    boosted = isinstance(model, GBTClassificationModel)
    kind = (
        ensembles.regression.DecisionTreeRegressionModel
        if boosted
        else ensembles.classification.DecisionTreeClassificationModel
    )
    kept = new_array(kind, n)
    for i in range(n):
        kept[i] = trees[i]
    shape = (model.numFeatures, model.numClasses)
    if boosted:
        weights = new_array(jvm.double, n)
        for i, weight in enumerate(model.treeWeights[:n]):
            weights[i] = float(weight)
        fewer = ensembles.classification.GBTClassificationModel(f"{model.uid}_{n}", kept, weights, *shape)
    else:
        fewer = ensembles.classification.RandomForestClassificationModel(f"{model.uid}_{n}", kept, *shape)
    return type(model)(fewer).setFeaturesCol(model.getFeaturesCol())


def side_by_side(spark: SparkSession, task: Callable, items: Sequence, at_a_time: int = FITS) -> list:
    """``task`` of each item, in their order; their Spark jobs share the cluster."""
    if not items:
        return []
    with ThreadPool(min(at_a_time, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(task), items, chunksize=1)


def written_scores(
    fits: Sequence[tuple[Estimator, dict[int, str]]], train: DataFrame, holdout: DataFrame
) -> DataFrame:
    """``model, split, label, score`` on both parts of each estimator, cut to the given sizes under the given names.

    The rows are scored by all sizes of a fit in one pass and written to the shared folder, so
    no plan grows with the fits and a lost executor costs none.
    """
    spark = train.sparkSession
    root = f"{checkpoint_root(spark)}/staged-scores-{uuid.uuid4().hex}"
    both = train.select("label", "features", F.lit("train").alias("split")).unionByName(
        holdout.select("label", "features", F.lit("holdout").alias("split"))
    )
    in_tasks = grown.prepared([estimator for estimator, _ in fits], train, both)

    def by_spark(estimator: Estimator, sizes: Iterable[int]) -> DataFrame:
        fitted, scored = estimator.fit(train), both
        for n in sizes:
            model = first_trees(fitted, n)
            scored = with_score(model.transform(scored), f"_{n}").drop("rawPrediction", "probability", "prediction")
        return scored

    def fit_and_score(number: int) -> str:
        estimator, names = fits[number]
        scored = in_tasks[number](list(names)) if number in in_tasks else by_spark(estimator, names)
        named = [F.struct(F.lit(name).alias("model"), F.col(f"_{n}").alias("score")) for n, name in names.items()]
        long = scored.select("split", F.col("label").cast("double"), F.inline(F.array(*named)))
        path = f"{root}/{number}"
        long.select("model", "split", "label", "score").write.parquet(path)
        return path

    return spark.read.schema(SCORES).parquet(*side_by_side(spark, fit_and_score, range(len(fits))))


def staged_scores(build: Callable[..., Estimator], grid: dict, train: DataFrame, holdout: DataFrame) -> DataFrame:
    """``model, split, label, score`` of every setting of the grid on both parts.

    For each setting apart from the size there is one fit, of the largest size.
    An empty ``holdout`` gives training rows only.
    """
    settings = every_setting({name: values for name, values in grid.items() if name != SIZE})
    fits = [
        (build(**{SIZE: max(grid[SIZE])}, **setting), {n: setting_name({SIZE: n, **setting}) for n in grid[SIZE]})
        for setting in settings
    ]
    return written_scores(fits, train, holdout)


def ranked_grid(scores: DataFrame) -> DataFrame:
    """``rank, model, train_auc, holdout_auc``, best on the holdout first; ties by name.

    The window runs over one row per setting.
    """
    areas = evaluate.auc(scores, ["model", "split"]).groupBy("model").agg(
        F.max(F.when(F.col("split") == "train", F.col("auc"))).alias("train_auc"),
        F.max(F.when(F.col("split") == "holdout", F.col("auc"))).alias("holdout_auc"),
    )
    order = Window.orderBy(F.desc_nulls_last("holdout_auc"), "model")
    return areas.select((F.row_number().over(order) - 1).alias("rank"), "model", "train_auc", "holdout_auc")


def refitted(
    build: Callable[..., Estimator], grid: dict, ranked: DataFrame, train: DataFrame, holdout: DataFrame, step: int = 5
) -> DataFrame:
    """Long scores of every ``step``-th ranked setting, each fitted by itself on ``train``."""
    named = {setting_name(setting): setting for setting in every_setting(grid)}
    chosen = ranked.filter(F.col("rank") % step == 0).orderBy("rank").select("model").collect()

    fits = [(build(**named[r["model"]]), {named[r["model"]][SIZE]: r["model"]}) for r in chosen]
    return written_scores(fits, train, holdout)
