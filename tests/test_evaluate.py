from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tidemark.operators import cumulate, evaluate
from tidemark.plans import explore


def scored(spark, seed=1, n=400, places=2):
    rng = random.Random(seed)
    data = [(int(rng.random() < 0.3), round(rng.random(), places)) for _ in range(n)]
    return data, spark.createDataFrame(data, "label int, score double")


def pairwise_auc(data):
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("places", [1, 2, 9])
def test_auc_equals_pairwise_wins_and_the_spark_metric(spark, places):
    data, df = scored(spark, places=places)
    value = evaluate.auc(df).first()["auc"]
    assert value == pytest.approx(pairwise_auc(data))
    metric = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert value == pytest.approx(metric.evaluate(df.withColumn("label", F.col("label").cast("double"))))


def test_auc_per_group_and_with_one_class(spark):
    data, df = scored(spark)
    single = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double")
    both = df.withColumn("model", F.lit("m")).unionByName(single.withColumn("model", F.lit("one")))
    got = dict(rows(evaluate.auc(both, ["model"])))
    assert got["one"] is None and got["m"] == pytest.approx(pairwise_auc(data))


def test_auc_when_a_third_of_the_scores_are_tied(spark):
    data, _ = scored(spark)
    data = [(y, 0.42 if i % 3 == 0 else s) for i, (y, s) in enumerate(data)]
    df = spark.createDataFrame(data, "label int, score double")
    assert evaluate.auc(df).first()["auc"] == pytest.approx(pairwise_auc(data))


def test_auc_of_a_hard_prediction(spark):
    data, df = scored(spark)
    hard = [(y, float(s > 0.3)) for y, s in data]
    assert evaluate.auc_at_cutoff(df, 0.3).first()["auc"] == pytest.approx(pairwise_auc(hard))


def test_roc_curve(spark):
    data, df = scored(spark, places=1)
    p, n = sum(y for y, _ in data), sum(1 - y for y, _ in data)
    for threshold, fpr, tpr in rows(evaluate.roc_curve(df)):
        assert tpr == pytest.approx(sum(y for y, s in data if s >= threshold) / p)
        assert fpr == pytest.approx(sum(1 - y for y, s in data if s >= threshold) / n)
    swapped = dict((r[0], r[1:]) for r in rows(evaluate.roc_curve(df, pos_label=0)))
    assert all(swapped[t] == (tpr, fpr) for t, fpr, tpr in rows(evaluate.roc_curve(df)))


def cells_of(data, cutoff):
    c = {"tn": 0, "fp": 0, "fn": 0, "tp": 0}
    for y, s in data:
        c[("t" if bool(y) == (s > cutoff) else "f") + ("p" if s > cutoff else "n")] += 1
    return c


def test_confusion_is_strict_at_the_cutoff(spark):
    data, df = scored(spark, places=1)
    row = evaluate.loss(evaluate.confusion(df, 0.3)).first()
    want = cells_of(data, 0.3)
    assert {k: row[k] for k in want} == want
    assert row["accuracy"] == pytest.approx((want["tn"] + want["tp"]) / len(data))
    assert row["precision"] == pytest.approx(want["tp"] / (want["tp"] + want["fp"]))
    assert row["recall"] == pytest.approx(want["tp"] / (want["tp"] + want["fn"]))
    assert row["loss"] == 15 * want["fn"] + want["fp"]
    matrix = evaluate.loss_matrix_total(evaluate.confusion(df, 0.3), [[0, 1], [10, 0]]).first()
    assert matrix["loss"] == 10 * want["fn"] + want["fp"]
    none = evaluate.confusion(df, 2.0).first()
    assert none["precision"] is None and none["recall"] == 0


def test_prior_cutoff(spark):
    data, df = scored(spark)
    share = sum(y for y, _ in data) / len(data)
    row = evaluate.confusion(df, evaluate.prior_cutoff(df)).first()
    assert {k: row[k] for k in ("tn", "fp", "fn", "tp")} == cells_of(data, share)


@pytest.mark.parametrize("points", [21, 101, 201])
def test_sweep_equals_one_pass_per_point(spark, points):
    data, df = scored(spark, places=2)
    data = data + [(1, 0.0), (0, 1.0), (1, 1.2), (0, -0.5)]
    df = spark.createDataFrame(data, "label int, score double")
    got = evaluate.threshold_sweep(df, points).orderBy("cutoff").collect()
    for row, cutoff in zip(got, np.linspace(0, 1, points), strict=True):
        want = cells_of(data, cutoff)
        assert row["cutoff"] == cutoff
        assert {k: row[k] for k in want} == want
        assert row["loss"] == 15 * want["fn"] + want["fp"]


def test_rows_without_a_score_or_a_label_take_no_part(spark):
    full = [(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.6)]
    holes = full + [(0, None), (1, None), (None, 0.95)]
    a, b = (spark.createDataFrame(d, "label int, score double") for d in (full, holes))
    for run in (evaluate.auc, evaluate.roc_curve, evaluate.threshold_sweep, evaluate.best_cutoff, lambda d: evaluate.confusion(d, 0.5)):
        assert sorted(map(tuple, run(a).collect())) == sorted(map(tuple, run(b).collect()))
    assert evaluate.halving_cutoff(a) == evaluate.halving_cutoff(b)


def test_margins_need_their_span(spark):
    df = spark.createDataFrame([(1, 0.5), (1, -1.0), (0, -1.5), (0, -3.0)], "label int, score double")
    best = evaluate.best_cutoff(df, span=(-4.0, 4.0)).first()
    assert best["loss"] == 0 and -1.5 <= best["cutoff"] < -1.0
    with pytest.raises(Exception, match="outside"):
        evaluate.best_cutoff(df).collect()
    with pytest.raises(Exception, match="outside"):
        evaluate.halving_cutoff(df)


def walk(data, penalty):
    """Halving with a full pass per step."""
    def cost(cutoff):
        c = cells_of(data, cutoff)
        return (penalty * c["fn"] + c["fp"]) / len(data)

    low, high = 0.0, 1.0
    while high - low >= evaluate.HALVING_TOLERANCE:
        step, middle = (high - low) / 50, (low + high) / 2
        low, high = (middle, high) if cost(middle) > cost(middle + step) else (low, middle)
    return low, cost(low)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("penalty", [15, 3])
def test_halving_equals_a_pass_per_step(spark, seed, penalty):
    data, df = scored(spark, seed, n=200, places=3)
    cutoff, loss = evaluate.halving_cutoff(df, penalty)
    want = walk(data, penalty)
    assert (cutoff, loss) == (want[0], pytest.approx(want[1]))
    best = evaluate.best_cutoff(df, fn_penalty=penalty).first()
    assert best["loss_per_row"] <= loss + 1e-12


def test_best_cutoff_of_train_applied_to_holdout(spark):
    train, train_df = scored(spark, 5)
    held, held_df = scored(spark, 6)
    row = evaluate.apply_cutoff(train_df, held_df).first()
    for data, name in ((train, "train_loss"), (held, "holdout_loss")):
        c = cells_of(data, row["cutoff"])
        assert row[name] == pytest.approx((15 * c["fn"] + c["fp"]) / len(data))


def test_compare_models_orders_by_holdout(spark):
    frames = []
    for model, seed in (("a", 1), ("b", 2)):
        for split, extra in (("train", 0), ("holdout", 10)):
            data, _ = scored(spark, seed + extra)
            data = [(y, min(1.0, s + 0.4 * y * (model == "b"))) for y, s in data]
            df = spark.createDataFrame(data, "label int, score double")
            frames.append(df.select(F.lit(model).alias("model"), F.lit(split).alias("split"), "label", "score"))
    long = frames[0]
    for f in frames[1:]:
        long = long.unionByName(f)
    table = evaluate.compare_models(long).collect()
    assert [r["model"] for r in table] == ["b", "a"]
    assert table[0]["holdout_auc"] > table[1]["holdout_auc"]
    melted = evaluate.melt(evaluate.compare_models(long), ["model"], ["train_auc", "holdout_auc"], "test", "auc")
    assert melted.count() == 4


def test_calibration_bins(spark):
    data, df = scored(spark)
    table = evaluate.calibration(df, 10).collect()
    assert sum(r["n"] for r in table) == len(data)
    assert sum(r["n"] * r["truth"] for r in table) == pytest.approx(sum(y for y, _ in data))


def test_running_totals_over_many_ranges(spark):
    rng = random.Random(9)
    values = sorted({rng.random() for _ in range(500)})
    df = spark.createDataFrame([(g, v, 1) for g in ("x", None) for v in values], "g string, v double, n int").repartition(7)
    edges = cumulate.range_edges(df, "v", 16)
    assert len(edges) > 8
    got = {(r["g"], r["v"]): r["cum_n"] for r in cumulate.running_totals(df, "v", ["n"], edges, ["g"]).collect()}
    assert all(got[(g, v)] == i + 1 for g in ("x", None) for i, v in enumerate(values))


def test_quantiles_are_exact(spark):
    rng = random.Random(4)
    values = [round(rng.gauss(0, 1), 1) for _ in range(301)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 2.0), ("b", None)], "g string, v double")
    got = {(g, p): q for g, p, q in rows(cumulate.quantiles(df, "v", [0.25, 0.5, 1.0], ["g"]))}
    ordered = sorted(values)
    for p in (0.25, 0.5, 1.0):
        assert got[("a", p)] == ordered[int(np.ceil(p * len(values))) - 1]
        assert got[("b", p)] == 2.0
    assert rows(cumulate.quantiles(df.filter("g = 'b'"), "v", [0.5])) == [(0.5, 2.0)]


def test_numbers_are_dense_per_group(spark):
    df = spark.range(500).withColumn("g", F.when(F.col("id") % 3 == 0, "x").otherwise("y"))
    numbered = cumulate.numbered(df, ["g"], F.xxhash64("id"), ranges=8)
    for g, n in (("x", 167), ("y", 333)):
        got = sorted(r["number"] for r in numbered.filter(F.col("g") == g).collect())
        assert got == list(range(n))


def test_ranges_weigh_distinct_values(spark):
    """With 95 % of the rows on one score, no range holds over twice its share of the scores."""
    df = spark.range(40_000).select(
        F.when(F.col("id") % 20 == 0, F.col("id") / 40_000).otherwise(F.lit(0.5)).alias("score")
    )
    edges = cumulate.range_edges(df, "score", 32)
    sizes = cumulate.with_range(df.distinct(), "score", edges).groupBy("_range").count()
    held = [r["count"] for r in sizes.collect()]
    assert len(held) == 32 and max(held) <= 2 * sum(held) / 32


def test_ranges_of_odd_values(spark):
    schema = "score double"
    assert cumulate.range_edges(spark.createDataFrame([], schema), "score", 8) == []
    odd = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (-float("inf"),), (1.0,)], schema)
    assert cumulate.range_edges(odd, "score", 8) in ([], [1.0])
    counts = {r["score"]: r["cum_n"] for r in cumulate.running_totals(
        odd.filter("score = 1.0 OR abs(score) = double('Infinity')").withColumn("n", F.lit(1)), "score", ["n"],
        cumulate.range_edges(odd, "score", 8)).collect()}
    assert counts == {-float("inf"): 1, 1.0: 2, float("inf"): 3}


def test_shares_read_their_source_once(spark, tmp_path):
    path = str(tmp_path / "levels")
    spark.range(1000).selectExpr("cast(id % 7 as string) AS level").write.parquet(path)
    shares = explore.value_counts(spark.read.parquet(path), "level", share=True)
    assert sum(r["share"] for r in shares.collect()) == pytest.approx(1.0)
    plan = shares._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1
