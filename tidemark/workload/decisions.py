"""Evaluation and cut-off queries on line items: label = returned, two simple scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import cumulate, evaluate
from tidemark.plans import explore
from tidemark.workload.market import Market
from tidemark.workload.registry import Registry, rounded

REGISTRY = Registry()
MODELS = ("price", "discount")

SCORED = """
returned AS (
  SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
         CASE WHEN l_shipdate >= TIMESTAMP '2001-01-01' THEN 'holdout' ELSE 'train' END AS split,
         l_extendedprice / 110000 AS price, l_discount * 10 AS discount FROM lineitem),
scored AS (
  SELECT 'price' AS model, split, label, price AS score FROM returned
  UNION ALL SELECT 'discount' AS model, split, label, discount AS score FROM returned)
"""


def with_scores(select: str) -> str:
    select = select.strip()
    if select.startswith("WITH "):
        return f"WITH {SCORED.strip()},\n{select[5:]}"
    return f"WITH {SCORED.strip()}\n{select}"


def scored(m: Market) -> DataFrame:
    models = F.array(
        F.struct(F.lit("price").alias("model"), (F.col("l_extendedprice") / 110000).alias("score")),
        F.struct(F.lit("discount").alias("model"), (F.col("l_discount") * 10).alias("score")),
    )
    return (
        m.table("lineitem")
        .select(
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
            F.when(F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz"), F.lit("holdout"))
            .otherwise(F.lit("train"))
            .alias("split"),
            F.explode(models).alias("m"),
        )
        .select("m.model", "split", "label", "m.score")
    )


def one_model(m: Market, name: str) -> DataFrame:
    return scored(m).filter(F.col("model") == name).select("split", "label", "score")


AUC = """
ranked AS (
  SELECT model, split, label, score,
         rank() OVER (PARTITION BY model, split ORDER BY score)
         + (count(*) OVER (PARTITION BY model, split, score) - 1) / 2.0::DOUBLE AS r FROM scored),
areas AS (
  SELECT model, split,
         (sum(CASE WHEN label = 1 THEN r ELSE 0 END)
          - sum(label) * (sum(label) + 1) / 2.0::DOUBLE)
         / (CAST(sum(label) AS DOUBLE) * sum(1 - label)) AS auc
  FROM ranked GROUP BY model, split)
"""


@REGISTRY.add(with_scores(f"WITH {AUC} SELECT model, split, round(auc, 6) AS auc FROM areas"))
def auc_by_model(m: Market) -> DataFrame:
    return rounded(evaluate.auc(scored(m), ["model", "split"]), "auc")


@REGISTRY.add(with_scores("""
WITH hard AS (SELECT model, label, CASE WHEN score > 0.3::DOUBLE THEN 1 ELSE 0 END AS g FROM scored),
c AS (SELECT model, sum(label * g)::DOUBLE AS tp, sum(label * (1 - g))::DOUBLE AS fn,
             sum((1 - label) * g)::DOUBLE AS fp, sum((1 - label) * (1 - g))::DOUBLE AS tn FROM hard GROUP BY model)
SELECT model, round((tp * (tn + fp / 2) + fn * tn / 2) / ((tp + fn) * (fp + tn)), 6) AS auc FROM c"""))
def auc_of_hard_prediction(m: Market) -> DataFrame:
    return rounded(evaluate.auc_at_cutoff(scored(m), 0.3, ["model"]), "auc")


@REGISTRY.add(with_scores("""
WITH s AS (SELECT label, score FROM scored WHERE model = 'price'),
c AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM s GROUP BY score),
t AS (SELECT sum(p) AS tp, sum(n) AS tn FROM c)
SELECT score AS threshold, CAST(sum(n) OVER (ORDER BY score DESC) AS DOUBLE) / tn AS fpr,
       CAST(sum(p) OVER (ORDER BY score DESC) AS DOUBLE) / tp AS tpr FROM c, t"""))
def roc_points(m: Market) -> DataFrame:
    return evaluate.roc_curve(one_model(m, "price"))


@REGISTRY.add(with_scores("""
WITH c AS (SELECT model, score, sum(label) AS p, sum(1 - label) AS n FROM scored WHERE model = 'discount'
           GROUP BY model, score),
t AS (SELECT model, sum(p) AS tp, sum(n) AS tn FROM c GROUP BY model)
SELECT model, score AS threshold, CAST(sum(p) OVER (PARTITION BY model ORDER BY score DESC) AS DOUBLE) / tp AS fpr,
       CAST(sum(n) OVER (PARTITION BY model ORDER BY score DESC) AS DOUBLE) / tn AS tpr FROM c JOIN t USING (model)"""))
def roc_points_of_class_zero(m: Market) -> DataFrame:
    rows = scored(m).filter(F.col("model") == "discount")
    return evaluate.roc_curve(rows, ["model"], pos_label=0)


CELLS = """
CAST(sum(CASE WHEN NOT g AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
CAST(sum(CASE WHEN g AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
CAST(sum(CASE WHEN NOT g AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
CAST(sum(CASE WHEN g AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp"""
RATIOS = """(tp + tn) / (tp + tn + fp + fn) AS accuracy,
CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall"""


@REGISTRY.add(with_scores(f"""
WITH h AS (SELECT model, split, label, score > 0.5::DOUBLE AS g FROM scored),
c AS (SELECT model, split, {CELLS} FROM h GROUP BY model, split)
SELECT *, {RATIOS}, CAST(15 * fn + fp AS DOUBLE) AS loss, (15 * fn + fp) / (tn + fp + fn + tp) AS loss_per_row FROM c"""))
def confusion_and_loss(m: Market) -> DataFrame:
    return evaluate.loss(evaluate.confusion(scored(m), 0.5, ["model", "split"]))


@REGISTRY.add(with_scores(f"""
WITH h AS (SELECT model, label, score > (SELECT avg(label) FROM scored) AS g FROM scored),
c AS (SELECT model, {CELLS} FROM h GROUP BY model),
r AS (SELECT *, {RATIOS}, tn + fp + fn + tp AS n FROM c)
SELECT model, tn / n AS tn, fp / n AS fp, fn / n AS fn, tp / n AS tp, accuracy, precision, recall FROM r"""))
def confusion_at_prior(m: Market) -> DataFrame:
    """Shares of the confusion cells when the cut-off is the share of positives."""
    rows = scored(m)
    return evaluate.normalised(evaluate.confusion(rows, evaluate.prior_cutoff(rows), ["model"]))


@REGISTRY.add(with_scores(f"""
WITH h AS (SELECT model, label, score > 0.1::DOUBLE AS g FROM scored),
c AS (SELECT model, {CELLS} FROM h GROUP BY model)
SELECT *, {RATIOS}, CAST(10 * fn + fp AS DOUBLE) AS loss FROM c"""))
def loss_from_matrix(m: Market) -> DataFrame:
    cells = evaluate.confusion(scored(m), 0.1, ["model"])
    return evaluate.loss_matrix_total(cells, [[0, 1], [10, 0]])


def sweep_sql(points: int, where: str = "TRUE") -> str:
    last = points - 1
    return f"""
grid AS (SELECT i, CASE WHEN i = {last} THEN 1.0::DOUBLE ELSE i * (1.0::DOUBLE / {last}) END AS cutoff FROM range({points}) x(i)),
counts AS (SELECT model, score, sum(label) AS p, sum(1 - label) AS n FROM scored WHERE {where} GROUP BY model, score),
cells AS (
  SELECT model, cutoff,
         CAST(sum(CASE WHEN score > cutoff THEN 0 ELSE n END) AS BIGINT) AS tn,
         CAST(sum(CASE WHEN score > cutoff THEN n ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN score > cutoff THEN 0 ELSE p END) AS BIGINT) AS fn,
         CAST(sum(CASE WHEN score > cutoff THEN p ELSE 0 END) AS BIGINT) AS tp
  FROM counts, grid GROUP BY model, cutoff),
sweep AS (SELECT *, CAST(15 * fn + fp AS DOUBLE) AS loss, (15 * fn + fp) / (tn + fp + fn + tp) AS loss_per_row FROM cells)
"""


@REGISTRY.add(with_scores(f"WITH {sweep_sql(101)} SELECT * FROM sweep"))
def threshold_sweep(m: Market) -> DataFrame:
    return evaluate.threshold_sweep(scored(m), 101, ["model"])


@REGISTRY.add(with_scores(f"""
WITH {sweep_sql(2001, "model = 'discount'")}
SELECT model, cutoff, loss, loss_per_row FROM sweep ORDER BY loss, cutoff LIMIT 1"""))
def best_cutoff(m: Market) -> DataFrame:
    return evaluate.best_cutoff(scored(m).filter(F.col("model") == "discount"), ["model"])


@REGISTRY.add()
def halving_cutoff(m: Market) -> DataFrame:
    """Cut-off of each model by repeated halving; checked against a step-by-step search in the tests."""
    found = {name: evaluate.halving_cutoff(one_model(m, name)) for name in MODELS}
    total = m.table("lineitem").agg(F.count(F.lit(1)).alias("n_rows"))
    rows = [F.struct(F.lit(k).alias("model"), F.lit(c).alias("cutoff"), F.lit(v).alias("loss_per_row")) for k, (c, v) in found.items()]
    return total.select("n_rows", F.explode(F.array(*rows)).alias("m")).select("n_rows", "m.*")


@REGISTRY.add(with_scores("""
WITH b AS (SELECT min(score) AS lo, max(score) AS hi FROM scored),
k AS (SELECT model, label, score, lo, (hi - lo) / 10.0::DOUBLE AS step, CAST(ceil((score - lo) / ((hi - lo) / 10.0::DOUBLE)) AS BIGINT) AS g
      FROM scored, b),
f AS (SELECT model, label, CASE WHEN score > g * step + lo THEN g + 1 WHEN score <= (g - 1) * step + lo THEN g - 1 ELSE g END AS s FROM k)
SELECT model, CAST(least(greatest(s, 1), 10) AS INTEGER) AS bin, count(*) AS n, avg(label) AS truth FROM f GROUP BY 1, 2"""))
def calibration(m: Market) -> DataFrame:
    return evaluate.calibration(scored(m), 10, ["model"])


@REGISTRY.add(with_scores(f"""
WITH {AUC}, {sweep_sql(2001, "split = 'train' AND model = 'discount'")},
picked AS (SELECT model, cutoff, loss_per_row AS train_loss FROM sweep ORDER BY loss, cutoff LIMIT 1),
held AS (SELECT s.model, p.cutoff, p.train_loss,
                sum(CASE WHEN s.label = 1 AND NOT s.score > p.cutoff THEN 15 WHEN s.label = 0 AND s.score > p.cutoff THEN 1 ELSE 0 END)
                / count(*) AS holdout_loss
         FROM scored s JOIN picked p USING (model) WHERE split = 'holdout' GROUP BY ALL)
SELECT h.model, round(t.auc, 6) AS train_auc, round(o.auc, 6) AS holdout_auc, h.cutoff, h.train_loss, h.holdout_loss
FROM held h JOIN areas t ON t.model = h.model AND t.split = 'train'
JOIN areas o ON o.model = h.model AND o.split = 'holdout'"""))
def model_comparison(m: Market) -> DataFrame:
    table = evaluate.compare_models(scored(m).filter(F.col("model") == "discount"))
    return rounded(table, "train_auc", "holdout_auc")


# The same over all models; the queries above take one each.
@REGISTRY.add(with_scores("""
WITH c AS (SELECT model, score, sum(label) AS p, sum(1 - label) AS n FROM scored GROUP BY model, score),
t AS (SELECT model, sum(p) AS tp, sum(n) AS tn FROM c GROUP BY model)
SELECT model, score AS threshold, CAST(sum(n) OVER (PARTITION BY model ORDER BY score DESC) AS DOUBLE) / tn AS fpr,
       CAST(sum(p) OVER (PARTITION BY model ORDER BY score DESC) AS DOUBLE) / tp AS tpr FROM c JOIN t USING (model)"""))
def roc_points_by_model(m: Market) -> DataFrame:
    return evaluate.roc_curve(scored(m), ["model"])


@REGISTRY.add(with_scores("""
WITH c AS (SELECT model, score, sum(label) AS p, sum(1 - label) AS n FROM scored GROUP BY model, score),
t AS (SELECT model, sum(p) AS tp, sum(n) AS tn FROM c GROUP BY model)
SELECT model, score AS threshold, CAST(sum(p) OVER (PARTITION BY model ORDER BY score DESC) AS DOUBLE) / tp AS fpr,
       CAST(sum(n) OVER (PARTITION BY model ORDER BY score DESC) AS DOUBLE) / tn AS tpr FROM c JOIN t USING (model)"""))
def roc_points_of_class_zero_by_model(m: Market) -> DataFrame:
    return evaluate.roc_curve(scored(m), ["model"], pos_label=0)


def best_sql(where: str = "TRUE") -> str:
    """The best of 2,001 cut-offs of each model, from running counts: no crossing of scores and grid."""
    return f"""
counts AS (SELECT model, score, sum(label) AS p, sum(1 - label) AS n FROM scored WHERE {where} GROUP BY model, score),
below AS (SELECT model, score, sum(p) OVER (PARTITION BY model ORDER BY score) AS fn,
                 sum(n) OVER (PARTITION BY model ORDER BY score) AS tn FROM counts),
totals AS (SELECT model, sum(p) AS p, sum(n) AS n FROM counts GROUP BY model),
grid AS (SELECT model, p, n, CASE WHEN i = 2000 THEN 1.0::DOUBLE ELSE i * (1.0::DOUBLE / 2000) END AS cutoff
         FROM totals, range(2001) x(i)),
losses AS (SELECT g.model, cutoff, p + n AS total, CAST(15 * coalesce(fn, 0) + n - coalesce(tn, 0) AS DOUBLE) AS loss
           FROM grid g ASOF LEFT JOIN below b ON g.model = b.model AND g.cutoff >= b.score),
best AS (SELECT model, cutoff, loss, loss / total AS loss_per_row FROM losses
         QUALIFY row_number() OVER (PARTITION BY model ORDER BY loss, cutoff) = 1)
"""


@REGISTRY.add(with_scores(f"WITH {best_sql()} SELECT * FROM best"))
def best_cutoff_by_model(m: Market) -> DataFrame:
    return evaluate.best_cutoff(scored(m), ["model"])


@REGISTRY.add(with_scores(f"""
WITH {AUC}, {best_sql("split = 'train'")},
held AS (SELECT s.model, p.cutoff, p.loss_per_row AS train_loss,
                sum(CASE WHEN s.label = 1 AND NOT s.score > p.cutoff THEN 15 WHEN s.label = 0 AND s.score > p.cutoff THEN 1 ELSE 0 END)
                / count(*) AS holdout_loss
         FROM scored s JOIN best p USING (model) WHERE split = 'holdout' GROUP BY ALL)
SELECT h.model, round(t.auc, 6) AS train_auc, round(o.auc, 6) AS holdout_auc, h.cutoff, h.train_loss, h.holdout_loss
FROM held h JOIN areas t ON t.model = h.model AND t.split = 'train'
JOIN areas o ON o.model = h.model AND o.split = 'holdout'"""))
def comparison_of_all_models(m: Market) -> DataFrame:
    return rounded(evaluate.compare_models(scored(m)), "train_auc", "holdout_auc")


@REGISTRY.add(with_scores("""
WITH p AS (SELECT model, avg(CASE WHEN split = 'train' THEN score END) AS train,
                  avg(CASE WHEN split = 'holdout' THEN score END) AS holdout FROM scored GROUP BY model)
SELECT model, 'train' AS part, round(train, 6) AS mean_score FROM p UNION ALL SELECT model, 'holdout', round(holdout, 6) FROM p"""))
def melted_scores(m: Market) -> DataFrame:
    """Mean score per model and part, turned from wide to long."""
    wide = scored(m).groupBy("model").agg(
        F.avg(F.when(F.col("split") == "train", F.col("score"))).alias("train"),
        F.avg(F.when(F.col("split") == "holdout", F.col("score"))).alias("holdout"),
    )
    return rounded(evaluate.melt(wide, ["model"], ["train", "holdout"], "part", "mean_score"), "mean_score")


@REGISTRY.add("""
SELECT CAST(sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_0,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_1,
       avg(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS share_0,
       avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS share_1 FROM lineitem""")
def class_balance(m: Market) -> DataFrame:
    return explore.class_balance(one_model(m, "price"))


@REGISTRY.add("""
WITH q AS (
  SELECT l_returnflag, quantile_disc(l_extendedprice, [0.25, 0.5, 0.75]) AS v FROM lineitem GROUP BY 1)
SELECT l_returnflag, 0.25::DOUBLE AS probability, v[1] AS quantile FROM q
UNION ALL SELECT l_returnflag, 0.5::DOUBLE, v[2] FROM q UNION ALL SELECT l_returnflag, 0.75::DOUBLE, v[3] FROM q""")
def price_quartiles(m: Market) -> DataFrame:
    """Spread of prices per return flag: exact quartiles."""
    return cumulate.quantiles(m.table("lineitem"), "l_extendedprice", [0.25, 0.5, 0.75], ["l_returnflag"])


@REGISTRY.add("""
WITH n AS (SELECT l_returnflag AS label, (row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey) - 1) % 5 AS fold
           FROM lineitem)
SELECT label, CAST(fold AS INTEGER) AS fold, count(*) AS n FROM n GROUP BY 1, 2""")
def stratified_fold_sizes(m: Market) -> DataFrame:
    from tidemark.operators.models import stratified_folds

    rows = m.table("lineitem").withColumnRenamed("l_returnflag", "label")
    folds = stratified_folds(rows, ["l_orderkey", "l_linenumber", "l_partkey"], 5, seed=30)
    return folds.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))
