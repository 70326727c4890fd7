"""Encodings, feature matrices and fitted models over the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import discriminant, evaluate, gramian, models, staged
from tidemark.plans import features
from tidemark.session import stage_table
from tidemark.workload.catalog import MAIN, main
from tidemark.workload.market import Market, with_market
from tidemark.workload.registry import Registry, rounded

REGISTRY = Registry()
SUPPLIERS = [str(i) for i in range(1, 9)]


@REGISTRY.add(with_market(f"""
WITH counted AS (SELECT *, count(performer_id) OVER (PARTITION BY performer_id) AS perf_events,
                        count(event_id) OVER (PARTITION BY event_id) AS event_perf_count FROM performers),
leveled AS (SELECT event_id, event_perf_count, CASE WHEN perf_events < 500 THEN '0' ELSE CAST(performer_id AS VARCHAR) END AS level FROM counted)
SELECT event_id, event_perf_count, {', '.join(f"max(CASE WHEN level = '{s}' THEN 1 ELSE 0 END) AS performer_id_{s}" for s in SUPPLIERS)}
FROM leveled GROUP BY 1, 2"""))
def performer_columns(m: Market) -> DataFrame:
    """Wide multi-hot of given performers per event."""
    return features.performer_columns(m.performers, SUPPLIERS, 500)


@REGISTRY.add(with_market("""
WITH best AS (SELECT performer_id FROM performers GROUP BY 1 ORDER BY count(DISTINCT event_id) DESC, performer_id LIMIT 20),
counted AS (SELECT *, count(performer_id) OVER (PARTITION BY performer_id) AS perf_events,
                   count(event_id) OVER (PARTITION BY event_id) AS event_perf_count FROM performers),
leveled AS (SELECT event_id, event_perf_count, CASE WHEN perf_events < 10 OR performer_id NOT IN (SELECT performer_id FROM best)
                   THEN '0' ELSE CAST(performer_id AS VARCHAR) END AS level FROM counted)
SELECT event_id, event_perf_count, CAST(count(DISTINCT CASE WHEN level <> '0' THEN level END) AS BIGINT) AS n_set
FROM leveled GROUP BY 1, 2"""))
def performer_vector_sizes(m: Market) -> DataFrame:
    """Set slots per event of the multi-hot vector over the twenty most booked performers."""
    sets, slots = features.performer_multihot(m.performers, max_perf=20)
    vectors = features.multihot_vector(sets, "performer_levels", slots, "performer_vec")
    total = F.aggregate(vector_to_array("performer_vec"), F.lit(0.0), lambda a, x: a + x)
    return vectors.select("event_id", "event_perf_count", total.cast("long").alias("n_set"))


def level_sums(column: str, expression: str) -> str:
    return (
        f"SELECT '{column}_' || lv AS feature, CAST(count(*) AS DOUBLE) AS total "
        f"FROM (SELECT {expression} AS lv FROM main) WHERE lv > (SELECT min({expression}) FROM main) GROUP BY lv"
    )


CLEAN = "replace(replace(trim({0}), ' ', '_'), '/', '')"
NUMBERS = [
    "ticket_splits_option", "days_until_show", "event_parking", "quantity", "popularity", "totallistings", "full_listing",
]


@REGISTRY.add(with_market(f"""
WITH main AS ({MAIN}),
zones AS (SELECT zone_name FROM main GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3),
best AS (SELECT performer_id FROM performers GROUP BY 1 ORDER BY count(DISTINCT event_id) DESC, performer_id LIMIT 5),
hot AS (SELECT DISTINCT event_id, CASE WHEN performer_id IN (SELECT performer_id FROM best) THEN CAST(performer_id AS VARCHAR) ELSE '0' END AS lv
        FROM performers),
sizes AS (SELECT event_id, count(*) AS n FROM performers GROUP BY 1),
sums AS (
{' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST(sum(CAST({c} AS DOUBLE)) AS DOUBLE) AS total FROM main" for c in NUMBERS)}
UNION ALL SELECT 'event_perf_count', CAST(sum(COALESCE(n, 0)) AS DOUBLE) FROM main LEFT JOIN sizes USING (event_id)
UNION ALL SELECT 'performer_id_' || lv, CAST(sum(CASE WHEN m.event_id IS NULL THEN 0 ELSE 1 END) AS DOUBLE) FROM hot h LEFT JOIN main m USING (event_id)
  WHERE lv > '0' GROUP BY lv
UNION ALL {level_sums('dow_show', 'CAST(dow_show AS VARCHAR)')}
UNION ALL {level_sums('geos', CLEAN.format('geos'))}
UNION ALL {level_sums('category', CLEAN.format('category'))}
UNION ALL {level_sums('dirty_ticket_ind', "CASE WHEN dirty_ticket_ind = '' THEN 'False' ELSE dirty_ticket_ind END")}
UNION ALL {level_sums('zone_name_simp', "CASE WHEN zone_name <> '' AND zone_name IN (SELECT zone_name FROM zones) THEN zone_name ELSE '0' END")})
SELECT feature, round(total, 6) AS total FROM sums"""))
def feature_matrix_sums(m: Market) -> DataFrame:
    """Sum of every column of the feature matrix but the prices, over both parts of the split."""
    matrix = features.feature_matrix(
        main(m), m.performers, max_perf=5, venues=False, events=False, max_zones=3, zones_min_listings=0
    )
    both = matrix.train.unionByName(matrix.holdout)
    sums = both.select(Summarizer.metrics("sum").summary(F.col("features")).alias("s")).select(
        vector_to_array("s.sum").alias("total")
    )
    named = F.arrays_zip(F.array(*[F.lit(n) for n in matrix.names]).alias("feature"), F.col("total"))
    rows = sums.select(F.explode(named).alias("r")).select(F.col("r.feature").alias("feature"), "r.total")
    return rounded(rows.filter(~F.col("feature").isin("price_curr", "price_over_min", "minprice")), "total")


def parts(m: Market, **options) -> tuple[DataFrame, DataFrame, list[str]]:
    """Feature matrix of the marketplace with lumped venues, events and zones."""
    settings = {"max_perf": 20, "venues_min_events": 0, "events_min_listings": 0, "max_events": 10,
                "max_zones": 3, "zones_min_listings": 0, **options}
    matrix = features.feature_matrix(main(m), m.performers, **settings)
    return matrix.train, matrix.holdout, matrix.names


@REGISTRY.add()
def feature_matrix_rows(m: Market) -> DataFrame:
    """Rows and used slots of the full feature matrix per part."""
    train, holdout, names = parts(m)
    used = F.size(F.filter(vector_to_array("features"), lambda x: x != 0))
    both = train.withColumn("part", F.lit("train")).unionByName(holdout.withColumn("part", F.lit("holdout")))
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(used).alias("n_used"), F.lit(len(names)).alias("n_features")
    )


def vectors(m: Market) -> DataFrame:
    """Embeddings with the label ``label >= 5``."""
    rows = models.feature_vector(m.table("embeddings"), "embedding")
    return rows.select("vec_id", (F.col("label") >= 5).cast("double").alias("label"), "features")


def lines(m: Market, *columns: str) -> DataFrame:
    """Line items as vectors of the given columns with the label 'returned'."""
    rows = m.table("lineitem").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        F.array(*[F.col(c).cast("double") for c in columns]).alias("x"),
    )
    return models.feature_vector(rows, "x").select("label", "features")


@REGISTRY.add("""
SELECT l_orderkey, l_linenumber, round((l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER (), 6) AS quantity,
       round((l_discount - avg(l_discount) OVER ()) / stddev_samp(l_discount) OVER (), 6) AS discount FROM lineitem""")
def standardised_columns(m: Market) -> DataFrame:
    rows = m.table("lineitem").select("l_orderkey", "l_linenumber", F.array("l_quantity", "l_discount").alias("x"))
    data = models.feature_vector(rows, "x")
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True).fit(data)
    out = vector_to_array("scaled")
    columns = scaler.transform(data).select(
        "l_orderkey", "l_linenumber", out[0].alias("quantity"), out[1].alias("discount")
    )
    return rounded(columns, "quantity", "discount")


@REGISTRY.add("""
WITH n AS (SELECT quality AS label, count(*) AS n FROM labels GROUP BY 1)
SELECT l.quality AS label, (SELECT count(*) FROM labels) / (2 * n.n) AS weight, count(*) AS n_rows
FROM labels l JOIN n ON n.label = l.quality GROUP BY ALL""")
def balanced_class_weights(m: Market) -> DataFrame:
    rows = m.table("labels").select(F.col("quality").alias("label"))
    return models.balanced_weights(rows).groupBy("label", "weight").agg(F.count(F.lit(1)).alias("n_rows"))


TWO = "WITH x AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, l_quantity AS a, l_discount * 100 AS b FROM lineitem)"


@REGISTRY.add(f"""
{TWO}, s AS (SELECT y, count(*) AS n, avg(a) AS ma, avg(b) AS mb, count(*) * var_pop(a) AS saa,
             count(*) * var_pop(b) AS sbb, count(*) * covar_pop(a, b) AS sab FROM x GROUP BY y),
p AS (SELECT sum(saa) / (sum(n) - 2) AS caa, sum(sbb) / (sum(n) - 2) AS cbb, sum(sab) / (sum(n) - 2) AS cab FROM s),
d AS (SELECT p.*, o.ma - z.ma AS da, o.mb - z.mb AS db, (o.ma + z.ma) / 2 AS ha, (o.mb + z.mb) / 2 AS hb,
             ln(o.n / z.n) AS prior, caa * cbb - cab * cab AS det FROM p, s o, s z WHERE o.y = 1 AND z.y = 0),
w AS (SELECT *, (cbb * da - cab * db) / det AS wa, (caa * db - cab * da) / det AS wb FROM d)
SELECT round(wa, 9) AS quantity, round(wb, 9) AS discount, round(prior - wa * ha - wb * hb, 9) AS intercept FROM w""")
def linear_discriminant(m: Market) -> DataFrame:
    """Coefficients of LDA on two columns."""
    rows = m.table("lineitem").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        F.array("l_quantity", F.col("l_discount") * 100).alias("x"),
    )
    model = discriminant.fit_lda(models.feature_vector(rows, "x"))
    one = m.table("lineitem").agg(F.count(F.lit(1)).alias("n"))
    a, b = (F.round(F.lit(float(w)), 9) for w in model.coefficients)
    return one.select(a.alias("quantity"), b.alias("discount"), F.round(F.lit(model.intercept), 9).alias("intercept"))


@REGISTRY.add("""
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_quantity AS a FROM lineitem),
s AS (SELECT y, count(*) AS n, avg(a) AS m, 0.99 * var_samp(a) + 0.01 AS v FROM x GROUP BY y),
d AS (SELECT l_orderkey, l_linenumber, l_partkey,
             (ln(o.n) - 0.5 * ln(o.v) - 0.5 * (a - o.m) ** 2 / o.v) - (ln(z.n) - 0.5 * ln(z.v) - 0.5 * (a - z.m) ** 2 / z.v) AS g
      FROM x, s o, s z WHERE o.y = 1 AND z.y = 0)
SELECT l_orderkey, l_linenumber, l_partkey, round(1 / (1 + exp(-g)), 6) AS score FROM d""")
def quadratic_discriminant_scores(m: Market) -> DataFrame:
    """QDA with shrunk spreads on one column, scored on every row."""
    rows = m.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_returnflag") == "R").cast("double").alias("label"), F.array("l_quantity").alias("x"))
    data = models.feature_vector(rows, "x")
    model = discriminant.fit_qda(data, reg_param=0.01)
    scored = models.with_score(model.transform(data))
    return rounded(scored.select("l_orderkey", "l_linenumber", "l_partkey", "score"), "score")


NEWTON_STEPS = 8
RIDGE = 50.0


def newton_sql(name: str, weighted: bool, ridge: float) -> str:
    """The steps of one fit on ``a`` and ``b``: sums of products, then the 3 x 3 system by determinants."""
    parts = [f"{name}_0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)"]
    w = "w" if weighted else "1.0"
    for step in range(NEWTON_STEPS):
        parts.append(f"""{name}_p{step} AS (
  SELECT x.*, {w} AS v, 1 / (1 + exp(-(b0 + b1 * a + b2 * b))) AS p, b0, b1, b2 FROM x, {name}_{step}),
{name}_h{step} AS (
  SELECT any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2,
         sum(v * (y - p)) AS g0, sum(v * (y - p) * a) - {ridge} * any_value(b1) AS g1, sum(v * (y - p) * b) - {ridge} * any_value(b2) AS g2,
         sum(v * p * (1 - p)) AS h00, sum(v * p * (1 - p) * a) AS h01, sum(v * p * (1 - p) * b) AS h02,
         sum(v * p * (1 - p) * a * a) + {ridge} AS h11, sum(v * p * (1 - p) * a * b) AS h12, sum(v * p * (1 - p) * b * b) + {ridge} AS h22
  FROM {name}_p{step}),
{name}_d{step} AS (
  SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det FROM {name}_h{step}),
{name}_{step + 1} AS (
  SELECT b0 + (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det AS b0,
         b1 + (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det AS b1,
         b2 + (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det AS b2
  FROM {name}_d{step})""")
    return ",\n".join(parts)


NEWTON_FITS = {
    "plain": (False, 0.0), "plain_balanced": (True, 0.0), "ridge": (False, RIDGE), "ridge_balanced": (True, RIDGE),
}
NEWTON_SQL = """
WITH lines AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, CAST(l_quantity AS DOUBLE) AS a, CAST(l_discount AS DOUBLE) * 100 AS b FROM lineitem),
x AS (SELECT *, count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY y)) AS w FROM lines),
@fits@,
fits AS (@rows@),
weights AS (SELECT model, unnest(['intercept', 'quantity', 'discount']) AS feature, unnest([b0, b1, b2]) AS weight FROM fits)
""".replace("@fits@", ",\n".join(newton_sql(name, *how) for name, how in NEWTON_FITS.items())).replace(
    "@rows@", " UNION ALL ".join(f"SELECT '{name}' AS model, * FROM {name}_{NEWTON_STEPS}" for name in NEWTON_FITS)
)


def newton_weights(m: Market) -> DataFrame:
    """model, feature, weight of logistic fits on two columns, plain and ridge, each as it is and balanced."""
    data = stage_table(models.balanced_weights(lines(m, "l_quantity", "l_discount").select(
        "label", F.transform(vector_to_array("features"), lambda v, i: v * F.when(i == 1, 100.0).otherwise(1.0)).alias("features")
    )), "lines")
    found = []
    for name, (weighted, ridge) in NEWTON_FITS.items():
        fit = gramian.fit_newton(data, weight="weight" if weighted else None, ridge=ridge, steps=NEWTON_STEPS)
        found += [(name, c, float(v)) for c, v in zip(("intercept", "quantity", "discount"), (fit.intercept, *fit.coefficients))]
    return m.spark.createDataFrame(found, "model string, feature string, weight double")


@REGISTRY.add(NEWTON_SQL + "SELECT model, feature, round(weight, 6) AS weight FROM weights")
def logistic_coefficients(m: Market) -> DataFrame:
    return rounded(newton_weights(m), "weight")


@REGISTRY.add(NEWTON_SQL + """
SELECT model, feature, round(weight, 6) AS weight, round(abs(weight), 6) AS magnitude,
       CAST(row_number() OVER (PARTITION BY model ORDER BY abs(weight) DESC, feature) AS INTEGER) AS rank FROM weights WHERE feature <> 'intercept'""")
def weights_by_magnitude(m: Market) -> DataFrame:
    """The weight table of every fit, largest first."""
    weights = newton_weights(m).filter("feature <> 'intercept'").withColumn("magnitude", F.abs("weight"))
    order = Window.partitionBy("model").orderBy(F.desc("magnitude"), "feature")
    return rounded(weights.withColumn("rank", F.row_number().over(order)), "weight", "magnitude")


TWO_COLUMNS = """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_returnflag = 'R' AS INTEGER) AS y,
                  CAST(l_quantity AS DOUBLE) AS a, CAST(l_discount AS DOUBLE) * 100 AS b FROM lineitem)"""


def density_sql(d: str) -> str:
    """Log density, with prior, of ``a`` and ``b`` in the class of row ``d``."""
    squares = f"{d}.cbb * (a - {d}.ma) ** 2 - 2 * {d}.cab * (a - {d}.ma) * (b - {d}.mb) + {d}.caa * (b - {d}.mb) ** 2"
    return f"(ln({d}.n) - 0.5 * ln({d}.det) - 0.5 * ({squares}) / {d}.det)"


def two_columns(m: Market) -> DataFrame:
    return m.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_returnflag") == "R").cast("double").alias("label"),
        F.array(F.col("l_quantity").cast("double"), F.col("l_discount").cast("double") * 100).alias("features"))


@REGISTRY.add(TWO_COLUMNS + """,
c AS (SELECT avg(a) AS ma, avg(b) AS mb, var_samp(a) AS saa, var_samp(b) AS sbb, covar_samp(a, b) AS sab FROM x),
e AS (SELECT *, (saa + sbb) / 2 + sqrt(((saa - sbb) / 2) ** 2 + sab ** 2) AS v1 FROM c),
-- The first axis solves (S - v1) u = 0; its larger entry is positive, and so is that of the second.
u AS (SELECT *, v1 - sbb AS u0, sab AS u1 FROM e),
n AS (SELECT *, u0 / sqrt(u0 * u0 + u1 * u1) AS p, u1 / sqrt(u0 * u0 + u1 * u1) AS q FROM u)
SELECT l_orderkey, l_linenumber, l_partkey, round((a - ma) * p + (b - mb) * q, 5) AS first,
       round(-(a - ma) * q + (b - mb) * p, 5) AS second
FROM x, n""")
def projected_rows(m: Market) -> DataFrame:
    """Every row along the two principal components of two columns."""
    rows = two_columns(m)
    model = gramian.fit_components(rows)
    both = model.project(F.col("features"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(both[0], 5).alias("first"), F.round(both[1], 5).alias("second"))


@REGISTRY.add(TWO_COLUMNS + """,
s AS (SELECT y, count(*) AS n, avg(a) AS ma, avg(b) AS mb, var_samp(a) AS caa, var_samp(b) AS cbb, covar_samp(a, b) AS cab FROM x GROUP BY y),
d AS (SELECT *, caa * cbb - cab * cab AS det FROM s),
g AS (SELECT l_orderkey, l_linenumber, l_partkey, @of(o)@ - @of(z)@ AS g FROM x, d o, d z WHERE o.y = 1 AND z.y = 0)
SELECT l_orderkey, l_linenumber, l_partkey, round(1 / (1 + exp(-g)), 6) AS score FROM g""".replace("@of(o)@", density_sql("o")).replace("@of(z)@", density_sql("z")))
def discriminant_on_components(m: Market) -> DataFrame:
    """QDA on the two principal components of two columns: no other axes change its densities."""
    rows = two_columns(m)
    low = rows.withColumn("features", gramian.fit_components(rows).project(F.col("features")))
    low = models.feature_vector(low, "features")
    scored = models.with_score(discriminant.fit_qda(low).transform(low))
    return rounded(scored.select("l_orderkey", "l_linenumber", "l_partkey", "score"), "score")


@REGISTRY.add("""
WITH c AS (SELECT var_samp(l_quantity) AS a, var_samp(l_discount * 100) AS b, covar_samp(l_quantity, l_discount * 100) AS c FROM lineitem),
e AS (SELECT (a + b) / 2 + sqrt(((a - b) / 2) ** 2 + c * c) AS v1, a + b AS total FROM c)
SELECT round(v1 / total, 8) AS first, round(1 - v1 / total, 8) AS second FROM e""")
def explained_variance(m: Market) -> DataFrame:
    """Shares of variance of the principal components of two columns."""
    rows = m.table("lineitem").select(F.array("l_quantity", F.col("l_discount") * 100).alias("x"))
    model = discriminant.projection(2).fit(models.feature_vector(rows, "x"))
    shares = [F.round(F.lit(v), 8) for v in discriminant.explained_variance(model)]
    one = m.table("lineitem").agg(F.count(F.lit(1)).alias("n"))
    return one.select(shares[0].alias("first"), shares[1].alias("second"))


@REGISTRY.add("""
WITH x AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, CAST(l_quantity > 25 AS INTEGER) AS a, CAST(l_discount > 0.05::DOUBLE AS INTEGER) AS b FROM lineitem)
SELECT CAST(y AS INTEGER) AS label, round(ln((sum(a) + 1) / (count(*) + 2)), 6) AS large, round(ln((sum(b) + 1) / (count(*) + 2)), 6) AS cheap FROM x GROUP BY y""")
def bernoulli_parameters(m: Market) -> DataFrame:
    """Smoothed log frequencies of Bernoulli naive Bayes on two flags."""
    rows = m.table("lineitem").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        F.array((F.col("l_quantity") > 25).cast("double"), (F.col("l_discount") > 0.05).cast("double")).alias("x"))
    data = models.feature_vector(rows, "x")
    model = models.naive_bayes("bernoulli").fit(data).stages[-1]
    theta = model.theta.toArray()
    pick = lambda values: F.when(F.col("label") == 0, F.lit(float(values[0]))).otherwise(F.lit(float(values[1])))
    classes = data.select(F.col("label").cast("int").alias("label")).distinct()
    return classes.select("label", F.round(pick(theta[:, 0]), 6).alias("large"), F.round(pick(theta[:, 1]), 6).alias("cheap"))


@REGISTRY.add("""
WITH x AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, l_quantity AS a FROM lineitem)
SELECT CAST(y AS INTEGER) AS label, round(count(*) / (SELECT count(*) FROM x), 6) AS prior, round(avg(a), 6) AS mean,
       round(var_pop(a), 4) AS variance FROM x GROUP BY y""")
def gaussian_parameters(m: Market) -> DataFrame:
    """Priors, means and variances of Gaussian naive Bayes on one column."""
    data = lines(m, "l_quantity")
    model = models.naive_bayes("gaussian").fit(data).stages[-1]
    pi, mean, var = model.pi.toArray(), model.theta.toArray()[:, 0], model.sigma.toArray()[:, 0]
    pick = lambda values: F.when(F.col("label") == 0, F.lit(float(values[0]))).otherwise(F.lit(float(values[1])))
    classes = data.select(F.col("label").cast("int").alias("label")).distinct()
    return classes.select(
        "label", F.round(F.exp(pick(pi)), 6).alias("prior"), F.round(pick(mean), 6).alias("mean"), F.round(pick(var), 4).alias("variance"))


def halves(data: DataFrame, *ids: str) -> tuple[DataFrame, DataFrame]:
    """Four fifths of each class to fit on and one to hold out, read by many jobs."""
    folded = stage_table(models.stratified_folds(data, ids, 5, seed=30), "folds")
    return folded.filter("fold > 0"), folded.filter("fold = 0")


def report(fitted: dict, train: DataFrame, holdout: DataFrame, cutoff: float = 0.5) -> DataFrame:
    """Rows, AUC and cells of ``{name: model}`` on both parts, from one long frame that is scored once."""
    long = [models.long_scores(model, name, train, holdout) for name, model in fitted.items()]
    return cells_and_areas(reduce(DataFrame.unionByName, long), cutoff)


def cells_and_areas(long: DataFrame, cutoff: float = 0.5) -> DataFrame:
    scored, by = stage_table(long, "scores"), ["model", "split"]
    return evaluate.confusion(scored, cutoff, by).join(evaluate.auc(scored, by), by)


def weighted_halves(m: Market) -> tuple[DataFrame, DataFrame, int]:
    """Both parts of the vectors, the first with balanced weights, and its number of rows."""
    train, holdout = halves(vectors(m), "vec_id")
    return models.balanced_weights(train), holdout, train.count()


@REGISTRY.add()
def logistic_variants(m: Market) -> DataFrame:
    """Plain, ridge and lasso logistic regression, each unweighted and balanced, on train and holdout."""
    train, holdout, n = weighted_halves(m)
    fitted = {
        f"{name}{'_balanced' if weighted else ''}": models.logistic(n, strength, penalty, weighted).fit(train)
        for weighted in (False, True)
        for name, strength, penalty in (("plain", 1e5, "l2"), ("ridge", 1.0, "l2"), ("lasso", 1.0, "l1"))
    }
    return report(fitted, train, holdout)


@REGISTRY.add()
def naive_bayes_stack(m: Market) -> DataFrame:
    """Bernoulli on the 0/1 slots and Gaussian on the rest of the feature matrix, blended."""
    train, holdout, _ = parts(m)
    train = train.cache()
    flags = models.binary_slots(train)
    zero_one = [i for i, f in enumerate(flags) if f]
    rest = [i for i, f in enumerate(flags) if not f]
    stack = models.fit_stack(
        train, models.naive_bayes("bernoulli", zero_one), models.naive_bayes("gaussian", rest), train.count()
    )
    return evaluate.auc(models.long_scores(stack, "stack", train, holdout), ["model", "split"])


@REGISTRY.add()
def random_forest_report(m: Market) -> DataFrame:
    train, holdout = halves(vectors(m), "vec_id")
    return report({"forest": models.forest(100, 25, 5).fit(train)}, train, holdout)


@REGISTRY.add()
def boosting_report(m: Market) -> DataFrame:
    train, holdout = halves(vectors(m), "vec_id")
    return report({"boosting": models.boosting(10, 0.5, 3).fit(train)}, train, holdout)


@REGISTRY.add()
def linear_svm_report(m: Market) -> DataFrame:
    """Linear SVM, plain and balanced."""
    train, holdout, n = weighted_halves(m)
    plain, balanced = (models.linear_svm(n, weighted=weighted).fit(train) for weighted in (False, True))
    return report({"linear SVM": plain, "linear SVM, balanced": balanced}, train, holdout, cutoff=0.0)


@REGISTRY.add()
def radial_svm_report(m: Market) -> DataFrame:
    train, holdout, n = weighted_halves(m)
    return report({"radial SVM": models.radial_svm(n, 64).fit(train)}, train, holdout, cutoff=0.0)


@REGISTRY.add()
def discriminant_report(m: Market) -> DataFrame:
    """LDA, QDA and QDA on two components, on all vectors."""
    train, holdout = halves(vectors(m), "vec_id")
    flat = discriminant.projection(2).fit(train)
    low = [flat.transform(part).select("label", F.col("projected").alias("features")) for part in (train, holdout)]
    long = [
        models.long_scores(discriminant.fit_lda(train), "LDA", train, holdout),
        models.long_scores(discriminant.fit_qda(train, reg_param=0.01), "QDA", train, holdout),
        models.long_scores(discriminant.fit_qda(low[0]), "QDA on 2 components", *low),
    ]
    return cells_and_areas(reduce(DataFrame.unionByName, long))


@REGISTRY.add()
def grid_search(m: Market) -> DataFrame:
    """Ranked settings of a small logistic grid by stratified cross-validation."""
    data = models.stratified_folds(vectors(m), ["vec_id"], 5, seed=30).cache()
    base = LogisticRegression(maxIter=20)
    result = models.cross_validated(base, data, models.logistic_grid(base, data.count()))
    return models.settings_table(m.spark, result)


@REGISTRY.add()
def refitted_settings(m: Market) -> DataFrame:
    """All 36 settings of the forest grid by AUC on a validation fold, every fifth of them refitted.

    18 fits give the 36 settings.  The refits see the validation fold too and are
    scored on rows that no fit has seen.
    """
    train, holdout = halves(vectors(m), "vec_id")
    scores = staged.staged_scores(models.forest, models.FOREST_GRID, train.filter("fold > 1"), train.filter("fold = 1"))
    ranked = stage_table(staged.ranked_grid(scores), "ranked_settings")
    again = staged.ranked_grid(staged.refitted(models.forest, models.FOREST_GRID, ranked, train, holdout))
    again = again.select(
        "model", F.col("train_auc").alias("refit_train_auc"), F.col("holdout_auc").alias("refit_holdout_auc")
    )
    return ranked.withColumnRenamed("holdout_auc", "validation_auc").join(again, "model", "left")


@REGISTRY.add()
def top_coefficients(m: Market) -> DataFrame:
    """Largest coefficients of a standardised logistic regression on the feature matrix."""
    train, _, names = parts(m)
    train = train.cache()
    fitted = models.standardised(models.logistic(train.count())).fit(train)
    return models.top_weights(m.spark, fitted.stages[-1], names)


@REGISTRY.add()
def predicted_class_counts(m: Market) -> DataFrame:
    """Rows per class that a model predicts for rows it was not fitted on."""
    train, holdout = halves(vectors(m), "vec_id")
    return models.predicted_counts(models.logistic(train.count()).fit(train).transform(holdout))
