"""Scores against labels: AUC, confusion cells, losses, cut-offs, calibration.

Every function takes a long frame with ``label`` (0/1) and ``score`` and optional
grouping columns such as ``model`` and ``split``.  Rows without a label or a score
take no part anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.binning import equal_width_bin, grid_slot
from tidemark.operators.cumulate import range_edges, running_totals, totals_before, totals_inside, with_range
from tidemark.plans.explore import column_range

FN_PENALTY = 15
HALVING_TOLERANCE = 0.0005


def known(scored: DataFrame) -> DataFrame:
    """The rows that have both a label and a score."""
    return scored.filter(F.col("label").isNotNull() & F.col("score").isNotNull())


def score_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    return known(scored).groupBy(*by, "score").agg(
        F.sum((F.col("label") == 1).cast("long")).alias("pos"),
        F.sum((F.col("label") == 0).cast("long")).alias("neg"),
    )


def _ranked(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    edges = range_edges(scored, "score")
    return running_totals(score_counts(scored, by), "score", ["pos", "neg"], edges, by, descending=True)


def auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve; tied scores count half.  NULL with one class only.

    For every score: its negatives times the positives scored higher, plus half
    of the positives tied with it.  Wins inside a value range come from a window
    over that range; wins over the ranges above are range totals multiplied, so
    the counts are read once and never joined.
    """
    by = list(by)
    placed = with_range(score_counts(scored, by), "score", range_edges(scored, "score"))
    local = totals_inside(placed, "score", ["pos"], by, descending=True)
    higher = (F.col("_in_pos") - F.col("pos")).cast("double") + F.col("pos") / 2
    per_range = local.groupBy(*by, "_range").agg(
        F.sum(F.col("neg") * higher).alias("_wins"),
        F.sum("pos").cast("double").alias("_p"),
        F.sum("neg").cast("double").alias("_n"),
    )
    above = totals_before({"_above": "_p"}, by, descending=True)["_above"]
    sums = per_range.withColumn("_above", above).groupBy(*by).agg(
        F.sum(F.col("_wins") + F.col("_n") * F.col("_above")).alias("_wins"),
        F.sum("_p").alias("_p"),
        F.sum("_n").alias("_n"),
    )
    pairs = F.col("_p") * F.col("_n")
    return sums.select(*by, F.when(pairs > 0, F.col("_wins") / pairs).alias("auc"))


def auc_at_cutoff(scored: DataFrame, cutoff: float, by: Sequence[str] = ()) -> DataFrame:
    """AUC of the 0/1 prediction ``score > cutoff``."""
    hard = scored.withColumn("score", (F.col("score") > cutoff).cast("double"))
    cells = score_counts(hard, by).groupBy(*by).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("score") == s, F.col(c))), F.lit(0)).alias(f"{c}{s}")
            for c in ("pos", "neg")
            for s in (0, 1)
        ]
    )
    pairs = (F.col("pos0") + F.col("pos1")).cast("double") * (F.col("neg0") + F.col("neg1"))
    wins = F.col("pos1").cast("double") * (F.col("neg0") + F.col("neg1") / 2) + F.col("pos0") / 2 * F.col("neg0")
    return cells.select(*by, F.when(pairs > 0, wins / pairs).alias("auc"))


def roc_curve(scored: DataFrame, by: Sequence[str] = (), pos_label: int = 1) -> DataFrame:
    """``threshold, fpr, tpr`` per distinct score, highest first when sorted.

    ``pos_label=0`` treats class 0 as the one the score points to.
    """
    by = list(by)
    ranked = _ranked(scored, by)
    totals = known(scored).groupBy(*by).agg(
        F.sum((F.col("label") == 1).cast("long")).alias("_p"),
        F.sum((F.col("label") == 0).cast("long")).alias("_n"),
    )
    renamed = totals.withColumnsRenamed({c: f"_t_{c}" for c in by})
    if by:
        ranked = ranked.join(renamed, [ranked[c].eqNullSafe(renamed[f"_t_{c}"]) for c in by])
    else:
        ranked = ranked.withColumns(
            {"_p": totals.select("_p").scalar(), "_n": totals.select("_n").scalar()}
        )
    hits, alarms = F.col("cum_pos") / F.col("_p"), F.col("cum_neg") / F.col("_n")
    if pos_label == 0:
        hits, alarms = alarms, hits
    return ranked.select(*by, F.col("score").alias("threshold"), alarms.alias("fpr"), hits.alias("tpr"))


def confusion(scored: DataFrame, cutoff: float | DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``tn, fp, fn, tp`` for the prediction ``score > cutoff``, and ratios of them.

    A one-cell frame (see :func:`prior_cutoff`) is accepted as the cut-off.
    """
    limit = cutoff.scalar() if isinstance(cutoff, DataFrame) else F.lit(float(cutoff))
    guess, truth = F.col("score") > limit, F.col("label") == 1
    cells = known(scored).groupBy(*by).agg(
        F.sum((~guess & ~truth).cast("long")).alias("tn"),
        F.sum((guess & ~truth).cast("long")).alias("fp"),
        F.sum((~guess & truth).cast("long")).alias("fn"),
        F.sum((guess & truth).cast("long")).alias("tp"),
    )
    return with_ratios(cells)


def with_ratios(cells: DataFrame) -> DataFrame:
    """Accuracy, precision and recall; NULL where a ratio has no denominator."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.withColumns(
        {
            "accuracy": F.try_divide(tp + tn, tp + tn + fp + fn),
            "precision": F.try_divide(tp, tp + fp),
            "recall": F.try_divide(tp, tp + fn),
        }
    )


def normalised(cells: DataFrame) -> DataFrame:
    """Confusion cells as shares of all rows."""
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return cells.withColumns({c: F.col(c) / total for c in ("tn", "fp", "fn", "tp")})


def loss(cells: DataFrame, fn_penalty: float = FN_PENALTY, fp_penalty: float = 1.0) -> DataFrame:
    """Adds the asymmetric loss, total and per row."""
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    value = F.col("fn") * F.lit(float(fn_penalty)) + F.col("fp") * F.lit(float(fp_penalty))
    return cells.withColumns({"loss": value, "loss_per_row": value / total})


def loss_matrix_total(cells: DataFrame, matrix: Sequence[Sequence[float]]) -> DataFrame:
    """Loss from a matrix indexed ``[truth][prediction]``."""
    (tn, fp), (fn, tp) = matrix
    weights = {"tn": tn, "fp": fp, "fn": fn, "tp": tp}
    return cells.withColumn("loss", sum(F.col(c) * F.lit(float(w)) for c, w in weights.items()))


def prior_cutoff(scored: DataFrame) -> DataFrame:
    """The share of positives as a one-cell frame."""
    return scored.agg(F.avg(F.col("label").cast("double")))


def _within(span: tuple[float, float]) -> Column:
    """The score, or an error where it is outside ``span``: a search there would never see it."""
    score = F.col("score")
    outside = F.concat(F.lit(f"score outside {list(span)}, give the span of these scores: "), score.cast("string"))
    return F.when(score.isNull() | score.between(*span), score).otherwise(F.raise_error(outside))


def threshold_sweep(
    scored: DataFrame,
    points: int = 101,
    by: Sequence[str] = (),
    fn_penalty: float = FN_PENALTY,
    span: tuple[float, float] = (0.0, 1.0),
) -> DataFrame:
    """Confusion cells and loss at every cut-off of an even grid on ``span``, in one pass.

    A score is put between two grid points and counted there; the cells at a
    cut-off follow from running totals over at most ``points + 1`` slots.
    """
    low, high = map(float, span)
    step = (high - low) / (points - 1)
    slot = F.least(F.greatest(grid_slot(F.col("score"), low, step), F.lit(0)), F.lit(points))
    # slot = number of grid points below the score, so it beats cut-offs 0..slot-1.
    slots = known(scored).select(*by, "label", slot.alias("slot"))
    counts = slots.groupBy(*by, "slot").agg(
        F.sum((F.col("label") == 1).cast("long")).alias("pos"),
        F.sum((F.col("label") == 0).cast("long")).alias("neg"),
    )
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    one_row = counts.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("slot", F.struct("pos", "neg")))).alias("_m")
    )
    # The map holds at most points + 1 entries.
    per_point = one_row.select(*by, "_m", grid).select(
        *by,
        "point",
        F.coalesce(F.try_element_at("_m", (F.col("point") + 1).cast("long"))["pos"], F.lit(0)).alias("pos"),
        F.coalesce(F.try_element_at("_m", (F.col("point") + 1).cast("long"))["neg"], F.lit(0)).alias("neg"),
        F.coalesce(F.try_element_at("_m", F.lit(0).cast("long"))["pos"], F.lit(0)).alias("pos0"),
        F.coalesce(F.try_element_at("_m", F.lit(0).cast("long"))["neg"], F.lit(0)).alias("neg0"),
    )
    above = Window.partitionBy(*by).orderBy(F.desc("point")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    beaten = per_point.select(
        *by,
        "point",
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        (F.sum("pos").over(whole) + F.col("pos0")).alias("_p"),
        (F.sum("neg").over(whole) + F.col("neg0")).alias("_n"),
    )
    last = points - 1
    cutoff = F.when(F.col("point") == last, F.lit(high)).otherwise(F.lit(low) + F.col("point") * F.lit(step))
    cells = beaten.select(
        *by,
        cutoff.alias("cutoff"),
        (F.col("_n") - F.col("fp")).alias("tn"),
        "fp",
        (F.col("_p") - F.col("tp")).alias("fn"),
        "tp",
    )
    return loss(cells, fn_penalty)


def best_cutoff(
    scored: DataFrame,
    by: Sequence[str] = (),
    fn_penalty: float = FN_PENALTY,
    points: int = 2001,
    span: tuple[float, float] = (0.0, 1.0),
) -> DataFrame:
    """The grid cut-off with the smallest loss; ties go to the smallest cut-off.

    The span is that of probabilities; margins need one of their own, and a
    score outside it is an error.
    """
    inside = scored.withColumn("score", _within(span))
    sweep = threshold_sweep(inside, points, by, fn_penalty, span)
    best = F.min_by(F.struct("cutoff", "loss", "loss_per_row"), F.struct("loss", "cutoff"))
    return sweep.groupBy(*by).agg(best.alias("_b")).select(*by, "_b.*")


def _halving_cutoffs() -> list[float]:
    """Every cut-off that halving [0, 1] can ask for."""
    wanted, spans = set(), [(0.0, 1.0)]
    while spans:
        low, high = spans.pop()
        if high - low < HALVING_TOLERANCE:
            wanted.add(low)
            continue
        middle = (low + high) / 2
        wanted.update((middle, middle + (high - low) / 50))
        spans += [(low, middle), (middle, high)]
    return sorted(wanted)


def halving_cutoff(scored: DataFrame, fn_penalty: float = FN_PENALTY) -> tuple[float, float]:
    """Cut-off and loss per row found by repeated halving of [0, 1].

    Each step looks whether the loss falls just right of the middle and keeps
    that half.  All cut-offs it may visit are fixed beforehand, so one pass
    counts the scores between them and the steps run on those counts.
    """
    cutoffs = _halving_cutoffs()
    # Bucketizer ranges are closed on the left; on negated scores that is the
    # right side, which makes "score > cutoff" strict.
    edges = [-float("inf"), *[-c for c in reversed(cutoffs)], float("inf")]
    negated = known(scored).select("label", (-_within((0.0, 1.0))).alias("_s"))
    placed = Bucketizer(splits=edges, inputCol="_s", outputCol="_slot").transform(negated)
    rows = placed.groupBy(F.col("_slot").cast("int").alias("slot")).agg(
        F.sum((F.col("label") == 1).cast("long")).alias("pos"),
        F.sum((F.col("label") == 0).cast("long")).alias("neg"),
    )
    found = {r["slot"]: (r["pos"], r["neg"]) for r in rows.collect()}
    positives = sum(p for p, _ in found.values())
    total = positives + sum(n for _, n in found.values())
    cost, tp, fp = {}, 0, 0
    for position, cutoff in enumerate(reversed(cutoffs)):
        pos, neg = found.get(position, (0, 0))
        tp, fp = tp + pos, fp + neg
        cost[cutoff] = (fn_penalty * (positives - tp) + fp) / total
    low, high = 0.0, 1.0
    while high - low >= HALVING_TOLERANCE:
        middle = (low + high) / 2
        if cost[middle] > cost[middle + (high - low) / 50]:
            low = middle
        else:
            high = middle
    return low, cost[low]


def apply_cutoff(
    train: DataFrame, holdout: DataFrame, by: Sequence[str] = (), fn_penalty: float = FN_PENALTY
) -> DataFrame:
    """Best cut-off on the training rows with its loss per row on both parts."""
    by = list(by)
    best = best_cutoff(train, by, fn_penalty).select(
        *by, "cutoff", F.col("loss_per_row").alias("train_loss")
    )
    if not by:
        limit = best.select("cutoff").scalar()
        cells = holdout.select("label", "score", limit.alias("cutoff"))
    else:
        cells = holdout.join(best.select(*by, "cutoff"), by)
    guess, truth = F.col("score") > F.col("cutoff"), F.col("label") == 1
    cost = F.sum((~guess & truth).cast("long")) * F.lit(float(fn_penalty)) + F.sum((guess & ~truth).cast("long"))
    held = cells.groupBy(*by, "cutoff").agg((cost / F.count(F.lit(1))).alias("holdout_loss"))
    return held.join(best, [*by, "cutoff"]).select(*by, "cutoff", "train_loss", "holdout_loss")


def calibration(scored: DataFrame, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Mean label per equal-width bin of the score."""
    low, high = column_range(scored, "score")
    binned = scored.select(*by, "label", equal_width_bin(F.col("score"), low, high, bins).alias("bin"))
    return binned.groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("label").cast("double")).alias("truth")
    )


def compare_models(scored: DataFrame, fn_penalty: float = FN_PENALTY) -> DataFrame:
    """AUC and loss of every model on both parts, best holdout AUC first.

    ``scored`` is long: ``model, split ('train' or 'holdout'), label, score``.
    The cut-off behind the loss is chosen on the training rows of the model.
    """
    areas = auc(scored, ["model", "split"])
    wide = areas.groupBy("model").agg(
        F.max(F.when(F.col("split") == "train", F.col("auc"))).alias("train_auc"),
        F.max(F.when(F.col("split") == "holdout", F.col("auc"))).alias("holdout_auc"),
    )
    losses = apply_cutoff(
        scored.filter(F.col("split") == "train"),
        scored.filter(F.col("split") == "holdout"),
        ["model"],
        fn_penalty,
    )
    return wide.join(losses, "model").orderBy(F.desc("holdout_auc"), "model")


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide to long."""
    return df.unpivot(list(ids), list(values), name, value)
