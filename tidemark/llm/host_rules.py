"""Quality rules with verdicts per host (native: DataFrame functions only).

Every document is measured against text rules. Failures are counted per host and rule, the rates
are shrunk towards the rate of all hosts with a beta prior fitted to the hosts themselves, and the
verdicts go back to the documents: on a host with too high a shrunk rate for a rule, that rule
binds. A document is dropped when it fails a base rule, or when it fails a rule that binds on its
host. A host alone never drops a document that keeps to the rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, words_of
from tidemark.session import stage_table

SYMBOLS = "#*$%&|<>"
WINDOW = 5

# A rule a document may break; it only binds where the host breaks it too often. Integers only,
# so that no verdict hangs on rounding.
SOFT_RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "many_symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 3 * n_words OR word_chars > 12 * n_words",
    "repeats": "10 * n_repeat_words > n_words",
}
BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"
HOST_LIMIT = 0.3
# Hosts with a binding rule that may be broadcast; a row takes about 100 bytes.
BROADCAST_HOSTS = 100_000
# Bounds of the prior's weight, in documents.
WEIGHTS = (1.0, 1000000.0)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _covered(positions: Column) -> Column:
    """Words covered by windows that start at the sorted ``positions``."""
    steps = F.transform(
        F.slice(positions, 2, F.greatest(F.size(positions) - 1, F.lit(0))),
        lambda p, i: F.least(p - F.get(positions, i), F.lit(WINDOW)),
    )
    return F.when(F.size(positions) == 0, F.lit(0)).otherwise(
        F.aggregate(steps, F.lit(WINDOW), lambda total, s: total + s)
    )


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host and the figures of every row of ``docs``; a null or blank text has none (zeros).

    Repeated rows are measured each; extra columns are not looked at.
    """
    base = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    lines = F.filter(F.split("text", "\n", -1), lambda x: _without(x, BLANKS) != "")
    counted = base.select(
        "doc_id",
        "host",
        F.length(_without(F.col("text"), BLANKS)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"),
    )
    n_windows = F.size("hashes") - (WINDOW - 1)
    windows = counted.select(
        "doc_id",
        "host",
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("hashes").cast("long").alias("n_words"),
        F.when(
            n_windows > 1,
            F.transform(F.sequence(F.lit(1), n_windows), lambda i: F.xxhash64(F.slice("hashes", i, WINDOW))),
        ).alias("windows"),
    )
    # Only a text with a repeated window is sorted.
    paired = windows.withColumn(
        "paired",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("windows")
    repeated = paired.withColumn(
        "repeated",
        F.sort_array(
            F.transform(
                F.filter(
                    "paired",
                    # Outside the array get() is null.
                    lambda x, k: F.get("paired", k + 1)["h"].eqNullSafe(x["h"])
                    | F.get("paired", k - 1)["h"].eqNullSafe(x["h"]),
                ),
                lambda x: x["i"],
            )
        ),
    ).drop("paired")
    return repeated.withColumn(
        "n_repeat_words",
        F.when(F.col("repeated").isNull(), F.lit(0)).otherwise(_covered(F.col("repeated"))).cast("long"),
    ).drop("repeated")


def host_rates(figures: DataFrame) -> DataFrame:
    """host_key, rule, n_docs, n_failed, rate: the shrunk rate of every host and rule.

    The prior of a rule has the mean of all documents; its weight follows from the spread of the
    hosts' rates (method of moments, hosts weighted by documents), within ``WEIGHTS``.
    """
    failed = [
        F.count_if(F.expr(test)).alias(name) for name, test in SOFT_RULES.items()
    ]
    counts = figures.groupBy("host_key").agg(F.count(F.lit(1)).alias("n_docs"), *failed)
    long = counts.unpivot(["host_key", "n_docs"], list(SOFT_RULES), "rule", "n_failed")
    prior = (
        long.groupBy("rule")
        .agg(
            F.sum("n_docs").alias("docs"),
            F.sum("n_failed").alias("failed"),
            F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("squares"),
        )
        .withColumn("mean", F.col("failed") / F.col("docs"))
        .withColumn("spread", F.col("squares") / F.col("docs") - F.col("mean") * F.col("mean"))
        .select(
            "rule",
            "mean",
            F.when(
                F.col("spread") > 1e-12,
                F.least(
                    F.greatest(F.col("mean") * (1 - F.col("mean")) / F.col("spread") - 1, F.lit(WEIGHTS[0])),
                    F.lit(WEIGHTS[1]),
                ),
            )
            .otherwise(F.lit(WEIGHTS[1]))
            .alias("weight"),
        )
    )
    return long.join(prior, "rule").select(
        "host_key",
        "rule",
        "n_docs",
        "n_failed",
        ((F.col("n_failed") + F.col("mean") * F.col("weight")) / (F.col("n_docs") + F.col("weight"))).alias("rate"),
    )


def host_verdicts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    limit: float = HOST_LIMIT,
) -> DataFrame:
    """One row per row of ``docs``: its figures, ``base_failed``, ``host_rules`` and ``kept``.

    ``host_rules`` names, by comma, the rules that bind on the host and that the document fails.
    Documents without a host form a host of their own. An empty table gives no rows.
    """
    figures = measured(docs, doc_id, text, host).withColumn(
        # A null host is a key too, so that the join below is a plain equality.
        "host_key", F.coalesce(F.concat(F.lit("="), "host"), F.lit("?"))
    )
    figures = stage_table(figures, "host_rules")
    binding = (
        host_rates(figures)
        .filter(F.col("rate") > limit)
        .groupBy("host_key")
        .agg(F.collect_set("rule").alias("binding"))
    )
    binding = stage_table(binding, "host_bindings")
    # Few hosts break rules this often. Beyond the bound the join shuffles, and splits hot hosts.
    if binding.count() <= BROADCAST_HOSTS:
        binding = F.broadcast(binding)
    judged = figures.join(binding, "host_key", "left")
    broken = F.concat_ws(
        ",",
        *[
            F.when(F.array_contains("binding", name) & F.expr(test), F.lit(name))
            for name, test in SOFT_RULES.items()
        ],
    )
    return (
        judged.withColumn("base_failed", F.expr(BASE_FAILED))
        .withColumn("host_rules", broken)
        .withColumn("kept", ~F.col("base_failed") & (F.col("host_rules") == ""))
        .drop("host_key", "binding")
    )
