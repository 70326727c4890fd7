"""Per-key operators that stay safe when one key holds a large share of the rows.

Each of them reduces rows before the shuffle (partial aggregation, or the
group limit Spark puts under a ranked filter) or joins an aggregate back, where
adaptive execution can split a hot partition.  None puts all rows of a key
into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CHUNK = 1 << 16


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row ``df[times]`` times, in two steps so that no long array is built."""
    chunks = F.sequence(F.lit(0).cast("long"), (F.col(times) - 1).cast("long"), F.lit(_CHUNK).cast("long"))
    left = F.least(F.col(times).cast("long") - F.col("_start"), F.lit(_CHUNK).cast("long"))
    return (
        df.filter(F.col(times) > 0)
        .withColumn("_start", F.explode(chunks))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
        .drop("_start", "_copy", times)
    )


def later_counts(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Per key and ``order`` value: ``n_rows`` and how many of them have no later row.

    Rows of a key are first counted per ``order`` value, so the window runs over
    the distinct snapshot days of a key and not over its rows.
    """
    per_day = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("n_rows"))
    window = Window.partitionBy(*keys).orderBy(order)
    return per_day.withColumn("n_gone", F.coalesce(F.lead(F.lit(0)).over(window), F.lit(1)))


def later_flags(df: DataFrame, keys: Sequence[str], order: str, flag: str = "indicator") -> DataFrame:
    """One row per input row: 0 if the key shows up again later, 1 if not.

    Of several rows on the last day of a key one is flagged 1, the others are
    followed by it and get 0.
    """
    counts = later_counts(df, keys, order)
    ends = counts.withColumn(
        "_parts",
        F.when(
            (F.col("n_gone") == 1) & (F.col("n_rows") > 1),
            F.array(
                F.struct(F.lit(1).alias("flag"), F.lit(1).cast("long").alias("n")),
                F.struct(F.lit(0).alias("flag"), (F.col("n_rows") - 1).alias("n")),
            ),
        ).otherwise(F.array(F.struct(F.col("n_gone").alias("flag"), F.col("n_rows").alias("n")))),
    )
    parts = ends.select(*keys, order, F.explode("_parts").alias("_p"))
    return repeat_rows(
        parts.select(*keys, order, F.col("_p.flag").alias(flag), F.col("_p.n").alias("_n")), "_n"
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key by ``order``; Spark limits each group to one row before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def first_seen(df: DataFrame, keys: Sequence[str], batch: str) -> DataFrame:
    """All rows of the earliest batch that holds their key (duplicates in it survive).

    The closed form of inserting batch after batch the rows with absent keys: a key with a NULL in
    it equals nothing, so its rows are new in every batch.
    """
    earliest = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.min(batch).alias("_first"))
    # The null-safe condition deals both sides out anew: a plain one would keep the aggregate's partitioning,
    # which adaptive execution can't split. No key of the aggregate has a NULL, so none is matched.
    joined = _join_null_safe(df, earliest, keys, "left")
    return joined.filter(F.col("_first").isNull() | (F.col(batch) == F.col("_first"))).select(*df.columns)


def count_over(df: DataFrame, keys: Sequence[str], counts: dict[str, str]) -> DataFrame:
    """``COUNT(col) OVER (PARTITION BY keys)`` for each ``{new name: col}``."""
    per_key = df.groupBy(*keys).agg(*[F.count(col).alias(name) for name, col in counts.items()])
    return _join_null_safe(df, per_key, keys)


def top_levels(df: DataFrame, key: str, measure: Column, n: int | None, name: str = "measure") -> DataFrame:
    """The ``n`` largest groups of ``key`` by ``measure``; ties go to the smallest key."""
    groups = df.filter(F.col(key).isNotNull()).groupBy(key).agg(measure.alias(name))
    if n is None:
        return groups
    return groups.orderBy(F.desc(name), F.asc(key)).limit(n)


def keep_top(df: DataFrame, key: str, measure: Column, n: int) -> DataFrame:
    """Rows whose key is among the ``n`` largest groups."""
    return df.join(top_levels(df, key, measure, n).select(key), key, "left_semi")


def _join_null_safe(df: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    renamed = per_key.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    condition = [df[k].eqNullSafe(renamed[f"_k_{k}"]) for k in keys]
    return df.join(renamed, condition, how).drop(*[f"_k_{k}" for k in keys])
