"""Running totals over a global order without sending all rows to one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Values a range should hold at most, and the size of the sketch that cuts them: its rank error is far
# below one in a thousand, its bytes are bounded whatever it has seen.
RANGE_VALUES = 1_000_000
SKETCH_SIZE = 16_384
LEAST_RANGES = 1024


def range_edges(df: DataFrame, column: str, ranges: int | None = None) -> list[float]:
    """Edges that cut the *distinct* values of ``column`` into about equal ranges.

    Running totals work on one row per value, so a value that most rows carry
    weighs no more than any other.  The number of ranges follows from the number
    of values.  Distinct values are found map-side and by one shuffle; only the
    sketch and the edges reach the driver.  The edges decide which task handles
    a value; every value is kept whichever way they fall.
    """
    spark = df.sparkSession
    value = F.col(column).cast("double")
    values = df.select(value.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v")).distinct()
    n, sketch = values.agg(F.count("_v"), F.expr(f"kll_sketch_agg_double(_v, {SKETCH_SIZE})")).first()
    if ranges is None:
        ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // RANGE_VALUES))
    ranges = min(ranges, n)
    if ranges <= 1:
        return []
    ranks = ", ".join(f"{i / ranges}D" for i in range(1, ranges))
    held = spark.createDataFrame([(sketch,)], "sketch binary")
    found = held.select(F.expr(f"kll_sketch_get_quantile_double(sketch, array({ranks}))")).first()[0]
    return sorted({edge for edge in found if math.isfinite(edge)})


def with_range(df: DataFrame, column: str, edges: Sequence[float], name: str = "_range") -> DataFrame:
    """Number of the range a value falls in; equal values share a range."""
    if not edges:
        return df.withColumn(name, F.lit(0.0))
    splits = [-float("inf"), *edges, float("inf")]
    return Bucketizer(splits=splits, inputCol=column, outputCol=name, handleInvalid="keep").transform(df)


def totals_inside(
    placed: DataFrame, value: str, sums: Sequence[str], by: Sequence[str], descending: bool
) -> DataFrame:
    """Running total ``_in_<col>`` inside each range."""
    toward = F.desc if descending else F.asc
    inside = Window.partitionBy(*by, "_range").orderBy(toward(value)).rowsBetween(Window.unboundedPreceding, 0)
    return placed.select("*", *[F.sum(c).over(inside).alias(f"_in_{c}") for c in sums])


def totals_before(columns: dict[str, str], by: Sequence[str], descending: bool) -> dict[str, Column]:
    """For each ``{name: col}`` the sum of ``col`` over the ranges before a range."""
    toward = F.desc if descending else F.asc
    window = Window.partitionBy(*by).orderBy(toward("_range")).rowsBetween(Window.unboundedPreceding, -1)
    return {name: F.coalesce(F.sum(col).over(window), F.lit(0)) for name, col in columns.items()}


def running_totals(
    df: DataFrame,
    value: str,
    sums: Sequence[str],
    edges: Sequence[float],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Inclusive running total ``cum_<col>`` of each column of ``sums`` in ``value`` order.

    ``df`` holds one row per (``by``, ``value``).  Each range is totalled, the
    totals of the ranges (one row for up to a million values) are summed up
    as offsets, and the running total inside a range is a window over that
    range alone.
    """
    by = list(by)
    placed = with_range(df, value, edges)
    offsets = placed.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_all_{c}") for c in sums])
    before = totals_before({f"_before_{c}": f"_all_{c}" for c in sums}, by, descending)
    offsets = offsets.select(*by, "_range", *[column.alias(name) for name, column in before.items()])
    local = totals_inside(placed, value, sums, by, descending)
    offsets = offsets.withColumnsRenamed({c: f"_o_{c}" for c in [*by, "_range"]})
    match = [local[c].eqNullSafe(offsets[f"_o_{c}"]) for c in [*by, "_range"]]
    return local.join(offsets, match).select(
        *df.columns,
        *[(F.col(f"_in_{c}") + F.col(f"_before_{c}")).alias(f"cum_{c}") for c in sums],
    )


def quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles per group as ``probability, quantile`` rows.

    The quantile is the smallest value whose running count reaches
    ``probability * rows``.
    """
    by = list(by)
    rows = df.filter(F.col(value).isNotNull())
    counts = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    reached = running_totals(counts, value, ["n"], range_edges(rows, value), by)
    totals = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_total"))
    totals = totals.withColumnsRenamed({c: f"_t_{c}" for c in by})
    match = [reached[c].eqNullSafe(totals[f"_t_{c}"]) for c in by]
    joined = reached.join(totals, match) if by else reached.withColumn("_total", totals.scalar())
    asked = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    need = F.greatest(F.ceil(F.col("probability") * F.col("_total")), F.lit(1))
    return (
        joined.select(*by, value, "cum_n", "_total", asked)
        .filter(F.col("cum_n") >= need)
        .groupBy(*by, "probability")
        .agg(F.min(value).alias("quantile"))
    )


def numbered(df: DataFrame, by: Sequence[str], key: Column, name: str = "number", ranges: int | None = None) -> DataFrame:
    """0-based row numbers within each group, in an order drawn from a hash of ``key``.

    A group is cut into ranges of the hash, as many as the number of rows asks
    for; rows are numbered inside a range and the sizes of the ranges before it
    are added.
    """
    by = list(by)
    if ranges is None:
        ranges = max(LEAST_RANGES, -(-df.count() // RANGE_VALUES))
    spread = df.withColumn("_hash", key).withColumn("_range", F.pmod(F.col("_hash"), F.lit(ranges)))
    sizes = spread.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(c).alias(f"_o_{c}") for c in by],
        F.col("_range").alias("_o_range"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy(*by, "_range").orderBy("_hash")
    local = spread.withColumn("_in", F.row_number().over(inside) - 1)
    match = [local[c].eqNullSafe(offsets[f"_o_{c}"]) for c in by] + [local["_range"] == offsets["_o_range"]]
    return (
        local.join(offsets, match)
        .withColumn(name, F.col("_in") + F.col("_before"))
        .select(*df.columns, name)
    )
