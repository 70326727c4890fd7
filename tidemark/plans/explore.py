"""The query catalogue over labels, listings, events and performers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidemark.functions.binning import edge_bin, equal_width_bin, spread_bounds
from tidemark.functions.dates import local_date, snapshot_day
from tidemark.functions.text import wordless_to
from tidemark.operators.keyed import count_over, top_levels

# Bin edges of the exploration.
DAYS_EDGES = [0, 1, 2, 3, 4, 5, 7, 10, 15, 20, 30, 50, 100, 200, 450]
PERFORMER_EDGES = [0, 1, 2, 3, 4, 5, 10, 75]


def with_listing(labels: DataFrame, listings: DataFrame, *columns: str) -> DataFrame:
    """Label rows with columns of their listing.

    Joined on ``listing_id, date`` as the label itself is, so the label side
    keeps its partitioning and only the listings move.
    """
    side = listings.select("listing_id", snapshot_day(listings).alias("date"), *columns)
    return labels.join(side, ["listing_id", "date"])


def event_sizes(listings: DataFrame) -> DataFrame:
    return listings.groupBy("event_id").agg(F.countDistinct("listing_id").alias("event_listing_n"))


def label_event_size(labels: DataFrame, listings: DataFrame) -> DataFrame:
    """Label rows with the number of distinct listings of their event."""
    return with_listing(labels, listings, "event_id").join(event_sizes(listings), "event_id")


def label_date_features(labels: DataFrame, listings: DataFrame, dates: DataFrame) -> DataFrame:
    return with_listing(labels, listings, "event_id").join(dates, ["event_id", "date_accessed"])


def label_event_columns(
    labels: DataFrame, listings: DataFrame, events: DataFrame, *columns: str
) -> DataFrame:
    """Label rows with attributes of their event (place, category, venue...)."""
    return (
        with_listing(labels, listings, "event_id")
        .join(events.select("event_id", *columns), "event_id")
        .select("listing_id", "ticket_splits_option", "date", "indicator", "event_id", *columns)
    )


def label_performers(
    labels: DataFrame, listings: DataFrame, events: DataFrame, performers: DataFrame
) -> DataFrame:
    """Label rows once per performer of their event."""
    return label_event_columns(labels, listings, events, "name").join(
        performers.select("event_id", "performer_id", "performer_name", "role"), "event_id"
    )


def event_gone_rates(
    labels: DataFrame, listings: DataFrame, events: DataFrame, dates: DataFrame, by_date: bool = False
) -> DataFrame:
    """Gone rate per event, place and days to the show (and snapshot day).

    Every grouping column but the day and the days left depends on the event,
    so labels are averaged per event and day first and the dimension tables
    join the result, not the label rows.
    """
    per_day = (
        with_listing(labels, listings, "event_id")
        .groupBy("event_id", "date", "date_accessed")
        .agg(F.sum(F.col("indicator").cast("long")).alias("gone"), F.count(F.lit(1)).alias("n"))
    )
    joined = (
        per_day.join(dates.select("event_id", "date_accessed", "days_until_show"), ["event_id", "date_accessed"])
        .join(events.select("event_id", "geos"), "event_id")
        .join(event_sizes(listings), "event_id")
    )
    keys = ["event_id", "event_listing_n", *(["date"] if by_date else []), "geos", "days_until_show"]
    return joined.groupBy(*keys).agg((F.sum("gone") / F.sum("n")).alias("gone_rate"))


def seats_by_section_zone(listings: DataFrame, n: int = 1000) -> DataFrame:
    """Listings outside general admission per section and zone, most frequent first."""
    return (
        listings.filter(~F.col("is_ga"))
        .groupBy("is_ga", "section_name", "zone_name")
        .agg(F.count(F.lit(1)).alias("n_listings"))
        .orderBy(F.desc("n_listings"), "section_name", "zone_name")
        .limit(n)
    )


def latest_events(events: DataFrame, n: int = 100) -> DataFrame:
    return (
        events.withColumn("show_date", local_date(F.col("eventdatelocal")))
        .orderBy(F.desc("show_date"), "event_id")
        .limit(n)
    )


def sample_rows(df: DataFrame, order: Sequence[str], n: int = 100) -> DataFrame:
    """The first ``n`` rows by ``order``: a sample that is the same on every run."""
    return df.orderBy(*order).limit(n)


def zones_by_listings(listings: DataFrame, n: int = 100) -> DataFrame:
    return (
        listings.groupBy("zone_name")
        .agg(F.count(F.lit(1)).alias("n_listings"))
        .orderBy(F.desc("n_listings"), "zone_name")
        .limit(n)
    )


def busy_performers(performers: DataFrame, min_events: int = 10) -> DataFrame:
    """Performer and event pairs of performers with more than ``min_events`` rows."""
    return (
        count_over(performers.select("performer_id", "event_id"), ["performer_id"], {"total_events": "performer_id"})
        .filter(F.col("total_events") > min_events)
    )


def performer_counts(performers: DataFrame) -> DataFrame:
    """Each performer and event pair with the events per performer and performers per event."""
    pairs = performers.select("performer_id", "event_id")
    counted = count_over(pairs, ["performer_id"], {"perf_events": "performer_id"})
    return count_over(counted, ["event_id"], {"event_perf_count": "event_id"})


def row_loss(labels: DataFrame, listings: DataFrame) -> DataFrame:
    """Rows on both sides of the label and listing join, to compare with the label rows."""
    return with_listing(labels, listings, "event_id").agg(
        F.count("listing_id").alias("label_rows"), F.count("event_id").alias("listing_rows")
    )


def observations_per_event(splits: DataFrame, listings: DataFrame) -> DataFrame:
    """Distinct listings and split observations per event.

    Split rows are counted per listing and day first, so the join sees one row
    per listing and day.
    """
    day = snapshot_day(splits).alias("date")
    per_listing = splits.groupBy("listing_id", day).agg(F.count(F.lit(1)).alias("obs"))
    return (
        listings.select("listing_id", snapshot_day(listings).alias("date"), "event_id")
        .join(per_listing, ["listing_id", "date"])
        .groupBy("event_id", "listing_id")
        .agg(F.sum("obs").alias("obs"))
        .groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("unique_listings"), F.sum("obs").alias("observations"))
    )


def count_mean(df: DataFrame, *keys: str, value: str = "indicator") -> DataFrame:
    """Rows and mean of ``value`` per key."""
    return df.groupBy(*keys).agg(F.count(value).alias("count"), F.avg(value).alias("mean"))


def value_counts(df: DataFrame, column: str, share: bool = False) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    if not share:
        return counts
    # The total is that of the counts, so both sides share one shuffle and the source is read once.
    return counts.withColumn("share", F.col("count") / counts.agg(F.sum("count")).scalar())


def distinct_per(df: DataFrame, key: str | Sequence[str], value: str, name: str) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.countDistinct(value).alias(name))


def labelled_acts(
    labels: DataFrame, listings: DataFrame, events: DataFrame, performers: DataFrame, *keys: str
) -> DataFrame:
    """Label rows per event (and ``keys``) beside the performers of the event.

    ``n`` and ``gone`` count the rows :func:`label_performers` would give for one
    performer row.  Counting before the join with the performers keeps the
    number of joined rows at events times performers.
    """
    shows = events.groupBy("event_id", "name").agg(F.count(F.lit(1)).alias("_copies"))
    counts = (
        with_listing(labels, listings, "event_id")
        .groupBy("event_id", *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("indicator").cast("long")).alias("gone"))
        .join(shows, "event_id")
        .withColumns({"n": F.col("n") * F.col("_copies"), "gone": F.col("gone") * F.col("_copies")})
        .drop("_copies")
    )
    return counts.join(performers.select("event_id", "performer_id", "performer_name", "role"), "event_id")


def performer_summary(acts: DataFrame) -> DataFrame:
    """Distinct events, distinct listings and gone rate per performer.

    ``acts`` are :func:`labelled_acts` per listing.
    """
    return acts.groupBy("performer_id", "performer_name").agg(
        F.countDistinct("event_id").alias("n_events"),
        F.countDistinct("listing_id").alias("n_listings"),
        (F.sum("gone") / F.sum("n")).alias("gone_rate"),
    )


def role_counts(acts: DataFrame) -> DataFrame:
    """Label rows per performer role; roles without a word count as 'None'."""
    return acts.groupBy(wordless_to(F.col("role")).alias("role")).agg(F.sum("n").alias("count"))


def column_sums(df: DataFrame) -> DataFrame:
    """Sum of every numeric column, one row."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return df.agg(*[F.sum(c).alias(c) for c in numeric])


def range_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, maximum and a 0/1 flag per column: one scan, one row per column."""
    stats = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo_{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(c).cast("double")).alias(f"hi_{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"lo_{i}").alias("min"), F.col(f"hi_{i}").alias("max"))
            for i, c in enumerate(columns)
        ]
    )
    return stats.select(F.explode(rows).alias("r")).select(
        "r.*", ((F.col("r.min") == 0) & (F.col("r.max") == 1)).alias("is_binary")
    )


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(
        F.sum((F.col(label) == 0).cast("long")).alias("n_0"),
        F.sum((F.col(label) == 1).cast("long")).alias("n_1"),
        F.avg((F.col(label) == 0).cast("int")).alias("share_0"),
        F.avg((F.col(label) == 1).cast("int")).alias("share_1"),
    )


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def column_range(df: DataFrame, column: str) -> tuple[float, float]:
    """Smallest and largest value of a column: one pass that returns one row."""
    row = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if row[0] is None:
        raise ValueError(f"{column} has no values to bin")
    return row[0], row[1]


def with_equal_bins(df: DataFrame, column: str, bins: int, name: str = "bin") -> DataFrame:
    """``df`` with an equal-width bin of ``column`` over its own range."""
    return df.withColumn(name, equal_width_bin(F.col(column), *column_range(df, column), bins))


def histogram(df: DataFrame, column: str, bins: int, *by: str) -> DataFrame:
    """Rows per equal-width bin with the edges of the bin, per group if asked."""
    bounds = column_range(df, column)
    low, high = spread_bounds(*bounds)
    step = (high - low) / bins
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(*by, equal_width_bin(F.col(column), *bounds, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("lower", F.lit(low) + (F.col("bin") - 1) * F.lit(step))
        .withColumn("upper", F.lit(low) + F.col("bin") * F.lit(step))
    )


def binned_rate(df: DataFrame, column: str, bins: int | Sequence[float]) -> DataFrame:
    """Rows and gone rate per bin; an int asks for equal widths, a list gives the edges."""
    if isinstance(bins, int):
        binned = with_equal_bins(df, column, bins)
    else:
        binned = df.withColumn("bin", edge_bin(F.col(column), bins))
    return count_mean(binned.filter(F.col("bin").isNotNull()), "bin")


def performers_per_event(acts: DataFrame) -> DataFrame:
    """Distinct performers per event, their bin, and the event's label rows and rate."""
    per_event = acts.groupBy("event_id", "name").agg(
        F.countDistinct("performer_id").alias("performer_count"),
        F.sum("n").alias("count"),
        F.sum("gone").alias("gone"),
        (F.sum("gone") / F.sum("n")).alias("mean"),
    )
    return per_event.withColumn("perf_count_bin", edge_bin(F.col("performer_count"), PERFORMER_EDGES))


def top_event_rates(rates: DataFrame, n: int = 10) -> DataFrame:
    """Rows of the ``n`` events with most listings, for a chart of rate by day."""
    best = top_levels(rates, "event_id", F.avg("event_listing_n"), n)
    return rates.join(best.select("event_id"), "event_id", "left_semi")

