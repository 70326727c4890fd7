"""The label: a listing and split option that is never seen again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import snapshot_day, snapshot_text
from tidemark.operators.keyed import later_flags

# Names that mark general admission and parking.
EXCLUDED_SECTIONS = [
    "General Admission",
    "General Admission Floor",
    "Floor General Admission",
    "General Admission Standing 2",
    "General Admission Balcony",
    "GA",
    "PARKING PASS",
]
EXCLUDED_ZONES = [
    "General Admission",
    "Floor General Admission",
    "GA",
    "General Admission Floor",
    "Main Floor General Admission",
    "General Admission Balcony",
    "Pit GA",
    "GA Floor",
    "GA Balcony",
    "Mezzanine GA",
    "Balcony GA",
]


def reserved_seats(listings: DataFrame) -> DataFrame:
    """Listings with assigned seats; rows with an unknown section or zone are left out too."""
    return listings.filter(
        ~F.col("is_ga")
        & ~F.col("section_name").isin(EXCLUDED_SECTIONS)
        & ~F.col("zone_name").isin(EXCLUDED_ZONES)
    )


def observed_next_day(listings: DataFrame, summary: DataFrame) -> DataFrame:
    """``listing_id, date`` of listings whose event was seen again on the following day."""
    day = listings.select("listing_id", "event_id", snapshot_day(listings).alias("date"))
    seen = summary.select("event_id", F.date_sub(snapshot_day(summary), 1).alias("date"))
    return day.join(seen, ["event_id", "date"]).select("listing_id", "date")


def response_label(splits: DataFrame, listings: DataFrame, summary: DataFrame) -> DataFrame:
    """``listing_id, ticket_splits_option, date_accessed, date, indicator`` (1 = gone).

    Rows whose event has no snapshot on the next day are dropped: nothing is
    known about them.  The joins with listings and summary come first, on
    listing level, so that the wider split level joins only once.
    """
    dated = splits.select("listing_id", "ticket_splits_option", snapshot_day(splits).alias("date"))
    flags = later_flags(dated, ["listing_id", "ticket_splits_option"], "date")
    return flags.join(
        observed_next_day(reserved_seats(listings), summary), ["listing_id", "date"]
    ).select(
        "listing_id",
        "ticket_splits_option",
        snapshot_text(F.col("date")).alias("date_accessed"),
        "date",
        "indicator",
    )


def gone_rate(labels: DataFrame, *keys: str) -> DataFrame:
    """Rows, gone rows and gone rate per key."""
    return labels.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("indicator").cast("long")).alias("n_gone"),
        F.avg("indicator").alias("gone_rate"),
    )
