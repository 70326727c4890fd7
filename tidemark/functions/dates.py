"""Date columns: snapshot days are text ``YYYY_MM_DD``, event times local text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SNAPSHOT_PATTERN = "yyyy_MM_dd"


def snapshot_date(text: Column) -> Column:
    return F.to_date(text, SNAPSHOT_PATTERN)


def snapshot_text(day: Column) -> Column:
    return F.date_format(day, SNAPSHOT_PATTERN)


def snapshot_day(df: DataFrame) -> Column:
    """Snapshot day of a table: the folder column where there is one, else its text.

    The folder column needs no parsing and lets the scan skip days.
    """
    if "snapshot_date" in df.columns:
        return F.col("snapshot_date")
    return snapshot_date(F.col("date_accessed"))


def local_date(text: Column) -> Column:
    """Day of a local timestamp text; whatever follows the day is ignored."""
    return F.to_date(F.substring(text, 1, 10))


def days_until(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def day_of_week(day: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(day) - F.lit(1)
