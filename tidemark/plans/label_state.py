"""The label kept up to date: each day closes what it shows again, and no earlier day is read anew.

Two tables under one root. ``open/as_of=day`` holds one row per key that no day up to then has shown again:
its last day, its copies on that day and, once the following day has told, how many label rows each copy
stands for (``times``: rows of its listing whose event was seen on that following day). ``closed`` holds the
rows flagged 0, as counts, in the folder of the day that closed them.

Day D reads the open keys, its own observations and summary, and the listings of the day before. Of a key last
seen on the day before, all copies but one are closed; keys that D shows again are closed; keys of D open.
The rows flagged 1 are the open keys themselves, so nothing already written ever changes. A day
that is run again replaces its own two folders and gives the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.dates import snapshot_day, snapshot_text
from tidemark.operators.keyed import repeat_rows
from tidemark.plans.label import observed_next_day, reserved_seats
from tidemark.session import subfolders
from tidemark.sources.snapshots import read_if_present

KEY = ["listing_id", "ticket_splits_option"]
OPEN = "listing_id long, ticket_splits_option int, date date, copies long, times long"
CLOSED = "listing_id long, ticket_splits_option int, date date, n long, closed_on date"


def close_day(
    state: DataFrame, splits: DataFrame, listings_before: DataFrame, summary: DataFrame, day: dt.date
) -> tuple[DataFrame, DataFrame]:
    """Rows flagged 0 that ``day`` closes, with their number ``n``, and the keys open after it.

    ``splits`` and ``summary`` are those of ``day``, ``listings_before`` those of the day before it.
    """
    before = F.lit(day) - F.expr("INTERVAL 1 DAY")
    told = (
        observed_next_day(reserved_seats(listings_before), summary)
        .groupBy(F.col("listing_id").alias("_listing"))
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    shown = splits.groupBy(*[F.col(k).alias(f"_{k}") for k in KEY]).agg(F.count(F.lit(1)).alias("_copies"))
    same_key = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY]
    yesterday = F.col("date") == before
    # A key that the day after its last day did not tell about has no label rows, now or later.
    times = F.when(yesterday, F.col("_times")).otherwise(F.col("times"))
    known = (
        state.join(told, F.col("listing_id") == F.col("_listing"), "left")
        .withColumn("times", times)
        .filter(F.col("times") > 0)
        .join(shown, same_key, "left")
    )
    again = F.col("_copies").isNotNull()
    n_closed = F.col("times") * (F.when(yesterday, F.col("copies") - 1).otherwise(0) + again.cast("long"))
    closed = known.select(*KEY, "date", n_closed.alias("n")).filter("n > 0")
    still_open = known.filter(~again).select(*KEY, "date", F.lit(1).cast("long").alias("copies"), "times")
    opened = shown.select(
        *[F.col(f"_{k}").alias(k) for k in KEY],
        F.lit(day).alias("date"),
        F.col("_copies").alias("copies"),
        F.lit(None).cast("long").alias("times"),
    )
    return closed, still_open.unionByName(opened)


def _of_day(table: DataFrame, day: dt.date) -> DataFrame:
    return table.filter(snapshot_day(table) == F.lit(day))


def advance(spark: SparkSession, root: str, splits: DataFrame, listings: DataFrame, summary: DataFrame, day: dt.date) -> None:
    """Takes in one day; days must come in order, a day may be repeated before the next one.

    The tables may hold any number of days: with a folder per day only those needed are read.
    """
    earlier = [d for d in subfolders(spark, f"{root}/open") if d < f"as_of={day}"]
    state = spark.read.schema(OPEN).parquet(f"{root}/open/{max(earlier)}") if earlier else spark.createDataFrame([], OPEN)
    of_day = _of_day(splits, day)
    eve = _of_day(listings, day - dt.timedelta(days=1))
    closed, after = close_day(state, of_day, eve, _of_day(summary, day), day)
    closed.write.mode("overwrite").parquet(f"{root}/closed/closed_on={day}")
    after.write.mode("overwrite").parquet(f"{root}/open/as_of={day}")


def current_labels(spark: SparkSession, root: str) -> DataFrame:
    """The rows ``response_label`` gives over all days taken in so far."""
    closed = read_if_present(spark, f"{root}/closed", StructType.fromDDL(CLOSED))
    days = subfolders(spark, f"{root}/open")
    if closed is None or not days:
        raise ValueError("no day has been taken in")
    # After a day that was broken off its closed rows have no state yet: they belong to its repetition.
    last = max(days)
    gone = spark.read.schema(OPEN).parquet(f"{root}/open/{last}").filter("times > 0")
    seen_again = closed.filter(F.col("closed_on") <= F.lit(last.partition("=")[2]).cast("date"))
    rows = seen_again.select(*KEY, "date", F.lit(0).alias("indicator"), "n").unionByName(
        gone.select(*KEY, "date", F.lit(1).alias("indicator"), F.col("times").alias("n"))
    )
    dated = rows.withColumn("date_accessed", snapshot_text(F.col("date")))
    return repeat_rows(dated, "n").select(*KEY, "date_accessed", "date", "indicator")
