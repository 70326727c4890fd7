"""Snapshot tables: dated folders, CSV files, appends and first-seen loads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.operators.parse import clean_events, clean_listings, event_tables, listing_tables
from tidemark.session import stage_table
from tidemark.sources.raw import read_events_json, read_listings_json


def table_path(root: str, name: str) -> str:
    group, _, rest = name.partition("_")
    return f"{root}/{group}/{rest}"


def write_snapshot(tables: dict[str, DataFrame], root: str) -> None:
    """Each table under its folder, one sub-folder per day; days written again are replaced."""
    for name, df in tables.items():
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("snapshot_date")
            .parquet(table_path(root, name))
        )


def read_snapshot(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(root, name))


def backfill(spark: SparkSession, raw_root: str, root: str, dates: Sequence[dt.date]) -> None:
    """Parses stored raw days again, all days in one job per table.

    The text is parsed and its copies removed once; the five tables of each
    kind read their columns from that staged result.
    """
    events = stage_table(clean_events(read_events_json(spark, raw_root, dates)), "events")
    write_snapshot(event_tables(events), root)
    listings = stage_table(clean_listings(read_listings_json(spark, raw_root, dates)), "listings")
    write_snapshot(listing_tables(listings), root)


def read_table_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = True) -> DataFrame:
    """Comma separated file with one header line; columns are taken by position.

    The header carries the names of the raw objects and is skipped.  Whole
    numbers may be written as ``2.0`` and texts padded with blanks.  Quoted line
    breaks need ``multi_line``; files known to have none can be split without it.
    """
    whole = (IntegerType, LongType)
    as_text = StructType(
        [StructField(f.name, StringType() if isinstance(f.dataType, whole) else f.dataType) for f in schema.fields]
    )
    raw = (
        spark.read.schema(as_text)
        .options(header=True, enforceSchema=True, quote='"', escape='"', multiLine=multi_line)
        .csv(path)
    )
    columns = []
    for f in schema.fields:
        column = F.col(f.name)
        if isinstance(f.dataType, whole):
            column = F.regexp_replace(column, r"\.0+$", "").cast(f.dataType)
        elif isinstance(f.dataType, StringType):
            column = F.rtrim(column)
        columns.append(column.alias(f.name))
    return raw.select(*columns)


def export_csv(df: DataFrame, path: str) -> None:
    """Replaces whatever was exported to ``path``."""
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def append_rows(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Both frames by column name; columns only one of them has are NULL in the other."""
    return target.unionByName(batch, allowMissingColumns=True)


def absent_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key ``target`` does not hold.

    Copies of a key inside the batch all survive, and so do rows with a NULL key.
    The keys of the target are first cut down to those of the batch: a day is
    small beside the history, so the history is scanned but not shuffled when
    the day's keys fit a broadcast (adaptive execution checks their size).
    """
    keys = list(keys)
    known = target.select(*keys).join(batch.select(*keys).distinct(), keys, "left_semi").distinct()
    return batch.join(known, keys, "left_anti")


def insert_absent(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], day: dt.date
) -> None:
    """Adds the rows of one day whose key no earlier day holds.

    Writes the folder of that day only and compares with earlier days only, so
    running a day again after a failure gives the same table.
    """
    rows = batch.drop("snapshot_date")
    stored = read_if_present(spark, path, StructType([*rows.schema.fields, StructField("snapshot_date", DateType())]))
    if stored is not None:
        rows = absent_rows(stored.filter(F.col("snapshot_date") < F.lit(day)), rows, keys)
    write_snapshot_day(rows, path, day)


def write_snapshot_day(df: DataFrame, path: str, day: dt.date) -> None:
    (
        df.drop("snapshot_date")
        .withColumn("snapshot_date", F.lit(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )


def read_if_present(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The table under ``path``, or None before its first load."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
