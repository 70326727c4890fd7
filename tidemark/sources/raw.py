"""Raw snapshots: JSON lines under ``<root>/<kind>/snapshot_date=YYYY-MM-DD/``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tidemark.schemas import EVENT_SCHEMA, LISTING_SCHEMA


def read_events_json(spark: SparkSession, root: str, dates: Sequence[dt.date] | None = None) -> DataFrame:
    return _read(spark, f"{root}/events", EVENT_SCHEMA, dates)


def read_listings_json(spark: SparkSession, root: str, dates: Sequence[dt.date] | None = None) -> DataFrame:
    return _read(spark, f"{root}/listings", LISTING_SCHEMA, dates)


def read_day(spark: SparkSession, path: str, schema: StructType, day: dt.date) -> DataFrame:
    """One file of a day that is not kept in a dated folder."""
    return spark.read.schema(schema).json(path).withColumn("snapshot_date", F.lit(day))


def _read(spark: SparkSession, path: str, schema: StructType, dates) -> DataFrame:
    # A new list: adding to StructType(schema.fields) would change the shared schema.
    with_day = StructType([*schema.fields, StructField("snapshot_date", DateType())])
    df = spark.read.schema(with_day).json(path)
    # A filter on the folder column: only the asked days are listed and read.
    return df if dates is None else df.filter(F.col("snapshot_date").isin(list(dates)))


def write_raw(df: DataFrame, root: str, kind: str) -> None:
    """Adds the objects to the folders of their days, compressed: the names of the fields come with every object."""
    df.write.mode("append").option("compression", "gzip").partitionBy("snapshot_date").json(f"{root}/{kind}")
