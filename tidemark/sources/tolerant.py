"""Raw days whose objects miss fields, carry odd types, or are no JSON at all.

Each line is parsed once into a variant, and one cast takes all fields of the schema from it. The cast goes part
by part: a field that is missing or can't be read as its type is NULL and costs nothing else of the object.
Lines that are no object, or an object without its key, go to quarantine as they are, with the reason.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

QUARANTINE = "line string, reason string, snapshot_date date"


def picked(value: Column, kind: StructType) -> Column:
    """A variant as ``kind``, part by part: what does not fit is NULL, the rest stays; NULL for what is no object."""
    return F.try_variant_get(value, "$", kind.simpleString())


def read_lines(spark: SparkSession, path: str, dates: Sequence[dt.date] | None = None) -> DataFrame:
    """line, snapshot_date of the days asked for."""
    schema = StructType.fromDDL("value string").add("snapshot_date", DateType())
    lines = spark.read.schema(schema).text(path).withColumnRenamed("value", "line")
    return lines if dates is None else lines.filter(F.col("snapshot_date").isin(list(dates)))


def read_tolerant(lines: DataFrame, schema: StructType, key: str) -> tuple[DataFrame, DataFrame]:
    """The objects with the fields of ``schema``, and the lines that are none.

    ``key`` is the field no object can do without. Blank lines are neither. Both frames read ``lines``.
    """
    # As the one element of an array: a filter on a plain column would parse the line a second time.
    value = F.explode(F.array(F.try_parse_json("line"))).alias("_v")
    parsed = lines.filter(F.trim("line") != "").select("line", "snapshot_date", value)
    # Tells objects and their key apart from the rest without reading the other fields.
    keyed = picked(F.col("_v"), StructType([schema[key]]))
    good = parsed.filter(keyed[key].isNotNull()).select(picked(F.col("_v"), schema).alias("_o"), "snapshot_date")
    good = good.select("_o.*", "snapshot_date")
    reason = F.when(F.col("_v").isNull(), "no JSON").when(keyed.isNull(), "no object").when(keyed[key].isNull(), "no key")
    bad = parsed.select("line", reason.alias("reason"), "snapshot_date").filter("reason IS NOT NULL")
    return good, bad


def quarantine(bad: DataFrame, path: str) -> None:
    """Keeps the lines of the days they came with; days written again are replaced."""
    bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)
