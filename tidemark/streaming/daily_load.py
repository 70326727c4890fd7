"""Daily files as they arrive: the first-seen load driven by a file stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.operators.keyed import first_seen
from tidemark.sources.snapshots import absent_rows, read_if_present


def load_new_days(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    keys: Sequence[str],
    checkpoint: str,
    batch_column: str = "snapshot_date",
) -> StreamingQuery:
    """Reads the parquet files not read before, inserts rows with new keys, stops.

    A micro-batch may hold several days: the earliest day wins inside it.  Each
    micro-batch owns one folder of the target and looks only at the folders of
    earlier ones, so a repeated micro-batch replaces its own rows.
    """

    def insert(batch: DataFrame, batch_id: int) -> None:
        fresh = first_seen(batch, keys, batch_column)
        stored = read_if_present(spark, target, StructType([*schema.fields, StructField("load_id", LongType())]))
        if stored is not None:
            fresh = absent_rows(stored.filter(F.col("load_id") < batch_id), fresh, keys)
        fresh.withColumn("load_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("load_id").parquet(target)

    return (
        spark.readStream.schema(schema)
        .parquet(source)
        .writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
