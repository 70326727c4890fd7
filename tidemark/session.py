"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Sized by the cluster at run time: AQE coalesces small partitions and splits
# the hot ones, so shuffle.partitions is left to the deployment.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where that is not set, as in tests, it is set to a new folder in the
    warehouse, which executors share too; it goes when the session ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staged-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, none where it does not exist."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(where) if s.isDirectory())


def stage_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Use it for a frame that several later jobs read (the label table, scored
    rows): it cuts the lineage and survives the loss of executors.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
