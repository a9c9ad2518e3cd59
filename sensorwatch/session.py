"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: A partition of a join beyond this size is split, also where all are as large, as when the rows grow and the number of partitions stays.
JOIN_SPLITS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
}

# Runtime settings only: nothing here depends on the size of one cluster.
SETTINGS = {
    **JOIN_SPLITS,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "sensorwatch", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def split_large_joins(spark: SparkSession) -> None:
    """The same for a session that was built elsewhere."""
    for key, value in JOIN_SPLITS.items():
        spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a local folder is made up only for a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="sensorwatch-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/sensorwatch/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Used where an expensive result feeds several plans. The files outlive any executor, later
    plans prune columns on them, and the lineage ends at the scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
