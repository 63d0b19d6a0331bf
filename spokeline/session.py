"""Session settings the library relies on, and the shared folder it may write to."""

import tempfile
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    # Table timestamps are UTC wall clocks.
    "spark.sql.session.timeZone": "UTC",
    # A JSON object that repeats a key keeps the last value instead of failing to parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The JVM never compiles methods beyond 8000 bytes; wide JSON projections would be one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Parquet files keep common paths of a VARIANT as columns, and scans read only the paths in use.
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
}

#: Splits for each core from which on rows stay where they are, and the tasks they are else dealt to.
SPLITS_PER_CORE = 2
SPREAD_BYTES = 4 << 20
SPREAD_TASKS = 16


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def utc(instant: datetime) -> Column:
    """A UTC wall clock time as a literal, whatever the time zone of this process."""
    return F.lit(instant.isoformat(sep=" ")).cast("timestamp")


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables and stream checkpoints.

    It lies in the shared folder the cluster names in spark.checkpoint.dir. Only a local
    session without that setting falls back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{base.rstrip('/')}/spokeline/{name}-{uuid.uuid4().hex}"


def estimated_size(df: DataFrame) -> int:
    """Bytes that Catalyst expects df to have, from file sizes and statistics."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame) -> DataFrame:
    """df on all cores before costly row-by-row work, in tasks of SPREAD_BYTES at most SPREAD_TASKS times
    their number, if it may be too small to be split well.

    A file is split at its row groups, which may be as large as a split. So only what has several splits
    for each core has enough of its own and is not shuffled.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = estimated_size(df)
    if df.isStreaming or size > SPLITS_PER_CORE * cores * split:
        return df
    return df.repartition(min(max(cores, -(-size // SPREAD_BYTES)), SPREAD_TASKS * cores))
