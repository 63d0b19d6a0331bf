"""Topics: the Kafka connector, and folders that stand in for a topic without one."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline.schemas import MESSAGE


def kafka_source(
    spark: SparkSession, servers: str, topic: str, max_offsets: int = 1_000_000
) -> DataFrame:
    """New records of a topic. Needs the Kafka connector package on the classpath."""
    reader = spark.readStream.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic}
    )
    reader = reader.option("startingOffsets", "latest").option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(*MESSAGE.names)


def folder_source(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


KEY_PARTS = 8


def kafka_sink(servers: str, topic: str) -> Callable[[DataFrame, int], None]:
    """Publish key and value, at least once. Needs the Kafka connector package."""

    def publish(messages: DataFrame, batch_id: int) -> None:
        writer = messages.select("key", "value").write.format("kafka")
        writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return publish


def folder_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Key and value as JSON files, a folder for each batch; partition is a hash of the key, so all
    records of a key have the same. Publishing a batch again replaces it. There are no offsets, as there is no broker to give them."""

    def publish(messages: DataFrame, batch_id: int) -> None:
        numbered = messages.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            F.pmod(F.xxhash64("key"), F.lit(KEY_PARTS)).cast("int").alias("partition"),
            F.current_timestamp().alias("timestamp"),
        )
        numbered.write.mode("overwrite").json(f"{path}/batch={batch_id}")

    return publish
