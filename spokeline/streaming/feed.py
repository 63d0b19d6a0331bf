"""Snapshot feed: landed exports to classified, keyed messages."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spokeline.operators.records import build_messages
from spokeline.sources.exports import explode_records

POLL = "60 seconds"


def start_feed(
    exports: DataFrame,
    publish: Callable[[DataFrame, int], None],
    rejects_path: str,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Publish the messages of every new export; records that make none go to rejects_path."""

    def process(batch: DataFrame, batch_id: int) -> None:
        built = build_messages(explode_records(batch), F.current_timestamp()).persist()
        try:
            publish(built.filter(F.col("reason").isNull()).select("key", "value"), batch_id)
            rejects = built.filter(F.col("reason").isNotNull())
            rejects.select(
                "source", "pos", "raw", "reason", F.current_timestamp().alias("rejected_at")
            ).write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
        finally:
            built.unpersist()

    trigger = {"availableNow": True} if available_now else {"processingTime": POLL}
    return (
        exports.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
