"""Event ingest: topic messages to the event table."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spokeline import schemas
from spokeline.operators.records import parse_messages
from spokeline.sources.tables import StoredTable

FLUSH = "5 seconds"


def start_ingest(
    messages: DataFrame, path: str, checkpoint: str, available_now: bool = False,
    unique_within: str | None = None, every: str = FLUSH,
) -> StreamingQuery:
    """Append every message to the table at path, each exactly once per checkpoint.

    Good events and rejects are partitions of one table, so one pass over the topic and one
    commit write both. unique_within leaves out messages that were published again within that time.
    A batch begins at most once every interval and takes what the source's rate limit allows.
    """
    if unique_within:
        messages = without_duplicates(messages, unique_within)
    shaped = (
        parse_messages(messages, F.current_timestamp())
        .withColumn("accepted", F.col("reason").isNull())
        .withColumn("consumed_date", F.to_date("consumed_at"))
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return (
        shaped.writeStream.format("parquet")
        .partitionBy("accepted", "consumed_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def without_duplicates(messages: DataFrame, within: str) -> DataFrame:
    """The messages without those that were published before with the same key and value, within the
    given time of each other by their timestamps.

    Delivery is at least once, so a producer that starts again may publish twice. The state holds a
    digest per message for that long, dealt out by the digest, and forgets it then."""
    digest = F.sha2(F.concat_ws("\u0000", F.col("key").cast("string"), F.col("value").cast("string")), 256)
    known = messages.withColumn("_digest", digest).withWatermark("timestamp", within)
    return known.dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")


def event_archive(spark: SparkSession, path: str) -> StoredTable:
    """Closed days of the event table, a partition a day; one writer at a time."""
    columns = [f for f in schemas.STORED_EVENTS if f.name not in ("accepted", "reason", "raw")]
    return StoredTable(spark, path, schemas.T.StructType(columns), ["partition", "offset"], "consumed_date", "date")


def archive_closed_days(spark: SparkSession, path: str, archive: StoredTable, today: date) -> list[date]:
    """Write the days before today that the archive doesn't have from the sink's many small files as few
    large ones; returns these days. Days of a lost run are written again as a whole."""
    events = read_events(spark, path).where(F.col("consumed_date") < F.lit(today))
    newest = archive.with_parts().agg(F.max("part")).first()[0]
    if newest is not None:
        events = events.where(F.col("consumed_date") > F.lit(newest))
    days = sorted(r[0] for r in events.select("consumed_date").distinct().collect())
    if days:
        # Spark makes files of the advisory size, of a large day several.
        archive.replace(events.hint("rebalance", "consumed_date"))
    return days


def read_all_events(spark: SparkSession, path: str, archive: StoredTable) -> DataFrame:
    """The event table: closed days from the archive, and the days since from the sink."""
    closed = archive.with_parts()
    newest = closed.select(F.coalesce(F.max("part"), F.lit("0001-01-01").cast("date"))).scalar()
    open_days = read_events(spark, path).where(F.col("consumed_date") > newest)
    return closed.select(*open_days.columns).unionByName(open_days)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The event table, with partition and offset for the order of one consume time."""
    stored = spark.read.schema(schemas.STORED_EVENTS).parquet(path).filter("accepted")
    return stored.select(*schemas.EVENTS.names, "partition", "offset", "consumed_date")


def payload_columns(events: DataFrame, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """The events with a column per path, name to (path, type), in place of the payload.

    Null where a message lacks the path or holds something that isn't of the type. Stored payloads are
    shredded, so a scan reads these paths and not the whole messages."""
    found = [F.try_variant_get("payload", path, kind).alias(name) for name, (path, kind) in paths.items()]
    return events.select(*(c for c in events.columns if c != "payload"), *found)


def consumed_in_order(events: DataFrame) -> DataFrame:
    """station_code, n_events, n_batches and in_order: no later batch consumed an earlier offset.

    events: the event table; those of a batch share their consume time. Batches are aggregated before
    they are compared, so the window holds a row per batch of a station, however many events it has."""
    batches = events.groupBy("station_code", "partition", "consumed_at").agg(
        F.count("*").alias("n"), F.min("offset").alias("first"), F.max("offset").alias("last")
    )
    earlier = Window.partitionBy("station_code", "partition").orderBy("consumed_at")
    highest = F.max("last").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    later = batches.withColumn("later", F.coalesce(F.col("first") > highest, F.lit(True)))
    return later.groupBy("station_code").agg(
        F.sum("n").alias("n_events"), F.count_distinct("consumed_at").alias("n_batches"), F.bool_and("later").alias("in_order")
    )


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.schema(schemas.STORED_EVENTS).parquet(path).filter("NOT accepted")
    return stored.select(
        F.lit("topic").alias("source"), "partition", "offset", "raw", "reason",
        F.col("consumed_at").alias("rejected_at"),
    )
