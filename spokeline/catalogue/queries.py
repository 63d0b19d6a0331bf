"""Every operator and result as a query over the given tables."""

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline import schemas
from spokeline.catalogue import standins
from spokeline.catalogue.standins import AS_OF, NOW, as_of, plain_times, table
from spokeline.functions import coerce, metrics
from spokeline.operators import records, rollups
from spokeline.operators.keyed import fold, latest_one, upsert
from spokeline.plans import batch, quality, views
from spokeline.session import configure, utc, work_folder
from spokeline.sources.exports import explode_records, read_array_elements, read_exports
from spokeline.sources.tables import DayTable, KeyedTable, StoredTable
from spokeline.streaming import feed, ingest, topics


#: Records of a landed file in export_files.
EXPORT_SIZE = 1000
#: By how much a second load changes the values of the events.
CHANGE = 7


def _since(hours: int):
    return metrics.hours_before(as_of(), hours)


def _current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.current_status(standins.stations(spark, sf_dir), standins.status(spark, sf_dir))


def _rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = standins.stations(spark, sf_dir)
    latest = rollups.latest_counts(
        standins.status(spark, sf_dir), ["event_id"], stations=stations
    )
    snapshot_time = F.date_trunc("minute", as_of())
    return rollups.district_rollup(stations, latest, snapshot_time)


def district_rollup(spark, sf_dir):
    return plain_times(_rollup(spark, sf_dir))


def _trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.hourly_trend(standins.status(spark, sf_dir, _since(24)), as_of())


def hourly_trend(spark, sf_dir):
    return plain_times(_trend(spark, sf_dir))


def hourly_trend_station(spark, sf_dir):
    """The station is the bound parameter of this result."""
    return plain_times(views.station_trend(_trend(spark, sf_dir), "7", NOW))


def current_status(spark, sf_dir):
    return plain_times(_current(spark, sf_dir))


def latest_status_one(spark, sf_dir):
    rows = standins.status(spark, sf_dir)
    return plain_times(latest_one(rows, ["station_code"], "ingested_at", ["event_id"]))


def critical_stations(spark, sf_dir):
    return plain_times(views.critical_stations(_current(spark, sf_dir)))


def critical_stations_view(spark, sf_dir):
    """Through the named views."""
    stations, status = standins.stations(spark, sf_dir), standins.status(spark, sf_dir)
    views.register_views(spark, stations, status, as_of())
    return plain_times(views.query(spark, "SELECT * FROM v_critical_stations"))


def top_active_stations(spark, sf_dir):
    return views.top_active_stations(standins.status(spark, sf_dir, _since(24)), as_of())


def kpi_summary(spark, sf_dir):
    return views.kpis(_current(spark, sf_dir))


def kpi_empty(spark, sf_dir):
    """No station rents."""
    current = _current(spark, sf_dir).withColumn("is_renting", F.col("capacity") < 0)
    return views.kpis(current)


def kpi_cards(spark, sf_dir):
    return views.kpi_cards(views.kpis(_current(spark, sf_dir)))


def station_map(spark, sf_dir):
    return views.station_map(_current(spark, sf_dir))


def _rollup_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollups of every hour, each of the rows loaded at that hour."""
    rows = standins.status(spark, sf_dir).withColumn("hour", F.col("ingested_at"))
    latest = rollups.latest_counts(rows, ["event_id"], ["station_code", "hour"])
    return rollups.district_rollup(standins.stations(spark, sf_dir), latest, F.col("hour"))


def district_history(spark, sf_dir):
    return plain_times(_rollup_history(spark, sf_dir))


def district_latest_snapshot(spark, sf_dir):
    return plain_times(views.latest_districts(_rollup_history(spark, sf_dir)))


def district_stored_snapshot(spark, sf_dir):
    """The same from the stored history."""
    stored = _district_table(spark)
    stored.replace(_rollup_history(spark, sf_dir))
    return plain_times(views.latest_stored_districts(stored))


def district_long(spark, sf_dir):
    return views.district_bars(_rollup(spark, sf_dir))


def fill_labels(spark, sf_dir):
    return views.district_labels(_rollup(spark, sf_dir))


def _classified_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standins.event_rows(spark, sf_dir)
    return rows.withColumn(
        "event_type",
        metrics.classify_event(F.col("num_bikes_available"), F.col("num_docks_available")),
    )


def recent_events(spark, sf_dir):
    return plain_times(views.recent_events(_classified_events(spark, sf_dir), ["event_id"]))


def recent_stored_events(spark, sf_dir):
    """The same from a table partitioned by day."""
    folder = work_folder(spark, "events")
    rows = _classified_events(spark, sf_dir).withColumn("day", F.to_date("consumed_at"))
    rows.repartition("day").write.partitionBy("day").parquet(folder)
    events = spark.read.parquet(folder)
    return plain_times(views.recent_stored_events(events, ["event_id"], "day"))


def classify_events(spark, sf_dir):
    rows = standins.event_rows(spark, sf_dir)
    event_type = metrics.classify_event(F.col("num_bikes_available"), F.col("num_docks_available"))
    return rows.select(
        "event_id", event_type.alias("event_type"),
        metrics.alert_colour(event_type).alias("alert_colour"),
    )


def fill_rate_rows(spark, sf_dir):
    rows = standins.status(spark, sf_dir)
    rate = metrics.fill_rate(F.col("num_bikes_available"), F.col("num_docks_available"))
    return rows.select(
        "event_id", rate.alias("fill_rate_pct"), metrics.colour_scale(rate).alias("colour_value")
    )


def district_parse(spark, sf_dir):
    padded = F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit("\t"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", padded.alias("padded"))
    codes = orders.selectExpr("o_orderkey", f"{coerce.strip('padded')} AS code")
    return codes.selectExpr("o_orderkey", f"{coerce.district('code')} AS arrondissement")


def payload_fields(spark, sf_dir):
    parsed = records.parse_messages(standins.messages(table(spark, sf_dir, "events")), as_of())
    return parsed.select(
        "offset", "station_code", "event_type", "num_bikes_available", "num_docks_available",
        "num_ebikes", F.try_variant_get("payload", "$.extra", "int").alias("extra"), "reason",
    )


def payload_stored(spark, sf_dir):
    """A field of the payload, from the archive of the event table by day."""
    messages = standins.messages(table(spark, sf_dir, "events"))
    parsed = records.parse_messages(messages, F.col("timestamp")).where("reason IS NULL")
    archive = ingest.event_archive(spark, work_folder(spark, "archive"))
    archive.replace(parsed.withColumn("consumed_date", F.to_date("consumed_at")).hint("rebalance", "consumed_date"))
    found = ingest.payload_columns(archive.read(), {"extra": ("$.extra", "int"), "bikes": ("$.num_bikes_available", "int")})
    return found.select("offset", "station_code", "extra", "bikes", "consumed_date")


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    exports = standins.exports(table(spark, sf_dir, "events"))
    return records.parse_records(explode_records(exports), as_of())


def export_parse(spark, sf_dir):
    """The station and status columns of all good records."""
    rows = records.accepted_rows(_parsed(spark, sf_dir))
    return plain_times(rows.drop("pos", "reason", "raw"))


def export_rejects(spark, sf_dir):
    return records.reject_rows(_parsed(spark, sf_dir)).select("source", "pos", "reason")


_MESSAGE_FIELDS = (
    "station_code string, name string, num_bikes_available int, num_docks_available int, "
    "num_ebikes int, num_mechanical int, capacity int, is_renting boolean, lat string, "
    "lon string, produced_at string, event_type string"
)


def _message_columns(messages: DataFrame) -> DataFrame:
    """Message texts back as columns; names and coordinates as the text they have there."""
    value = F.from_json(F.col("value").cast("string"), _MESSAGE_FIELDS)
    fields = messages.select(F.col("key").cast("string").alias("key"), value.alias("m"))
    return fields.select("key", "m.*").withColumns(
        {"lat": F.col("lat").try_cast("double"), "lon": F.col("lon").try_cast("double")}
    )


def message_json(spark, sf_dir):
    exports = standins.exports(table(spark, sf_dir, "events"))
    built = records.build_messages(explode_records(exports), as_of())
    return _message_columns(built.where("reason IS NULL").select("key", "value"))


def status_upsert(spark, sf_dir):
    changes = table(spark, sf_dir, "lineitem")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    keep_first = ["l_returnflag", "l_linestatus"]
    return fold(changes, ["l_orderkey", "l_linenumber"], order, keep_first)


def _station_changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    base = standins.stations(spark, sf_dir)
    changes = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") * 2).cast("string").alias("station_code"),
        F.col("o_orderpriority").alias("name"),
        F.floor("o_totalprice").cast("int").alias("capacity"),
        F.lit(None).cast("double").alias("lat"),
        F.col("o_totalprice").alias("lon"),
        F.lit(1).alias("arrondissement"),
        "o_orderdate",
        "o_orderkey",
    )
    return base, changes


def stations_upsert(spark, sf_dir):
    base, changes = _station_changes(spark, sf_dir)
    return upsert(base, changes, schemas.STATIONS_KEY, ["o_orderdate", "o_orderkey"])


def _district_table(spark: SparkSession) -> DayTable:
    root = work_folder(spark, "districts")
    return DayTable(spark, root, schemas.DISTRICTS, schemas.DISTRICTS_KEY, "snapshot_time")


def rollup_upsert_rerun(spark, sf_dir):
    """The district rollup stored twice in the same minute."""
    stored = _district_table(spark)
    for _ in range(2):
        stored.upsert(_rollup(spark, sf_dir))
    return plain_times(stored.read())


def trend_upsert(spark, sf_dir):
    """The hourly trend stored by two runs, half a day apart, the second over the first."""
    root = work_folder(spark, "hourly")
    stored = DayTable(spark, root, schemas.HOURLY, schemas.HOURLY_KEY, "hour_bucket")
    for run in (AS_OF - timedelta(hours=12), AS_OF):
        since = utc(run - timedelta(hours=24))
        stored.upsert(rollups.hourly_trend(standins.status(spark, sf_dir, since), utc(run)))
    return plain_times(stored.read())


STORED_STATUS = schemas.T.StructType([f for f in schemas.STATUS if f.name not in ("source", "pos")])


def _status_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All status rows, and all again an hour later with bikes and docks swapped and their flags turned;
    a third of those is reported a day later and so new."""
    rows = standins.status(spark, sf_dir).withColumns(
        {"is_installed": F.col("num_ebikes") > 2, "is_returning": F.col("num_ebikes") > 4}
    )
    hour = F.expr("INTERVAL 1 HOUR")
    moved = F.col("last_reported") + F.expr("if(event_id % 3 = 0, INTERVAL 1 DAY, INTERVAL 0 DAY)")
    changes = rows.withColumns(
        {
            "num_bikes_available": F.col("num_docks_available"),
            "num_docks_available": F.col("num_bikes_available"),
            "is_installed": ~F.col("is_installed"), "is_returning": ~F.col("is_returning"),
            "is_renting": ~F.col("is_renting"), "last_reported": moved,
            "ingested_at": F.col("ingested_at") + hour,
        }
    )
    return rows, changes


def status_table_upsert(spark, sf_dir):
    """A stored status table, in days and buckets of the station, after a second load."""
    stored = StoredTable(
        spark, work_folder(spark, "status"), STORED_STATUS, schemas.STATUS_KEY,
        "to_date(last_reported)", "date", bucket_by=["station_code"],
    )
    rows, changes = _status_loads(spark, sf_dir)
    stored.upsert(rows, ["event_id"])
    stored.upsert(changes, ["event_id"], schemas.STATUS_KEEP_FIRST)
    return plain_times(stored.read())


def stations_table_upsert(spark, sf_dir):
    """A stored station table in buckets, after an upsert."""
    base, changes = _station_changes(spark, sf_dir)
    stored = KeyedTable(spark, work_folder(spark, "stations"), base.schema, schemas.STATIONS_KEY)
    stored.replace(base.repartition(stored.buckets, *stored.bucket_by))
    stored.upsert(changes, ["o_orderdate", "o_orderkey"])
    return stored.read()


def dq_counts(spark, sf_dir):
    return quality.row_counts(
        standins.stations(spark, sf_dir), standins.status(spark, sf_dir, _since(1)),
        standins.event_rows(spark, sf_dir, _since(1)), as_of(),
    )


def key_checks(spark, sf_dir):
    """Keys of three tables: unique ones, the rollup's, and one that repeats."""
    return quality.stored_key_checks(
        {
            "stations": (standins.stations(spark, sf_dir), schemas.STATIONS_KEY),
            "trend": (_trend(spark, sf_dir), schemas.HOURLY_KEY),
            "lineitem": (table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]),
        }
    )


def stream_feed(spark, sf_dir):
    """Exports to a topic, as a stream over the events file; the topic read back."""
    folder = work_folder(spark, "feed")
    exports = standins.exports(standins.event_stream(configure(spark), sf_dir))
    feed.start_feed(
        exports, topics.folder_sink(f"{folder}/topic"), f"{folder}/rejects",
        f"{folder}/checkpoint", available_now=True,
    ).awaitTermination()
    topic = spark.read.schema(schemas.MESSAGE).json(f"{folder}/topic/*")
    return _message_columns(topic).drop("produced_at")


def stream_ingest(spark, sf_dir):
    """Topic messages to the event table, as a stream over the events file."""
    folder = work_folder(spark, "ingest")
    messages = standins.messages(standins.event_stream(configure(spark), sf_dir))
    ingest.start_ingest(
        messages, f"{folder}/events", f"{folder}/checkpoint", available_now=True
    ).awaitTermination()
    stored = ingest.read_events(spark, f"{folder}/events")
    return stored.drop("payload", "consumed_at", "consumed_date", "partition")


def stream_order(spark, sf_dir):
    """Messages published in two parts and ingested by a timed trigger, a limited number of files at a
    time: are the events of each station consumed in order?"""
    folder = work_folder(spark, "order")
    messages = standins.messages(table(spark, sf_dir, "events"))
    half = F.lit(messages.agg(F.max("offset")).first()[0] // 2)
    for n, part in enumerate((F.col("offset") <= half, F.col("offset") > half)):
        # All messages of a key are in one file of each part.
        messages.where(part).repartition("key").write.json(f"{folder}/topic/batch={n}")
    query = ingest.start_ingest(
        topics.folder_source(spark, f"{folder}/topic/*", files_per_trigger=3), f"{folder}/events",
        f"{folder}/checkpoint", every="1 second",
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return ingest.consumed_in_order(ingest.read_events(spark, f"{folder}/events")).drop("n_batches")


def batch_run(spark, sf_dir):
    """The whole batch run; the district rollup it stored."""
    root = work_folder(spark, "batch")
    exports = standins.exports(table(spark, sf_dir, "events"))
    batch.run_batch(configure(spark), exports, root, AS_OF)
    return plain_times(batch.Tables(spark, root).districts.read())


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """Files with the records of EXPORT_SIZE events each, as one array; their path."""
    folder = work_folder(spark, "landing")
    events = table(spark, sf_dir, "events")
    record = F.expr("substring(text, 2, length(text) - 2)")
    # A file for every EXPORT_SIZE events, so a group is no larger than that.
    group = F.floor(F.col("source").cast("long") / EXPORT_SIZE)
    texts = standins.exports(events).select(group.alias("file"), "source", record.alias("record"))
    arrays = texts.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("source", "record"))).alias("r"))
    text = F.concat(F.lit("["), F.array_join("r.record", ",\n"), F.lit("]"))
    arrays.select("file", text.alias("value")).repartition("file").write.partitionBy("file").text(folder)
    return f"{folder}/*/*.txt"


def _landed_rows(elements: DataFrame) -> DataFrame:
    """Good records of landed files, and their place in the file."""
    rows = records.accepted_rows(records.parse_records(elements, as_of()))
    number = F.regexp_extract("source", "file=([0-9]+)", 1).cast("long")
    return rows.select(number.alias("file"), "pos", "station_code", "num_bikes_available", "num_docks_available", "is_renting")


def export_files(spark, sf_dir):
    """Files with many records each, a text a file."""
    return _landed_rows(explode_records(read_exports(spark, _landed(spark, sf_dir))))


def export_elements(spark, sf_dir):
    """The same files, split at the records."""
    return _landed_rows(read_array_elements(spark, _landed(spark, sf_dir)))


def _loads(spark: SparkSession, sf_dir: str, loads: list[int]) -> batch.Tables:
    """The tables after some loads: 0 is all exports, 1 all of them with changed values, five minutes
    later."""
    root = work_folder(configure(spark), "batch")
    events = table(spark, sf_dir, "events")
    for load in loads:
        changed = events.withColumn("value", F.col("value") + CHANGE * load)
        batch.load_exports(batch.Tables(spark, root), standins.exports(changed), AS_OF + timedelta(minutes=5 * load))
    return batch.Tables(spark, root)


def batch_rerun(spark, sf_dir):
    """The station table after two loads and the first one again."""
    return plain_times(_loads(spark, sf_dir, [0, 1, 0]).stations.read().drop("source", "pos"))


def batch_status(spark, sf_dir):
    """The status table after two loads and the first one again."""
    return plain_times(_loads(spark, sf_dir, [0, 1, 0]).status.read().drop("source", "pos"))


def batch_rejects(spark, sf_dir):
    """The rejects of two loads."""
    tables = _loads(spark, sf_dir, [0, 1])
    return plain_times(tables.rejects.read().select("source", "pos", "reason", "rejected_at"))


QUERIES = {
    query.__name__: query
    for query in (
        district_rollup, hourly_trend, hourly_trend_station, current_status, latest_status_one,
        critical_stations, critical_stations_view, top_active_stations, kpi_summary, kpi_empty,
        kpi_cards, station_map, district_history, district_latest_snapshot, district_long,
        fill_labels, recent_events, classify_events, fill_rate_rows, district_parse,
        payload_fields, export_parse, export_rejects, message_json, status_upsert,
        stations_upsert, rollup_upsert_rerun, trend_upsert, dq_counts, stream_feed,
        stream_ingest, stream_order, payload_stored, batch_run, export_files, batch_rerun, batch_status, batch_rejects,
        status_table_upsert, stations_table_upsert, export_elements,
        district_stored_snapshot, recent_stored_events, key_checks,
    )
}
