"""Feed and ingest over landed files: one topic folder in between."""

import json
from datetime import date
from pathlib import Path

from conftest import plan_of
from pyspark.sql import functions as F

from spokeline.operators import records
from spokeline.plans import views
from spokeline.sources.exports import explode_records, read_exports, stream_exports
from spokeline.streaming import feed, ingest, topics


def land(folder, name, *elements):
    with open(f"{folder}/landing/{name}.json", "w") as file:
        json.dump(elements, file)


def pump(spark, folder):
    """Everything that has landed, through the topic, to the event table."""
    feed.start_feed(
        stream_exports(spark, f"{folder}/landing", files_per_trigger=1),
        topics.folder_sink(f"{folder}/topic"), f"{folder}/feed_rejects",
        f"{folder}/feed_checkpoint", available_now=True,
    ).awaitTermination()
    ingest.start_ingest(
        topics.folder_source(spark, f"{folder}/topic/*"), f"{folder}/events",
        f"{folder}/ingest_checkpoint", available_now=True,
    ).awaitTermination()
    return ingest.read_events(spark, f"{folder}/events")


def station(code, bikes, docks=5):
    return {"stationcode": code, "numbikesavailable": bikes, "numdocksavailable": docks}


def test_stream_equals_batch_and_runs_once(spark, folder):
    Path(f"{folder}/landing").mkdir()
    land(folder, "a", station("1", 0), station("2", 2), station("3", "x"), station("4", 5, 0))
    land(folder, "b", station("1", 7), {"numbikesavailable": 1})
    columns = ["station_code", "event_type", "num_bikes_available", "num_docks_available"]
    expected = [("", "low_bikes", 1, 0), ("1", "empty_station", 0, 5), ("1", "snapshot", 7, 5),
                ("2", "low_bikes", 2, 5), ("4", "full_station", 5, 0)]
    events = pump(spark, folder)
    assert sorted(map(tuple, events.select(columns).collect())) == expected

    built = records.build_messages(
        explode_records(read_exports(spark, f"{folder}/landing")), F.current_timestamp()
    ).filter("reason IS NULL")
    topic = built.select("value", F.lit(0).alias("partition"), F.lit(0).alias("offset"))
    batch = records.parse_messages(topic, F.current_timestamp())
    assert sorted(map(tuple, batch.select(columns).collect())) == expected

    # A second run on the same checkpoints adds nothing; a new file adds only itself.
    assert pump(spark, folder).count() == 5
    land(folder, "c", station("9", 3))
    events = pump(spark, folder)
    assert events.count() == 6
    rejects = spark.read.parquet(f"{folder}/feed_rejects/*")
    assert [row["reason"] for row in rejects.collect()] == ["num_bikes_available is not an integer"]

    newest = views.recent_events(
        views.newest_days(events, "consumed_date", F.current_timestamp(), limit=2),
        ["partition", "offset"], limit=2,
    ).collect()
    assert len(newest) == 2 and newest[0]["station_code"] == "9"
    assert events.select(F.to_json("payload")).filter(F.col("station_code") == "9").first()


def test_bad_messages_go_to_the_rejects(spark, folder):
    Path(f"{folder}/topic/batch=0").mkdir(parents=True)
    values = ['{"station_code": "1"}', "{}", "not json", '{"station_code": "2"}']
    with open(f"{folder}/topic/batch=0/m.json", "w") as file:
        for n, value in enumerate(values):
            file.write(json.dumps({"key": "k", "value": value, "partition": 0, "offset": n}) + "\n")
    ingest.start_ingest(
        topics.folder_source(spark, f"{folder}/topic/*"), f"{folder}/events",
        f"{folder}/checkpoint", available_now=True,
    ).awaitTermination()
    good = ingest.read_events(spark, f"{folder}/events").collect()
    assert [(r["station_code"], r["event_type"], r["num_ebikes"]) for r in good] == [
        ("1", "snapshot", 0), ("2", "snapshot", 0)
    ]
    bad = ingest.read_rejects(spark, f"{folder}/events").orderBy("offset").collect()
    assert [(r["offset"], r["raw"], r["reason"]) for r in bad] == [
        (1, "{}", "station code is missing"), (2, "not json", "message is not JSON")
    ]


def publish(folder, name, *messages):
    """Messages (value, offset, minute) as a file of the topic."""
    Path(f"{folder}/topic/batch={name}").mkdir(parents=True)
    with open(f"{folder}/topic/batch={name}/m.json", "w") as file:
        for value, offset, minute in messages:
            time = f"2026-06-10T{10 + minute // 60}:{minute % 60:02}:00.000Z"
            file.write(json.dumps({"key": "k", "value": value, "partition": 0, "offset": offset, "timestamp": time}) + "\n")


def test_a_message_published_twice_is_one_event(spark, folder):
    def ingested():
        query = ingest.start_ingest(
            topics.folder_source(spark, f"{folder}/topic/*"), f"{folder}/events", f"{folder}/checkpoint",
            available_now=True, unique_within="10 minutes",
        )
        query.awaitTermination()
        state = query.lastProgress["stateOperators"][0]["numRowsTotal"] if query.lastProgress else None
        return sorted(r["offset"] for r in ingest.read_events(spark, f"{folder}/events").collect()), state

    one, two = '{"station_code": "1"}', '{"station_code": "2"}'
    publish(folder, 0, (one, 0, 0), (two, 1, 1), (one, 2, 2), ("bad", 3, 2))
    assert ingested()[0] == [0, 1]
    # Again in another run, within the time: nothing new.
    publish(folder, 1, (two, 4, 5), ('{"station_code": "3"}', 5, 6))
    assert ingested()[0] == [0, 1, 5]
    # Long after, the state is forgotten, and the same content is a new message.
    publish(folder, 2, ('{"station_code": "4"}', 6, 200))
    ingested()
    publish(folder, 3, (one, 7, 201))
    found, state = ingested()
    assert found == [0, 1, 5, 6, 7] and state <= 2


def test_closed_days_are_archived_in_few_files(spark, folder):
    for n in range(50):
        publish(folder, n, *((f'{{"station_code": "{n}", "num_ebikes": {m}}}', 10 * n + m, m) for m in range(2)))
    schema = topics.folder_source(spark, f"{folder}/topic/*", files_per_trigger=1)
    # Three days, as the consume time is the clock's.
    shaped = records.parse_messages(schema, F.current_timestamp()).withColumn("accepted", F.col("reason").isNull())
    shaped = shaped.withColumn("consumed_date", F.date_add(F.lit("2026-01-01").cast("date"), (F.col("offset") % 3).cast("int")))
    shaped.writeStream.format("parquet").partitionBy("accepted", "consumed_date").option("path", f"{folder}/events").option(
        "checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    files = lambda place: [p for p in Path(place).rglob("*.parquet")]
    assert len(files(f"{folder}/events")) >= 50
    show = lambda df: sorted(
        (r.offset, r.station_code, r.num_ebikes, r.consumed_date, r.p)
        for r in df.withColumn("p", F.to_json("payload")).collect()
    )
    expected = show(ingest.read_events(spark, f"{folder}/events"))
    archive = ingest.event_archive(spark, f"{folder}/archive")
    assert show(ingest.read_all_events(spark, f"{folder}/events", archive)) == expected
    for today, days in ((date(2026, 1, 2), 1), (date(2026, 1, 2), 0), (date(2026, 1, 3), 1)):
        assert len(ingest.archive_closed_days(spark, f"{folder}/events", archive, today)) == days
        both = ingest.read_all_events(spark, f"{folder}/events", archive)
        assert show(both) == expected
    assert len(files(f"{folder}/archive")) == 2
    assert {str(p).split("part=")[1][:10] for p in files(f"{folder}/archive")} == {"2026-01-01", "2026-01-02"}


def test_a_timed_trigger_takes_limited_batches_in_order(spark, folder):
    def ingested(path):
        source = topics.folder_source(spark, f"{folder}/topic/*", files_per_trigger=2)
        query = ingest.start_ingest(source, f"{folder}/{path}", f"{folder}/{path}_checkpoint", every="200 milliseconds")
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
        rows = ingest.consumed_in_order(ingest.read_events(spark, f"{folder}/{path}")).collect()
        return sizes, sorted(tuple(r) for r in rows)

    for n in range(5):
        publish(folder, n, *((f'{{"station_code": "{m % 2}"}}', 10 * n + m, n) for m in range(4)))
    assert ingested("events") == ([8, 8, 4], [("0", 10, 3, True), ("1", 10, 3, True)])
    # An earlier offset that comes in a later batch shows.
    publish(folder, 5, ('{"station_code": "1"}', 3, 9))
    assert ingested("events")[1] == [("0", 10, 3, True), ("1", 11, 4, False)]


def test_a_path_of_stored_payloads_is_read_alone(spark, folder):
    values = ['{"station_code": "1", "extra": 7, "far": {"x": [1, 2]}}', '{"station_code": "2", "extra": "8"}',
              '{"station_code": "3", "extra": null}', '{"station_code": "4"}', '{"station_code": "5", "extra": {"y": 1}}']
    publish(folder, 0, *((v, n, 0) for n, v in enumerate(values)))
    ingest.start_ingest(
        topics.folder_source(spark, f"{folder}/topic/*"), f"{folder}/events", f"{folder}/checkpoint", available_now=True,
    ).awaitTermination()
    archive = ingest.event_archive(spark, f"{folder}/archive")
    assert ingest.archive_closed_days(spark, f"{folder}/events", archive, date(9999, 1, 1))
    for events in (ingest.read_events(spark, f"{folder}/events"), archive.read()):
        found = ingest.payload_columns(events, {"extra": ("$.extra", "int"), "x": ("$.far.x[1]", "int")})
        rows = found.select("station_code", "extra", "x")
        assert sorted(map(tuple, rows.collect())) == [("1", 7, 2), ("2", 8, None), ("3", None, None), ("4", None, None), ("5", None, None)]
        schema = [line for line in plan_of(rows).splitlines() if "ReadSchema" in line]
        assert schema and "payload:struct<0:int,1:int>" in schema[0]
