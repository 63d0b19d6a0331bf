"""The given tables in the role of stations, status, events, exports and topic messages."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline.session import configure, utc

# The fixed "now" of all queries.
AS_OF = datetime(2024, 1, 31)
NOW = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def as_of() -> Column:
    return utc(AS_OF)


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps as wall clocks without zone, as the given tables have them."""
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") / 100000)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("station_code"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % 50).cast("int").alias("capacity"),
        (48.0 + shift).alias("lat"),
        (2.0 + shift).alias("lon"),
        F.when(F.col("c_nationkey").between(1, 99), F.col("c_nationkey")).alias("arrondissement"),
    )


def _status_columns(events: DataFrame) -> list[Column]:
    bikes = F.floor("value").cast("int")
    return [
        F.col("user_id").cast("string").alias("station_code"),
        bikes.alias("num_bikes_available"),
        F.get_json_object("props", "$.k").cast("int").alias("num_docks_available"),
        (bikes % 10).alias("num_ebikes"),
        (bikes - bikes % 10).alias("num_mechanical"),
        (F.col("event_type") != "error").alias("is_renting"),
    ]


def status(spark: SparkSession, sf_dir: str, loaded_after: Column | None = None) -> DataFrame:
    """Status rows loaded at the full hour of their event.

    loaded_after repeats a filter on the load time as one on the event time, which is never
    earlier; in that form it reaches the scan.
    """
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    if loaded_after is not None:
        events = events.filter(F.col("ts") > loaded_after)
    return events.select(
        *_status_columns(events),
        F.col("ts").alias("last_reported"),
        F.date_trunc("hour", "ts").alias("ingested_at"),
        "event_id",
    )


def event_rows(spark: SparkSession, sf_dir: str, consumed_after: Column | None = None) -> DataFrame:
    """Classified stream events, consumed at the time of their event."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    if consumed_after is not None:
        events = events.filter(F.col("ts") > consumed_after)
    return events.select(*_status_columns(events), F.col("ts").alias("consumed_at"), "event_id")


def _json(**fields: Column) -> Column:
    options = {"ignoreNullFields": "false"}
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), options)


def exports(events: DataFrame) -> DataFrame:
    """One export per event: an array with one record, whose form depends on the event type."""
    code, bikes = F.col("user_id"), F.floor("value").cast("int")
    docks = F.get_json_object("props", "$.k").cast("int")
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    nothing = F.lit(None).cast("string")

    typed = _json(
        stationcode=code * 1000 + 7,
        name=F.concat(F.lit(" S"), code.cast("string"), F.lit("\t")),
        capacity=(code % 50).cast("int"),
        coordonnees_geo=F.struct(
            (48.0 + docks / 1000).alias("lat"), (2.0 + docks / 1000).alias("lon")
        ),
        duedate=F.concat(iso, F.lit("+02:00")),
        numbikesavailable=bikes,
        numdocksavailable=docks,
        ebike=bikes % 10,
        mechanical=F.col("value"),
        is_installed=F.lit("OUI"),
        is_renting=F.lit(True),
        is_returning=F.lit("NON"),
    )
    as_text = _json(
        stationcode=F.concat(F.lit("\n "), (code * 1000 + 7).cast("string"), F.lit(" ")),
        name=nothing,
        capacity=F.concat(F.lit(" +"), (code % 50).cast("string")),
        coordonnees_geo=F.struct(F.lit(0.0).alias("lat"), F.lit("").alias("lon")),
        lat=F.lit("48.25"),
        duedate=F.lit(""),
        last_reported=F.concat(F.regexp_replace(iso, "T", " "), F.lit("Z")),
        numbikesavailable=bikes.cast("string"),
        numdocksavailable=docks.cast("string"),
        ebike=F.lit(True),
        mechanical=F.lit("1_000"),
        is_renting=nothing,
        is_returning=F.lit(""),
    )
    sparse = _json(
        stationcode=code.cast("string"),
        duedate=F.lit("not a time"),
        last_reported=iso,
        numdocksavailable=docks,
        is_installed=F.lit(0),
        is_renting=F.array().cast("array<int>"),
    )
    without_code = _json(name=F.lit("x"), numbikesavailable=bikes)
    malformed = _json(
        stationcode=code,
        name=F.when(bikes < 30, F.lit("x")),
        numbikesavailable=F.concat(docks.cast("string"), F.lit(".5")),
    )
    too_large = _json(stationcode=code, numbikesavailable=F.lit(2**31), capacity=docks)
    record = (
        F.when(F.col("event_type") == "view", typed)
        .when(F.col("event_type") == "click", as_text)
        .when(F.col("event_type") == "purchase", sparse)
        .when(F.col("event_type") == "signup", without_code)
        .when(bikes < 60, malformed)
        .otherwise(too_large)
    )
    return events.select(
        F.concat(F.lit("["), record, F.lit("]")).alias("text"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("source"),
    )


def messages(events: DataFrame) -> DataFrame:
    """One topic record per event: full, without optional fields, with nulls, or unreadable."""
    code, bikes = F.col("user_id").cast("string"), F.floor("value").cast("int")
    docks = F.get_json_object("props", "$.k").cast("int")
    nothing = F.lit(None).cast("int")
    value = (
        F.when(
            F.col("event_type") == "view",
            _json(
                station_code=code, event_type=F.col("event_type"), num_bikes_available=bikes,
                num_docks_available=docks, num_ebikes=bikes % 10,
            ),
        )
        .when(F.col("event_type") == "click", _json(station_code=F.col("user_id"), extra=docks))
        .when(
            F.col("event_type") == "purchase",
            _json(station_code=code, event_type=nothing, num_bikes_available=nothing),
        )
        .when(
            F.col("event_type") == "signup",
            _json(station_code=code, num_bikes_available=bikes.cast("string")),
        )
        .when(bikes < 60, _json(event_type=F.col("event_type"), num_ebikes=docks))
        .otherwise(F.concat(F.lit('{"station_code": '), code))
    )
    return events.select(
        code.alias("key"),
        value.alias("value"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream."""
    schema = table(spark, sf_dir, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return files.parquet(sf_dir)
