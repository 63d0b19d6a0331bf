"""Typed tables and their upsert keys."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
    "date": T.DateType(), "variant": T.VariantType(),
}


def _table(columns: str) -> T.StructType:
    """A schema from 'name type, ...', without needing a session as the DDL parser does."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The longest station code and event type a table accepts.
MAX_CODE_LENGTH = 20
MAX_EVENT_TYPE_LENGTH = 50

STATIONS = _table(
    "station_code string, name string, capacity int, lat double, lon double, "
    "arrondissement int, ingested_at timestamp"
)
STATIONS_KEY = ["station_code"]

# source and pos give the input order of a row inside its load.
STATUS = _table(
    "station_code string, num_bikes_available int, num_docks_available int, num_ebikes int, "
    "num_mechanical int, is_installed boolean, is_renting boolean, is_returning boolean, "
    "last_reported timestamp, ingested_at timestamp, source string, pos int"
)
STATUS_KEY = ["station_code", "last_reported"]
STATUS_ORDER = ["ingested_at", "source", "pos"]
# A re-loaded status row keeps the first value of these and the newest of all others.
STATUS_KEEP_FIRST = ["is_installed", "is_returning"]

EVENTS = _table(
    "station_code string, event_type string, num_bikes_available int, num_docks_available int, "
    "num_ebikes int, payload variant, consumed_at timestamp"
)

# The event table as stored: good events and rejects are its two accepted partitions.
STORED_EVENTS = T.StructType(
    [
        *EVENTS.fields,
        *_table(
            "partition int, offset long, reason string, raw string, accepted boolean, "
            "consumed_date date"
        ).fields,
    ]
)

DISTRICTS = _table(
    "arrondissement int, snapshot_time timestamp, total_stations int, total_bikes int, "
    "total_docks int, total_ebikes int, avg_fill_rate double, empty_stations int, "
    "full_stations int"
)
DISTRICTS_KEY = ["arrondissement", "snapshot_time"]

HOURLY = _table(
    "station_code string, hour_bucket timestamp, avg_bikes double, avg_docks double, "
    "min_bikes int, max_bikes int, snapshots_count int"
)
HOURLY_KEY = ["station_code", "hour_bucket"]

REJECTS = _table("source string, pos int, raw string, reason string, rejected_at timestamp")

# A topic record, with the column names the Kafka source gives.
MESSAGE = _table("key string, value string, partition int, offset long, timestamp timestamp")
