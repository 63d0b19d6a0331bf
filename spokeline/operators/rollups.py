"""Availability rollups by district and by station and hour."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokeline.functions import metrics
from spokeline.operators.keyed import latest_one
from spokeline.schemas import DISTRICTS, HOURLY

WINDOW_HOURS = 24


def latest_counts(
    status: DataFrame, tie_break: list[str], keys: list[str] = ("station_code",),
    stations: DataFrame | None = None,
) -> DataFrame:
    """The newest counts of every station, or of the given ones: the input of a district rollup.

    Only these columns enter the aggregate; Catalyst cannot drop others from inside it.
    """
    counts = ["num_bikes_available", "num_docks_available", "num_ebikes"]
    columns = dict.fromkeys([*keys, *counts, "ingested_at", *tie_break])
    return latest_one(status.select(*columns), list(keys), "ingested_at", tie_break, stations)


def district_rollup(stations: DataFrame, latest: DataFrame, snapshot_time: Column) -> DataFrame:
    """Totals per known district over stations with one latest status row each.

    snapshot_time may be a column of latest; then there is one total per district and time.
    """
    located = stations.filter(F.col("arrondissement").isNotNull()).select(
        "station_code", "arrondissement", "capacity"
    )
    bikes, docks = F.col("num_bikes_available"), F.col("num_docks_available")
    totals = (
        latest.join(located, "station_code")
        .groupBy("arrondissement", snapshot_time.alias("snapshot_time"))
        .agg(
            F.count_distinct("station_code").cast("int").alias("total_stations"),
            metrics.total(bikes).alias("total_bikes"),
            metrics.total(docks).alias("total_docks"),
            metrics.total(F.col("num_ebikes")).alias("total_ebikes"),
            metrics.mean_fill_rate(bikes, F.col("capacity")).alias("avg_fill_rate"),
            metrics.count_where(bikes == 0).alias("empty_stations"),
            metrics.count_where(docks == 0).alias("full_stations"),
        )
    )
    return totals.select(*DISTRICTS.names)


def hourly_trend(status: DataFrame, as_of: Column, align_to_hour: bool = False) -> DataFrame:
    """Bikes and docks per station and hour over the last 24 hours.

    The window starts 24 hours before as_of to the second, so its oldest hour is partial;
    align_to_hour starts it at the full hour instead.
    """
    start = metrics.hours_before(as_of, WINDOW_HOURS)
    recent = (
        status.filter(F.col("ingested_at") >= F.date_trunc("hour", start))
        if align_to_hour
        else status.filter(F.col("ingested_at") > start)
    )
    bikes, docks = F.col("num_bikes_available"), F.col("num_docks_available")
    return (
        recent.groupBy("station_code", F.date_trunc("hour", "ingested_at").alias("hour_bucket"))
        .agg(
            F.round(F.avg(bikes), 2).alias("avg_bikes"),
            F.round(F.avg(docks), 2).alias("avg_docks"),
            F.min(bikes).alias("min_bikes"),
            F.max(bikes).alias("max_bikes"),
            F.count("*").cast("int").alias("snapshots_count"),
        )
        .select(*HOURLY.names)
    )
