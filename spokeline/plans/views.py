"""The results users read: current state, lists, indicators and trends."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spokeline.functions import metrics
from spokeline.operators.keyed import latest_with_ties
from spokeline.operators.rollups import WINDOW_HOURS
from spokeline.sources.tables import DayTable

KPI_TOTALS = ["total_bikes", "total_docks", "total_stations", "total_ebikes", "empty_stations"]


def current_status(stations: DataFrame, status: DataFrame) -> DataFrame:
    """Every station with its newest status rows (all that share the newest load time)."""
    dimension = stations.select("station_code", "name", "arrondissement", "capacity", "lat", "lon")
    counts = ["num_bikes_available", "num_docks_available", "num_ebikes", "num_mechanical"]
    history = status.select("station_code", *counts, "is_renting", "last_reported", "ingested_at")
    newest = latest_with_ties(history, ["station_code"], "ingested_at", dimension)
    rate = metrics.fill_rate(F.col("num_bikes_available"), F.col("capacity"))
    return newest.select(
        *dimension.columns, *counts, "is_renting", "last_reported", rate.alias("fill_rate_pct")
    )


def critical_stations(current: DataFrame) -> DataFrame:
    """Renting stations with fewer than 3 bikes, the emptiest first."""
    low = F.col("num_bikes_available") < metrics.LOW_BIKES
    return current.filter(low & F.col("is_renting")).orderBy(
        F.asc_nulls_last("num_bikes_available"), "station_code", "last_reported"
    )


def top_active_stations(status: DataFrame, as_of: Column, limit: int = 10) -> DataFrame:
    """The stations with most status rows in the last 24 hours; ties by station code."""
    bikes = F.col("num_bikes_available")
    return (
        status.filter(F.col("ingested_at") > metrics.hours_before(as_of, WINDOW_HOURS))
        .groupBy("station_code")
        .agg(
            F.count("*").alias("snapshot_count"),
            F.avg(bikes).alias("avg_bikes"),
            F.min(bikes).alias("min_bikes"),
            F.max(bikes).alias("max_bikes"),
        )
        .orderBy(F.desc("snapshot_count"), "station_code")
        .limit(limit)
    )


def kpis(current: DataFrame) -> DataFrame:
    """Totals over renting stations: always one row, sums and mean null when there are none."""
    bikes = F.col("num_bikes_available")
    return current.filter("is_renting").agg(
        F.sum(bikes).alias("total_bikes"),
        F.sum("num_docks_available").alias("total_docks"),
        F.count("*").alias("total_stations"),
        F.sum("num_ebikes").alias("total_ebikes"),
        F.count_if(bikes == 0).alias("empty_stations"),
        metrics.mean_fill_rate(bikes, F.col("capacity")).alias("avg_fill_pct"),
    )


def kpi_cards(kpi_row: DataFrame) -> DataFrame:
    """Indicator values as shown: null is 0, the mean a per cent label."""
    return kpi_row.select(
        *[metrics.or_zero(F.col(c)).alias(c) for c in KPI_TOTALS],
        metrics.percent_label(metrics.or_zero(F.col("avg_fill_pct"))).alias("avg_fill_label"),
    )


def kpi_record(kpi_row: DataFrame) -> dict:
    return kpi_row.first().asDict()


def station_map(current: DataFrame) -> DataFrame:
    """Stations with known coordinates, and their fill rate on the 0..100 colour scale."""
    return current.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
        "name", "lat", "lon", "arrondissement", "num_bikes_available", "num_docks_available",
        "capacity", "fill_rate_pct", "is_renting",
        metrics.colour_scale(F.col("fill_rate_pct")).alias("colour_value"),
    )


def latest_districts(rollups: DataFrame) -> DataFrame:
    """The district rows of the newest snapshot."""
    newest = rollups.select(F.max("snapshot_time")).scalar()
    return (
        rollups.filter(F.col("snapshot_time") == newest)
        .select(
            "arrondissement", "snapshot_time", "total_bikes", "total_docks", "total_stations",
            "avg_fill_rate", "empty_stations", "full_stations",
        )
        .orderBy(F.asc_nulls_last("arrondissement"))
    )


def latest_stored_districts(table: DayTable) -> DataFrame:
    """The same from a stored rollup: only the partition of the newest day is read."""
    rollups = table.with_parts()
    newest = rollups.select(F.max("part")).scalar()
    return latest_districts(rollups.where(F.col("part") == newest).drop("part"))


def district_bars(districts: DataFrame) -> DataFrame:
    """Bikes and empty stations in long form, one row per district and measure."""
    return districts.unpivot(
        ["arrondissement"], ["total_bikes", "empty_stations"], "variable", "value"
    )


def district_labels(districts: DataFrame) -> DataFrame:
    """District and fill rate as text, with the rate on the 0..100 colour scale."""
    rate = F.col("avg_fill_rate")
    return districts.select(
        F.col("arrondissement").cast("string").alias("district"),
        rate,
        metrics.colour_scale(rate).alias("colour_value"),
        metrics.percent_label(rate).alias("fill_label"),
    )


def recent_events(events: DataFrame, order: list[str], limit: int = 50) -> DataFrame:
    """The newest events with their alert colour; order breaks ties of one consume time."""
    return (
        events.orderBy(F.desc_nulls_first("consumed_at"), *[F.desc(c) for c in order])
        .limit(limit)
        .select(
            "consumed_at", "station_code", "event_type", "num_bikes_available",
            "num_docks_available", metrics.alert_colour(F.col("event_type")).alias("alert_colour"),
        )
    )


def recent_stored_events(events: DataFrame, order: list[str], day: str, limit: int = 50) -> DataFrame:
    """recent_events of a table partitioned by the day of consumed_at, in the column day: only the
    newest days that together hold enough rows, and the rows without a time, are read.

    The rows of the days are counted from the partitions and the files' footers."""
    days = events.groupBy(day).agg(F.count("*").alias("n"))
    newer = Window.orderBy(F.desc(day)).rowsBetween(Window.unboundedPreceding, -1)
    # One row per day; the oldest one that is needed has less than limit rows in newer ones.
    needed = days.where(F.col(day).isNotNull()).withColumn("newer", F.coalesce(F.sum("n").over(newer), F.lit(0)))
    first = needed.where(F.col("newer") < limit).select(F.min(day)).scalar()
    return recent_events(events.where(F.col(day).isNull() | (F.col(day) >= first)), order, limit)


def newest_days(events: DataFrame, day: str, as_of: Column, limit: int = 50) -> DataFrame:
    """The days that hold the newest limit rows, so that older partitions are not read.

    day is the partition column. These are the day of as_of and the one before when they have
    enough rows, and all days otherwise.
    """
    yesterday = F.date_sub(F.to_date(as_of), 1)
    recent = events.filter(F.col(day) >= yesterday).select(day).limit(limit)
    is_enough = recent.agg(F.count("*") == limit).scalar()
    first_day = F.when(is_enough, yesterday).otherwise(F.lit("0001-01-01").cast("date"))
    return events.filter(F.col(day).isNull() | (F.col(day) >= first_day))


STATION_TREND = """
    SELECT hour_bucket, avg_bikes, avg_docks, snapshots_count
    FROM {trend}
    WHERE station_code = :station_code
      AND hour_bucket > CAST(:as_of AS TIMESTAMP) - INTERVAL 24 HOURS
    ORDER BY hour_bucket NULLS LAST
"""


def station_trend(trend: DataFrame, station_code: str, as_of: str) -> DataFrame:
    """Hours of one station within the last 24 hours, oldest first."""
    return query(
        trend.sparkSession, STATION_TREND, {"station_code": station_code, "as_of": as_of},
        trend=trend,
    )


def query(
    spark: SparkSession, sql: str, params: dict | None = None, **tables: DataFrame
) -> DataFrame:
    """SQL text with named parameters; {name} in it stands for a given DataFrame."""
    return spark.sql(sql, args=params, **tables)


def register_views(spark: SparkSession, stations: DataFrame, status: DataFrame, as_of: Column):
    """The named views over the station and status tables."""
    current = current_status(stations, status)
    current.createOrReplaceTempView("v_current_status")
    critical_stations(current).createOrReplaceTempView("v_critical_stations")
    top_active_stations(status, as_of).createOrReplaceTempView("v_top_active_stations")
