"""Rates, event classes and display values."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alert colours of the event types; any other type has none.
ALERT_COLOURS = {
    "empty_station": "background-color: #d62728; color: white",
    "low_bikes": "background-color: #ff7f0e; color: white",
    "full_station": "background-color: #1f77b4; color: white",
}
LOW_BIKES = 3


def hours_before(instant: Column, hours: int) -> Column:
    return instant - F.expr(f"INTERVAL {hours} HOURS")


def fill_rate(bikes: Column, capacity: Column) -> Column:
    """Per cent of the capacity, 1 decimal; null for capacity 0."""
    return F.round(100.0 * bikes / F.nullif(capacity, F.lit(0)), 1)


def mean_fill_rate(bikes: Column, capacity: Column) -> Column:
    """Mean of the unrounded fill rates, 1 decimal.

    Decimal arithmetic with 16 decimals per rate, so that no row order changes the result.
    """
    hundred = F.lit("100.00000").cast("decimal(8,5)")
    return F.round(F.avg(hundred * bikes / F.nullif(capacity, F.lit(0))), 1).cast("double")


def count_where(condition: Column) -> Column:
    return F.count_if(condition).cast("int")


def total(column: Column) -> Column:
    return F.sum(column).cast("int")


def classify_event(bikes: Column, docks: Column) -> Column:
    return (
        F.when(bikes == 0, "empty_station")
        .when(bikes < LOW_BIKES, "low_bikes")
        .when(docks == 0, "full_station")
        .otherwise("snapshot")
    )


def alert_colour(event_type: Column) -> Column:
    colours = F.create_map(*[F.lit(x) for pair in ALERT_COLOURS.items() for x in pair])
    return F.coalesce(F.try_element_at(colours, event_type), F.lit(""))


def colour_scale(rate: Column) -> Column:
    """A rate clamped to 0..100; null stays null."""
    return F.when(rate.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), rate)))


def percent_label(rate: Column) -> Column:
    return F.when(rate.isNotNull(), F.format_string("%.1f%%", rate))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def utc_iso(instant: Column) -> Column:
    """ISO text without offset; the fraction is left out when it is zero."""
    text = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(text, r"\.000000$", "")
