"""Row-count checks after a load."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokeline.functions import metrics
from spokeline.schemas import MAX_CODE_LENGTH

# An empty table fails the check only if its label contains this.
FATAL = "stations"


class QualityError(ValueError):
    pass


def row_counts(
    stations: DataFrame, status: DataFrame, events: DataFrame, as_of: Column
) -> DataFrame:
    """(label, row_count, fatal, passed) for all stations, and status and events of one hour."""
    start = metrics.hours_before(as_of, 1)
    checked = {
        "raw_stations": stations,
        "raw_station_status (last hour)": status.filter(F.col("ingested_at") > start),
        "stream_events (last hour)": events.filter(F.col("consumed_at") > start),
    }
    counts = [
        rows.agg(F.count("*").alias("row_count")).select(F.lit(label).alias("label"), "row_count")
        for label, rows in checked.items()
    ]
    fatal = (F.col("row_count") == 0) & F.col("label").contains(FATAL)
    return (
        reduce(DataFrame.unionByName, counts)
        .withColumn("fatal", fatal)
        .withColumn("passed", ~F.col("fatal"))
    )


def enforce(counts: DataFrame) -> dict[str, int]:
    """The counts by label; raises when a check failed."""
    rows = counts.collect()
    failed = [row["label"] for row in rows if not row["passed"]]
    if failed:
        raise QualityError(f"empty: {', '.join(failed)}")
    return {row["label"]: row["row_count"] for row in rows}


def key_checks(
    rows: DataFrame, label: str, keys: list[str], longest: dict[str, int] | None = None
) -> DataFrame:
    """(label, rule, violations, passed): keys that several rows have, rows with a null in their key, and
    texts beyond their longest length. One pass over rows, combined per key before the shuffle."""
    per_key = [F.count("*").alias("n")]
    for column, most in (longest or {}).items():
        per_key.append(F.count_if(F.length(column) > most).alias(f"long_{column}"))
    unknown = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    totals = rows.groupBy(*keys).agg(*per_key).agg(
        F.count_if((F.col("n") > 1) & ~unknown).alias("key is not unique"),
        F.coalesce(F.sum(F.when(unknown, F.col("n"))), F.lit(0)).alias("key is null"),
        *(F.coalesce(F.sum(f"long_{c}"), F.lit(0)).alias(f"{c} is too long") for c in longest or {}),
    )
    rules = totals.unpivot([], totals.columns, "rule", "violations")
    return rules.select(
        F.lit(label).alias("label"), "rule", "violations", (F.col("violations") == 0).alias("passed")
    )


def enforce_keys(checks: DataFrame) -> None:
    """Raises QualityError for the rules that are violated."""
    failed = [f"{r['label']}: {r['rule']} ({r['violations']})" for r in checks.where("NOT passed").collect()]
    if failed:
        raise QualityError("; ".join(sorted(failed)))


def stored_key_checks(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """key_checks of stored tables by label, with the length of their station codes."""
    return reduce(
        DataFrame.unionByName,
        [
            key_checks(rows, label, keys, {"station_code": MAX_CODE_LENGTH} if "station_code" in rows.columns else {})
            for label, (rows, keys) in tables.items()
        ],
    )
