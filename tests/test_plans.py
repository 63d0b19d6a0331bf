"""Plans that have to hold at any size of the data."""

from datetime import datetime

import pytest
from conftest import SF, plan_of
from pyspark.sql import functions as F

from spokeline.catalogue import queries, standins
from spokeline import schemas
from spokeline.functions import metrics
from spokeline.operators import rollups
from spokeline.plans import views
from spokeline.session import estimated_size, spread, utc
from spokeline.sources.tables import DayTable


def test_time_windows_reach_the_scan(spark):
    for query in (queries.hourly_trend, queries.top_active_stations, queries.hourly_trend_station):
        plan = plan_of(query(spark, SF))
        assert "GreaterThan(ts,2024-01-30T00:00)" in plan, query.__name__
    assert "GreaterThan(ts,2024-01-30T23:00)" in plan_of(queries.dq_counts(spark, SF))


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(queries.top_active_stations(spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    plan = plan_of(queries.district_rollup(spark, SF))
    assert "c_name" not in plan and "c_acctbal" not in plan and "event_type" not in plan


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in (
    "stream_feed", "stream_ingest", "batch_run", "export_parse", "export_rejects",
    "rollup_upsert_rerun", "trend_upsert", "export_files", "batch_rerun", "batch_status",
    "batch_rejects", "status_table_upsert", "stations_table_upsert",
    "export_elements", "district_stored_snapshot")])
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(queries.QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert node not in plan


def test_top_lists_are_not_sorted_globally(spark):
    for query in (queries.top_active_stations, queries.recent_events):
        plan = plan_of(query(spark, SF))
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_rollup_sorts_the_newest_rows_only(spark):
    """The history is hash-aggregated and joined with broadcast maxima, below the sort."""
    plan = plan_of(queries.district_rollup(spark, SF), "simple")
    first_sort = plan.index("partial_max_by")
    assert "BroadcastHashJoin" in plan[first_sort:]
    assert "HashAggregate(keys=[station_code" in plan[first_sort:]
    assert "SortMergeJoin" not in plan and plan.count("partial_max_by") == 1


def test_newest_snapshot_and_newest_days_prune_partitions(spark, folder):
    rows = spark.range(400).select(
        F.col("id").cast("int").alias("arrondissement"),
        F.expr("make_timestamp(2026, 1, 1 + CAST(id % 20 AS INT), 0, 0, 0)").alias("consumed_at"),
    )
    rows.withColumn("day", F.to_date("consumed_at")).write.partitionBy("day").parquet(folder + "/e")
    events = spark.read.parquet(f"{folder}/e")
    for as_of, limit, size in (("2026-01-20", 40, 40), ("2026-01-20", 41, 400), ("2027-01-01", 5, 400)):
        cut = views.newest_days(events, "day", utc(datetime.fromisoformat(as_of)), limit)
        assert cut.count() == size
        partition_filters = plan_of(cut).split("PartitionFilters: ")[1].split("\n")[0]
        assert "ubquery" in partition_filters


def test_the_newest_snapshot_is_read_from_its_partition(spark, folder):
    table = DayTable(spark, f"{folder}/d", schemas.DISTRICTS, schemas.DISTRICTS_KEY, "snapshot_time")
    rows = [(d, datetime(2026, 1, day, hour), day, hour, 0, 0, 1.5, 0, 0)
            for d in (1, 2) for day in (1, 2, 3) for hour in (5, 6)]
    table.replace(spark.createDataFrame(rows, schemas.DISTRICTS))
    found = views.latest_stored_districts(table)
    assert [(r.arrondissement, r.total_stations, r.total_bikes) for r in found.collect()] == [(1, 3, 6), (2, 3, 6)]
    filters = [x.split("\n")[0] for x in plan_of(found).split("PartitionFilters: ")[1:]]
    assert filters and all("ubquery" in x for x in filters if "part" in x)


@pytest.mark.parametrize("limit", [1, 40, 41, 60, 400, 500])
def test_recent_events_read_the_days_they_need(spark, folder, limit):
    rows = spark.range(400).select(
        F.col("id").alias("n"), F.lit("1").alias("station_code"), F.lit("low_bikes").alias("event_type"),
        F.lit(1).alias("num_bikes_available"), F.col("id").cast("int").alias("num_docks_available"),
        F.expr("if(id < 3, NULL, make_timestamp(2026, 1, 1 + CAST(id % 20 AS INT), 0, 0, 0))").alias("consumed_at"),
    )
    rows.withColumn("day", F.to_date("consumed_at")).write.partitionBy("day").parquet(folder + "/e")
    events = spark.read.parquet(f"{folder}/e")
    found = views.recent_stored_events(events, ["n"], "day", limit)
    assert found.collect() == views.recent_events(rows, ["n"], limit).collect()
    plan = plan_of(found)
    assert "TakeOrderedAndProject" in plan or limit > 400
    assert any("ubquery" in x.split("\n")[0] for x in plan.split("PartitionFilters: ")[1:])


def test_align_to_hour(spark):
    status = spark.createDataFrame(
        [("1", datetime(2026, 1, 1, 0, minute), minute, 0) for minute in (5, 25, 45)],
        "station_code string, ingested_at timestamp, num_bikes_available int, "
        "num_docks_available int",
    )
    as_of = utc(datetime(2026, 1, 2, 0, 25))
    partial = rollups.hourly_trend(status, as_of).first()
    full = rollups.hourly_trend(status, as_of, align_to_hour=True).first()
    assert (partial["snapshots_count"], partial["avg_bikes"]) == (1, 45.0)
    assert (full["snapshots_count"], full["avg_bikes"]) == (3, 25.0)


def test_null_rates(spark):
    df = spark.createDataFrame([(1, 0), (None, 5), (7, 5), (-1, 5)], "b int, c int")
    rate = metrics.fill_rate(F.col("b"), F.col("c"))
    rows = df.select(rate, metrics.colour_scale(rate), metrics.percent_label(rate)).collect()
    assert list(map(tuple, rows)) == [
        (None, None, None), (None, None, None), (140.0, 100.0, "140.0%"), (-20.0, 0.0, "-20.0%")
    ]
    assert df.select(metrics.mean_fill_rate(F.col("b"), F.col("c"))).first()[0] == 60.0


def test_small_inputs_are_spread_and_large_ones_are_not(spark, folder):
    spark.range(10).write.parquet(f"{folder}/r")
    df = spark.read.parquet(f"{folder}/r")
    assert "RoundRobinPartitioning" in plan_of(spread(df))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10b")
    try:
        assert "Exchange" not in plan_of(spread(df))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_file_of_one_row_group_is_spread_though_it_has_splits(spark, folder):
    spark.range(10000).coalesce(1).write.parquet(f"{folder}/r")
    df = spark.read.parquet(f"{folder}/r")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", f"{estimated_size(df) // 3}b")
    try:
        assert "RoundRobinPartitioning" in plan_of(spread(df))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_kpi_record(spark):
    record = views.kpi_record(queries.kpi_empty(spark, SF))
    assert record == {
        "total_bikes": None, "total_docks": None, "total_stations": 0, "total_ebikes": None,
        "empty_stations": 0, "avg_fill_pct": None,
    }
    empty = standins.stations(spark, SF).limit(0)
    current = views.current_status(empty, standins.status(spark, SF))
    assert views.kpi_cards(views.kpis(current)).first()["avg_fill_label"] == "0.0%"
