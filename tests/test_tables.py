from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from spokeline import schemas
from spokeline.operators.keyed import without_keys
from spokeline.sources.tables import DayTable, KeyedTable, LoadLog, StoredTable

ROLLUP = schemas._table("k int, at timestamp, v int")


def rows(spark, *values):
    return spark.createDataFrame(list(values), ROLLUP)


def read(df):
    return sorted((row["k"], row["at"].day, row["v"]) for row in df.collect())


def at(day):
    return datetime(2026, 1, day, 10)


def files(folder):
    return {p for p in Path(folder).rglob("part-*.parquet")}


def test_an_upsert_rewrites_the_days_it_touches_only(spark, folder):
    table = DayTable(spark, f"{folder}/t", ROLLUP, ["k", "at"], "at")
    assert table.read().count() == 0
    table.upsert(rows(spark, (1, at(1), 1), (2, at(1), 1), (1, at(2), 1)))
    first = files(f"{folder}/t")
    for _ in range(2):  # twice is once
        table.upsert(rows(spark, (1, at(2), 2), (1, at(3), 2)))
        assert read(table.read()) == [(1, 1, 1), (1, 2, 2), (1, 3, 2), (2, 1, 1)]
    assert {f for f in first if "part=2026-01-01" in str(f)} == {f for f in files(f"{folder}/t") if "part=2026-01-01" in str(f)}
    assert not {f for f in first if "part=2026-01-02" in str(f)} & files(f"{folder}/t")
    assert read(table.read([date(2026, 1, 2), date(2026, 1, 9)])) == [(1, 2, 2)]
    table.upsert(rows(spark))
    table.insert_missing(rows(spark, (1, at(2), 9), (7, at(2), 9), (7, at(4), 9)))
    assert read(table.read()) == [(1, 1, 1), (1, 2, 2), (1, 3, 2), (2, 1, 1), (7, 2, 9), (7, 4, 9)]
    # Another session's object for the same folder sees the same rows; nothing but partitions lies there.
    assert read(DayTable(spark, f"{folder}/t", ROLLUP, ["k", "at"], "at").read([date(2026, 1, 4)])) == [(7, 4, 9)]
    assert {p.name[:5] for p in Path(f"{folder}/t").iterdir()} <= {"part=", "_SUCC", "._SUC"}


def test_a_day_is_read_from_its_partition(spark, folder):
    table = DayTable(spark, f"{folder}/t", ROLLUP, ["k", "at"], "at")
    table.upsert(rows(spark, (1, at(1), 1), (1, at(2), 1)))
    plan = plan_of(table.read([date(2026, 1, 2)]))
    assert "PartitionFilters: [isnotnull(part" in plan and "Exchange" not in plan


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
@pytest.mark.parametrize("parts", [1, 3])
def test_an_upsert_does_not_shuffle_the_stored_rows(spark, folder, threshold, parts):
    table = KeyedTable(spark, f"{folder}/t", ROLLUP, ["k"], parts)
    base = [(n, at(1), n) for n in range(50)]
    table.replace(rows(spark, *base).repartition(table.buckets, "k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        changes = rows(spark, *[(n, at(2), -n) for n in range(40, 60)])
        kept = plan_of(without_keys(table.read(), changes, ["k"]), "simple")
        join, scan = kept.index("LeftAnti"), kept.index("FileScan")
        assert join < scan and "Exchange" not in kept[join:scan] and "Aggregate" not in kept
        table.upsert(changes.withColumn("n", F.lit(1)).unionByName(
            changes.withColumns({"v": F.lit(0), "n": F.lit(0)})), ["n"])
        expected = base[:40] + [(n, at(2), -n) for n in range(40, 60)]
        assert sorted(map(tuple, table.read().collect())) == expected
        # Older changes give way to what is stored, newer ones don't.
        table.fold_in(rows(spark, (0, at(3), 7), (45, at(1), 7), (99, at(1), 7)), ["at"])
        expected[0] = (0, at(3), 7)
        assert sorted(map(tuple, table.read().collect())) == [*expected, (99, at(1), 7)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_touched_parts_are_rewritten(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ROLLUP, ["k"], parts=4)
    table.replace(rows(spark, *[(n, at(1), n) for n in range(40)]))
    first = files(f"{folder}/t")
    table.upsert(rows(spark, (3, at(1), 9)))
    (part,) = table.parts_of(rows(spark, (3, at(1), 9)))
    assert {f for f in first if f"/part={part}/" not in str(f)} <= files(f"{folder}/t")
    assert table.read().count() == 40 and table.read([part]).where("v = 9").count() == 1


def status(spark, *values):
    """(code, reported hour, bikes, installed, loaded hour, pos)"""
    return spark.createDataFrame(
        [
            (code, bikes, 0, 0, 0, installed, True, installed,
             datetime(2026, 1, 1, reported), datetime(2026, 1, 1, loaded), "a", pos)
            for code, reported, bikes, installed, loaded, pos in values
        ],
        schemas.STATUS,
    )


def test_load_log(spark, folder):
    log = LoadLog(spark, f"{folder}/s", schemas.STATUS, schemas.STATUS_KEY,
                  schemas.STATUS_ORDER, schemas.STATUS_KEEP_FIRST)
    assert log.read().count() == 0
    first = status(spark, ("1", 1, 5, True, 2, 0), ("1", 1, 6, False, 2, 1), ("2", 1, 7, True, 2, 2))
    again = status(spark, ("1", 1, 8, False, 3, 0), ("1", 2, 9, False, 3, 1))
    day = (date(2026, 1, 1) - date(1970, 1, 1)).days * 86_400_000_000
    log.append(first, day + 2)
    for _ in range(2):
        log.append(again, day + 3)
    found = log.read().select(
        "station_code", F.hour("last_reported"), "num_bikes_available", "is_installed",
        "is_returning", F.hour("ingested_at"),
    )
    # A re-loaded row takes the new counts and load time but keeps its first flags.
    assert sorted(map(tuple, found.collect())) == [
        ("1", 1, 8, True, True, 3), ("1", 2, 9, False, False, 3), ("2", 1, 7, True, True, 2),
    ]
    assert log.read(date(2026, 1, 1)).count() == 3 and log.read(date(2026, 1, 2)).count() == 0


def test_partial_upsert_into_days_and_buckets(spark, folder):
    table = StoredTable(spark, f"{folder}/s", schemas.STATUS, schemas.STATUS_KEY,
                        "to_date(last_reported)", "date", ["station_code"])
    table.upsert(status(spark, ("1", 1, 5, True, 2, 0), ("2", 1, 7, True, 2, 2)), schemas.STATUS_ORDER)
    table.upsert(status(spark, ("1", 1, 8, False, 3, 0), ("1", 1, 9, True, 3, 1), ("3", 1, 1, False, 3, 2),
                        ("3", 1, 2, True, 3, 3)), schemas.STATUS_ORDER, schemas.STATUS_KEEP_FIRST)
    found = table.read().select("station_code", "num_bikes_available", "is_installed").collect()
    assert sorted(map(tuple, found)) == [("1", 9, True), ("2", 7, True), ("3", 2, False)]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_a_bucket_of_a_day_stays_one_file(spark, folder, threshold):
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        table = StoredTable(spark, f"{folder}/s", ROLLUP, ["k", "at"], "to_date(at)", "date", ["k"])
        assert table.buckets < 40
        table.upsert(rows(spark, *[(n, at(1 + n % 3), 1) for n in range(300)]))
        table.upsert(rows(spark, *[(n, at(1 + n % 3), 2) for n in range(0, 300, 2)]))
        assert read(table.read()) == [(n, 1 + n % 3, 1 + (n % 2 == 0)) for n in range(300)]
        assert len(files(f"{folder}/s")) <= 3 * table.buckets
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("schema", [schemas.STATIONS, schemas.STATUS, schemas.DISTRICTS,
                                    schemas.HOURLY, schemas.EVENTS, schemas.REJECTS])
def test_schemas_read_an_empty_table(spark, schema):
    assert spark.createDataFrame([], schema).schema == schema
