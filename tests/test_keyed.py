"""Latest rows and upserts against brute force, with a hot key and ties."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from spokeline.operators import keyed
from spokeline.operators.keyed import fold, latest_one, latest_with_ties, upsert

START = datetime(2026, 1, 1)
SCHEMA = "k string, t timestamp, n int, v int"


def sample(seed, size=600):
    """A third of the rows has one key; times tie often and are null sometimes."""
    rng = random.Random(seed)
    rows = []
    for n in range(size):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}"
        time = None if rng.random() < 0.02 else START + timedelta(hours=rng.randrange(30))
        rows.append((key, time, n, rng.randrange(1000)))
    return rows


def result(df):
    return sorted(tuple(row) for row in df.select("k", "t", "n", "v").collect())


@pytest.mark.parametrize("bits", [64, 1 << 25])
@pytest.mark.parametrize("seed", range(3))
def test_latest_one(spark, monkeypatch, seed, bits):
    """Also when every bit of the filter is set by many keys."""
    monkeypatch.setattr(keyed, "FILTER_BITS", bits)
    rows = [*sample(seed), (None, START, 1000, 1), (None, None, 1001, 2), (None, START, 1002, 3)]
    expected = {}
    for row in sorted(rows, key=lambda r: (r[1] is None, r[1] or START, r[2])):
        expected[row[0]] = row
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    actual = latest_one(df, ["k"], "t", ["n"]).collect()
    assert {row["k"]: tuple(row) for row in actual} == expected
    assert len(actual) == len(expected)


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_latest_one_of_known_keys(spark, threshold):
    rows = sample(7)
    expected = {}
    for row in sorted(rows, key=lambda r: (r[1] is None, r[1] or START, r[2])):
        if row[0] in ("hot", "k1"):
            expected[row[0]] = row
    df = spark.createDataFrame([*rows, (None, START, 0, 0)], SCHEMA).repartition(7)
    keys = spark.createDataFrame([("hot", 1), ("k1", 2), ("other", 3), (None, 4)], "k string, v int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        actual = latest_one(df, ["k"], "t", ["n"], keys).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {row["k"]: tuple(row) for row in actual} == expected


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_latest_with_ties(spark, seed, threshold):
    rows = sample(seed)
    newest = {}
    for key, time, _, _ in rows:
        if time is not None:
            newest[key] = max(newest.get(key, time), time)
    expected = sorted(r for r in rows if r[1] is not None and r[1] == newest[r[0]])
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    keys = spark.createDataFrame([("hot", 1), ("k1", 2), ("other", 3)], "k string, d int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        assert result(latest_with_ties(df, ["k"], "t")) == expected
        known = latest_with_ties(df, ["k"], "t", keys)
        assert result(known) == [r for r in expected if r[0] in ("hot", "k1")]
        assert {row["d"] for row in known.collect()} == {1, 2}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def one_by_one(base, changes, keep_first):
    """Upserts applied in order: rows are (k, n, v, w)."""
    table = {row[0]: list(row) for row in base}
    for k, n, v, w in sorted(changes, key=lambda r: r[1]):
        first_w = table[k][3] if k in table and keep_first else w
        table[k] = [k, n, v, first_w]
    return sorted(map(tuple, table.values()))


@pytest.mark.parametrize("keep_first", [[], ["w"]])
@pytest.mark.parametrize("partitions", [1, 5])
def test_upsert(spark, keep_first, partitions):
    rng = random.Random(7)
    columns = "k string, n int, v int, w int"
    base = [(f"k{n}", -1, n, n) for n in range(30)]
    changes = [
        ("hot" if rng.random() < 0.3 else f"k{rng.randrange(60)}", n, rng.randrange(99), n)
        for n in range(300)
    ]
    old = spark.createDataFrame(base, columns)
    new = spark.createDataFrame(changes, columns).repartition(partitions)
    once = upsert(old, new, ["k"], ["n"], keep_first)
    assert sorted(map(tuple, once.collect())) == one_by_one(base, changes, keep_first)
    twice = upsert(once, new, ["k"], ["n"], keep_first)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    log = old.unionByName(new)
    assert sorted(map(tuple, fold(log, ["k"], ["n"], keep_first).collect())) == one_by_one(
        [], base + changes, keep_first
    )


def test_history_is_not_shuffled_for_a_small_dimension(spark, folder):
    spark.range(1000).selectExpr("id % 10 AS k", "id AS t", "id AS v").write.parquet(f"{folder}/h")
    spark.range(10).selectExpr("id AS k", "id AS d").write.parquet(f"{folder}/d")
    history, dimension = spark.read.parquet(f"{folder}/h"), spark.read.parquet(f"{folder}/d")
    plan = plan_of(latest_with_ties(history, ["k"], "t", dimension))
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin Inner") >= 2
    # The only shuffle is that of the partial maxima.
    assert plan.count("hashpartitioning") == 1
    assert "partial_max" in plan


def test_latest_one_sorts_only_what_may_be_newest(spark):
    df = spark.range(100).select(
        F.lit("a").alias("k"), F.col("id").cast("timestamp").alias("t"), F.col("id").alias("n")
    )
    plan = plan_of(latest_one(df, ["k"], "t", ["n"]), "simple")
    join = plan.index("BroadcastHashJoin")
    assert plan.index("partial_max_by") < join and "Sort" not in plan[join:]
    assert "HashAggregate(keys=[" in plan[join:]
