import datetime as dt

import pytest
from pyspark.sql import functions as F

from martflow.operators.scd import END, START
from martflow.operators.temporal import all_versions, asof_lookup

from .conftest import rows

D = dt.datetime


@pytest.fixture
def dim(spark):
    data = [
        ("a", "v1", D(2024, 1, 1), D(2024, 1, 10, 9)),
        ("a", "v2", D(2024, 1, 10, 9), D(2024, 1, 10, 17)),
        ("a", "v3", D(2024, 1, 10, 17), None),
        ("b", "w1", D(2024, 1, 5), D(2024, 1, 6)),
        (None, "n", D(2024, 1, 1), None),
    ]
    return spark.createDataFrame(data, f"k string, sk string, {START} timestamp_ntz, {END} timestamp_ntz")


@pytest.fixture
def events(spark):
    data = [
        (1, "a", D(2024, 1, 9)),
        (2, "a", D(2024, 1, 10)),
        (3, "a", D(2024, 1, 10, 12)),
        (4, "a", D(2023, 12, 31)),
        (5, "b", D(2024, 1, 6)),
        (6, None, D(2024, 1, 6)),
        (7, "a", D(2099, 12, 31)),
    ]
    return spark.createDataFrame(data, "id int, k string, at timestamp_ntz")


def found(df):
    return {r["id"]: r["sk"] for r in df.collect()}


def test_date_precision_gives_a_day_to_its_last_version(events, dim):
    got = found(asof_lookup(events, dim, [("k", "k")], "at", ["sk"]))
    assert got == {1: "v1", 2: "v3", 3: "v3", 4: None, 5: None, 6: None, 7: "v3"}


def test_open_versions_can_end_on_a_day(events, dim):
    got = found(asof_lookup(events, dim, [("k", "k")], "at", ["sk"], open_until="2099-12-31"))
    assert got[3] == "v3" and got[7] is None


def test_timestamp_precision_is_exact_and_half_open(events, dim):
    got = found(asof_lookup(events, dim, [("k", "k")], "at", ["sk"], "timestamp"))
    assert got == {1: "v1", 2: "v1", 3: "v2", 4: None, 5: None, 6: None, 7: "v3"}


def test_only_limits_the_lookup_and_keeps_the_rows(events, dim):
    got = found(asof_lookup(events, dim, [("k", "k")], "at", ["sk"], only=F.col("id") > 2))
    assert got == {1: None, 2: None, 3: "v3", 4: None, 5: None, 6: None, 7: "v3"}


def test_take_renames_and_left_columns_survive(events, dim):
    df = asof_lookup(events, dim, [(F.trim("k"), F.trim("k"))], "at", {"sk": "key", START: "since"})
    assert df.columns == ["id", "k", "at", "key", "since"]


def test_no_pairwise_join(events, dim):
    df = asof_lookup(events, dim, [("k", "k")], "at", ["sk"], "timestamp")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_all_versions_or_the_open_one(spark, dim):
    left = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert len(rows(all_versions(left, dim, ["k"]))) == 5
    assert rows(all_versions(left, dim, ["k"], current_only=True), "k", "sk") == [
        ("a", "v3"),
        ("b", None),
        ("c", None),
    ]


def test_hot_key_is_split(spark):
    """One customer holds most events; its partition is read by several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 > 0, F.col("id") % 50).otherwise(F.lit(0))
        at = F.timestamp_add("SECOND", F.col("id"), F.lit(D(2024, 1, 1)).cast("timestamp_ntz"))
        events = spark.range(0, 60000, 1, 8).select("id", key.alias("k"), at.alias("at"))
        starts = [(k, f"{k}/{v}", D(2024, 1, 1, 8 * v), D(2024, 1, 1, 8 * v + 8)) for k in range(50) for v in (0, 1)]
        dim = spark.createDataFrame(starts, f"k long, sk string, {START} timestamp_ntz, {END} timestamp_ntz")
        found = asof_lookup(events, dim, [("k", "k")], "at", ["sk"], "timestamp")
        counts = found.groupBy("k", "sk").agg(F.count(F.lit(1)).alias("n"))
        got = {(r["k"], r["sk"]): r["n"] for r in counts.collect()}
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        expected = {}
        for i in range(60000):
            k = i % 50 if i % 3 else 0
            sk = f"{k}/{i // 28800}" if i < 57600 else None
            expected[k, sk] = expected.get((k, sk), 0) + 1
        assert got == expected
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_events_carry_no_helper_columns_to_the_join(events, dim):
    df = asof_lookup(events, dim, [("k", "k")], "at", ["sk"], only=F.col("id") > 2)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert not any(name in plan for name in ("__event", "__only", "__l0"))
