"""The sorted merge gives what the join gives, whatever the ranges."""

import datetime as dt
import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from martflow.operators import asof
from martflow.operators.asof import asof_merge
from martflow.operators.scd import END, START
from martflow.operators.temporal import asof_lookup

from .conftest import rows

D = dt.datetime
BEGIN = D(2024, 1, 1)


def histories(seed, keys, most):
    """Versions without overlap, some with gaps, some empty, some open."""
    rng = random.Random(seed)
    out = []
    for k in keys:
        at = BEGIN
        for v in range(rng.randint(0, most)):
            at += dt.timedelta(hours=rng.randint(0, 30))
            end = at + dt.timedelta(hours=rng.choice([0, 1, 20, 30]))
            out.append((k, f"{k}/{v}", at, end))
            at = end
        if rng.random() < 0.5:
            out.append((k, f"{k}/open", at + dt.timedelta(hours=1), None))
    return out


def visits(seed, keys, count):
    rng = random.Random(seed)
    own = [k for k in keys if k is not None]
    return [
        (
            i,
            rng.choice([own[0], rng.choice(own), None]),
            rng.choice([None, *[BEGIN + dt.timedelta(hours=rng.randint(-20, 900))] * 9]),
            {"a": i},
        )
        for i in range(count)
    ]


@pytest.fixture
def many_ranges(spark):
    names = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("precision", ["date", "timestamp"])
@pytest.mark.parametrize("batch", ["3", "10000"])
def test_same_as_the_join(spark, many_ranges, precision, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        keys = list(range(8)) + [None]
        dim = spark.createDataFrame(
            histories(1, keys, 40), f"k long, sk string, {START} timestamp_ntz, {END} timestamp_ntz"
        )
        left = spark.createDataFrame(
            visits(2, keys, 600), "id long, k long, at timestamp_ntz, __time map<string,long>"
        ).repartition(5)
        for options in ({}, {"only": F.col("id") % 2 == 0}, {"open_until": "2024-01-20"}):
            how = dict(on=[("k", "k")], event="at", take={"sk": "found", START: "since"}, precision=precision)
            theirs = asof_lookup(left, dim, **how, **options)
            mine = asof_merge(left, dim, **how, **options)
            assert mine.schema == theirs.schema
            assert rows(mine) == rows(theirs)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_several_keys_and_expressions(spark):
    dim = spark.createDataFrame(
        [("a ", 1, "x", BEGIN, None), ("a", 2, "y", BEGIN, None)],
        f"k string, n int, sk string, {START} timestamp_ntz, {END} timestamp_ntz",
    )
    left = spark.createDataFrame([(1, " a", 2), (2, "a", 1), (3, "b", 1), (4, "a", None)], "id int, k string, n int")
    on = [(F.trim("k"), F.trim("k")), ("n", "n")]
    out = asof_merge(left, dim, on, F.lit(D(2024, 5, 1)), ["sk"])
    assert rows(out, "id", "sk") == [(1, "y"), (2, "x"), (3, None), (4, None)]


def test_nothing_on_either_side(spark):
    dim = spark.createDataFrame([], f"k long, sk string, {START} timestamp_ntz, {END} timestamp_ntz")
    left = spark.createDataFrame([(1, BEGIN)], "k long, at timestamp_ntz")
    assert rows(asof_merge(left, dim, [("k", "k")], "at", ["sk"]), "k", "sk") == [(1, None)]
    assert rows(asof_merge(left.where("k > 5"), dim, [("k", "k")], "at", ["sk"])) == []


def test_one_version_for_all_ranges(spark, many_ranges):
    """The version of a key begins in one range and holds for those after it."""
    dim = spark.createDataFrame(
        [(1, "only", BEGIN, None)], f"k long, sk string, {START} timestamp_ntz, {END} timestamp_ntz"
    )
    at = F.timestamp_add("SECOND", F.col("id"), F.lit(BEGIN).cast("timestamp_ntz"))
    left = spark.range(5000).select("id", F.lit(1).cast("long").alias("k"), at.alias("at"))
    out = asof_merge(left, dim, [("k", "k")], "at", ["sk"], "timestamp")
    assert out.where("sk = 'only'").count() == 5000


def test_a_hot_key_is_spread_evenly(spark, many_ranges, monkeypatch):
    """One key holds a third of events and versions; no range has three times the median."""
    kept = []
    monkeypatch.setattr(asof, "materialize", lambda df: kept.append(real(df)) or kept[-1])
    from martflow.sources.tables import materialize as real

    key = F.when(F.col("id") % 3 > 0, F.col("id") % 50 + 1).otherwise(F.lit(0)).alias("k")
    at = F.timestamp_add("SECOND", F.col("id"), F.lit(BEGIN).cast("timestamp_ntz"))
    left = spark.range(0, 40000, 1, 8).select("id", key, at.alias("at"))
    start = F.timestamp_add("SECOND", F.lit(-1), F.col("at"))
    # Each version ends with the next event but one of its key, or never.
    dim = left.select("k", F.col("id").alias("sk"), start.alias(START), F.col("at").alias(END))
    out = asof_merge(left, dim, [("k", "k")], F.timestamp_add("SECOND", F.lit(-1), "at"), ["sk"], "timestamp")
    assert out.where("sk = id").count() == 40000
    sizes = [r["count"] for r in kept[0].groupBy("__range").count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 3 * median(sizes)
