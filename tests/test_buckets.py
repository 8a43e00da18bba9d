"""Bucketed tables and the index of keys, against plain merges."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martflow.operators import buckets, keyindex
from martflow.operators.buckets import BUCKET, bucket_of, split_prefixes, stored_buckets, upsert_bucketed
from martflow.operators.upsert import upsert
from martflow.plans import facts
from martflow.plans.facts import FACTS, Fact, load_fact
from martflow.sources.tables import work_dir

from .conftest import rows

KIND = "k int, v string, row_hash string"


def batch(spark, pairs):
    return spark.createDataFrame([(k, v, v) for k, v in pairs], KIND)


def files(spark, table):
    return set(spark.read.table(table).inputFiles())


def test_random_batches_equal_a_dictionary(spark, database):
    table, rng, want = f"{database}.t", random.Random(4), {}
    for step in range(6):
        pairs = {rng.choice([None, *range(400)]): f"{step}.{i}" for i in range(60 * (step + 1))}
        want |= pairs
        upsert_bucketed(spark, table, batch(spark, list(pairs.items())), ["k"], rows_per_bucket=40)
        got = {r["k"]: r["v"] for r in spark.read.table(table).collect()}
        assert got == want
    sizes = [r["count"] for r in spark.read.table(table).groupBy(BUCKET).count().collect()]
    assert max(sizes) <= 40 and len(sizes) > 8
    lengths = {len(b) for b in stored_buckets(spark, table)}
    assert len(lengths) > 1


def test_a_batch_touches_the_buckets_of_its_keys_only(spark, database):
    table = f"{database}.t"
    upsert_bucketed(spark, table, batch(spark, [(i, "a") for i in range(3000)]), ["k"], rows_per_bucket=20)
    before = files(spark, table)
    upsert_bucketed(spark, table, batch(spark, [(i, "b") for i in range(5)]), ["k"], rows_per_bucket=20)
    after = files(spark, table)
    held = spark.read.table(table)
    assert held.where("v = 'b'").count() == 5 and held.count() == 3000
    assert 0 < len(before - after) <= 5 and len(before) > 100


def test_only_buckets_of_the_batch_are_read(spark, database):
    table = f"{database}.t"
    upsert_bucketed(spark, table, batch(spark, [(i, "a") for i in range(500)]), ["k"], rows_per_bucket=20)
    few = buckets.with_bucket(spark, table, batch(spark, [(3, "x")]), ["k"])
    plan = buckets.buckets_for(spark, table, few)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key_bucket" in plan


def test_an_unfinished_split_is_undone(spark, database):
    """The parts of a bucket that still stands don't count."""
    table = f"{database}.t"
    upsert_bucketed(spark, table, batch(spark, [(i, "a") for i in range(50)]), ["k"])
    half = spark.read.table(table).where("k < 20").withColumn(BUCKET, F.lit("b0"))
    half.select(*spark.read.table(table).columns).write.mode("append").insertInto(table)
    assert spark.read.table(table).count() == 70
    upsert_bucketed(spark, table, batch(spark, [(1, "b"), (99, "c")]), ["k"], rows_per_bucket=10)
    got = {r["k"]: r["v"] for r in spark.read.table(table).collect()}
    assert got == {i: "a" for i in range(50)} | {1: "b", 99: "c"}
    assert spark.read.table(table).count() == 51


def test_buckets_are_prefixes_without_gaps(spark):
    split = split_prefixes(["b00", "b010", "b1"])
    assert split == {"b", "b0", "b01"}
    bits = spark.createDataFrame([("b0000",), ("b0101",), ("b0111",), ("b1010",)], "bits string")
    assert [r[0] for r in bits.select(bucket_of(F.col("bits"), split)).collect()] == ["b00", "b010", "b011", "b1"]
    assert [r[0] for r in bits.select(bucket_of(F.col("bits"), set())).distinct().collect()] == ["b"]


def test_types_of_the_stored_key_decide(spark, database):
    table = f"{database}.t"
    upsert_bucketed(spark, table, batch(spark, [(i, "a") for i in range(100)]), ["k"], rows_per_bucket=10)
    wide = spark.createDataFrame([(i, "b", "b") for i in range(100)], "k long, v string, row_hash string")
    upsert_bucketed(spark, table, wide, ["k"], rows_per_bucket=10)
    assert rows(spark.read.table(table).groupBy("v").count()) == [("b", 100)]


def moved(spark, data):
    return spark.createDataFrame(data, "k int, p string, v int, row_hash string")


def test_an_index_finds_moved_rows(spark, database):
    plain, indexed = f"{database}.a", f"{database}.b"
    rng = random.Random(2)
    for step in range(5):
        keys = rng.sample([None, *range(60)], 25)
        data = [(k, rng.choice(["1", "2", "3", None]), step, rng.choice("xyz")) for k in keys]
        for table, index in ((plain, False), (indexed, True)):
            upsert(spark, table, moved(spark, data), ["k"], partition_by=["p"], key_index=index)
        assert rows(spark.read.table(indexed), "k", "p", "v") == rows(spark.read.table(plain), "k", "p", "v")
    known = spark.read.table(keyindex.index_of(indexed))
    assert known.select(keyindex.HASHED).distinct().count() == spark.read.table(indexed).count()


def test_an_index_reads_few_buckets_and_periods(spark, database):
    table = f"{database}.t"
    data = [(i, f"p{i // 10:03}", 0, "a") for i in range(600)]
    upsert(spark, table, moved(spark, data), ["k"], partition_by=["p"], key_index=True)
    before = files(spark, table)
    wanted = moved(spark, [(15, "p001", 1, "b"), (599, "p000", 1, "b")])
    found = keyindex.partitions_of(spark, table, wanted, ["k"], ["p"])
    assert sorted(r["p"] for r in found) == ["p001", "p059"]
    upsert(spark, table, wanted, ["k"], partition_by=["p"], key_index=True)
    assert spark.read.table(table).where("v = 1").count() == 2 and spark.read.table(table).count() == 600
    gone = {f.split("p=")[1][:4] for f in before - files(spark, table)}
    assert gone == {"p000", "p001", "p059"}


def test_a_table_from_before_gets_an_index(spark, database):
    table = f"{database}.t"
    upsert(spark, table, moved(spark, [(1, "a", 0, "x"), (2, "b", 0, "x")]), ["k"], partition_by=["p"])
    upsert(spark, table, moved(spark, [(2, "c", 1, "y")]), ["k"], partition_by=["p"], key_index=True)
    assert rows(spark.read.table(table), "k", "p", "v") == [(1, "a", 0), (2, "c", 1)]


def test_pairs_come_before_rows(spark, database, monkeypatch):
    """A driver lost between the two leaves an index that knows too much, not too little."""
    table = f"{database}.t"
    upsert(spark, table, moved(spark, [(1, "a", 0, "x")]), ["k"], partition_by=["p"], key_index=True)
    lost = moved(spark, [(2, "b", 0, "x")])
    from martflow.operators import upsert as module

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(module, "by_partition", fail)
        with pytest.raises(RuntimeError):
            upsert(spark, table, lost, ["k"], partition_by=["p"], key_index=True)
    assert spark.read.table(table).count() == 1
    upsert(spark, table, lost, ["k"], partition_by=["p"], key_index=True)
    assert rows(spark.read.table(table), "k", "p") == [(1, "a"), (2, "b")]


def test_a_lost_grain_is_read_off_the_periods(spark, database, monkeypatch, day):
    fact = Fact("f", ("k", "d"), "d", ())
    data = spark.createDataFrame([(1, day("2024-01-05"), 5)], "k int, d date, v int")

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(facts, "set_table_property", fail)
        with pytest.raises(RuntimeError):
            load_fact(spark, database, fact, data, {}, grain="day")
    load_fact(spark, database, fact, data, {})
    assert rows(spark.read.table(f"{database}.f"), "k", "event_period") == [(1, "2024-01-05")]
    with pytest.raises(ValueError):
        load_fact(spark, database, fact, data, {}, grain="month")


def test_facts_without_a_date_in_the_key_are_indexed(spark, database, day):
    fact = FACTS["fact_product_prices"]
    assert fact.event not in fact.keys and fact.period not in fact.keys
    lookups = Fact("g", ("k",), "d", ())
    for when, v in (("2024-01-05", 1), ("2024-03-05", 2)):
        data = spark.createDataFrame([(1, day(when), v), (v * 10, day(when), v)], "k int, d date, v int")
        load_fact(spark, database, lookups, data, {})
    held = spark.read.table(f"{database}.g")
    assert rows(held, "k", "v", "event_period") == [(1, 2, "2024-03"), (10, 1, "2024-01"), (20, 2, "2024-03")]
    assert spark.read.table(f"{database}.{keyindex.index_of('g')}").count() == 4

def test_a_new_table_is_not_copied_for_its_index(spark, database, monkeypatch):
    folder, data = Path(work_dir(spark)), [(1, "a", 0, "x"), (None, "b", 0, "x")]
    copies = set(folder.glob("stage-*"))
    upsert(spark, f"{database}.t", moved(spark, data), ["k"], partition_by=["p"], key_index=True)
    made = set(folder.glob("stage-*")) - copies
    assert not [p for p in made if "v" in spark.read.parquet(str(p)).columns]
    lost = f"{database}.lost"

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(keyindex, "index_stored", fail)
        with pytest.raises(RuntimeError):
            upsert(spark, lost, moved(spark, data), ["k"], partition_by=["p"], key_index=True)
    for table in (f"{database}.t", lost):
        upsert(spark, table, moved(spark, [(None, "c", 1, "y")]), ["k"], partition_by=["p"], key_index=True)
        assert rows(spark.read.table(table), "k", "p", "v") == [(1, "a", 0), (None, "c", 1)]


def test_an_index_left_over_learns_a_new_table_first(spark, database):
    table = f"{database}.t"
    for data in ([(1, "a", 0, "x")], [(2, "b", 0, "x"), (1, "c", 0, "x")]):
        upsert(spark, table, moved(spark, data), ["k"], partition_by=["p"], key_index=True)
        if data[0][0] == 1:
            spark.sql(f"DROP TABLE {table}")
    upsert(spark, table, moved(spark, [(1, "d", 1, "y")]), ["k"], partition_by=["p"], key_index=True)
    assert rows(spark.read.table(table), "k", "p") == [(1, "d"), (2, "b")]
