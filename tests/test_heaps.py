"""Stored lists of the last rows equal those of all rows at once."""

import random

import pytest
from pyspark.sql import functions as F

from martflow.operators.heaps import HEAP, heap_rows, merge_heaps

from .conftest import rows

KIND = "k int, day int, doc int, v string"


def merge(spark, table, data, **options):
    merge_heaps(spark, table, spark.createDataFrame(data, KIND), ["k"], "doc", ["day"], 3, **options)


def last_three(seen):
    by_key = {}
    for (k, doc), (day, v) in seen.items():
        by_key.setdefault(k, []).append((day, doc, v))
    return sorted(
        ((k, *r) for k, own in by_key.items() for r in sorted(own, reverse=True)[:3]), key=str
    )


@pytest.mark.parametrize("rows_per_bucket", [2, 1000])
def test_random_batches_with_late_and_repeated_rows(spark, database, rows_per_bucket):
    table, rng, seen = f"{database}.t", random.Random(rows_per_bucket), {}
    days = {doc: rng.randrange(20) for doc in range(200)}
    for step in range(5):
        data = {}
        for _ in range(40):
            doc = rng.randrange(200)
            data[doc] = (None if doc % 9 == 0 else doc % 9, days[doc], doc, f"{step}")
        merge(spark, table, list(data.values()), rows_per_bucket=rows_per_bucket)
        seen |= {(k, doc): (day, v) for k, day, doc, v in data.values()}
        held = spark.read.table(table)
        assert rows(heap_rows(held, ["k"]), "k", "day", "doc", "v") == last_three(seen)
        assert held.where(F.size(HEAP) > 3).count() == 0


def test_a_repeated_batch_changes_nothing(spark, database):
    table = f"{database}.t"
    data = [(1, d, d, "a") for d in range(6)] + [(2, 1, 9, "a"), (2, 1, 9, "a")]
    for _ in range(2):
        merge(spark, table, data)
    got = spark.read.table(table).where("k = 2").select(F.size(HEAP)).first()
    assert got[0] == 1
    assert [r["day"] for r in spark.read.table(table).where("k = 1").first()[HEAP]] == [5, 4, 3]


def test_only_the_buckets_of_the_batch_are_rewritten(spark, database):
    table = f"{database}.t"
    merge(spark, table, [(k, 1, k, "a") for k in range(300)], rows_per_bucket=10)
    before = set(spark.read.table(table).inputFiles())
    merge(spark, table, [(5, 2, 1000, "b")], rows_per_bucket=10)
    gone = before - set(spark.read.table(table).inputFiles())
    assert len(gone) == 1 and len(before) > 20
    assert spark.read.table(table).count() == 300


def test_an_empty_batch(spark, database):
    table = f"{database}.t"
    merge(spark, table, [])
    merge(spark, table, [(1, 1, 1, "a")])
    merge(spark, table, [])
    assert spark.read.table(table).count() == 1
