"""Snapshots are compared in the buckets alone that changed."""

import datetime as dt
import random

import pytest

from martflow.operators import checksums
from martflow.operators.buckets import BUCKET
from martflow.operators.scd import END, START
from martflow.plans import history
from martflow.plans.history import Dimension, apply_snapshot, read_history

from .conftest import rows

SPEC = Dimension("d", ("k",), ("v",))
KIND = "k int, v string, w string"


def at(step):
    return dt.datetime(2024, 1, 1 + step)


def files(spark, table, slices="open"):
    return {f for f in spark.read.table(table).inputFiles() if f"closed_in={slices}" in f}


def test_random_snapshots_equal_the_plain_rule(spark, database):
    """Keys appear, change, vanish and come back; a small limit makes many buckets."""
    table, rng, versions = f"{database}.d", random.Random(6), {}
    for step in range(5):
        data = {k: (rng.choice("ab"), rng.choice("xy")) for k in range(60) if rng.random() < 0.8}
        if step == 3:
            data = {}
        if step == 4:
            data = {None: ("a", "x"), 5: ("a", None), 6: (None, "a")}
        frame = spark.createDataFrame([(k, *v) for k, v in data.items()], KIND)
        assert apply_snapshot(spark, table, SPEC, frame, at(step), rows_per_bucket=4)
        for k, own in versions.items():
            last = own[-1]
            if last[3] is None and (k not in data or data[k][0] != last[0]):
                own[-1] = (*last[:3], at(step))
        for k, (v, w) in data.items():
            own = versions.setdefault(k, [])
            if own and own[-1][3] is None:
                own[-1] = (v, w, own[-1][2], None)
            else:
                own.append((v, w, at(step), None))
        want = sorted([(k, *v) for k, own in versions.items() for v in own], key=str)
        assert rows(read_history(spark, table), "k", "v", "w", START, END) == want


def test_unchanged_buckets_are_neither_read_nor_written(spark, database, monkeypatch):
    table = f"{database}.d"
    data = [(k, "a", "x") for k in range(2000)]
    apply_snapshot(spark, table, SPEC, spark.createDataFrame(data, KIND), at(0), rows_per_bucket=20)
    before, read = files(spark, table), []
    real = history.scd2_changes
    monkeypatch.setattr(history, "scd2_changes", lambda old, *rest: read.append(old) or real(old, *rest))
    changed = [(k, "b" if k in (7, 8) else "a", "x") for k in range(2000)]
    apply_snapshot(spark, table, SPEC, spark.createDataFrame(changed, KIND), at(1), rows_per_bucket=20)
    assert len(before) >= 100 and 1 <= len(before - files(spark, table)) <= 2
    plan = read[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "key_bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    assert read[0].count() < 60
    assert rows(read_history(spark, table).where(f"{END} IS NOT NULL"), "k") == [(7,), (8,)]
    # the same snapshot once more, later: nothing to compare
    read.clear()
    apply_snapshot(spark, table, SPEC, spark.createDataFrame(changed, KIND), at(2), rows_per_bucket=20)
    assert read == []


def test_a_lost_run_is_done_again(spark, database, monkeypatch):
    table = f"{database}.d"
    first = spark.createDataFrame([(k, "a", "x") for k in range(50)], KIND)
    apply_snapshot(spark, table, SPEC, first, at(0), rows_per_bucket=5)
    second = spark.createDataFrame([(k, "b", "x") for k in range(40)], KIND)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(history, "store_sums", fail)
        with pytest.raises(RuntimeError):
            apply_snapshot(spark, table, SPEC, second, at(1), rows_per_bucket=5)
    apply_snapshot(spark, table, SPEC, second, at(1), rows_per_bucket=5)
    held = read_history(spark, table)
    assert held.count() == 90 and held.where(f"{END} IS NULL").count() == 40


def test_a_lost_first_run_keeps_its_width(spark, database, monkeypatch):
    table = f"{database}.d"
    data = spark.createDataFrame([(k, "a", "x") for k in range(50)], KIND)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(history, "set_table_property", fail)
        with pytest.raises(RuntimeError):
            apply_snapshot(spark, table, SPEC, data, at(0), rows_per_bucket=5)
    apply_snapshot(spark, table, SPEC, data.where("k < 30"), at(1), rows_per_bucket=5)
    held = read_history(spark, table)
    assert held.count() == 50 and held.where(f"{END} IS NULL").count() == 30


def test_the_tree_finds_what_differs(spark):
    names = [f"b{i:06b}" for i in range(64)]
    kind = f"{BUCKET} string, n long, total long, mixed long"
    frame = lambda rows: spark.createDataFrame(rows, kind)
    old = [(b, 3, i + 1, 7) for i, b in enumerate(names) if i != 9]
    new = [(b, 3, i + 1 + (i == 40), 7) for i, b in enumerate(names) if i != 20]
    found = checksums.changed_buckets(frame(old), frame(new), 7)
    assert found == [names[9], names[20], names[40]]
    assert checksums.changed_buckets(frame(old), frame(old), 7) == []
    assert checksums.changed_buckets(frame(old), frame([]), 1) == ["b"]


def test_values_that_change_columns_change_the_sums(spark):
    kind = f"{BUCKET} string, v string, w string"
    one = spark.createDataFrame([("b", None, "a")], kind)
    other = spark.createDataFrame([("b", "a", None)], kind)
    sums = [checksums.bucket_sums(df, ["v", "w"]) for df in (one, other)]
    assert checksums.changed_buckets(*sums, 1) == ["b"]
