import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from martflow.operators.scd import END, START, applied_until, current, scd2_apply, scd2_build
from martflow.plans.history import Dimension, applied_snapshot, apply_snapshot, first_history, read_history

from .conftest import rows

T = [dt.datetime(2024, 1, d) for d in (1, 2, 3, 4)]
COLUMNS = "k int, seg string, bal int"


def snap(spark, data):
    return spark.createDataFrame(data, COLUMNS)


def fold(spark, snapshots):
    versions = first_history(snap(spark, snapshots[0]), T[0])
    for at, data in zip(T[1:], snapshots[1:]):
        versions = scd2_apply(versions, snap(spark, data), ["k"], ["seg"], at)
    return versions


def build(spark, snapshots):
    stacked = None
    for at, data in zip(T, snapshots):
        part = snap(spark, data).withColumn("at", F.lit(at).cast("timestamp_ntz"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return scd2_build(stacked, ["k"], ["seg"], "at", T[: len(snapshots)])


def test_insert_change_update_delete_reappear(spark):
    snapshots = [
        [(1, "a", 1), (2, "a", 1), (3, "a", 1)],
        [(1, "b", 1), (2, "a", 9), (4, None, 1)],
        [(1, "b", 1), (2, "a", 9), (3, "a", 1), (4, "x", 1)],
    ]
    expected = sorted(
        [
            (1, "a", 1, T[0], T[1]),
            (1, "b", 1, T[1], None),
            (2, "a", 9, T[0], None),
            (3, "a", 1, T[0], T[1]),
            (3, "a", 1, T[2], None),
            (4, None, 1, T[1], T[2]),
            (4, "x", 1, T[2], None),
        ],
        key=str,
    )
    assert rows(fold(spark, snapshots)) == expected
    assert rows(build(spark, snapshots)) == expected


def test_older_or_equal_snapshot_changes_nothing(spark):
    versions = fold(spark, [[(1, "a", 1)], [(1, "b", 1)]])
    again = scd2_apply(versions, snap(spark, []), ["k"], ["seg"], T[1], applied_until(versions))
    assert rows(again) == rows(versions)


def test_a_missing_key_is_a_key(spark):
    versions = fold(spark, [[(None, "a", 1)], [(None, "a", 2)], [(None, "b", 2)]])
    assert rows(versions) == sorted([(None, "a", 2, T[0], T[2]), (None, "b", 2, T[2], None)], key=str)


def test_duplicate_key_fails(spark):
    with pytest.raises(Exception, match="duplicate key in snapshot"):
        fold(spark, [[(1, "a", 1)], [(1, "b", 1), (1, "c", 1)]]).collect()
    with pytest.raises(Exception, match="duplicate key in snapshot"):
        build(spark, [[(1, "a", 1), (1, "b", 1)], []]).collect()


states = st.dictionaries(
    st.integers(0, 5), st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 2)), max_size=6
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(states, min_size=2, max_size=4))
def test_history_properties(spark, snaps):
    snapshots = [[(k, seg, bal) for k, (seg, bal) in s.items()] for s in snaps]
    versions = build(spark, snapshots)
    got = [tuple(r) for r in versions.collect()]
    assert sorted(got, key=str) == rows(fold(spark, snapshots))
    assert sorted(r[:3] for r in got if r[4] is None) == sorted(snapshots[-1]) or sorted(
        (r[:3] for r in got if r[4] is None), key=str
    ) == sorted(snapshots[-1], key=str)
    spans = {}
    for k, _, _, start, end in got:
        spans.setdefault(k, []).append((start, end or dt.datetime.max))
    for s in spans.values():
        s.sort()
        assert all(a < b for a, b in s)
        assert all(x[1] <= y[0] for x, y in zip(s, s[1:]))


def test_stored_history_keeps_closed_versions_and_ignores_replays(spark, database):
    spec, table = Dimension("d", ("k",), ("seg",)), f"{database}.d"
    steps = [
        (T[0], [(1, "a", 1), (2, "a", 1)]),
        (T[1], [(1, "b", 1)]),
        (T[2], [(1, "c", 1), (2, "a", 2)]),
    ]
    for at, data in steps:
        assert apply_snapshot(spark, table, spec, snap(spark, data), at)
        assert not apply_snapshot(spark, table, spec, snap(spark, []), at)
    assert applied_snapshot(spark, table) == T[2]
    expected = fold(spark, [d for _, d in steps])
    assert rows(read_history(spark, table), *expected.columns) == rows(expected)
    assert rows(current(read_history(spark, table)), "k", "seg") == [(1, "c"), (2, "a")]


def test_stored_history_can_close_everything(spark, database):
    spec, table = Dimension("d", ("k",), ("seg",)), f"{database}.d"
    apply_snapshot(spark, table, spec, snap(spark, [(1, "a", 1)]), T[0])
    apply_snapshot(spark, table, spec, snap(spark, []), T[1])
    assert rows(read_history(spark, table), "k", START, END) == [(1, T[0], T[1])]


def test_retry_after_a_failed_run_repeats_nothing(spark, database):
    """A run that stored its rows but not its mark is done again."""
    spec, table = Dimension("d", ("k",), ("seg",)), f"{database}.d"
    apply_snapshot(spark, table, spec, snap(spark, [(1, "a", 1)]), T[0])
    apply_snapshot(spark, table, spec, snap(spark, [(1, "b", 1)]), T[1])
    before = rows(read_history(spark, table))
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES ('martflow.applied_until')")
    apply_snapshot(spark, table, spec, snap(spark, [(1, "b", 1)]), T[1])
    assert rows(read_history(spark, table)) == before


def test_retry_after_half_a_run(spark, database):
    """A run that stored only the closed versions is done again."""
    spec, table = Dimension("d", ("k",), ("seg",)), f"{database}.d"
    apply_snapshot(spark, table, spec, snap(spark, [(1, "a", 1), (2, "a", 1)]), T[0])
    closed = snap(spark, [(1, "a", 1)]).withColumns(
        {
            START: F.lit(T[0]).cast("timestamp_ntz"),
            END: F.lit(T[1]).cast("timestamp_ntz"),
            "closed_in": F.lit("2024-01"),
            "key_bucket": F.lit("closed"),
        }
    )
    closed.write.mode("append").insertInto(table)
    apply_snapshot(spark, table, spec, snap(spark, [(1, "b", 1), (2, "a", 1)]), T[1])
    assert rows(read_history(spark, table)) == rows(
        fold(spark, [[(1, "a", 1), (2, "a", 1)], [(1, "b", 1), (2, "a", 1)]])
    )


def test_unknown_and_repeated_snapshot_times_fail(spark):
    stacked = spark.createDataFrame(
        [("a", "x", T[0]), ("a", "y", T[1])], "k string, seg string, at timestamp_ntz"
    )
    with pytest.raises(Exception, match="not in the timeline"):
        scd2_build(stacked, ["k"], ["seg"], "at", T[:1]).collect()
    with pytest.raises(ValueError, match="twice"):
        scd2_build(stacked, ["k"], ["seg"], "at", [T[0], T[0], T[1]])
