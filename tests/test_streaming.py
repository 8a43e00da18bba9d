import datetime as dt

from martflow.plans.history import Dimension, read_history
from martflow.sources.tables import new_folder
from martflow.streaming.snapshots import announce, follow_snapshots
from martflow.streaming.upserts import follow_changes

from .conftest import rows

T = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]


def test_snapshots_are_applied_once_and_in_time_order(spark, database):
    base = new_folder(spark, "stream")
    spec, table = Dimension("d", ("k",), ("v",)), f"{database}.d"
    for at, data in zip(T, ([(1, "a"), (2, "a")], [(1, "b")], [(1, "b"), (2, "a")])):
        spark.createDataFrame(data, "k int, v string").write.parquet(f"{base}/{at:%d}")
    announce(spark, f"{base}/manifest", T[1], f"{base}/02")
    announce(spark, f"{base}/manifest", T[0], f"{base}/01")
    run = lambda checkpoint: follow_snapshots(
        spark, f"{base}/manifest", table, spec, f"{base}/{checkpoint}"
    ).awaitTermination()
    run("one")
    announce(spark, f"{base}/manifest", T[2], f"{base}/03")
    run("one")
    expected = sorted(
        [(1, "a", T[0], T[1]), (1, "b", T[1], None), (2, "a", T[0], T[1]), (2, "a", T[2], None)], key=str
    )
    assert rows(read_history(spark, table)) == expected
    # A lost checkpoint replays every snapshot.
    run("two")
    assert rows(read_history(spark, table)) == expected


def test_late_changes_do_not_win(spark, database):
    base, table = new_folder(spark, "stream"), f"{database}.t"
    kinds = "k int, v string, at timestamp_ntz"

    def feed(data):
        spark.createDataFrame(data, kinds).coalesce(1).write.mode("append").parquet(f"{base}/in")
        changes = spark.readStream.schema(kinds).parquet(f"{base}/in")
        follow_changes(spark, changes, table, ["k"], "at", f"{base}/checkpoint").awaitTermination()

    feed([(1, "new", T[2]), (2, "x", T[0])])
    feed([(1, "late", T[1]), (2, "y", T[1]), (2, "z", T[1]), (3, "n", T[0])])
    got = dict((k, v) for k, v, _ in rows(spark.read.table(table).select("k", "v", "at")))
    assert got[1] == "new" and got[2] in ("y", "z") and got[3] == "n"
