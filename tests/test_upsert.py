import datetime as dt
import hashlib
import time
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from martflow.functions.keys import row_hash
from martflow.operators.control import advance, advance_table, read_watermark, since, table_maxima
from martflow.operators.reduce import NEAR, near, with_key
from martflow.operators.upsert import append_once, merge_frames, replace_period, replace_slice, upsert
from martflow.sources import tables

from .conftest import rows

COLUMNS = "k int, p string, v string, load string"


def frame(spark, data):
    return spark.createDataFrame(data, COLUMNS).withColumn("row_hash", row_hash(["p", "v"]))


def plain(df):
    return rows(df, "k", "p", "v", "load")


def test_update_insert_keep(spark):
    target = frame(spark, [(1, "x", "a", "old"), (2, "x", "b", "old"), (3, "x", None, "old")])
    source = frame(spark, [(1, "x", "a", "new"), (2, "x", "B", "new"), (4, "x", "d", "new")])
    got = merge_frames(target, source, ["k"])
    assert plain(got) == [(1, "x", "a", "old"), (2, "x", "B", "new"), (3, "x", None, "old"), (4, "x", "d", "new")]


def test_load_time_does_not_make_a_row_change(spark):
    target = frame(spark, [(1, "x", "a", "monday")])
    assert plain(merge_frames(target, frame(spark, [(1, "x", "a", "tuesday")]), ["k"])) == [(1, "x", "a", "monday")]


def test_stored_hash_follows_the_update(spark):
    target = frame(spark, [(1, "x", "a", "old")])
    source = frame(spark, [(1, "x", "b", "new")])
    got = merge_frames(target, source, ["k"], update=["v"])
    assert plain(got) == [(1, "x", "b", "old")]
    assert got.first()["row_hash"] == source.first()["row_hash"]


def test_null_keys_match_each_other(spark):
    target = frame(spark, [(None, "x", "a", "old")])
    source = frame(spark, [(None, "x", "b", "new")])
    got = merge_frames(target, source, ["k", "p"])
    assert plain(merge_frames(got, source, ["k", "p"])) == [(None, "x", "b", "new")]


def test_late_rows_lose(spark):
    target = frame(spark, [(1, "x", "5", "old"), (2, "x", "5", "old"), (3, "x", None, "old")])
    source = frame(spark, [(1, "y", "4", "new"), (2, "y", "6", "new"), (3, "y", "1", "new"), (4, "y", "1", "new")])
    got = merge_frames(target, source, ["k"], newest="v")
    assert plain(got) == [(1, "x", "5", "old"), (2, "y", "6", "new"), (3, "y", "1", "new"), (4, "y", "1", "new")]
    tied = frame(spark, [(1, "z", "5", "new")])
    forth = merge_frames(target.where("k = 1"), tied, ["k"], newest="v").first()["p"]
    back = merge_frames(tied, target.where("k = 1"), ["k"], newest="v").first()["p"]
    assert forth == back


def test_column_sets_are_checked_first(spark):
    target = frame(spark, [(1, "x", "a", "old")])
    with pytest.raises(ValueError, match="missing in target: nothing"):
        merge_frames(target, target, ["k"], update=["nothing"])
    with pytest.raises(ValueError, match="missing in source: load"):
        merge_frames(target, target.drop("load"), ["k"])


def test_key_twice_in_the_source_fails(spark, database):
    twice = frame(spark, [(1, "x", "a", "n"), (1, "x", "b", "n")])
    with pytest.raises(Exception, match="duplicate key in upsert source"):
        merge_frames(frame(spark, []), twice, ["k"]).collect()
    with pytest.raises(Exception, match="duplicate key in upsert source"):
        upsert(spark, f"{database}.t", twice, ["k"])


def test_each_side_is_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = merge_frames(frame(spark, [(1, "x", "a", "o")]), frame(spark, [(2, "x", "b", "n")]), ["k", "p"])
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Sort [") == 2


def test_a_merge_takes_rows_dealt_by_a_part_of_the_key(spark):
    keys = ["k", "p"]
    target = frame(spark, [(1, "x", "a", "o"), (1, "y", "b", "o"), (None, "x", "c", "o"), (-1, "x", "d", "o")])
    source = frame(spark, [(1, "x", "A", "n"), (None, "x", "C", "n"), (1, "z", "e", "n"), (-1, "x", "d", "n")])
    dealt = with_key(source.withColumn(NEAR, near("k", source.schema["k"].dataType)).repartition(NEAR), keys)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with tables.shuffled_by_part_of_key(spark):
            got = merge_frames(target, dealt, keys, reduced=True, near_by=["k"])
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert plain(got) == plain(merge_frames(target, source, keys))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
    assert spark.conf.get(tables.ALL_KEYS) == "true"


def test_an_error_never_replaces_the_table(spark, database):
    table = f"{database}.t"
    upsert(spark, table, frame(spark, [(1, "x", "a", "old"), (2, "y", "b", "old")]), ["k"])
    with pytest.raises(ValueError):
        upsert(spark, table, frame(spark, [(1, "x", "c", "new")]).drop("load"), ["k"])
    assert spark.read.table(table).count() == 2


entries = st.dictionaries(st.integers(0, 6), st.tuples(st.sampled_from("xyz"), st.sampled_from("abc")), max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(entries, entries, st.sampled_from([(), ("p",)]))
def test_stored_upsert_equals_a_dictionary_and_is_idempotent(spark, old, new, parts):
    table = f"{tables.new_database(spark, 'test')}.t"
    first = [(k, p, v, "l") for k, (p, v) in old.items()]
    second = [(k, p, v, "l") for k, (p, v) in new.items()]
    for data in (first, second, second):
        upsert(spark, table, frame(spark, data), ["k"], partition_by=parts)
    expected = sorted(((k, p, v, "l") for k, (p, v) in {**old, **new}.items()), key=str)
    assert plain(spark.read.table(table)) == expected


def test_a_row_that_moves_empties_its_partition(spark, database):
    table = f"{database}.t"
    upsert(spark, table, frame(spark, [(1, "x", "a", "o"), (2, "y", "b", "o")]), ["k"], partition_by=["p"])
    upsert(spark, table, frame(spark, [(1, "z", "a", "n"), (3, None, "c", "n")]), ["k"], partition_by=["p"])
    assert plain(spark.read.table(table)) == sorted(
        [(1, "z", "a", "n"), (2, "y", "b", "o"), (3, None, "c", "n")], key=str
    )
    upsert(spark, table, frame(spark, [(3, "y", "c", "n")]), ["k"], partition_by=["p"])
    assert plain(spark.read.table(table)) == [(1, "z", "a", "n"), (2, "y", "b", "o"), (3, "y", "c", "n")]
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    assert sorted(parts) == ["p=y", "p=z"]


def test_untouched_partitions_are_not_rewritten(spark, database):
    table = f"{database}.t"
    upsert(spark, table, frame(spark, [(1, "x", "a", "o"), (2, "y", "b", "o")]), ["k", "p"], partition_by=["p"])
    files = lambda p: {r[0] for r in spark.read.table(table).where(F.col("p") == p).select(F.input_file_name()).collect()}
    before = files("y")
    upsert(spark, table, frame(spark, [(1, "x", "z", "n")]), ["k", "p"], partition_by=["p"])
    assert files("y") == before


def test_append_once(spark, database):
    table = f"{database}.t"
    data = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    for _ in range(2):
        append_once(spark, table, data, ["k"])
    append_once(spark, table, spark.createDataFrame([(2, "c"), (1, "z")], "k int, v string"), ["k"])
    assert rows(spark.read.table(table)) == sorted([(1, "a"), (None, "b"), (2, "c")], key=str)


def test_append_once_keeps_one_row_of_a_batch(spark, database):
    table = f"{database}.t"
    data = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 1, "c"), (None, 1, "c")], "k int, at int, v string")
    for _ in range(2):
        append_once(spark, table, data, ["k"], order_by=[F.col("at").desc()])
    assert rows(spark.read.table(table)) == sorted([(1, 2, "b"), (None, 1, "c")], key=str)
    append_once(spark, table, spark.createDataFrame([(2, 1, "x"), (2, 1, "y")], data.schema), ["k"])
    assert spark.read.table(table).where("k = 2").count() == 1


def test_upsert_of_very_many_partitions(spark, database):
    table = f"{database}.t"
    kind = "day string, k int, v int, row_hash string"
    data = [(f"d{i:04}", i, 0, "a") for i in range(600)] + [(None, 1, 0, "a")]
    upsert(spark, table, spark.createDataFrame(data, kind), ["day", "k"], partition_by=["day"])
    again = [(d, k, 1, "b") for d, k, _, _ in data]
    upsert(spark, table, spark.createDataFrame(again, kind), ["day", "k"], partition_by=["day"])
    assert spark.read.table(table).groupBy("v").count().collect() == [(1, 601)]


def test_upsert_by_several_partition_columns(spark, database):
    table, kind = f"{database}.t", "y string, m string, k int, v int, row_hash string"
    data = [("1", "a", 1, 0, "h"), ("1", "b", 2, 0, "h"), ("2", "a", 3, 0, "h"), (None, "b", 4, 0, "h")]
    load = lambda some: upsert(
        spark, table, spark.createDataFrame(some, kind), ["y", "m", "k"], partition_by=["y", "m"]
    )
    load(data)
    load([("1", "a", 1, 5, "i"), ("2", "b", 9, 5, "i"), (None, "b", 4, 5, "i")])
    want = [(1, 5), (2, 0), (3, 0), (4, 5), (9, 5)]
    assert rows(spark.read.table(table), "k", "v") == want


def test_replace_period(spark, database):
    table = f"{database}.t"
    month = lambda m, v: spark.createDataFrame([(v, "2024", m)], "v int, years string, months string")
    replace_period(spark, table, month("1", 1), {"years": "2024", "months": "1"})
    replace_period(spark, table, month("2", 2), {"years": "2024", "months": "2"})
    replace_period(spark, table, month("1", 3), {"years": "2024", "months": "1"})
    assert rows(spark.read.table(table), "v", "months") == [(2, "2"), (3, "1")]
    replace_period(spark, table, month("1", 3).where("false"), {"years": "2024", "months": "1"})
    assert rows(spark.read.table(table), "v", "months") == [(2, "2")]


def test_replace_slice_keeps_unknown_rows(spark):
    target = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "v int, m string")
    new = spark.createDataFrame([(9, "a")], "v int, m string")
    assert rows(replace_slice(target, new, F.col("m") == "a"), "v") == [(2,), (3,), (9,)]


CONTROL = "table_name string, column_name string, date_control date, previous_days int"


def test_watermarks(spark, database, day):
    control = spark.createDataFrame(
        [("t", "d", day("2024-01-01"), 2), ("e", "d", day("2024-01-01"), 2), ("u", "d", None, 1)], CONTROL
    )
    assert read_watermark(control, "t", "d") == day("2024-01-01")
    assert read_watermark(control, "missing", "d") is None
    data = spark.createDataFrame([(dt.datetime(2024, 3, 5, 9),), (dt.datetime(2024, 3, 1),)], "d timestamp_ntz")
    assert since(data, "d", None).count() == 2 and since(data, "d", day("2024-03-02")).count() == 1
    maxima = table_maxima({("t", "d"): data, ("e", "d"): data.where("false"), ("x", "d"): data})
    assert rows(advance(control, maxima), "table_name", "date_control") == sorted(
        [("e", day("2024-01-01")), ("t", day("2024-03-03")), ("u", None)], key=str
    )
    data.write.saveAsTable(f"{database}.t")
    stored = f"{database}.control"
    control.where("table_name = 't'").write.saveAsTable(stored)
    for _ in range(2):
        advance_table(spark, stored, database)
    assert rows(spark.read.table(stored)) == [("t", "d", day("2024-03-03"), 2)]


def test_watermark_reaches_the_scan(spark, tmp_path, day):
    path = str(tmp_path / "t")
    spark.createDataFrame([(dt.datetime(2024, 3, 5, 9),)], "d timestamp_ntz").write.parquet(path)
    plan = since(spark.read.parquet(path), "d", day("2024-03-02"))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(d," in plan


def test_table_helpers(spark, database):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    tables.materialized_view(spark, df, f"{database}.mv", "a view's note", ["k"], {"quality": "checked"})
    assert "a view's note" in str(spark.sql(f"DESCRIBE EXTENDED {database}.mv").collect())
    for _ in range(2):
        tables.mark_run(spark, f"{database}.runs")
    assert spark.read.table(f"{database}.runs").count() == 2
    tables.drop(spark, f"{database}.mv")
    assert not tables.table_exists(spark, f"{database}.mv")
    with tables.temp_view(df, "shortly") as name:
        assert spark.table(name).count() == 1
    assert not spark.catalog.tableExists("shortly")


def test_work_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert tables.work_dir(spark) == folder
    copy = tables.materialize(spark.range(3).toDF("id"))
    assert copy.inputFiles()[0].replace("file://", "").startswith(folder) and copy.count() == 3


def test_hexadecimal_text_is_stored_in_half_its_bytes(spark, database):
    df = spark.range(4000).select(F.md5(F.col("id").cast("string")).alias("h"), (F.col("id") % 2).cast("string").alias("p"))
    upsert(spark, f"{database}.t", df, ["h", "p"], partition_by=["p"], hash_col=None)
    upsert(spark, f"{database}.t", df.withColumn("h", F.md5("h")), ["h", "p"], hash_col=None)
    for stored in (tables.materialize(df), spark.read.table(f"{database}.t")):
        sizes = [Path(f.removeprefix("file:")).stat().st_size for f in stored.inputFiles()]
        assert sum(sizes) < 0.75 * 32 * stored.count()


def test_a_write_leaves_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(str(d)) for d in manager.localDirs()]
    before = {f for d in folders for f in d.rglob("shuffle_*.data")}
    stored = tables.materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(100):
        left = {f for d in folders for f in d.rglob("shuffle_*.data")} - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and stored.count() == 7
    assert spark.conf.get(tables.SHUFFLE_CLEANUP) == "false"


def test_an_append_shuffles_a_batch_once(spark, database):
    table, folder = f"{database}.seen", Path(tables.work_dir(spark))
    kind = "k int, at int, v string"
    first = spark.createDataFrame([(1, 1, "a"), (None, 1, "b"), (None, 1, "a")], kind)
    append_once(spark, table, first, ["k", "at"])
    copies = set(folder.glob("stage-*"))
    again = spark.createDataFrame([(1, 1, "x"), (None, 1, "y"), (2, None, "c"), (2, None, "d")], kind)
    append_once(spark, table, again, ["k", "at"])
    assert set(folder.glob("stage-*")) == copies
    smallest = [(k, t, min(vs, key=lambda v: hashlib.md5(v.encode()).hexdigest())) for k, t, vs in
                ((1, 1, "a"), (None, 1, "ab"), (2, None, "cd"))]
    assert rows(spark.read.table(table), "k", "at", "v") == sorted(smallest, key=str)
    append_once(spark, table, again.withColumn("k", F.col("k").cast("long")), ["k", "at"])
    assert spark.read.table(table).count() == 3


def test_a_source_that_changes_while_it_is_read_fails(spark, database):
    table = f"{database}.changing"
    upsert(spark, table, frame(spark, [(1, "x", "a", "1"), (2, "y", "a", "1")]), ["k", "p"], partition_by=["p"])
    late = frame(spark, [(1, "x", "b", "2"), (3, "y", "b", "2")])
    with pytest.raises(Exception, match="changed while it was read"):
        upsert(spark, table, late, ["k", "p"], touching=late.where("k = 1").select("p"))
    assert plain(spark.read.table(table)) == [(1, "x", "a", "1"), (2, "y", "a", "1")]


def test_late_rows_rewrite_nothing(spark, database):
    table = f"{database}.late"
    load = lambda *data: upsert(
        spark, table, frame(spark, list(data)), ["k"], partition_by=["p"], newest="load"
    )
    files = lambda: {r[0] for r in spark.read.table(table).select(F.input_file_name()).collect()}
    load((1, "x", "a", "5"), (2, "y", "b", "5"), (None, "z", "c", "5"), (4, None, "d", None))
    before, folder = files(), Path(tables.work_dir(spark))
    copies = set(folder.glob("stage-*"))
    # older, the same row again, and an older row of another partition
    load((1, "x", "A", "4"), (2, "y", "b", "9"), (None, "x", "C", "4"))
    assert files() == before
    wide = [p for p in set(folder.glob("stage-*")) - copies if "v" in spark.read.parquet(str(p)).columns]
    assert not wide
    load((1, "x", "A", "4"), (2, "w", "B", "6"), (None, "z", "c", "9"), (4, None, "D", "1"), (5, "y", "e", None))
    assert plain(spark.read.table(table)) == sorted(
        [(1, "x", "a", "5"), (2, "w", "B", "6"), (None, "z", "c", "5"), (4, None, "D", "1"), (5, "y", "e", None)], key=str
    )
    kept = {f for f in before if "p=x" in f or "p=z" in f}
    assert len(kept) == 2 and kept <= files()
    with pytest.raises(Exception, match="duplicate key in upsert source"):
        load((1, "x", "A", "4"), (1, "x", "B", "3"))
    with pytest.raises(ValueError, match="missing in source: v"):
        upsert(spark, table, spark.createDataFrame([(1, "x", "4", "h")], "k int, p string, load string, row_hash string"),
               ["k"], partition_by=["p"], newest="load")


@pytest.mark.parametrize("kind, other", [("double", 0.0), ("timestamp", dt.datetime(2024, 1, 1)), ("array<string>", ["a, b"])])
def test_late_rows_of_other_key_types(spark, database, kind, other):
    table = f"{database}.kinds_{kind[:5]}"
    same = -0.0 if kind == "double" else other
    first = spark.createDataFrame([(other, "x", 5, "a")], f"k {kind}, p string, at int, row_hash string")
    upsert(spark, table, first, ["k"], partition_by=["p"], newest="at")
    for key, at in ((same, 4), (same, 6)):
        late = spark.createDataFrame([(key, "y", at, f"b{at}")], first.schema)
        upsert(spark, table, late, ["k"], partition_by=["p"], newest="at")
        assert rows(spark.read.table(table), "p", "at") == [("x", 5) if at == 4 else ("y", 6)]


def test_equally_new_rows_are_settled_by_their_hash(spark, database):
    got = []
    for first, second in (("a", "b"), ("b", "a")):
        table = f"{database}.tie_{first}"
        for h in (first, second):
            row = spark.createDataFrame([(1, h, 5, h)], "k int, p string, at int, row_hash string")
            upsert(spark, table, row, ["k"], partition_by=["p"], newest="at")
        got.append(rows(spark.read.table(table), "p"))
    assert got[0] == got[1] == [("a",)]
