"""Latest dates noted with every load equal those of a scan."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martflow.operators import maxima
from martflow.operators.control import advance_table
from martflow.operators.upsert import upsert
from martflow.plans.facts import FACTS, watermark_columns

from .conftest import rows

KIND = "k int, p string, d date, row_hash string"
BEGIN = dt.date(2024, 1, 1)


def load(spark, table, data, **options):
    upsert(
        spark, table, spark.createDataFrame(data, KIND), ["k"], partition_by=["p"], keep_maxima=["d"], **options
    )


def latest(spark, table):
    return maxima.latest_date(spark, table, "d").first()[0]


def scanned(spark, table):
    return spark.read.table(table).agg(F.max("d")).first()[0]


def test_random_loads(spark, database):
    """Rows move between partitions, and the latest one may become an earlier one."""
    table, rng = f"{database}.t", random.Random(8)
    for step in range(6):
        data = [
            (k, rng.choice(["a", "b/=%", None]), rng.choice([None, BEGIN + dt.timedelta(rng.randrange(50))]), str(step))
            for k in rng.sample(range(12), 6)
        ]
        load(spark, table, data, key_index=step % 2 == 0)
        assert latest(spark, table) == scanned(spark, table)


def test_no_partition_is_read(spark, database):
    table = f"{database}.t"
    load(spark, table, [(1, "a", BEGIN, "x"), (2, "b", BEGIN + dt.timedelta(3), "x")])
    plan = maxima.latest_date(spark, table, "d")._jdf.queryExecution().executedPlan().toString()
    assert "__maxima" in plan and f"{table}[" not in plan and plan.count("Scan parquet") == 1
    assert latest(spark, table) == BEGIN + dt.timedelta(3)


def test_a_lost_load_leaves_partitions_to_read(spark, database, monkeypatch):
    table = f"{database}.t"
    load(spark, table, [(1, "a", BEGIN, "x"), (2, "b", BEGIN, "x")])

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(maxima, "note", fail)
        with pytest.raises(RuntimeError):
            load(spark, table, [(1, "a", BEGIN + dt.timedelta(9), "y")])
    assert latest(spark, table) == BEGIN + dt.timedelta(9)
    assert rows(maxima.noted(spark, table), "partition") == [("b",)]


def test_watermarks_from_notes(spark, database):
    control = f"{database}.control"
    load(spark, f"{database}.t", [(1, "a", BEGIN, "x"), (2, "b", BEGIN + dt.timedelta(30), "x")])
    kind = "table_name string, column_name string, date_control date, previous_days int"
    spark.createDataFrame([("t", "d", None, 2)], kind).write.saveAsTable(control)
    advance_table(spark, control, database)
    assert rows(spark.read.table(control)) == [("t", "d", BEGIN + dt.timedelta(28), 2)]


def test_every_watermark_of_a_fact_is_noted():
    for fact in FACTS.values():
        if fact.watermark:
            assert fact.watermark[1] in watermark_columns(FACTS[fact.watermark[0]])


def test_partitions_that_end_before_a_day_are_not_read(spark, database):
    table = f"{database}.t"
    days = [BEGIN + dt.timedelta(10 * i) for i in range(8)]
    data = [(i, f"p{i}", d, "x") for i, d in enumerate(days)] + [(90, None, days[7], "x"), (91, "none", None, "x")]
    load(spark, table, data)
    got = maxima.rows_since(spark, table, "d", days[5])
    assert rows(got, "k") == [(5,), (6,), (7,), (90,)]
    read = {f.split("p=")[1].split("/")[0] for f in got.inputFiles()}
    assert read == {"p5", "p6", "p7", maxima.NULL_PARTITION}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(p" in plan
    # without notes all partitions are read, and the rows are the same
    spark.sql(f"DROP TABLE {maxima.maxima_of(table)}")
    assert rows(maxima.rows_since(spark, table, "d", days[5]), "k") == [(5,), (6,), (7,), (90,)]
