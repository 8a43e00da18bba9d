import pytest
from pyspark.sql import functions as F

from martflow.operators.reduce import argmax_rows, keep_one, last_n, near, unique_or_fail

from .conftest import rows


def test_keep_one_and_last_n(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 5), (None, 7), (None, 8)], "k string, v int")
    assert rows(keep_one(df, ["k"], ["v"])) == [("a", 1), ("b", 5), (None, 7)] or rows(
        keep_one(df, ["k"], ["v"])
    ) == sorted([("a", 1), ("b", 5), (None, 7)], key=str)
    top = last_n(df, ["k"], [F.col("v").desc()], 2)
    assert rows(top) == sorted(
        [("a", 3, 1), ("a", 2, 2), ("b", 5, 1), (None, 8, 1), (None, 7, 2)], key=str
    )


def test_argmax_keeps_ties(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 2, "y"), ("a", 1, "z"), ("b", 1, "w")], "k string, v int, t string")
    assert rows(argmax_rows(df, ["k"], "v")) == [("a", 2, "x"), ("a", 2, "y"), ("b", 1, "w")]


def test_duplicates_fail_with_their_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    with pytest.raises(Exception, match="duplicate key in feed: 1"):
        unique_or_fail(df, ["k"], "feed").collect()
    assert unique_or_fail(df.where("v <> 'b'"), ["k"], "feed").count() == 2


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = keep_one(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_rows_without_a_document_are_dealt_out_by_others(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (None, 5), (None, 6), (None, 5)], "doc int, day int")
    got = df.select("doc", "day", near("doc", df.schema["doc"].dataType, "day").alias("n")).distinct().collect()
    assert all(r["n"] is not None for r in got) and len({r["n"] for r in got}) == 3
