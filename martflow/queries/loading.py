"""Upserts, appends, period replacement and watermarks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import row_hash
from ..operators.control import advance, read_watermark, since, table_maxima
from ..operators.reduce import keep_one
from ..operators.upsert import append_once, merge_frames, replace_period, upsert
from ..sources.tables import drop, initial_load, new_database, table_exists, temp_view
from .base import query, table

# The stored state holds the orders before this day, and each run reads the
# orders from the watermark on, so the two overlap.
STORED_UNTIL = dt.date(2000, 7, 1)
WATERMARK = dt.date(1999, 1, 1)


def _orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderdate").cast("date").alias("day"),
    )


def _hashed(df: DataFrame, load: str, keys) -> DataFrame:
    compared = [c for c in df.columns if c not in keys]
    return df.withColumn("row_hash", row_hash(compared)).withColumn("load", F.lit(load))


def _stored(spark, sf_dir, keys) -> DataFrame:
    return _hashed(_orders(spark, sf_dir).where(F.col("day") < F.lit(STORED_UNTIL)), "first", keys)


def _arriving(spark, sf_dir, keys) -> DataFrame:
    """Orders since the watermark; those in process have a new amount."""
    recent = since(_orders(spark, sf_dir), "day", WATERMARK)
    raised = F.when(F.col("o_orderstatus") == "P", F.col("amount") + 1).otherwise(F.col("amount"))
    return _hashed(recent.withColumn("amount", raised.cast("decimal(18,2)")), "second", keys)


_MERGED = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
  CAST(CAST(o_totalprice AS DECIMAL(18,2))
    + CASE WHEN o_orderdate >= DATE '{WATERMARK}' AND o_orderstatus = 'P' THEN 1 ELSE 0 END AS DOUBLE) AS amount,
  CASE WHEN o_orderdate >= DATE '{STORED_UNTIL}'
         OR (o_orderdate >= DATE '{WATERMARK}' AND o_orderstatus = 'P') THEN 'second' ELSE 'first' END AS load
FROM orders
"""


@query(_MERGED)
def q24_upsert_update_insert(spark, sf_dir):
    keys = ["o_orderkey"]
    return merge_frames(_stored(spark, sf_dir, keys), _arriving(spark, sf_dir, keys), keys).drop("row_hash")


@query(_MERGED)
def q25_upsert_idempotent(spark, sf_dir):
    keys = ["o_orderkey"]
    arriving = _arriving(spark, sf_dir, keys)
    once = merge_frames(_stored(spark, sf_dir, keys), arriving, keys)
    again = merge_frames(once, arriving.withColumn("load", F.lit("third")), keys)
    return again.drop("row_hash")


@query(_MERGED.replace("o_custkey,", "CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS o_custkey,"))
def q26_upsert_null_key(spark, sf_dir):
    """The customer key is part of the match and missing for some orders."""
    keys = ["o_orderkey", "o_custkey"]
    source = table(spark, sf_dir, "orders")
    known = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    lookup = source.select(F.col("o_orderkey").alias("id"), known.alias("sk"))

    def with_gaps(df):
        joined = df.drop("o_custkey").join(lookup, F.col("o_orderkey") == F.col("id"))
        return joined.withColumnRenamed("sk", "o_custkey").drop("id")

    stored = _hashed(with_gaps(_stored(spark, sf_dir, keys).drop("row_hash", "load")), "first", keys)
    fresh = _hashed(with_gaps(_arriving(spark, sf_dir, keys).drop("row_hash", "load")), "second", keys)
    return merge_frames(stored, fresh, keys).drop("row_hash")


@query("""
SELECT user_id, event_id, event_type, value,
  CASE WHEN ts >= TIMESTAMP '2024-01-20 00:00:00' THEN 'second' ELSE 'first' END AS load
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events)
WHERE rn = 1
""")
def q27_scd1_latest(spark, sf_dir):
    """Latest event per user, kept by two loads into a stored table."""
    events = table(spark, sf_dir, "events")
    newest = [F.col("ts").desc(), F.col("event_id").desc()]
    cut = F.lit(dt.datetime(2024, 1, 20)).cast("timestamp_ntz")
    target = f"{new_database(spark)}.latest_event"
    for load, part in (("first", F.col("ts") < cut), ("second", F.col("ts") >= cut)):
        latest = keep_one(events.where(part), ["user_id"], newest).select(
            "user_id", "event_id", "event_type", "value"
        )
        upsert(spark, target, _hashed(latest, load, ["user_id"]), ["user_id"])
    return spark.read.table(target).drop("row_hash")


@query("""
SELECT event_id, user_id, CASE WHEN ts < TIMESTAMP '2024-01-20 00:00:00' THEN 'first' ELSE 'second' END AS load
FROM events
""")
def q28_append_snapshot(spark, sf_dir):
    """Two loads with overlapping windows append each observation once."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    target = f"{new_database(spark)}.observed"
    windows = (
        ("first", None, dt.date(2024, 1, 20)),
        ("second", dt.date(2024, 1, 10), dt.date(2025, 1, 1)),
    )
    for load, first, last in windows:
        day = F.col("ts").cast("date")
        rows = since(events, "ts", first).where(day < F.lit(last)).withColumn("load", F.lit(load))
        look_back = None if first is None else day >= F.lit(first)
        # each load holds every observation twice
        append_once(spark, target, rows.unionByName(rows), ["event_id"], look_back)
    return spark.read.table(target).drop("ts")


@query("""
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS years, CAST(month(o_orderdate) AS VARCHAR) AS months,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN year(o_orderdate) = 1998 AND month(o_orderdate) = 3
    THEN 10 ELSE 0 END AS DOUBLE) AS amount
FROM orders
""")
def q29_replace_period(spark, sf_dir):
    """A stored table by month, with one month replaced twice."""
    orders = _orders(spark, sf_dir).select(
        "o_orderkey",
        "amount",
        F.year("day").cast("string").alias("years"),
        F.month("day").cast("string").alias("months"),
    )
    target = f"{new_database(spark)}.monthly"
    march = {"years": "1998", "months": "3"}
    initial_load(orders, target, partition_by=list(march))
    month = orders.where((F.col("years") == "1998") & (F.col("months") == "3"))
    raised = month.withColumn("amount", (F.col("amount") + 10).cast("decimal(18,2)"))
    for _ in range(2):
        replace_period(spark, target, raised, march)
    return spark.read.table(target)


def _control(spark) -> DataFrame:
    rows = [
        ("orders", "o_orderdate", dt.date(1990, 1, 1), 7),
        ("lineitem", "l_shipdate", dt.date(1990, 1, 1), 3),
        ("events", "ts", dt.date(1990, 1, 1), 1),
        ("returns", "day", dt.date(1990, 1, 1), 5),
    ]
    kinds = "table_name STRING, column_name STRING, date_control DATE, previous_days INT"
    return spark.createDataFrame(rows, kinds)


def _advanced(spark, sf_dir) -> DataFrame:
    tables = {
        (name, column): table(spark, sf_dir, name)
        for name, column in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    }
    nothing = table(spark, sf_dir, "orders").where("o_orderdate < DATE '1900-01-01'")
    tables["returns", "day"] = nothing.withColumnRenamed("o_orderdate", "day")
    return advance(_control(spark), table_maxima(tables))


@query("""
SELECT 'orders' AS table_name, 'o_orderdate' AS column_name, 7 AS previous_days,
  CAST(CAST(max(o_orderdate) AS DATE) - 7 AS VARCHAR) AS date_control FROM orders
UNION ALL SELECT 'lineitem', 'l_shipdate', 3, CAST(CAST(max(l_shipdate) AS DATE) - 3 AS VARCHAR) FROM lineitem
UNION ALL SELECT 'events', 'ts', 1, CAST(CAST(max(ts) AS DATE) - 1 AS VARCHAR) FROM events
UNION ALL SELECT 'returns', 'day', 5, '1990-01-01'
""")
def q30_watermark_advance(spark, sf_dir):
    return _advanced(spark, sf_dir)


@query("""
SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day FROM lineitem
WHERE CAST(l_shipdate AS DATE) >= (SELECT CAST(max(l_shipdate) AS DATE) - 3 FROM lineitem)
""")
def q31_incremental_filter(spark, sf_dir):
    mark = read_watermark(_advanced(spark, sf_dir), "lineitem", "l_shipdate")
    recent = since(table(spark, sf_dir, "lineitem"), "l_shipdate", mark)
    return recent.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("day"))


@query("""
SELECT CAST(CAST(date_trunc('week', l_shipdate) AS DATE) AS VARCHAR) AS week, l_suppkey,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) + max(CASE WHEN l_suppkey % 5 = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS quantity
FROM lineitem GROUP BY ALL
""")
def q55_upsert_many_partitions(spark, sf_dir):
    """Two loads into a table with a partition for each of some hundred weeks."""
    week = F.date_trunc("week", "l_shipdate").cast("date").cast("string").alias("week")
    quantity = F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity")
    shipped = table(spark, sf_dir, "lineitem").groupBy(week, "l_suppkey").agg(quantity)
    raised = F.col("quantity") + F.when(F.col("l_suppkey") % 5 == 0, 1).otherwise(0)
    target, keys = f"{new_database(spark)}.shipped", ["week", "l_suppkey"]
    for load, rows in (("first", shipped), ("second", shipped.withColumn("quantity", raised))):
        upsert(spark, target, _hashed(rows, load, keys), keys, partition_by=["week"])
    return spark.read.table(target).select("week", "l_suppkey", "quantity")


@query("""
SELECT o_custkey, count(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1
""")
def q60_scoped_view_and_drop(spark, sf_dir):
    """A view that lives as long as a block, and a helper table that is dropped."""
    database = new_database(spark)
    helper, target = f"{database}.finished", f"{database}.counts"
    initial_load(table(spark, sf_dir, "orders").where("o_orderstatus = 'F'"), helper)
    with temp_view(spark.read.table(helper), "finished_orders") as view:
        counts = spark.sql(f"SELECT o_custkey, count(*) AS orders FROM {view} GROUP BY o_custkey")
        initial_load(counts, target)
    drop(spark, helper)
    if table_exists(spark, helper) or spark.catalog.tableExists("finished_orders"):
        raise AssertionError("the helper table and the view should be gone")
    return spark.read.table(target)
