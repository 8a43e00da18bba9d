"""Type-2 history and point-in-time lookups.

Scenario: three snapshots of a table. Keys are inserted, deleted and reappear;
``seg`` is tracked and ``bal`` is not.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.clean import days_between, holds
from ..operators.asof import asof_merge
from ..operators.scd import END, START, current, scd2_apply, scd2_build
from ..operators.temporal import all_versions, asof_lookup
from .base import Derived, query, table

YEARS = (dt.datetime(1995, 1, 1), dt.datetime(1997, 1, 1), dt.datetime(1999, 7, 1))
JANUARY = (
    dt.datetime(2024, 1, 1),
    dt.datetime(2024, 1, 10, 9, 30),
    dt.datetime(2024, 1, 20, 18, 15),
)


def snapshot(df: DataFrame, key: str, segment: str, balance: str, step: int) -> DataFrame:
    """One of the three snapshots of a table."""
    k = F.col(key)
    present = {1: k % 10 != 9, 2: k % 11 != 5, 3: F.lit(True)}[step]
    suffix = F.lit("")
    if step >= 2:
        suffix = F.when(k % 7 == 0, "#2").otherwise("")
    if step == 3:
        suffix = F.when(k % 13 == 0, "#3").otherwise(suffix)
    extra = F.when(k % 5 == 0, 1).otherwise(0) if step >= 2 else F.lit(0)
    return df.where(present).select(
        k.alias("k"),
        F.concat(F.col(segment).cast("string"), suffix).alias("seg"),
        (F.col(balance) + extra).alias("bal"),
    )


def stacked(df: DataFrame, key: str, segment: str, balance: str, times) -> DataFrame:
    parts = [
        snapshot(df, key, segment, balance, i).withColumn("at", F.lit(t).cast("timestamp_ntz"))
        for i, t in enumerate(times, 1)
    ]
    return reduce(DataFrame.unionByName, parts)


def history(spark, sf_dir, source="customer", times=YEARS) -> DataFrame:
    key, segment, balance = {
        "customer": ("c_custkey", "c_mktsegment", "c_acctbal"),
        "supplier": ("s_suppkey", "s_nationkey", "s_acctbal"),
        "part": ("p_partkey", "p_type", "p_retailprice"),
    }[source]
    rows = stacked(table(spark, sf_dir, source), key, segment, balance, times)
    return scd2_build(rows, ["k"], ["seg"], "at", times)


def history_sql(name: str, source="customer", times=YEARS) -> str:
    """CTEs that end in the history ``name(k, seg, bal, start_at, end_at)``."""
    key, segment, balance = {
        "customer": ("c_custkey", "c_mktsegment", "c_acctbal"),
        "supplier": ("s_suppkey", "CAST(s_nationkey AS VARCHAR)", "s_acctbal"),
        "part": ("p_partkey", "p_type", "p_retailprice"),
    }[source]
    values = ", ".join(f"({i}, TIMESTAMP '{t}')" for i, t in enumerate(times, 1))
    return f"""
{name}_t(i, ts) AS (VALUES {values}),
{name}_s AS (SELECT {key} k, i, ts,
  CASE i WHEN 1 THEN {key} % 10 <> 9 WHEN 2 THEN {key} % 11 <> 5 ELSE true END present,
  {segment} || CASE WHEN i = 3 AND {key} % 13 = 0 THEN '#3'
                    WHEN i >= 2 AND {key} % 7 = 0 THEN '#2' ELSE '' END seg,
  {balance} + CASE WHEN i >= 2 AND {key} % 5 = 0 THEN 1 ELSE 0 END bal
  FROM {source} CROSS JOIN {name}_t),
{name}_g AS (SELECT *, CASE WHEN present AND (lag(present) OVER w IS DISTINCT FROM true
    OR lag(seg) OVER w IS DISTINCT FROM seg) THEN 1 ELSE 0 END st
  FROM {name}_s WINDOW w AS (PARTITION BY k ORDER BY i)),
{name}_v AS (SELECT *, sum(st) OVER (PARTITION BY k ORDER BY i) vid FROM {name}_g),
{name}_h AS (SELECT k, any_value(seg) seg, arg_max(bal, i) bal, min(ts) start_at, max(i) li
  FROM {name}_v WHERE present GROUP BY k, vid),
{name} AS (SELECT k, seg, bal, start_at, (SELECT ts FROM {name}_t t WHERE t.i = h.li + 1) end_at
  FROM {name}_h h)"""


def shown(t: str) -> str:
    return f"strftime({t}, '%Y-%m-%d %H:%M:%S')"


VERSION = f"k, seg, bal, {shown('start_at')} AS start_at, {shown('end_at')} AS end_at"
SEES_DATE = """CAST({event} AS DATE) >= CAST(start_at AS DATE)
  AND CAST({event} AS DATE) < coalesce(CAST(end_at AS DATE), DATE '2099-12-31')"""
SEES_TIME = """{event} >= start_at AND {event} < coalesce(end_at, TIMESTAMP '2099-12-31 00:00:00')"""


def named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({START: "start_at", END: "end_at"})


@query(f"""
WITH {history_sql("h")}
SELECT o_custkey, seg, {shown("start_at")} AS start_at, count(*) AS orders,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders LEFT JOIN h ON o_custkey = k AND {SEES_DATE.format(event="o_orderdate")}
GROUP BY ALL
""")
def q00_point_in_time_revenue(spark, sf_dir):
    versions = history(spark, sf_dir).withColumn("valid_from", F.col(START))
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    take = {"seg": "seg", "valid_from": "start_at"}
    found = asof_lookup(orders, versions, [("o_custkey", "k")], "o_orderdate", take)
    return found.groupBy("o_custkey", "seg", "start_at").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"),
    )


@query(f"""
WITH {history_sql("h")}
SELECT o_orderkey, o_custkey, seg FROM orders
LEFT JOIN h ON o_custkey = k AND o_orderdate + INTERVAL 120 YEAR >= start_at
  AND (end_at IS NULL OR o_orderdate + INTERVAL 120 YEAR < end_at)
""")
def q56_lookup_in_the_far_future(spark, sf_dir):
    """Open versions hold for dates of any distance."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", (F.col("o_orderdate") + F.expr("INTERVAL 120 YEAR")).alias("at")
    )
    found = asof_lookup(orders, history(spark, sf_dir), [("o_custkey", "k")], "at", ["seg"], "timestamp")
    return found.select("o_orderkey", "o_custkey", "seg")


@query(f"WITH {history_sql('h')} SELECT {VERSION} FROM h")
def q14_scd2_history(spark, sf_dir):
    return named(history(spark, sf_dir))


@query(f"WITH {history_sql('h')} SELECT k, seg, bal FROM h WHERE end_at IS NULL")
def q15_scd2_current(spark, sf_dir):
    return current(history(spark, sf_dir)).select("k", "seg", "bal")


@query(f"""
WITH {history_sql("h")}, n AS (SELECT k, count(*) versions, count(end_at) closed, min(start_at) a,
  max(start_at) b FROM h GROUP BY k)
SELECT k, versions, closed, {shown("a")} AS first_start, {shown("b")} AS last_start FROM n
""")
def q16_scd2_reappear(spark, sf_dir):
    """Versions per key when snapshots are applied one after the other."""
    customers = table(spark, sf_dir, "customer")
    versions = None
    for step, at in enumerate(YEARS, 1):
        new = snapshot(customers, "c_custkey", "c_mktsegment", "c_acctbal", step)
        if versions is None:
            kind = "timestamp_ntz"
            versions = new.withColumns({START: F.lit(at).cast(kind), END: F.lit(None).cast(kind)})
        else:
            versions = scd2_apply(versions, new, ["k"], ["seg"], at)
    return versions.groupBy("k").agg(
        F.count(F.lit(1)).alias("versions"),
        F.count(END).alias("closed"),
        F.min(START).alias("first_start"),
        F.max(START).alias("last_start"),
    )


@query(f"""
WITH {history_sql("h")}
SELECT o_orderkey, o_custkey, seg, {shown("start_at")} AS start_at
FROM orders LEFT JOIN h ON o_custkey = k AND {SEES_DATE.format(event="o_orderdate")}
""")
def q17_asof_customer(spark, sf_dir):
    versions = history(spark, sf_dir).withColumn("valid_from", F.col(START))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    take = {"seg": "seg", "valid_from": "start_at"}
    return asof_lookup(orders, versions, [("o_custkey", "k")], "o_orderdate", take).drop("o_orderdate")


@query(f"""
WITH {history_sql("h", times=JANUARY)}
SELECT event_id, user_id, seg FROM events LEFT JOIN h ON user_id = k AND {SEES_TIME.format(event="ts")}
""")
def q18_asof_timestamp(spark, sf_dir):
    versions = history(spark, sf_dir, times=JANUARY)
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    found = asof_lookup(events, versions, [("user_id", "k")], "ts", ["seg"], precision="timestamp")
    return found.drop("ts")


@query(f"""
WITH {history_sql("c", times=JANUARY)}, {history_sql("s", "supplier", JANUARY)}
SELECT event_id, event_type, c.seg AS customer_seg, s.seg AS supplier_seg
FROM events
LEFT JOIN c ON event_type = 'purchase' AND user_id = c.k
  AND ts >= c.start_at AND ts < coalesce(c.end_at, TIMESTAMP '2099-12-31 00:00:00')
LEFT JOIN s ON event_type = 'click' AND user_id = s.k
  AND ts >= s.start_at AND ts < coalesce(s.end_at, TIMESTAMP '2099-12-31 00:00:00')
""")
def q19_asof_discriminated(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "ts")
    kind = F.col("event_type")
    for source, code in (("customer", "purchase"), ("supplier", "click")):
        events = asof_lookup(
            events,
            history(spark, sf_dir, source, JANUARY),
            [("user_id", "k")],
            "ts",
            {"seg": f"{source}_seg"},
            precision="timestamp",
            only=kind == code,
        )
    return events.drop("user_id", "ts")


@query(f"""
WITH {history_sql("p", "part")}
SELECT l_orderkey, l_linenumber, l_partkey, seg FROM lineitem
LEFT JOIN p ON trim(' P' || l_partkey || ' ') = trim('P' || p.k || '  ')
  AND {SEES_TIME.format(event="l_shipdate")}
""")
def q20_asof_expression_key(spark, sf_dir):
    versions = history(spark, sf_dir, "part").withColumn(
        "number", F.concat(F.lit("P"), F.col("k").cast("string"), F.lit("  "))
    )
    sku = F.concat(F.lit(" P"), F.col("l_partkey").cast("string"), F.lit(" "))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"
    )
    found = asof_lookup(
        lines, versions, [(F.trim(sku), F.trim("number"))], "l_shipdate", ["seg"], "timestamp"
    )
    return found.drop("l_shipdate")


@query(f"""
WITH {history_sql("h")}
SELECT c_custkey AS k, c_name, seg, bal, {shown("start_at")} AS start_at, {shown("end_at")} AS end_at
FROM customer LEFT JOIN h ON c_custkey = k
""")
def q21_history_fanout(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    return named(all_versions(customers, history(spark, sf_dir), ["k"]))


@query("""
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS valid_from,
  CAST(CAST(ts AS DATE) + CAST(user_id % 15 AS INTEGER) AS VARCHAR) AS valid_to,
  CAST(user_id % 15 AS INTEGER) AS offer_duration_days,
  DATE '2024-01-15' BETWEEN CAST(ts AS DATE) AND CAST(ts AS DATE) + CAST(user_id % 15 AS INTEGER)
    AS is_currently_active, seg
FROM events LEFT JOIN h ON user_id = k
  AND CAST(ts AS DATE) >= start_at AND CAST(ts AS DATE) < coalesce(end_at, TIMESTAMP '2099-12-31 00:00:00')
""".replace("SELECT event_id", f"WITH {history_sql('h', times=JANUARY)}\nSELECT event_id", 1))
def q46_daily_offer(spark, sf_dir):
    first = F.col("ts").cast("date")
    offers = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        first.alias("valid_from"),
        F.date_add(first, (F.col("user_id") % 15).cast("int")).alias("valid_to"),
    )
    versions = history(spark, sf_dir, times=JANUARY)
    found = asof_lookup(offers, versions, [("user_id", "k")], "valid_from", ["seg"], "timestamp")
    today = F.lit(dt.date(2024, 1, 15))
    return found.withColumns(
        {
            "offer_duration_days": days_between("valid_from", "valid_to"),
            "is_currently_active": holds(today.between(F.col("valid_from"), F.col("valid_to"))),
        }
    ).drop("user_id")


@query(f"""
WITH {history_sql("h")}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, seg
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN h ON o_custkey = k AND {SEES_TIME.format(event="l_shipdate")}
""")
def q48_asof_by_month(spark, sf_dir):
    """The lookup as a sorted merge, for keys with long histories."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey", "l_shipdate"
    )
    found = asof_merge(
        joined, history(spark, sf_dir), [("o_custkey", "k")], "l_shipdate", ["seg"], "timestamp"
    )
    return found.drop("o_custkey", "l_shipdate")


# A third of all visits is of user 0. Half of them open a session of ten minutes.
_VISITS = """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS k, ts, event_id % 2 = 0 AS opens,
  date_trunc('hour', ts) AS hour, CAST(floor(minute(ts) / 10) AS INTEGER) AS part FROM {events}"""
_SESSIONS = """
SELECT k, hour, part, max(event_id) AS sk FROM {visits} v WHERE opens GROUP BY k, hour, part"""
VISITS = Derived(_VISITS)
SESSIONS = Derived(_SESSIONS, visits=VISITS)


@query(f"""
SELECT event_id, v.k AS k, sk FROM ({VISITS.sql}) v LEFT JOIN ({SESSIONS.sql}) s
  ON v.k = s.k AND ts >= s.hour + to_minutes(10 * s.part) AND ts < s.hour + to_minutes(10 * s.part + 10)
WHERE NOT opens
""")
def q57_asof_hot_key(spark, sf_dir):
    """A key with a third of all events and of all versions."""
    start = F.timestamp_add("MINUTE", 10 * F.col("part"), "hour")
    sessions = SESSIONS.frame(spark, sf_dir).select(
        "k", "sk", start.alias(START), F.timestamp_add("MINUTE", F.lit(10), start).alias(END)
    )
    visits = VISITS.frame(spark, sf_dir).where("NOT opens").select("event_id", "k", "ts")
    return asof_merge(visits, sessions, [("k", "k")], "ts", ["sk"], "timestamp").drop("ts")
