"""Cleaning, keys, filters and one-row-per-key."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clean import code_label, default, full_name, holds, text, trade_region
from ..functions.keys import row_hash, surrogate_key
from ..operators.calendar import HOLIDAYS, date_dim
from ..functions.dates import date_key
from ..operators.reduce import argmax_rows, keep_one, last_n
from .base import query, sql_hash, sql_key, sql_uuid, table

LINE_ORDER = [
    "l_shipdate",
    "l_orderkey",
    "l_partkey",
    "l_linenumber",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
LINES = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate"""


@query("""
SELECT c_custkey AS nk_customer_id,
  trim(concat_ws(' ', coalesce(c_name, ''), coalesce(n_name, ''))) AS customer_name,
  trim(coalesce(c_mktsegment, '')) AS customer_segment,
  CASE WHEN rtrim(n_name) IN ('NATION_0', '') THEN 'Home'
       WHEN r_name = 'EUROPE' THEN 'Union' WHEN r_name <> 'EUROPE' THEN 'Third' END AS region,
  coalesce(c_acctbal, 0) AS credit_limit,
  coalesce(c_acctbal > 0, false) AS is_active,
  coalesce(nullif(c_mktsegment, 'BUILDING'), 'NONE') AS segment_or_none
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
""")
def q01_clean_customer(spark, sf_dir):
    customers, nations, regions = (table(spark, sf_dir, n) for n in ("customer", "nation", "region"))
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
        regions, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    in_union = (F.col("r_name") == "EUROPE").cast("int")
    return joined.select(
        F.col("c_custkey").alias("nk_customer_id"),
        full_name("c_name", "n_name").alias("customer_name"),
        text("c_mktsegment").alias("customer_segment"),
        trade_region("n_name", in_union, ("NATION_0", ""), ("Home", "Union", "Third")).alias("region"),
        default("c_acctbal", 0).alias("credit_limit"),
        holds(F.col("c_acctbal") > 0).alias("is_active"),
        text(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), "NONE").alias("segment_or_none"),
    )


@query(f"""
SELECT p_partkey AS nk_product_id,
  {sql_key("p_partkey", "p_name", "nullif(p_type, 'SMALL')", "p_brand")} AS sk_product_id,
  {sql_uuid("concat_ws('||', p_partkey, p_name, nullif(p_type, 'SMALL'), p_brand)")} AS sk_compat
FROM part
""")
def q02_surrogate_key(spark, sf_dir):
    parts = ["p_partkey", "p_name", F.nullif(F.col("p_type"), F.lit("SMALL")), "p_brand"]
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("nk_product_id"),
        surrogate_key(parts).alias("sk_product_id"),
        surrogate_key(parts, compat=True).alias("sk_compat"),
    )


_ORDER_VALUES = (
    "o_custkey",
    "o_orderstatus",
    "CAST(o_totalprice AS DECIMAL(18,2))",
    "CAST(o_orderdate AS DATE)",
    "nullif(o_orderpriority, '5-LOW')",
)


@query(f"""
SELECT o_orderkey, {sql_hash(*_ORDER_VALUES)} AS row_hash,
  md5(concat_ws('|', {", ".join(f"coalesce(CAST({v} AS VARCHAR), '')" for v in _ORDER_VALUES)}))
    AS hash_compat
FROM orders
""")
def q03_row_hash(spark, sf_dir):
    values = [F.expr(v) for v in _ORDER_VALUES]
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        row_hash(values).alias("row_hash"),
        row_hash(values, compat=True).alias("hash_compat"),
    )


@query("""
SELECT event_id,
  CASE WHEN event_type IN ('purchase') THEN 'Sale' WHEN event_type IN ('view', 'click') THEN 'Visit'
       WHEN event_type IN ('signup') THEN 'Account' ELSE 'Other' END AS category,
  CASE WHEN value > 10 THEN 'OUT' ELSE 'IN' END AS direction
FROM events
""")
def q04_code_map(spark, sf_dir):
    labels = {"Sale": ["purchase"], "Visit": ["view", "click"], "Account": ["signup"]}
    return table(spark, sf_dir, "events").select(
        "event_id",
        code_label("event_type", labels, "Other").alias("category"),
        F.when(F.col("value") > 10, "OUT").otherwise("IN").alias("direction"),
    )


@query("""
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus IN ('F', 'O') AND nullif(o_orderpriority, '1-URGENT') NOT IN ('5-LOW')
""")
def q05_tenant_filter(spark, sf_dir):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT"))
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus").isin("F", "O") & ~priority.isin("5-LOW"))
        .select("o_orderkey", "o_orderstatus", "o_orderpriority")
    )


@query(f"""
SELECT {LINES} FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY {", ".join(LINE_ORDER)}) rn
FROM lineitem) WHERE rn = 1
""")
def q06_first_per_key(spark, sf_dir):
    return keep_one(table(spark, sf_dir, "lineitem"), ["l_partkey"], LINE_ORDER)


@query("""
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events)
WHERE rn = 1
""")
def q07_latest_per_key(spark, sf_dir):
    newest = [F.col("ts").desc(), F.col("event_id").desc()]
    rows = keep_one(table(spark, sf_dir, "events"), ["user_id"], newest)
    return rows.select("event_id", "user_id", "event_type", "value")


@query("""
SELECT o_custkey, o_orderkey, CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS last_day
FROM orders o JOIN (SELECT o_custkey k, max(o_orderdate) d FROM orders GROUP BY 1) m
  ON o.o_custkey = m.k AND o.o_orderdate = m.d
""")
def q08_argmax_join(spark, sf_dir):
    rows = argmax_rows(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate")
    return rows.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("last_day"))


@query(f"""
SELECT {LINES} FROM (SELECT *, row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(LINE_ORDER)}) rn FROM lineitem) WHERE rn = 1
""")
def q09_dedup_deterministic(spark, sf_dir):
    return keep_one(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)


@query("""
SELECT user_id, rn, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events)
WHERE rn <= 12
""")
def q49_last_n_per_key(spark, sf_dir):
    newest = [F.col("ts").desc(), F.col("event_id").desc()]
    rows = last_n(table(spark, sf_dir, "events"), ["user_id"], newest, 12)
    return rows.select("user_id", "rn", "event_id")


_HOLIDAYS = ", ".join(f"DATE '{d}'" for d in HOLIDAYS)


@query(f"""
WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) a, max(CAST(o_orderdate AS DATE)) b FROM orders),
days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) d FROM span),
dim AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS VARCHAR) AS full_date,
    isodow(d) AS day_of_week, strftime(d, '%A') AS day_name, day(d) AS day_of_month,
    dayofyear(d) AS day_of_year, week(d) AS week_of_year, week(d) AS week_iso,
    month(d) AS month_number, strftime(d, '%B') AS month_name, quarter(d) AS quarter,
    year(d) AS year, strftime(d, '%Y-%m') AS year_month,
    CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter,
    isodow(d) >= 6 AS is_weekend, d IN ({_HOLIDAYS}) AS is_holiday_de,
    year(d) AS fiscal_year, quarter(d) AS fiscal_quarter, month(d) AS fiscal_month
  FROM days
  UNION ALL
  SELECT -1, NULL, 0, 'Unknown', 0, 0, 0, 0, 0, 'Unknown', 0, 0, '0000-00', '0000-Q0',
    false, false, 0, 0, 0),
sales AS (SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) k, count(*) n FROM orders GROUP BY 1)
SELECT dim.*, coalesce(n, 0) AS orders FROM dim LEFT JOIN sales ON date_key = k
""")
def q13_date_dim(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    first, last = orders.agg(F.min("day"), F.max("day")).first()
    sales = orders.groupBy(date_key("day").alias("date_key")).agg(F.count(F.lit(1)).alias("orders"))
    dim = date_dim(spark, first, last)
    return dim.join(sales, "date_key", "left").withColumn("orders", default("orders", 0))
