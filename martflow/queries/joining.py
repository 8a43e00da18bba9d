"""Equi-joins, lookups and document grains."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clean import days_between, default, home_amount, per_rate
from ..operators.documents import header_lines
from .base import query, table


@query("""
SELECT o_orderkey, l_linenumber, l_partkey, l_quantity, last_ship
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
LEFT JOIN (SELECT l_orderkey k, l_linenumber n, CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) last_ship
           FROM lineitem GROUP BY 1, 2) x
  ON o_orderkey = x.k AND l_linenumber = x.n
""")
def q10_composite_left(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    extra = lines.groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(
        F.max("l_shipdate").cast("date").alias("last_ship")
    )
    columns = ["o_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    _, joined = header_lines(orders, lines, [("o_orderkey", "l_orderkey")], columns)
    same_line = (F.col("o_orderkey") == F.col("k")) & (F.col("l_linenumber") == F.col("n"))
    return joined.join(extra, same_line, "left").select(*columns, "last_ship")


@query("""
WITH rates AS (SELECT l_returnflag a, l_linestatus b, l_linenumber c, max(l_tax) max_tax
               FROM lineitem GROUP BY 1, 2, 3),
groups AS (SELECT l_returnflag a, l_linestatus b, count(*) lines FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(max_tax, 0) AS max_tax, lines AS group_lines
FROM lineitem
LEFT JOIN rates r ON l_returnflag = r.a AND l_linestatus = r.b AND l_linenumber = r.c
LEFT JOIN groups g ON l_returnflag = g.a AND l_linestatus = g.b
""")
def q11_three_key_lookup(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    pair = ["l_returnflag", "l_linestatus"]
    rates = lines.groupBy(*pair, "l_linenumber").agg(F.max("l_tax").alias("max_tax"))
    groups = lines.groupBy(*pair).agg(F.count(F.lit(1)).alias("group_lines"))
    return (
        lines.join(rates, [*pair, "l_linenumber"], "left")
        .join(groups, pair, "left")
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            default("max_tax", 0).alias("max_tax"),
            "group_lines",
        )
    )


@query("""
WITH links AS (SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem),
first_lines AS (SELECT l_suppkey k, l_linenumber n, count(*) c FROM lineitem GROUP BY 1, 2)
SELECT s_suppkey, s_name, n_name, l_returnflag, c AS first_positions
FROM supplier JOIN links ON s_suppkey = l_suppkey JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN first_lines f ON s_suppkey = f.k AND f.n = 1
""")
def q12_inner_literal_on(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    links = lines.select("l_suppkey", "l_returnflag").distinct()
    # A literal in the join condition of the right side is a filter before it.
    firsts = (
        lines.where(F.col("l_linenumber") == 1)
        .groupBy(F.col("l_suppkey").alias("k"))
        .agg(F.count(F.lit(1)).alias("first_positions"))
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(links, F.col("s_suppkey") == F.col("l_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(firsts, F.col("s_suppkey") == F.col("k"), "left")
        .select("s_suppkey", "s_name", "n_name", "l_returnflag", "first_positions")
    )


@query("""
SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def q22_header_grain(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    shown = ["o_orderkey", "o_custkey", "o_orderstatus"]
    headers, _ = header_lines(orders, lines, [("o_orderkey", "l_orderkey")], shown, "inner")
    return headers.select(*shown)


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(18,2)) q,
    CAST(l_extendedprice AS DECIMAL(18,2)) p,
    CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 2 END rate,
    CASE l_linestatus WHEN 'F' THEN 10 END unit, l_shipdate FROM lineitem)
SELECT l_orderkey, l_linenumber, round(CAST(p AS DOUBLE) / CASE WHEN rate <> 0 THEN rate ELSE 1 END, 4) AS revenue,
  CAST(q * p AS DOUBLE) AS line_net_amount,
  round(CASE WHEN coalesce(rate, 1) <> 0 THEN CAST(q * p AS DOUBLE) / coalesce(rate, 1) * coalesce(unit, 1)
       ELSE CAST(q * p AS DOUBLE) END, 4) AS line_home_amount,
  date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS delivery_time_days
FROM orders JOIN l ON o_orderkey = l_orderkey
""")
def q23_line_amounts(spark, sf_dir):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    rate = F.when(flag == "A", 0).when(flag == "N", 2)
    unit = F.when(status == "F", 10)
    quantity = F.col("l_quantity").cast("decimal(18,2)")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    columns = [
        "l_orderkey",
        "l_linenumber",
        F.round(per_rate(price, rate), 4).alias("revenue"),
        (quantity * price).alias("line_net_amount"),
        F.round(home_amount(quantity, price, rate, unit), 4).alias("line_home_amount"),
        days_between("o_orderdate", "l_shipdate").alias("delivery_time_days"),
    ]
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    _, amounts = header_lines(orders, lines, [("o_orderkey", "l_orderkey")], columns, "inner")
    return amounts
