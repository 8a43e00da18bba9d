"""Latest dates of a partitioned table, kept with every load.

Beside the table stands a small one with the latest date of each partition. A load
forgets the partitions it is about to rewrite, writes them, and notes their new dates
from the rows it has at hand. So the latest date of the whole table takes no scan; a
partition that is not noted, since a load was lost between the two, is read again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.tables import initial_load, materialize, partition_columns, table_exists

SUFFIX = "__maxima"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_EMPTY = "partition STRING, column_name STRING, latest DATE"


def maxima_of(table: str) -> str:
    return table + SUFFIX


def _named(part: str) -> Column:
    return F.coalesce(F.col(part).cast("string"), F.lit(NULL_PARTITION))


def noted(spark: SparkSession, table: str) -> DataFrame:
    """``partition, column_name, latest`` as noted so far; a row for each partition."""
    if table_exists(spark, maxima_of(table)):
        return spark.read.table(maxima_of(table))
    return spark.createDataFrame([], _EMPTY)


def _write(rows: DataFrame, table: str) -> None:
    rows = materialize(rows.coalesce(1))
    if table_exists(rows.sparkSession, maxima_of(table)):
        rows.write.mode("overwrite").insertInto(maxima_of(table))
    else:
        initial_load(rows, maxima_of(table))


def forget(spark: SparkSession, table: str, partitions: Sequence[object]) -> None:
    """Drop the notes of partitions that will be rewritten."""
    if table_exists(spark, maxima_of(table)):
        names = [NULL_PARTITION if p is None else str(p) for p in partitions]
        _write(noted(spark, table).where(~F.col("partition").isin(names)), table)


def note(
    spark: SparkSession, table: str, rows: DataFrame, part: str, columns: Sequence[str]
) -> None:
    """Note the latest dates of partitions, of which ``rows`` are all rows."""
    dates = [F.max(F.col(c).cast("date")).alias(c) for c in columns]
    wide = rows.groupBy(_named(part).alias("partition")).agg(*dates)
    long = wide.unpivot("partition", list(columns), "column_name", "latest")
    _write(noted(spark, table).unionByName(long), table)


def _partitions(spark: SparkSession, table: str) -> set[str]:
    """The stored partitions; the list is as long as the table has them."""
    shown = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return {unquote(r[0].partition("=")[2]) for r in shown}


def _has_notes(spark: SparkSession, table: str) -> bool:
    return len(partition_columns(spark, table)) == 1 and table_exists(spark, maxima_of(table))


def latest_date(spark: SparkSession, table: str, column: str) -> DataFrame:
    """One row with ``max_date``, the latest date of a column of a stored table.

    Noted partitions are not read. A table without notes is scanned.
    """
    target = spark.read.table(table)
    if not _has_notes(spark, table):
        return target.agg(F.max(column).cast("date").alias("max_date"))
    own = noted(spark, table).where(F.col("column_name") == column)
    known = {r["partition"] for r in own.select("partition").collect()}
    stored = _partitions(spark, table)
    held = own.where(F.col("partition").isin(sorted(stored & known)))
    latest = held.select(F.col("latest").alias("date"))
    if missing := sorted(stored - known):
        unread = _in(spark, table, missing)
        latest = latest.unionByName(unread.select(F.col(column).cast("date").alias("date")))
    return latest.agg(F.max("date").alias("max_date"))


def _in(spark: SparkSession, table: str, partitions: Sequence[str]) -> DataFrame:
    """The rows of some partitions. Literals of the column itself prune the scan."""
    part = F.col(partition_columns(spark, table)[0])
    kept = part.isin([p for p in partitions if p != NULL_PARTITION])
    if NULL_PARTITION in partitions:
        kept |= part.isNull()
    return spark.read.table(table).where(kept)


def rows_since(spark: SparkSession, table: str, column: str, day: dt.date) -> DataFrame:
    """The rows of a stored table from a day on, whatever date it is stored by.

    A date predicate alone prunes no partition of a table that is stored by a text of
    another date. The notes tell which partitions end before the day; those are not
    read. Partitions without notes are.
    """
    late = F.col(column).cast("date") >= F.lit(day)
    if not _has_notes(spark, table):
        return spark.read.table(table).where(late)
    own = noted(spark, table).where(F.col("column_name") == column)
    over = own.where(F.col("latest").isNull() | (F.col("latest") < F.lit(day)))
    ended = {r["partition"] for r in over.select("partition").collect()}
    return _in(spark, table, sorted(_partitions(spark, table) - ended)).where(late)
