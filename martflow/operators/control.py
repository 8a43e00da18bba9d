"""Watermark control for incremental loads.

The control table holds one short row per loaded table: ``table_name,
column_name, date_control, previous_days``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import materialize
from .maxima import latest_date
from .merge import merge_frames

KEYS = ("table_name", "column_name")


def read_watermark(control: DataFrame, table: str, column: str) -> dt.date | None:
    """The stored watermark, or None, which means a full load."""
    row = (
        control.where((F.col("table_name") == table) & (F.col("column_name") == column))
        .select(F.col("date_control").cast("date"))
        .first()
    )
    return row[0] if row else None


def since(df: DataFrame, column: str, watermark: dt.date | None) -> DataFrame:
    """Rows from the watermark on.

    The typed comparison is pushed to the scan, also for timestamp columns.
    """
    if watermark is None:
        return df
    return df.where(F.col(column).cast("date") >= F.lit(watermark))


def table_maxima(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Latest date of each (table, column), one row each, in a single job."""
    return _named_maxima(
        {
            name: df.agg(F.max(name[1]).cast("date").alias("max_date"))
            for name, df in tables.items()
        }
    )


def _named_maxima(maxima: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    parts = [
        row.select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "max_date")
        for (table, column), row in maxima.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def advance(control: DataFrame, maxima: DataFrame) -> DataFrame:
    """Control rows moved to the latest date less their look-back.

    Tables without data, or without a control row, change nothing.
    """
    moved = (
        maxima.where(F.col("max_date").isNotNull())
        .join(control.select(*KEYS, "previous_days"), list(KEYS))
        .select(*KEYS, F.date_sub("max_date", F.col("previous_days")).alias("date_control"))
    )
    return merge_frames(control, moved, KEYS, update=["date_control"], insert=False, hash_col=None)


def advance_table(spark: SparkSession, control_table: str, schema: str | None = None) -> None:
    """Advance every watermark of a stored control table.

    Tables whose loads note their latest dates are not scanned.
    """
    control = spark.read.table(control_table)
    # The control table is the list of tables to read, a short row for each.
    entries = control.select(*KEYS).collect()
    prefix = f"{schema}." if schema else ""
    latest = {(t, c): latest_date(spark, f"{prefix}{t}", c) for t, c in entries}
    if latest:
        moved = materialize(advance(control, _named_maxima(latest)))
        moved.write.mode("overwrite").insertInto(control_table)
