"""Type-2 dimensions kept as stored tables."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.buckets import BUCKET, ROWS_PER_BUCKET, bucket_depth, hash_bits
from ..operators.checksums import (
    bucket_sums,
    changed_buckets,
    store_sums,
    stored_sums,
    sums_of,
)
from ..operators.reduce import KEY, unique_or_fail, with_key
from ..operators.scd import END, START, current, scd2_changes
from ..operators.upsert import new_rows
from ..sources.tables import (
    by_partition,
    dynamic_overwrite,
    initial_load,
    materialize,
    set_table_property,
    table_exists,
    table_property,
)


@dataclass(frozen=True)
class Dimension:
    name: str
    keys: tuple[str, ...]
    tracked: tuple[str, ...]


# Keys and history-tracking columns of each dimension.
DIMENSIONS = {
    d.name: d
    for d in (
        Dimension(
            "dim_customer",
            ("nk_customer_id",),
            ("account_manager_id", "customer_name", "phone", "email", "street", "house_number"),
        ),
        Dimension(
            "dim_product",
            ("nk_product_id",),
            ("product_number", "product_name", "product_type", "manufacturer_no"),
        ),
        Dimension(
            "dim_product_category",
            ("nk_category_id",),
            ("category_name", "parent_code", "is_online"),
        ),
        Dimension(
            "dim_salesperson",
            ("nk_salesperson_id",),
            ("last_name", "first_name", "department", "branch_code"),
        ),
        Dimension(
            "dim_supplier",
            ("nk_supplier_id",),
            ("supplier_name", "street", "house_number", "website"),
        ),
        Dimension(
            "dim_supplier_address",
            ("nk_supplier_id", "address_seq_no"),
            ("address_seq_no", "full_name", "street"),
        ),
        Dimension(
            "dim_warehouse",
            ("nk_warehouse_id", "warehouse_name"),
            (
                "warehouse_name",
                "purchase_price_avg",
                "purchase_price_repair",
                "purchase_price_net",
                "stock_available",
            ),
        ),
        Dimension(
            "dim_payment_term",
            ("nk_payment_term_id",),
            ("payment_term_name", "cash_discount_pct", "cash_discount_days", "minimum_order_value"),
        ),
        Dimension(
            "dim_shipping_method",
            ("nk_shipping_method_id",),
            ("shipping_method_name", "shipping_type_flag", "shipping_rate"),
        ),
    )
}

# Closed versions are kept by the month of their end, open ones together. So a
# run reads the open slice and rewrites it and the month it closes into, and a
# lookup of recent events skips the months before them. The open slice is cut into
# buckets of the key hash, with a checksum of the last snapshot for each: buckets
# whose checksum is that of the new snapshot are neither read nor written.
SLICE = "closed_in"
OPEN = "open"
APPLIED = "martflow.applied_until"
WIDTH = "martflow.bucket_width"
CLOSED = "closed"


def _stored(rows: DataFrame, keys: Sequence[str], width: int, like: DataFrame) -> DataFrame:
    """Rows of a history with the partition they are stored in."""
    bucket = F.when(F.col(END).isNull(), F.substring(hash_bits(F.col(KEY)), 1, width))
    slices = F.coalesce(F.date_format(END, "yyyy-MM"), F.lit(OPEN))
    keyed = with_key(rows, keys, like).withColumns(
        {SLICE: slices, BUCKET: F.coalesce(bucket, F.lit(CLOSED))}
    )
    return keyed.drop(KEY)


def _bucketed(snapshot: DataFrame, keys: Sequence[str], width: int, like: DataFrame) -> DataFrame:
    """A snapshot in the types of the history, with the bucket of each row."""
    typed = snapshot.select(*[F.col(c).cast(like.schema[c].dataType).alias(c) for c in snapshot.columns])
    bucket = F.substring(hash_bits(F.col(KEY)), 1, width)
    return with_key(typed, keys, like).withColumn(BUCKET, bucket).drop(KEY)


def first_history(snapshot: DataFrame, at: dt.datetime) -> DataFrame:
    """A history with one open version per row."""
    kind = "timestamp_ntz"
    return snapshot.withColumns({START: F.lit(at).cast(kind), END: F.lit(None).cast(kind)})


def apply_snapshot(
    spark: SparkSession,
    table: str,
    dimension: Dimension,
    snapshot: DataFrame,
    at: dt.datetime,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> bool:
    """Apply one full snapshot to a stored history; False if it is not newer.

    The time of the last snapshot is a property of the table, so a replay after
    a failure is recognised and changes nothing. A snapshot older than the last
    one can't be applied any more, which a warning reports.

    The snapshot is read whole, once for its checksums. The history is compared in the
    buckets alone whose checksums differ. The size of the first snapshot sets their
    number.
    """
    keys = dimension.keys
    if not table_exists(spark, table):
        first = materialize(first_history(unique_or_fail(snapshot, keys, "snapshot"), at))
        width = 1 + bucket_depth(first.count(), rows_per_bucket)
        initial_load(_stored(first, keys, width, first), table, partition_by=[SLICE, BUCKET])
        set_table_property(spark, table, WIDTH, str(width))
        sums = bucket_sums(_bucketed(first, keys, width, first), snapshot.columns)
        store_sums(spark, table, sums, None)
        _mark_applied(spark, table, at)
        return True
    done = applied_snapshot(spark, table)
    if done is not None and at < done:
        warnings.warn(f"{table}: snapshot of {at} is older than {done} and not applied", stacklevel=2)
    if done is not None and at <= done:
        return False
    history = spark.read.table(table)
    width = _width(spark, table, history)
    arrived = _bucketed(snapshot, keys, width, history)
    sums = materialize(bucket_sums(arrived, snapshot.columns).coalesce(1))
    buckets = None
    if table_exists(spark, sums_of(table)):
        buckets = changed_buckets(stored_sums(spark, table), sums, width)
    if buckets != []:
        _apply_in_buckets(spark, table, dimension, arrived, history, buckets, at)
        store_sums(spark, table, sums, buckets)
    _mark_applied(spark, table, at)
    return True


def _apply_in_buckets(
    spark: SparkSession,
    table: str,
    dimension: Dimension,
    arrived: DataFrame,
    history: DataFrame,
    buckets: Sequence[str] | None,
    at: dt.datetime,
) -> None:
    """Compare some buckets, or all, with a snapshot and store what changed."""
    keys = dimension.keys
    opened = history.where(F.col(SLICE) == OPEN)
    if buckets is not None:
        opened = opened.where(F.col(BUCKET).isin(list(buckets)))
        arrived = arrived.where(F.col(BUCKET).isin(list(buckets)))
    # Names of buckets, never more than there are.
    before = opened.select(BUCKET).distinct().collect() if buckets is None else [(b,) for b in buckets]
    changes = scd2_changes(
        current(opened.drop(SLICE, BUCKET)), arrived.drop(BUCKET), keys, dimension.tracked, at
    )
    width = _width(spark, table, history)
    fresh = materialize(_stored(changes, keys, width, history).select(*history.columns))
    closed, still_open = fresh.where(F.col(SLICE) != OPEN), fresh.where(F.col(SLICE) == OPEN)
    # The month already holds what earlier runs closed, and a failed run may
    # have stored what this one closes, so a version counts once.
    month = history.where(F.col(SLICE) == at.strftime("%Y-%m"))
    kept = materialize(new_rows(closed, month, [*keys, START]))
    # Closed versions first: until the open slice follows, a retry redoes both.
    with dynamic_overwrite(spark):
        for rows in (closed.unionByName(kept), still_open):
            by_partition(rows, [SLICE, BUCKET]).write.mode("overwrite").insertInto(table)
    filled = {r[0] for r in still_open.select(BUCKET).distinct().collect()}
    for bucket in sorted({r[0] for r in before} - filled):
        spec = f"{SLICE} = '{OPEN}', {BUCKET} = '{bucket}'"
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def _width(spark: SparkSession, table: str, history: DataFrame) -> int:
    """Letters of a bucket's name; lost with the driver of the first run, it is read off."""
    width = table_property(spark, table, WIDTH)
    if width is None:
        opened = history.where(F.col(SLICE) == OPEN)
        width = opened.agg(F.max(F.length(BUCKET))).first()[0] or 1
        set_table_property(spark, table, WIDTH, str(width))
    return int(width)


def _mark_applied(spark: SparkSession, table: str, at: dt.datetime) -> None:
    set_table_property(spark, table, APPLIED, at.isoformat())


def applied_snapshot(spark: SparkSession, table: str) -> dt.datetime | None:
    """Time of the last snapshot applied to a stored history."""
    value = table_property(spark, table, APPLIED)
    return None if value is None else dt.datetime.fromisoformat(value)


def read_history(spark: SparkSession, table: str) -> DataFrame:
    """A stored history without its storage slice and bucket."""
    return spark.read.table(table).drop(SLICE, BUCKET)


__all__ = [
    "DIMENSIONS",
    "Dimension",
    "applied_snapshot",
    "apply_snapshot",
    "first_history",
    "read_history",
]
