"""Where the rows of a key are stored: an index for keys that don't tell their partition.

The index of a table is a table beside it, in buckets of the key hash, with one row for
each pair of a key and a partition. Pairs are written before the rows they stand for,
so the index knows every stored key; a pair too many, after a row has moved or where
two keys share a hash, only makes an upsert read a partition more. Only the index of a
new table is written after it, and a table without one gets it with the next load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..functions.clean import all_of
from ..sources.tables import materialize, table_exists
from .buckets import BUCKET, ROWS_PER_BUCKET, buckets_for, upsert_bucketed, with_bucket
from .reduce import KEY, with_key

HASHED = "key_hash"
SUFFIX = "__keys"


def index_of(table: str) -> str:
    return table + SUFFIX


def _pairs(rows: DataFrame, keys: Sequence[str], parts: Sequence[str], like: DataFrame) -> DataFrame:
    hashed = F.xxhash64(KEY).alias(HASHED)
    return with_key(rows, keys, like).select(hashed, *parts).distinct()


def record_keys(
    spark: SparkSession,
    table: str,
    rows: DataFrame,
    keys: Sequence[str],
    parts: Sequence[str],
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> None:
    """Add the partitions of some rows to the index. Call it before the rows are stored.

    A stored table without an index gets one first, from its keys.
    """

    exists = table_exists(spark, table)
    if exists and not table_exists(spark, index_of(table)):
        index_stored(spark, table, keys, parts, rows_per_bucket)
    like = spark.read.table(table) if exists else rows
    _add(spark, table, _pairs(rows, keys, parts, like), parts, rows_per_bucket)


def index_stored(
    spark: SparkSession,
    table: str,
    keys: Sequence[str],
    parts: Sequence[str],
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> None:
    """Give a stored table its index, from its keys."""
    like = spark.read.table(table)
    _add(spark, table, _pairs(like, keys, parts, like), parts, rows_per_bucket)


def _add(
    spark: SparkSession, table: str, pairs: DataFrame, parts: Sequence[str], rows_per_bucket: int
) -> None:
    # Pairs have no other columns, so known ones stay as they are.
    upsert_bucketed(
        spark,
        index_of(table),
        pairs,
        [HASHED, *parts],
        hash_col=None,
        bucket_by=[HASHED],
        rows_per_bucket=rows_per_bucket,
    )


def partitions_of(
    spark: SparkSession, table: str, rows: DataFrame, keys: Sequence[str], parts: Sequence[str]
) -> list[Row]:
    """The partitions that may hold the keys of some rows; few index buckets are read.

    The list is bounded by the partitions of the table.
    """
    index = index_of(table)
    wanted = _pairs(rows, keys, [], spark.read.table(table))
    wanted = materialize(with_bucket(spark, index, wanted, [HASHED]))
    held = buckets_for(spark, index, wanted)
    same = all_of([F.col(f"i.{c}") == F.col(f"w.{c}") for c in (HASHED, BUCKET)])
    found = held.alias("i").join(wanted.alias("w"), same, "left_semi")
    return found.select(*parts).distinct().collect()
