"""Which key buckets of two tables differ, by checksums that add up to a tree.

A bucket is a prefix of the bits of the key hash (see :mod:`~.buckets`), and its
checksum is made of sums over its rows. So the checksum of a shorter prefix is the sum
of those below it, and a whole table, its halves, and so on down to the buckets are
compared from the top: what agrees is not looked at any further.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.keys import row_hash
from ..sources.tables import initial_load, materialize, table_exists
from .buckets import BUCKET
from .upsert import replace_slice

SUFFIX = "__sums"
SUMS = ("n", "total", "mixed")
# Levels of the tree are compared four bits at a time.
STEP = 4


def sums_of(table: str) -> str:
    return table + SUFFIX


def bucket_sums(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``key_bucket, n, total, mixed``: one row for each bucket of some rows.

    Two sums of independent hashes, both over values that mark nulls and tell columns
    apart, as the change hash of a row does.
    """
    mark = row_hash(columns)
    return rows.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(mark).cast("decimal(38,0)")).alias("total"),
        F.sum(F.xxhash64(F.lit(1), mark).cast("decimal(38,0)")).alias("mixed"),
    )


def _differing(old: DataFrame, new: DataFrame, length: int) -> DataFrame:
    """Prefixes of a length whose checksums differ."""
    prefix = F.substring(BUCKET, 1, length).alias("prefix")
    minus = [(-F.col(c)).alias(c) for c in SUMS]
    both = new.select(prefix, *SUMS).unionByName(old.select(prefix, *minus))
    sums = both.groupBy("prefix").agg(*[F.sum(c).alias(c) for c in SUMS])
    return sums.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in SUMS])).select("prefix")


def changed_buckets(old: DataFrame, new: DataFrame, length: int) -> list[str]:
    """The buckets, names of ``length`` letters, that differ between two checksum tables.

    The lists are short: a name for each prefix that differs.
    """
    found: list[str] = []
    for n in [*range(1, length, STEP), length]:
        found = [r[0] for r in _differing(old, new, n).collect()]
        if not found:
            break
        below = F.substring(BUCKET, 1, n).isin(found)
        old, new = old.where(below), new.where(below)
    return sorted(found)


def stored_sums(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.table(sums_of(table))


def store_sums(spark: SparkSession, table: str, sums: DataFrame, buckets: Sequence[str] | None) -> None:
    """Keep the checksums of some buckets of a table, or of all of them."""
    if buckets is None or not table_exists(spark, sums_of(table)):
        initial_load(materialize(sums.coalesce(1)), sums_of(table))
        return
    old = stored_sums(spark, table)
    new = replace_slice(old, sums.where(F.col(BUCKET).isin(list(buckets))), F.col(BUCKET).isin(list(buckets)))
    materialize(new.coalesce(1)).write.mode("overwrite").insertInto(sums_of(table))
