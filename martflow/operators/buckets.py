"""Tables without a natural partition, stored in buckets of a key hash.

A bucket is a prefix of the bits of the hash, and a partition of the table: ``b`` holds
all keys, ``b0`` and ``b1`` one half each. A load reads and rewrites the buckets of its
own keys only. A bucket that has grown too large is split into longer prefixes while it
is rewritten anyway, so buckets keep their size as the table grows and no other bucket
is touched.

Splitting writes the parts before the old bucket goes. As long as it stands, the parts
don't count: a run that finds both drops the parts, and has to be repeated as any
interrupted load.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.tables import by_partition, dynamic_overwrite, initial_load, materialize, table_exists
from .merge import HASH, merge_frames
from .reduce import KEY, unique_or_fail, with_key

BUCKET = "key_bucket"
ROOT = "b"
BITS = 32
ROWS_PER_BUCKET = 1_000_000


def hash_bits(keys: Column) -> Column:
    """The hash of a key struct as text of zeros and ones, after the root's letter."""
    number = F.pmod(F.xxhash64(keys), F.lit(1 << BITS))
    return F.concat(F.lit(ROOT), F.lpad(F.bin(number), BITS, "0"))


def split_prefixes(buckets: Iterable[str]) -> set[str]:
    """Prefixes that were split: all that some bucket continues."""
    return {b[:n] for b in buckets for n in range(1, len(b))}


def bucket_of(bits: Column, split: set[str]) -> Column:
    """The shortest prefix that was not split, which may be a bucket without rows yet."""
    depth = max(map(len, split), default=0)
    found = F.substring(bits, 1, depth + 1)
    for n in range(depth, 0, -1):
        prefix = F.substring(bits, 1, n)
        deeper = sorted(p for p in split if len(p) == n)
        found = F.when(prefix.isin(deeper), found).otherwise(prefix)
    return found


def split_buckets(bits: Column, deeper: Mapping[str, int]) -> Column:
    """The bucket, or for those in ``deeper`` the prefix of that length."""
    found = F.col(BUCKET)
    for length in sorted(set(deeper.values())):
        own = [b for b, n in deeper.items() if n == length]
        found = F.when(F.col(BUCKET).isin(own), F.substring(bits, 1, length)).otherwise(found)
    return found


def stored_buckets(spark: SparkSession, table: str) -> list[str]:
    """The buckets that count, one short name each; parts of an unfinished split go."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    names = sorted(r[0].partition("=")[2] for r in rows)
    counted: list[str] = []
    for name in names:  # a bucket comes right before the parts of it
        if counted and name.startswith(counted[-1]):
            _drop(spark, table, [name])
        else:
            counted.append(name)
    return counted


def _drop(spark: SparkSession, table: str, buckets: Sequence[str]) -> None:
    for b in buckets:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BUCKET} = '{b}')")


def bucket_depth(rows: int, limit: int) -> int:
    """How many more bits bring buckets of so many rows below the limit."""
    return max(0, math.ceil(math.log2(rows / limit))) if rows else 0


def with_bucket(spark: SparkSession, table: str, rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with the bucket of a stored table that holds their key, or would hold it."""
    bucket = bucket_of(hash_bits(F.col(KEY)), split_prefixes(stored_buckets(spark, table)))
    keyed = with_key(rows.drop(BUCKET), by, spark.read.table(table))
    return keyed.withColumn(BUCKET, bucket).drop(KEY)


def buckets_for(spark: SparkSession, table: str, rows: DataFrame) -> DataFrame:
    """The part of a stored table in the buckets of some rows; no others are read."""
    # One short name for each bucket the rows have keys of.
    touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]
    return spark.read.table(table).where(F.col(BUCKET).isin(touched))


def upsert_bucketed(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    hash_col: str | None = HASH,
    newest: str | None = None,
    bucket_by: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> None:
    """:func:`~.upsert.upsert` into a table stored in buckets of its key.

    The first run creates the table, with a column ``key_bucket``. A batch of ``n``
    keys reads and rewrites at most ``n`` buckets. ``bucket_by`` names the part of the
    key that is hashed, for readers that know no more of it.
    """
    by = list(bucket_by or keys)
    if not table_exists(spark, table):
        rows = materialize(unique_or_fail(source, keys, "upsert source"))
        length = min(1 + bucket_depth(rows.count(), rows_per_bucket), 1 + BITS)
        bits = hash_bits(F.col(KEY))
        first = with_key(rows, by).withColumn(BUCKET, F.substring(bits, 1, length)).drop(KEY)
        initial_load(first, table, partition_by=[BUCKET], order_by=keys)
        return
    source = materialize(with_bucket(spark, table, source, by))
    target = buckets_for(spark, table, source)
    merged = materialize(
        merge_frames(target, source, [*keys, BUCKET], update, hash_col=hash_col, newest=newest)
    )
    large = merged.groupBy(BUCKET).count().where(F.col("count") > rows_per_bucket).collect()
    deeper = {
        r[BUCKET]: min(len(r[BUCKET]) + bucket_depth(r["count"], rows_per_bucket), 1 + BITS) for r in large
    }
    deeper = {b: n for b, n in deeper.items() if n > len(b)}
    if deeper:
        bits = hash_bits(F.col(KEY))
        merged = with_key(merged, by, target).withColumn(BUCKET, split_buckets(bits, deeper))
    with dynamic_overwrite(spark):
        rows = by_partition(merged.select(*target.columns), [BUCKET], keys)
        rows.write.mode("overwrite").insertInto(table)
    _drop(spark, table, list(deeper))
