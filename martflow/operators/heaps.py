"""The last rows of each key, kept from batch to batch.

The state is a table with one row for each key and a list of its last ``n`` rows,
newest first, in buckets of the key. A batch is merged with the lists of its own keys
only, so its cost does not depend on how much came before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.keys import row_hash
from ..sources.tables import materialize, table_exists
from .buckets import BUCKET, ROWS_PER_BUCKET, buckets_for, upsert_bucketed, with_bucket
from .reduce import KEY, keep_one, last_n, with_key

HEAP = "heap"
_ARRIVED, _RANK = "__arrived", "__rank"


def heaps(
    rows: DataFrame, keys: Sequence[str], item: str, order: Sequence[str], n: int
) -> DataFrame:
    """Per key the last ``n`` rows by ``order``, descending, as the list ``heap``.

    Ties go to the larger ``item``. The rank filter cuts each key to ``n`` rows in every
    task before the shuffle, so no list and no group is longer.
    """
    newest = [F.col(c).desc() for c in (*order, item)]
    fields = [c for c in rows.columns if c not in keys]
    ranked = last_n(rows, keys, newest, n, _RANK)
    listed = F.sort_array(F.collect_list(F.struct(_RANK, *fields)))
    heap = F.transform(listed, lambda r: F.struct(*[r[c].alias(c) for c in fields]))
    return ranked.groupBy(*keys).agg(heap.alias(HEAP))


def heap_rows(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of the lists."""
    return state.select(*keys, F.inline(HEAP))


def merge_heaps(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    keys: Sequence[str],
    item: str,
    order: Sequence[str],
    n: int,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> None:
    """Merge a batch into the stored lists; the first batch creates them.

    ``item`` names a row within its key. A row that comes again replaces the stored one,
    so a batch may be repeated, and late rows take their place by ``order``. The order of
    an item must not change: a list forgets what lies behind its last row.
    """
    if table_exists(spark, table):
        batch = materialize(batch)
        wanted = materialize(with_bucket(spark, table, batch.select(*keys).distinct(), keys))
        held = with_key(buckets_for(spark, table, wanted).drop(BUCKET), keys)
        mine = with_key(wanted, keys, held).select(KEY)
        stored = heap_rows(held.join(mine, KEY, "left_semi").drop(KEY), keys)
        both = batch.select(*stored.columns).withColumn(_ARRIVED, F.lit(1))
        both = both.unionByName(stored.withColumn(_ARRIVED, F.lit(0)))
    else:
        both = batch.withColumn(_ARRIVED, F.lit(1))
    fields = [c for c in batch.columns if c not in (*keys, item)]
    single = keep_one(both, [*keys, item], [F.col(_ARRIVED).desc(), row_hash(fields)])
    merged = heaps(single.drop(_ARRIVED), keys, item, order, n)
    upsert_bucketed(spark, table, merged, keys, hash_col=None, rows_per_bucket=rows_per_bucket)
