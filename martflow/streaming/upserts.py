"""Upserts fed by a stream of changed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.keys import row_hash
from ..operators.buckets import upsert_bucketed
from ..operators.reduce import keep_one
from ..operators.upsert import HASH, upsert


def follow_changes(
    spark: SparkSession,
    changes: DataFrame,
    table: str,
    keys: Sequence[str],
    newest: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Upsert a stream of rows; the newest row of a key wins, also when late.

    Without ``partition_by`` the table is stored in buckets of its key, so that a batch
    rewrites the buckets of its own keys. A batch replayed after a failure finds equal hashes and changes nothing.
    """

    def apply(batch: DataFrame, _: int) -> None:
        compared = [c for c in batch.columns if c not in keys]
        hashed = batch.withColumn(HASH, row_hash(compared))
        latest = keep_one(hashed, keys, [F.col(newest).desc(), HASH])
        if partition_by:
            upsert(spark, table, latest, keys, partition_by=partition_by, newest=newest)
        else:
            upsert_bucketed(spark, table, latest, keys, newest=newest)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
