"""Type-2 dimensions fed by a stream of finished snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.history import Dimension, apply_snapshot

# A snapshot may have many files, so its files must not be the stream: a batch
# could hold half a snapshot and close every key of the other half. The stream
# is a manifest, one row per finished snapshot.
MANIFEST = "at TIMESTAMP_NTZ, folder STRING"


def announce(spark: SparkSession, manifest: str, at, folder: str) -> None:
    """Tell the stream that a snapshot is complete."""
    spark.createDataFrame([(at, folder)], MANIFEST).coalesce(1).write.mode("append").parquet(manifest)


def follow_snapshots(
    spark: SparkSession, manifest: str, table: str, dimension: Dimension, checkpoint: str
) -> StreamingQuery:
    """Apply every announced snapshot once, in time order, then stop.

    The snapshot time travels with the data, so a batch replayed after a
    failure changes nothing.
    """

    def apply(batch: DataFrame, _: int) -> None:
        # One short row per snapshot announced since the last run.
        for at, folder in batch.orderBy("at").collect():
            apply_snapshot(spark, table, dimension, spark.read.parquet(folder), at)

    return (
        spark.readStream.schema(MANIFEST)
        .parquet(manifest)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
