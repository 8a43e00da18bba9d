"""Structured Streaming runs over data in the work folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.history import Dimension, read_history
from ..sources.tables import new_database, new_folder
from ..streaming.snapshots import announce, follow_snapshots
from ..streaming.upserts import follow_changes
from .base import query, table
from .history import VERSION, YEARS, history_sql, named, snapshot


@query(f"WITH {history_sql('h')} SELECT {VERSION} FROM h")
def q47_stream_scd2(spark, sf_dir):
    """Three announced snapshots, followed by a stream into a stored history."""
    customers = table(spark, sf_dir, "customer")
    base = new_folder(spark, "snapshots")
    manifest, target = f"{base}/manifest", f"{new_database(spark)}.history"
    spec = Dimension("history", ("k",), ("seg",))
    for step, at in enumerate(YEARS, 1):
        folder = f"{base}/{step}"
        snapshot(customers, "c_custkey", "c_mktsegment", "c_acctbal", step).write.parquet(folder)
        announce(spark, manifest, at, folder)
        if step > 1:
            # The stream stops after what it finds, so it is started again later.
            follow_snapshots(spark, manifest, target, spec, f"{base}/checkpoint").awaitTermination()
    return named(read_history(spark, target))


@query("""
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events)
WHERE rn = 1
""")
def q52_stream_upsert(spark, sf_dir):
    """Latest event per user, kept by a stream over files of events."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    base = new_folder(spark, "events")
    # Newest first, so the later batches are late data.
    events.repartitionByRange(4, F.col("ts").desc()).write.parquet(f"{base}/files")
    stream = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/files")
    )
    target = f"{new_database(spark)}.latest"
    follow_changes(spark, stream, target, ["user_id"], "ts", f"{base}/checkpoint").awaitTermination()
    return spark.read.table(target).select("user_id", "event_id", "event_type")
