"""Type-2 history from successive full snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.clean import any_of
from .reduce import KEY, unique_or_fail, with_key

# Validity columns, [start, end), NULL end for the open version.
START = "__START_AT"
END = "__END_AT"


def current(history: DataFrame) -> DataFrame:
    """The open versions."""
    return history.where(F.col(END).isNull())


def scd2_build(
    snapshots: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    at: str,
    timeline: Sequence[dt.datetime | dt.date] | None = None,
) -> DataFrame:
    """History of many stacked snapshots in one pass over the data.

    ``at`` names the snapshot time of each row. A version runs while the key is
    present in consecutive snapshots with equal tracked columns; the other
    columns take their latest value. A key's group holds one row per snapshot,
    so one shuffle and one sort serve the whole build.
    """
    spark = snapshots.sparkSession
    if timeline is None:
        # One value per snapshot; the rows themselves stay on the executors.
        timeline = [r[0] for r in snapshots.select(at).distinct().collect()]
    times = sorted(timeline)
    if len(set(times)) < len(times):
        raise ValueError("a snapshot time is in the timeline twice")
    steps = spark.createDataFrame(
        list(zip(times, [None, *times], [*times[1:], None])),
        f"__at {snapshots.schema[at].dataType.simpleString()}, "
        f"__prior {snapshots.schema[at].dataType.simpleString()}, "
        f"__next {snapshots.schema[at].dataType.simpleString()}",
    )
    unknown = F.raise_error(
        F.concat(F.lit("snapshot time not in the timeline: "), F.col(at).cast("string"))
    )
    # The timeline has one short row per snapshot, so its size is known here.
    stacked = snapshots.join(F.broadcast(steps), F.col(at) == F.col("__at"), "left").where(
        F.when(F.col("__at").isNotNull(), F.lit(True)).otherwise(unknown.cast("boolean"))
    )

    by_time = Window.partitionBy(*keys).orderBy(at)
    before = F.lag(F.struct(at, *tracked)).over(by_time)
    changed = any_of([~before[c].eqNullSafe(F.col(c)) for c in tracked])
    twice = F.raise_error(F.lit(f"duplicate key in snapshot: {', '.join(keys)}")).cast("boolean")
    opens = (
        F.when(before.isNull(), True)
        .when(before[at] == F.col(at), twice)
        .otherwise(~before[at].eqNullSafe(F.col("__prior")) | changed)
    )
    running = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    attributes = [c for c in snapshots.columns if c != at]
    return (
        stacked.withColumn("__opens", opens)
        .withColumns(
            {
                START: F.max(F.when(F.col("__opens"), F.col(at))).over(running),
                "__last": F.coalesce(F.lead("__opens").over(by_time), F.lit(True)),
            }
        )
        .where("__last")
        .select(*attributes, START, F.col("__next").alias(END))
    )


def scd2_apply(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    at: dt.datetime | dt.date,
    applied_until: dt.datetime | dt.date | None = None,
) -> DataFrame:
    """Apply one full snapshot to a history.

    New keys open a version, tracked changes close and reopen, other changes
    update the open version in place, and missing keys close. A snapshot not
    newer than ``applied_until`` changes nothing.
    """
    if applied_until is not None and at <= applied_until:
        return history
    changes = scd2_changes(current(history), snapshot, keys, tracked, at)
    return history.where(F.col(END).isNotNull()).unionByName(changes.select(*history.columns))


def scd2_changes(
    open_versions: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    at: dt.datetime | dt.date,
) -> DataFrame:
    """Open versions after a snapshot, plus the versions it closes.

    Both sides hold a key at most once, so the join cannot fan out.
    """
    kind = open_versions.schema[START].dataType
    now = F.lit(at).cast(kind)
    attributes = [c for c in snapshot.columns]
    keyed = unique_or_fail(with_key(snapshot, keys, open_versions), [KEY], "snapshot")
    old = with_key(open_versions, keys).withColumn("__known", F.lit(True)).alias("old")
    new = keyed.withColumn("__seen", F.lit(True)).alias("new")

    known, seen = F.col("__known").isNotNull(), F.col("__seen").isNotNull()
    changed = any_of([~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in tracked])

    def version(side: str, start: Column, end: Column) -> Column:
        fields = [F.col(f"{side}.{c}").alias(c) for c in attributes]
        return F.struct(*fields, start.alias(START), end.alias(END))

    still_open = F.lit(None).cast(kind)
    begun = F.when(known & ~changed, F.col(f"old.{START}")).otherwise(now)
    versions = F.array(
        F.when(known & (~seen | changed), version("old", F.col(f"old.{START}"), now)),
        F.when(seen, version("new", begun, still_open)),
    )
    return (
        old.join(new, F.col(f"old.{KEY}") == F.col(f"new.{KEY}"), "full_outer")
        .select(F.explode(F.array_compact(versions)).alias("v"))
        .select("v.*")
    )


def applied_until(history: DataFrame):
    """Time of the latest visible change in a history, or None if it is empty."""
    return history.agg(F.max(F.greatest(START, END))).first()[0]
