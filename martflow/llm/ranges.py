"""Positions of rows within their groups, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martflow.llm.stored import stored


def positions(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add ``at``, the place of each row in its group, from 0; nulls come first.

    The rows are dealt into sorted ranges, so that a group of a third of all rows is
    spread over many. A task counts within its range; the rows that a group has in
    ranges before are added from one short row for each range. ``group`` is a long
    without nulls, and ``order`` should tell all rows of a group apart that differ.
    """

    names = [*rows.columns, "_part", "_at"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, count = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(group).to_numpy()
            begins = np.ones(len(own), bool)
            begins[1:] = own[1:] != own[:-1]
            starts = np.flatnonzero(begins)
            at = np.arange(len(own)) - starts[np.cumsum(begins) - 1]
            if last == own[0]:
                at[: starts[1] if len(starts) > 1 else None] += count
            last, count = own[-1], at[-1] + 1
            parts = pa.array(np.full(len(own), part))
            yield pa.RecordBatch.from_arrays([*batch.columns, parts, pa.array(at)], names)

    added = [StructField("_part", LongType()), StructField("_at", LongType())]
    keys = [group, *order]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    counted = stored(dealt.mapInArrow(scan, StructType([*rows.schema.fields, *added])))
    # One row for each range: its last group, which may go on in the next range.
    ends = (
        counted.groupBy("_part")
        .agg(F.max(F.struct(F.col(group).alias("_group"), "_at")).alias("end"))
        .select("_part", "end._group", (F.col("end._at") + 1).alias("_count"))
    )
    so_far = F.sum("_count").over(Window.partitionBy("_group").orderBy("_part"))
    following = F.lead("_part").over(Window.orderBy("_part"))
    before = ends.select(following.alias("_part"), "_group", so_far.alias("_before"))
    same = (counted["_part"] == before["_part"]) & (counted[group] == before["_group"])
    return counted.join(F.broadcast(before), same, "left").select(
        *[counted[c] for c in rows.columns],
        (counted["_at"] + F.coalesce("_before", F.lit(0))).alias("at"),
    )
