"""Point-in-time lookup for keys with very many versions, as one sorted merge.

Versions and events are one stream of rows, dealt into ranges by (key, time) and
sorted. A task runs through its range and keeps the last version it has passed, so
neither side is repeated and no key is bound to one task: a key with a third of all
rows is spread over a third of the ranges. What a range must know of those before it
is one row, the version that was valid at its border.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ..functions import as_col
from ..functions.clean import all_of, holds
from ..sources.tables import materialize
from .scd import END, START

VERSION, EVENT, BORDER = 0, 1, 2


def asof_merge(
    left: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[Column | str, Column | str]],
    event: Column | str,
    take: Mapping[str, str] | Sequence[str],
    precision: str = "date",
    only: Column | None = None,
    open_until: str | None = None,
) -> DataFrame:
    """What :func:`~.temporal.asof_lookup` gives, for histories of any length per key.

    The versions of a key must not overlap, as in every type-2 history; of versions
    that do, the one that began last counts, and an event matches one at most. Rows
    without a key or an event time are kept without a match, spread over the ranges.

    The merged rows are written to the work folder once, since the versions at the
    borders are known only when all ranges have been read.
    """
    kind = {"date": "date", "timestamp": "timestamp_ntz"}[precision]
    renamed = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
    keys = [f"__k{i}" for i in range(len(on))]

    # Taken columns may have any name, so they are numbered inside.
    versions = dim.select(
        *[as_col(d).alias(k) for k, (_, d) in zip(keys, on)],
        F.col(START).cast(kind).alias("__time"),
        F.coalesce(F.col(END).cast(kind), F.lit(open_until).cast(kind)).alias("__end"),
        *[F.col(c).alias(f"__v{i}") for i, c in enumerate(renamed)],
    ).where(all_of([F.col(c).isNotNull() for c in (*keys, "__time")]))
    # A version without a moment of its own is never valid; it must not hide another.
    lasting = versions.where(F.col("__end").isNull() | (F.col("__end") > F.col("__time")))
    taken = [f"__v{i}" for i in range(len(renamed))]
    old = lasting.select(
        *keys,
        "__time",
        F.lit(VERSION).cast("byte").alias("__kind"),
        F.lit(0).cast("long").alias("__salt"),
        F.struct("__end", *taken).alias("__version"),
    )
    looked_up = [F.lit(True) if only is None else holds(only), as_col(event).isNotNull()]
    looked_up = all_of([*looked_up, *[as_col(l).isNotNull() for l, _ in on]])
    new = left.select(
        *[F.when(looked_up, as_col(l)).alias(k) for k, (l, _) in zip(keys, on)],
        F.when(looked_up, as_col(event).cast(kind)).alias("__time"),
        F.lit(EVENT).cast("byte").alias("__kind"),
        F.xxhash64(*[F.col(f"`{f.name}`") for f in left.schema if _hashed(f)]).alias("__salt"),
        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("__row"),
    )
    order = [*keys, "__time", "__kind", "__salt"]
    both = old.unionByName(new, allowMissingColumns=True)
    dealt = both.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = _merged_schema(dealt, keys)
    merged = materialize(dealt.mapInArrow(_merging(keys, schema.names), schema))

    carried = F.broadcast(_at_borders(merged, keys))
    found = merged.where(F.col("__kind") == EVENT).join(carried, "__range", "left")
    version = F.when(F.col("__open"), F.col("__carried")).otherwise(F.col("__version"))
    found = found.withColumn("__found", version)
    end = F.col("__found.__end")
    valid = F.col("__found").isNotNull() & (end.isNull() | (F.col("__time") < end))
    return found.select(
        *[F.col(f"__row.`{c}`").alias(c) for c in left.columns],
        *[F.when(valid, F.col(f"__found.{v}")).alias(c) for v, c in zip(taken, renamed.values())],
    )


def _hashed(field: StructField) -> bool:
    kind = field.dataType.simpleString()
    return "map<" not in kind and "variant" not in kind


def _merged_schema(dealt: DataFrame, keys: Sequence[str]) -> StructType:
    """Events with their version, and one border row for each range."""
    of = {f.name: f.dataType for f in dealt.schema}
    fields = {"__range": LongType(), "__kind": of["__kind"], "__open": BooleanType()}
    fields |= {c: of[c] for c in ("__time", "__version", "__row")}
    fields |= {k.replace("__k", f"__{side}"): of[k] for side in ("first", "last") for k in keys}
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


def _merging(keys: Sequence[str], names: Sequence[str]):
    """The function that runs through a sorted range."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        first = passed = None  # first row of the range; last row, with its key's version
        one_key = True
        for batch in batches:
            if not batch.num_rows:
                continue
            first = batch.slice(0, 1) if first is None else first
            rows = pa.Table.from_batches([batch] if passed is None else [passed, batch])
            rows = rows.combine_chunks().to_batches()[0]
            at = np.arange(rows.num_rows)
            begins = np.zeros(rows.num_rows, bool)
            for k in keys:
                column = rows.column(k)
                same = pc.equal(column[1:], column[:-1]).fill_null(False).to_numpy(False)
                both_null = column.is_null().to_numpy(False)
                begins[1:] |= ~(same | (both_null[1:] & both_null[:-1]))
            kinds = rows.column("__kind").to_numpy()
            version = np.maximum.accumulate(np.where(kinds == VERSION, at, -1))
            known = version >= np.maximum.accumulate(np.where(begins, at, 0))
            in_first = np.cumsum(begins) == 0 if one_key else np.zeros(len(at), bool)
            one_key = bool(in_first[-1])

            chosen = pa.array(np.where(known, version, 0), mask=~known)
            versions = rows.column("__version").take(chosen)
            events = np.flatnonzero(kinds == EVENT)
            events = events[events > 0] if passed is not None else events
            if len(events):
                own = pa.array(events)
                columns = {
                    "__range": pa.array(np.full(len(events), number)),
                    "__kind": rows.column("__kind").take(own),
                    "__open": pa.array((in_first & ~known)[events]),
                    "__time": rows.column("__time").take(own),
                    "__version": versions.take(own),
                    "__row": rows.column("__row").take(own),
                }
                yield _batch(columns, names, len(events), batch.schema)
            last = rows.slice(rows.num_rows - 1)
            passed = _passed(last, versions.slice(rows.num_rows - 1), bool(known[-1]))
        if first is not None:
            columns = {
                "__range": pa.array([number]),
                "__kind": pa.array([BORDER], pa.int8()),
                "__version": passed.column("__version"),
            }
            columns |= {k.replace("__k", "__first"): first.column(k) for k in keys}
            columns |= {k.replace("__k", "__last"): passed.column(k) for k in keys}
            yield _batch(columns, names, 1, first.schema)

    return scan


def _passed(last: pa.RecordBatch, version: pa.Array, known: bool) -> pa.RecordBatch:
    """The last row as one that stands for the version of its key, if there is one."""
    columns = dict(zip(last.schema.names, last.columns))
    columns["__version"] = version
    columns["__kind"] = pa.array([VERSION if known else BORDER], pa.int8())
    return pa.RecordBatch.from_arrays([columns[c] for c in last.schema.names], schema=last.schema)


def _batch(columns: dict, names: Sequence[str], count: int, schema: pa.Schema) -> pa.RecordBatch:
    kinds = {"__open": pa.bool_()}

    def empty(name: str) -> pa.Array:
        source = name.replace("__first", "__k").replace("__last", "__k")
        return pa.nulls(count, kinds.get(name) or schema.field(source).type)

    arrays = [columns[c] if c in columns else empty(c) for c in names]
    return pa.RecordBatch.from_arrays(arrays, list(names))


def _at_borders(merged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``__range, __carried``: the version valid where a range begins, of its first key.

    There is one short row for each range, and so as many as tasks.
    """
    borders = merged.where(F.col("__kind") == BORDER)
    firsts = [k.replace("__k", "__first") for k in keys]
    lasts = [k.replace("__k", "__last") for k in keys]
    # Ranges that end with one key follow each other; all but the first hold it alone.
    so_far = F.last("__version", ignorenulls=True).over(
        Window.partitionBy(*lasts).orderBy("__range")
    )
    following = Window.orderBy("__range")
    goes_on = all_of([F.lead(f).over(following) == F.col(l) for f, l in zip(firsts, lasts)])
    return borders.select(
        F.lead("__range").over(following).alias("__range"),
        F.when(goes_on, so_far).alias("__carried"),
    ).where("__range IS NOT NULL AND __carried IS NOT NULL")
