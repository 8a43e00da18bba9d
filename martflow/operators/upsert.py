"""Upserts, append-once and period replacement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.clean import all_of
from ..functions.keys import row_hash
from ..sources.tables import (
    by_partition,
    dynamic_overwrite,
    initial_load,
    materialize,
    partition_columns,
    shuffled_by_part_of_key,
    shuffles_removed,
    table_exists,
)
from . import keyindex, maxima
from .merge import HASH, check_columns, merge_frames
from .reduce import KEY, keep_one, unique_or_fail, with_key

_MARK = "__mark"
# Types whose text tells all values apart, in every time zone.
_EXACT = "string tinyint smallint int bigint boolean date timestamp_ntz decimal".split()


def upsert(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    hash_col: str | None = HASH,
    newest: str | None = None,
    key_index: bool = False,
    keep_maxima: Sequence[str] = (),
    reduced: bool = False,
    touching: DataFrame | None = None,
    near_by: Sequence[str] = (),
) -> None:
    """Upsert into a stored table; the first run creates it.

    Only partitions that hold a changed key are read in full and rewritten. If the key
    does not tell its partition, the keys of the whole table are read to find them, or
    with ``key_index`` an index of the keys, which every load keeps (see
    :mod:`~.keyindex`). The merged rows are written to the shared work folder first,
    because a plan may not overwrite what it reads.

    A table without partitions is rewritten whole; for those that grow, use
    :func:`~.buckets.upsert_bucketed`. ``keep_maxima`` names date columns whose latest
    values are noted for each partition (see :mod:`~.maxima`).

    ``reduced`` says that the source holds each key once, which is not checked then.
    ``touching`` gives the partitions of the source where its key tells them, from fewer
    columns than it has. The source is then merged in place, without a work copy; if it
    has its key as a struct as well, the shuffle of its reduction serves the merge.
    ``near_by`` names the columns of the key that this shuffle was by (see
    :func:`~.reduce.near`), if the source has its values.

    With ``newest``, rows may come late or again. Where only the stored keys tell the
    partitions, they are compared with their times and hashes first, in a few bytes of
    each row (see :func:`_pending`). Only source rows that may change something are then
    copied and merged, and only their partitions rewritten. The source is read twice.
    """
    if not table_exists(spark, table):
        source = source if reduced else unique_or_fail(source, keys, "upsert source")
        indexed = key_index and not set(partition_by) <= set(keys)
        # Without an index, a load lost before it is written leaves it to the next one, which
        # takes the keys of the table. An index left over from an older table is added to first.
        left_over = indexed and table_exists(spark, keyindex.index_of(table))
        if left_over:
            source = materialize(source)
            keyindex.record_keys(spark, table, source, keys, partition_by)
        initial_load(source, table, cluster_by, partition_by)
        if indexed and not left_over:
            keyindex.index_stored(spark, table, keys, partition_by)
        if keep_maxima:
            maxima.note(spark, table, spark.read.table(table), partition_by[0], keep_maxima)
        return
    target = spark.read.table(table)
    parts = partition_columns(spark, table)
    told = set(parts) <= set(keys)
    in_place = touching is not None and bool(parts) and told
    late = newest is not None and bool(parts) and not told and not key_index
    if late:
        check_columns(target, source, keys, update, hash_col=hash_col)
        pending = materialize(_pending(target, source, keys, parts, hash_col, newest))
        if pending.isEmpty():
            return
        mine = _marked(source, keys, target)
        source = materialize(mine.join(pending.select(_MARK), _MARK, "left_semi").drop(_MARK))
    elif not in_place:
        source = materialize(source)
    if not parts:
        merged = materialize(
            merge_frames(target, source, keys, update, hash_col=hash_col, newest=newest)
        )
        merged.write.mode("overwrite").insertInto(table)
        return
    if key_index and not told:
        keyindex.record_keys(spark, table, source, keys, parts)
        touched = keyindex.partitions_of(spark, table, source, keys, parts)
    elif late:
        held = pending.where(F.col("__in_target")).select(*parts)
        touched = held.unionByName(source.select(*parts)).distinct().collect()
    else:
        touched = _touched_partitions(target, touching if in_place else source, keys, parts)
    if in_place:
        source = _only(source, touched, parts)
    slice_ = _partitions(target, touched, parts)
    keyed = reduced and KEY in source.columns
    merged = merge_frames(
        slice_, source, keys, update, hash_col=hash_col, newest=newest, reduced=keyed, near_by=near_by
    )
    with shuffled_by_part_of_key(spark) if keyed and near_by else nullcontext():
        merged = materialize(merged)
    if keep_maxima:
        maxima.forget(spark, table, [p[0] for p in touched])
    with dynamic_overwrite(spark), shuffles_removed(spark):
        by_partition(merged, parts).write.mode("overwrite").insertInto(table)
    if keep_maxima:
        maxima.note(spark, table, merged, parts[0], keep_maxima)
    # A row whose partition value changed can leave its old partition empty.
    filled = set(merged.select(*parts).distinct().collect())
    for p in touched:
        if p not in filled:
            spec = [f"{c} = {'NULL' if v is None else repr(str(v))}" for c, v in p.asDict().items()]
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({', '.join(spec)})")


def _marked(rows: DataFrame, keys: Sequence[str], like: DataFrame) -> DataFrame:
    """Add a short mark of the key: its md5 as bytes, or a struct of keys whose text is not exact."""
    kinds = [like.schema[k].dataType for k in keys]
    if any(k.simpleString().partition("(")[0] not in _EXACT for k in kinds):
        return with_key(rows, keys, like).withColumnRenamed(KEY, _MARK)
    cast = [F.col(k).cast(kind) for k, kind in zip(keys, kinds)]
    return rows.withColumn(_MARK, F.unhex(row_hash(cast)))


def _pending(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    parts: Sequence[str],
    hash_col: str | None,
    newest: str,
) -> DataFrame:
    """Marks of the source rows that may change the target, and the partitions they are stored in.

    Left out are rows with the stored hash and rows older than the stored one. Equally
    new ones stay, since the merge decides between them. A key twice in the source fails
    the job.
    """

    def short(rows: DataFrame, *more: str) -> DataFrame:
        digest = F.unhex(F.md5(F.col(hash_col).cast("string"))) if hash_col else F.lit(None)
        return _marked(rows, keys, target).select(
            _MARK, F.col(newest).alias("__time"), digest.alias("__digest"), *more
        )

    stored = short(target, *parts).withColumn("__in_target", F.lit(True)).alias("t")
    new = unique_or_fail(short(source), [_MARK], "upsert source").alias("s")
    ours, theirs = F.col("t.__time"), F.col("s.__time")
    change = ours.isNull() | (theirs >= ours)
    if hash_col:
        change &= ~F.col("t.__digest").eqNullSafe(F.col("s.__digest"))
    inserted = F.col("__in_target").isNull()
    same_key = F.col(f"t.{_MARK}") == F.col(f"s.{_MARK}")
    found = new.join(stored, same_key, "left").where(inserted | change)
    known = F.coalesce("__in_target", F.lit(False)).alias("__in_target")
    return found.select(f"s.{_MARK}", known, *[F.col(f"t.{c}") for c in parts])


def _partitions(target: DataFrame, touched: Sequence[Row], parts: Sequence[str]) -> DataFrame:
    """The rows of some partitions, of any number.

    Lists of literals prune the scan. With several partition columns they admit
    combinations that are not wanted, which a semi join with the list removes.
    """
    for c in parts:
        values = {p[c] for p in touched}
        known = F.col(c).isin([v for v in values if v is not None])
        target = target.where(known | F.col(c).isNull() if None in values else known)
    if len(parts) == 1:
        return target
    kind = StructType([target.schema[c] for c in parts])
    # One short row for each touched partition of the table.
    wanted = target.sparkSession.createDataFrame([tuple(p) for p in touched], kind)
    same = all_of([F.col(f"t.{c}").eqNullSafe(F.col(f"w.{c}")) for c in parts])
    return target.alias("t").join(F.broadcast(wanted.alias("w")), same, "left_semi")


def _only(source: DataFrame, touched: Sequence[Row], parts: Sequence[str]) -> DataFrame:
    """The source, which fails on a row of another partition.

    Stored rows of that partition were not read, and the write would replace them.
    """
    for c in parts:
        values = {p[c] for p in touched}
        known = F.coalesce(F.col(c).isin([v for v in values if v is not None]), F.lit(None in values))
        failure = F.raise_error(F.lit("the source has changed while it was read"))
        source = source.where(F.when(known, F.lit(True)).otherwise(failure.cast("boolean")))
    return source


def _touched_partitions(
    target: DataFrame, source: DataFrame, keys: Sequence[str], parts: Sequence[str]
) -> list[Row]:
    """Partitions the upsert reads and rewrites.

    The list is bounded by the partitions of the table, and as literals it
    prunes the scan of the target.
    """
    new = source.select(*parts)
    if not set(parts) <= set(keys):
        same_key = all_of([F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
        held = target.alias("t").join(source.select(*keys).alias("s"), same_key, "left_semi")
        new = new.unionByName(held.select(*parts))
    return new.distinct().collect()


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks, for appends that may be re-run."""
    same_key = all_of([F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys])
    return source.alias("s").join(target.select(*keys).alias("t"), same_key, "left_anti")


def append_once(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    since: Column | None = None,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    order_by: Sequence[Column | str] = (),
) -> None:
    """Append observations the table does not hold yet, each key once.

    ``since`` limits the part of the table to look in, normally the look-back
    window the source was read with. Of several source rows of a key the first
    by ``order_by`` stays, and of equal ones that with the smallest row hash. The hash is
    sorted by its bytes, in the order of its text and half as long.
    """
    rest = [c for c in source.columns if c not in keys]
    first = [*order_by, F.unhex(row_hash(rest)) if rest else F.lit(0)]
    if not table_exists(spark, table):
        initial_load(keep_one(source, keys, first), table, cluster_by, partition_by)
        return
    target = spark.read.table(table)
    seen = target if since is None else target.where(since)
    if all(source.schema[k].dataType == target.schema[k].dataType for k in keys):
        # A key struct lets the reduction and the match share one shuffle.
        batch, match = with_key(source, keys), [KEY]
        seen = with_key(seen.select(*keys), keys)
        fresh = keep_one(batch, match, first).join(seen.select(KEY), KEY, "left_anti")
    else:
        fresh = new_rows(seen, keep_one(source, keys, first), keys)
    # The files of the table are listed before the append, which only adds to them.
    with shuffles_removed(spark):
        fresh.select(*target.columns).write.mode("append").insertInto(table)


def replace_slice(target: DataFrame, source: DataFrame, slice_: Column) -> DataFrame:
    """The target with one slice exchanged for the source, as a plan."""
    kept = target.where(~F.coalesce(slice_, F.lit(False)))
    return kept.unionByName(source.select(*target.columns))


def replace_period(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    period: Mapping[str, object],
    order_by: Sequence[Column | str] = (),
) -> None:
    """Exchange one period of a stored table, which is partitioned by it.

    The slice is overwritten in one command: no moment without its rows, and
    re-running a period gives the same table. ``order_by`` sorts each file.
    """
    data = source.drop(*period)
    if not table_exists(spark, table):
        full = data.withColumns({c: F.lit(v) for c, v in period.items()})
        initial_load(full, table, partition_by=list(period), order_by=order_by)
        return
    if order_by:
        data = data.sortWithinPartitions(*order_by)
    order = [c for c in spark.read.table(table).columns if c not in period]
    spec = ", ".join(f"{c} = '{v}'" for c, v in period.items())
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT * FROM {{rows}}",
        rows=data.select(*order),
    )
