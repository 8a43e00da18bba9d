"""The merge of an upsert as a plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .reduce import KEY, NEAR, near, unique_or_fail, with_key

HASH = "row_hash"


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    insert: bool = True,
    hash_col: str | None = HASH,
    newest: str | None = None,
    reduced: bool = False,
    near_by: Sequence[str] = (),
) -> DataFrame:
    """The target after an upsert, as a plan.

    A matched row changes only if its hash differs (always, without a hash
    column); then the ``update`` columns and the hash come from the source.
    ``newest`` names a time column that must not go back: late rows lose, and
    of equally new rows the one with the smaller hash stays. NULL keys match
    each other. A key twice in the source fails the job.

    ``reduced`` says that the source holds each key once and has it as a struct (see
    :func:`~.reduce.with_key`), so that the shuffle of its reduction serves the merge. If
    that was by ``near_by``, of which it has the values too, the target is shuffled alike.
    """
    columns = target.columns
    update = check_columns(target, source, keys, update, insert, hash_col)
    if hash_col and hash_col not in update:
        update.append(hash_col)

    keyed = source if reduced else unique_or_fail(with_key(source, keys, target), [KEY], "upsert source")
    old = target
    new = keyed.withColumn("__in_source", F.lit(True)).alias("s")
    same_key = F.col(f"t.{KEY}") == F.col(f"s.{KEY}")
    if reduced and near_by and NEAR in keyed.columns:
        dealt = near(near_by[0], target.schema[near_by[0]].dataType, *near_by[1:])
        old = old.repartition(dealt).withColumn(NEAR, dealt)
        same_key = (F.col(f"t.{NEAR}") == F.col(f"s.{NEAR}")) & same_key
    old = with_key(old, keys).withColumn("__in_target", F.lit(True)).alias("t")
    inserted = F.col("__in_target").isNull()
    changed = F.col("__in_source").isNotNull()
    if hash_col:
        changed &= ~F.col(f"t.{hash_col}").eqNullSafe(F.col(f"s.{hash_col}"))
    if newest:
        ours, theirs = F.col(f"t.{newest}"), F.col(f"s.{newest}")
        tie = F.lit(True)
        if hash_col:
            tie = F.col(f"s.{hash_col}") < F.col(f"t.{hash_col}")
        changed &= ours.isNull() | (theirs > ours) | ((theirs == ours) & tie)

    def merged(c: str) -> Column:
        if c in update:
            value = F.when(inserted | changed, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        elif insert:
            value = F.when(inserted, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        else:
            value = F.col(f"t.{c}")
        return value.cast(target.schema[c].dataType).alias(c)

    how = "full_outer" if insert else "left"
    return old.join(new, same_key, how).select(*[merged(c) for c in columns])


def check_columns(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    insert: bool = True,
    hash_col: str | None = HASH,
) -> list[str]:
    """The columns to update; an error names those that a merge would miss."""
    columns = target.columns
    update = list(columns if update is None else update)
    _require(update, columns, "target")
    _require([*keys, *update, *([hash_col] if hash_col else [])], source.columns, "source")
    if insert:
        _require(columns, source.columns, "source")
    return update


def _require(wanted: Sequence[str], present: Sequence[str], where: str) -> None:
    missing = [c for c in wanted if c not in present]
    if missing:
        raise ValueError(f"columns missing in {where}: {', '.join(missing)}")
