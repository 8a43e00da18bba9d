"""One or a few rows per key.

All of these filter on a rank, which Spark turns into a group limit before the
shuffle. So a key that holds a large share of the rows sends only its best rows
from each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType, NumericType

from ..functions import as_col
from ..functions.keys import NULL_MARK

_RANK = "__rank"
KEY = "__key"
NEAR = "__near"


def keep_one(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order.

    The order should be total within a key, or the survivor is arbitrary.
    """
    return last_n(df, keys, order_by, 1, _RANK).drop(_RANK)


def last_n(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str], n: int, rank: str = "rn"
) -> DataFrame:
    """The first ``n`` rows of each key in the given order, numbered from 1."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def near(c: Column | str, kind: DataType, *spread: str) -> Column:
    """A column without NULL to deal rows out by, beside the exact comparison of their keys.

    Rows that were shuffled by it once are reduced by keys that hold the column as well, with
    no further shuffle. Equal values stay together, and NULLs by the values of ``spread``.
    The value for NULL is unlike the usual defaults: Spark loses a partitioning whose literal
    is a column, too.
    """
    c = as_col(c)
    if spread:
        return F.coalesce(c.cast("string"), F.xxhash64(*spread).cast("string"))
    if isinstance(kind, NumericType):
        return F.coalesce(c, F.lit(-1).cast(kind))
    return F.coalesce(c.cast("string"), F.lit(NULL_MARK))


def argmax_rows(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """All rows that hold the largest ``by`` of their key, ties included."""
    window = Window.partitionBy(*keys).orderBy(F.col(by).desc())
    return df.withColumn(_RANK, F.rank().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def with_key(df: DataFrame, keys: Sequence[str], like: DataFrame | None = None) -> DataFrame:
    """Add the key columns as one struct, with the types they have in ``like``.

    Structs compare NULL fields as equal, so an equi-join on the struct is
    null-safe, and a window over it shares the shuffle and sort of the join.
    """
    types = (df if like is None else like).schema
    return df.withColumn(KEY, F.struct(*[F.col(k).cast(types[k].dataType).alias(k) for k in keys]))


def unique_or_fail(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Pass the rows through; fail the job on a second row of a key.

    The check rides on the partitioning and sort that a reduction before it or
    a join after it needs on the same columns, so it adds no shuffle there.
    """
    window = Window.partitionBy(*keys).orderBy(*keys)
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    failure = F.raise_error(F.concat(F.lit(f"duplicate key in {what}: "), shown))
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .where(F.when(F.col(_RANK) == 1, F.lit(True)).otherwise(failure.cast("boolean")))
        .drop(_RANK)
    )
