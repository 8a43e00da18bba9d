"""Bounded samples for fitting, chosen by a hash so that they don't change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(modulus))


def chosen(df: DataFrame, key: str, groups: Sequence[str], limit: int) -> DataFrame:
    """At most ``limit`` rows of each group.

    The rank filter cuts each group within every task before the shuffle, so a
    group with most of the rows sends few of them.
    """
    window = Window.partitionBy(*groups).orderBy(F.xxhash64(key), key)
    return df.withColumn("_rank", F.row_number().over(window)).where(
        F.col("_rank") <= limit
    ).drop("_rank")
