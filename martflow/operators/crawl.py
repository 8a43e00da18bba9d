"""Typed reading of JSON text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def parse_json(df: DataFrame, column: str, schema: str, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """Parse a JSON column into a struct ``j``; rows without the key are dropped.

    Parsing is permissive: malformed text or a field of the wrong type gives
    NULL fields, so only a missing key removes a row. The test on the key sits
    inside the generator: as a plain filter it would be pushed below the
    projection and parse every document a second time.
    """
    parsed = F.array(F.from_json(F.col(column), schema))
    valid = F.filter(parsed, lambda j: j[key].isNotNull())
    return df.select(*keep, F.explode(valid).alias("j"))


def explode_items(df: DataFrame, items: str, keep: Sequence[Column | str], alias: str = "o") -> DataFrame:
    """One row per array element; rows with an empty array are dropped."""
    return df.select(*keep, F.explode(items).alias(alias))
