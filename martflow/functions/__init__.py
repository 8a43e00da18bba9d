"""Column expressions. Everything here stays inside Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
