"""Column layouts: a data dictionary of output column, source column and rule."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from .clean import default, holds, text


class Field(NamedTuple):
    name: str
    source: str
    rule: str


# What each rule does with a source column.
RULES = {
    "keep": lambda c: c,
    "text": text,
    "trim": F.trim,
    "lower": lambda c: F.lower(c.cast("string")),
    "eur": lambda c: text(c, "EUR"),
    "zero": lambda c: default(c, 0),
    "one": lambda c: default(c, 1),
    "bool": lambda c: default(c, False),
    "is_zero": lambda c: holds(c == 0),
    "none_or_zero": lambda c: default(c, 0) == 0,
    "positive": lambda c: holds(c > 0),
    "is_one": lambda c: holds(c == 1),
    "is_true": lambda c: holds(c),
    "is_J": lambda c: holds(c == "J"),
    "is_O": lambda c: holds(c == "O"),
    "is_G": lambda c: holds(c == "G"),
    "not_blank": lambda c: holds(c != " "),
    "date": lambda c: c.cast("date"),
    "timestamp": lambda c: c.cast("timestamp"),
    "bigint": lambda c: c.cast("bigint"),
    "string": lambda c: c.cast("string"),
    "boolean": lambda c: c.cast("boolean"),
    "decimal": lambda c: c.cast("decimal(38,9)"),
    "decimal_one": lambda c: default(c.cast("decimal(38,9)"), 1),
    "string_text": lambda c: text(c.cast("string")),
}


def layout(rows: str) -> tuple[Field, ...]:
    """Read lines of ``output source rule``."""
    return tuple(Field(*line.split()) for line in rows.strip().splitlines())


def columns(fields: tuple[Field, ...]) -> list[Column]:
    """The projection of a layout."""
    return [RULES[f.rule](F.col(f.source)).alias(f.name) for f in fields]


def names(fields: tuple[Field, ...]) -> list[str]:
    return [f.name for f in fields]


def missing_columns(df: DataFrame, fields: tuple[Field, ...], prefix: str = "") -> list[str]:
    """Source columns of a layout that a source lacks."""
    present = {c.lower() for c in df.columns}
    wanted = [f.source.removeprefix(prefix) for f in fields if f.source.startswith(prefix)]
    return [s for s in dict.fromkeys(wanted) if s.lower() not in present]


def with_sources(df: DataFrame, fields: tuple[Field, ...], prefix: str = "") -> DataFrame:
    """The source, if it has all columns of a layout; an error names the others.

    A column renamed upstream would otherwise turn into NULL or 0 unnoticed. Give
    a source that really lacks some to :func:`with_absent` first.
    """
    missing = missing_columns(df, fields, prefix)
    if missing:
        raise ValueError(f"source columns missing: {', '.join(missing)}")
    return df


def with_absent(df: DataFrame, absent: Sequence[str]) -> DataFrame:
    """Add columns that a source is known to lack, as NULL text."""
    present = {c.lower() for c in df.columns}
    return df.withColumns(
        {c: F.lit(None).cast("string") for c in absent if c.lower() not in present}
    )
