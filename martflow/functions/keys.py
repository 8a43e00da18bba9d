"""Surrogate keys and row-change hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from . import as_col

# Separators and the UUID shape of the key text.
KEY_SEPARATOR = "||"
HASH_SEPARATOR = "|"
UUID_GROUPS = r"(.{8})(.{4})(.{4})(.{4})(.{12})"
UUID_SHAPE = "$1-$2-$3-$4-$5"
NULL_MARK = "\\N"


def uuid_shaped(hex_text: Column) -> Column:
    return F.regexp_replace(hex_text, UUID_GROUPS, UUID_SHAPE)


def _marked(c: Column) -> Column:
    """Text in which neither NULL nor a separator can be confused.

    The separator cannot occur in the result, nor the NULL mark in a value.
    """
    value = F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\"))
    return F.coalesce(F.replace(value, F.lit("|"), F.lit("\\p")), F.lit(NULL_MARK))


def surrogate_key(cols: Sequence[Column | str], compat: bool = False) -> Column:
    """UUID-shaped md5 of several attributes.

    ``compat`` keeps the older recipe, which joins the bare values and skips
    NULLs; use it only to stay equal to keys that are already stored.
    """
    values = [as_col(c) for c in cols]
    parts = values if compat else [_marked(v) for v in values]
    return uuid_shaped(F.md5(F.concat_ws(KEY_SEPARATOR, *parts)))


def row_hash(cols: Sequence[Column | str], compat: bool = False) -> Column:
    """md5 over the compared attributes of a row.

    Pass no audit columns: a load timestamp would make every row look changed.
    ``compat`` keeps the older recipe, where NULL and empty text are the same.
    """
    values = [as_col(c) for c in cols]
    if compat:
        parts = [F.coalesce(v.cast("string"), F.lit("")) for v in values]
    else:
        # A mark for the whole list: one for each of many columns is more code than a JVM compiles.
        parts = [F.transform(F.array(*[v.cast("string") for v in values]), _marked)]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *parts))
