"""JSON documents parsed once on arrival and stored as VARIANT.

Text has to be parsed for every query, whole, whatever the query needs of it. A stored
VARIANT is binary and addressed by paths: a query takes the fields it names, and the
rest of a document is skipped over.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.tables import append

DOCUMENT = "document"


def field(path: str, kind: str, column: Column | str = DOCUMENT) -> Column:
    """One field of a document; NULL where it is missing or has no such value."""
    return F.try_variant_get(column, f"$.{path}", kind)


def fields(wanted: Mapping[str, tuple[str, str]], column: Column | str = DOCUMENT) -> list[Column]:
    """Fields by name: ``{name: (path, type)}``."""
    return [field(path, kind, column).alias(name) for name, (path, kind) in wanted.items()]


def parsed(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """The kept columns and the document; text that is no JSON gives a NULL document."""
    return df.select(*keep, F.try_parse_json(text).alias(DOCUMENT))


def items(df: DataFrame, path: str, keep: Sequence[Column | str], alias: str = "item") -> DataFrame:
    """One row for each element of a list, itself a VARIANT; empty lists give none."""
    return df.select(*keep, F.explode(field(path, "array<variant>")).alias(alias))


def store_documents(
    df: DataFrame, table: str, text: str, key: tuple[str, str, str], keep: Sequence[str] = ()
) -> None:
    """Parse arriving documents once and append them to a table.

    ``key`` is the name, path and type of the field that every document must have; it
    becomes a column of its own. Documents without it, or that are no JSON, are left out.
    The test on the key sits inside the generator: as a plain filter it would be pushed
    below the projection and parse every document a second time.
    """
    append(with_key_field(df, text, key, keep), table)


def with_key_field(
    df: DataFrame, text: str, key: tuple[str, str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """The kept columns, the key field and the document of texts that have the key."""
    name, path, kind = key
    document = F.array(F.try_parse_json(text))
    known = F.filter(document, lambda d: field(path, kind, d).isNotNull())
    found = df.select(*keep, F.explode(known).alias(DOCUMENT))
    return found.select(*keep, field(path, kind).alias(name), DOCUMENT)
