"""Documents with a header and lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions.clean import all_of, holds
from .reduce import NEAR, near


def header_lines(
    headers: DataFrame,
    lines: DataFrame,
    on: Sequence[tuple[str, str]],
    columns: Sequence[Column | str],
    how: str = "left",
) -> tuple[DataFrame, DataFrame]:
    """Split a document source into header grain and line grain.

    The header grain comes straight from the headers. It needs no join for a
    left join, and only a semi join on the distinct document ids for an inner
    join, so headers are never fanned out over their lines and reduced again.

    The line grain is the projection ``columns`` of the join. A document may
    hold a large share of all lines, and Spark can split such a partition of
    lines in an inner join but not in a left join. So headers without lines are
    added by an anti join on the distinct ids.

    Lines are many and wide, so they are matched by a hash table of each partition's
    headers; a merge join would sort them, and spill them to disk. Documents known by one
    number or text are dealt out by :func:`~.reduce.near` of it in both grains, so that
    steps after this one that keep a document together need no shuffle.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"documents join with 'left' or 'inner', not {how!r}")
    match = all_of([F.col(h) == F.col(l) for h, l in on])
    known = lines.where(all_of([F.col(l).isNotNull() for _, l in on]))
    kinds = {f.select(c).schema[0].dataType for pair in on for f, c in zip((headers, lines), pair)}
    kind = kinds.pop()
    if len(on) == 1 and not kinds and isinstance(kind, (NumericType, StringType)):
        (h, l), = on
        ids = known.select(near(l, kind).alias(NEAR)).distinct()
        has_lines = (near(h, kind) == F.col(NEAR)) & F.col(h).isNotNull()
        same = (near(h, kind) == near(l, kind)) & holds(match)
    else:
        ids = known.select(*[l for _, l in on]).distinct()
        has_lines = same = match
    detail = headers.hint("shuffle_hash").join(known, same).select(*columns)
    if how == "inner":
        return headers.join(ids, has_lines, "left_semi"), detail
    bare = headers.join(ids, has_lines, "left_anti")
    no_lines = bare.join(lines.where(F.lit(False)), match, "left").select(*columns)
    return headers, detail.unionByName(no_lines)
