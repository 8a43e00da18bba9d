"""Point-in-time lookup of dimension versions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import as_col
from ..functions.clean import all_of
from .scd import END, START


def asof_lookup(
    left: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[Column | str, Column | str]],
    event: Column | str,
    take: Mapping[str, str] | Sequence[str],
    precision: str = "date",
    only: Column | None = None,
    open_until: str | None = None,
) -> DataFrame:
    """Left join to the dimension version valid at the event.

    ``on`` pairs an expression over ``left`` with one over ``dim``. ``take``
    names the dimension columns to add, optionally renamed. ``only`` limits the
    rows of ``left`` that look anything up; the others are kept without a match.

    ``precision="date"`` compares whole days, so a day belongs to the version
    that is valid at its end. ``"timestamp"`` compares exact times. Open versions
    are valid for ever, or until ``open_until``, exclusive, for loads that end
    them on a fixed day.

    The plan is an equi-join with the interval as a residual, with no forced
    broadcast: histories grow, so Spark decides from the actual size, and splits
    a skewed key on the left side. Each event meets all versions of its key; where
    a key has very many, use :func:`~.asof.asof_merge`.
    """
    kinds = {"date": "date", "timestamp": "timestamp_ntz"}
    kind = kinds[precision]
    renamed = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
    pairs = [(l if isinstance(l, str) else f"__l{i}", f"__d{i}", l, d) for i, (l, d) in enumerate(on)]

    versions = dim.select(
        *[as_col(d).alias(dn) for _, dn, _, d in pairs],
        F.col(START).cast(kind).alias("__start"),
        F.coalesce(F.col(END).cast(kind), F.lit(open_until).cast(kind)).alias("__end"),
        *[F.col(c).alias(new) for c, new in renamed.items()],
    ).where(all_of([F.col(dn).isNotNull() for _, dn, _, _ in pairs]))
    # Only key expressions become columns, which every event would carry to the join.
    made = {ln: l for ln, _, l, _ in pairs if not isinstance(l, str)}
    events = left.withColumns(made) if made else left
    moment = as_col(event).cast(kind)
    match = [F.col(ln) == F.col(dn) for ln, dn, _, _ in pairs]
    still_open = F.col("__end").isNull() | (moment < F.col("__end"))
    match += [moment >= F.col("__start"), still_open]
    if only is not None:
        match.append(only)
    return events.join(versions, all_of(match), "left").select(*left.columns, *renamed.values())


def all_versions(left: DataFrame, history: DataFrame, keys: Sequence[str], current_only: bool = False):
    """Left join to every version of a key, or only to the open one."""
    versions = history.where(F.col(END).isNull()) if current_only else history
    return left.join(versions, list(keys), "left")
