"""Attribute cleaning: defaults, flags, labels, names and money."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, functions as F

from . import as_col


def text(c: Column | str, default: str = "") -> Column:
    """Trimmed text with a default in place of NULL."""
    return F.trim(F.coalesce(as_col(c), F.lit(default)))


def default(c: Column | str, value) -> Column:
    """``c``, or ``value`` where it is NULL."""
    return F.coalesce(as_col(c), F.lit(value))


def first_text(*cs: Column | str, fallback: str = "") -> Column:
    """First non-NULL of several texts, trimmed."""
    return F.trim(F.coalesce(*[as_col(c) for c in cs], F.lit(fallback)))


def holds(condition: Column) -> Column:
    """A condition as a two-valued flag: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def full_name(*parts: Column | str) -> Column:
    """Name parts joined by one blank, outer blanks removed."""
    return F.trim(F.concat_ws(" ", *[default(p, "") for p in parts]))


def code_label(c: Column | str, labels: Mapping[str, Sequence[str]], otherwise: str | None) -> Column:
    """Map codes to labels; ``labels`` lists the codes of each label."""
    code = as_col(c)
    branches = [(code.isin(*codes), F.lit(label)) for label, codes in labels.items()]
    chain = F.when(*branches[0])
    for condition, label in branches[1:]:
        chain = chain.when(condition, label)
    return chain.otherwise(F.lit(otherwise))


def trade_region(
    country: Column | str,
    in_union: Column | str,
    home: Sequence[str],
    labels: tuple[str, str, str],
) -> Column:
    """Home, union or third country. NULL if the country or its flag is unknown."""
    code, union = F.rtrim(as_col(country)), as_col(in_union)
    home_label, union_label, third_label = labels
    abroad = F.when(union == 1, union_label).when(union == 0, third_label)
    return F.when(code.isin(*home), F.lit(home_label)).when(code.isNotNull(), abroad)


def per_rate(amount: Column | str, rate: Column | str) -> Column:
    """Amount divided by an exchange rate; a zero or missing rate counts as 1."""
    r = as_col(rate)
    return as_col(amount) / F.when(r != 0, r).otherwise(F.lit(1))


def home_amount(
    quantity: Column | str, price: Column | str, rate: Column | str, unit: Column | str
) -> Column:
    """Quantity times price in home currency. Unconverted if the rate is zero."""
    net = as_col(quantity) * as_col(price)
    known = default(rate, 1)
    converted = net / F.when(known != 0, known) * default(unit, 1)
    return F.when(known == 0, net).otherwise(converted)


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from ``start`` to ``end``; NULL if either is missing."""
    return F.datediff(as_col(end).cast("date"), as_col(start).cast("date"))


def change_pct(current: Column | str, previous: Column | str) -> Column:
    """Percentage change to one decimal; NULL without a previous value."""
    now, before = as_col(current), as_col(previous)
    ratio = (now - before) / (F.abs(before) + F.lit(EPSILON)) * 100
    return F.when(before != 0, F.round(ratio, 1))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient that stays finite for a zero denominator."""
    return as_col(numerator) / (as_col(denominator) + F.lit(EPSILON))


def any_of(conditions: Sequence[Column]) -> Column:
    return _paired(conditions, lambda a, b: a | b, False)


def all_of(conditions: Sequence[Column]) -> Column:
    return _paired(conditions, lambda a, b: a & b, True)


def _paired(
    conditions: Sequence[Column], join: Callable[[Column, Column], Column], empty: bool
) -> Column:
    """Join conditions in pairs, so that the nesting grows with their logarithm."""
    level = list(conditions) or [F.lit(empty)]
    while len(level) > 1:
        rest = level[len(level) & ~1 :]
        level = [join(a, b) for a, b in zip(level[::2], level[1::2])] + rest
    return level[0]


# Fixed value: keeps ratios finite.
EPSILON = 1e-6
