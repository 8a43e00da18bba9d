"""Date expressions and the reporting periods around an observation date."""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from . import as_col


def date_key(c: Column | str) -> Column:
    """20240131-style integer key."""
    d = as_col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_weekday(c: Column | str) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(as_col(c)) + 1


def _month_end(year: int, month: int) -> dt.date:
    return dt.date(year, month, calendar.monthrange(year, month)[1])


@dataclass(frozen=True)
class Periods:
    """Reporting periods as of one day. ``same_span`` compares like with like.

    With ``same_span`` the comparison period of the previous year ends on the
    same day of the year; without it, at the end of the same month.
    """

    as_of: dt.date
    same_span: bool = True

    @property
    def year_start(self) -> dt.date:
        return dt.date(self.as_of.year, 1, 1)

    @property
    def last_year_start(self) -> dt.date:
        return dt.date(self.as_of.year - 1, 1, 1)

    @property
    def last_year_end(self) -> dt.date:
        return dt.date(self.as_of.year - 1, 12, 31)

    @property
    def last_year_cut(self) -> dt.date:
        end = _month_end(self.as_of.year - 1, self.as_of.month)
        if not self.same_span:
            return end
        return end.replace(day=min(self.as_of.day, end.day))

    @property
    def cutoff(self) -> dt.date:
        """First day of the feature history: 1 January three years back."""
        return dt.date(self.as_of.year - 3, 1, 1)

    def back(self, days: int) -> dt.date:
        return self.as_of - dt.timedelta(days=days)

    def conditions(self, date: Column | str) -> dict[str, Column]:
        """Membership of a date in each named period."""
        d = as_col(date)
        return {
            "last_3m": d >= F.lit(self.back(90)),
            "last_6m": d >= F.lit(self.back(180)),
            "this_year": d >= F.lit(self.year_start),
            "last_year": d.between(F.lit(self.last_year_start), F.lit(self.last_year_end)),
            "period_last_year": d.between(F.lit(self.last_year_start), F.lit(self.last_year_cut)),
        }
