"""Generated calendar dimension."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.dates import date_key, iso_weekday

# The default range and the default holidays.
FIRST_DAY = dt.date(2020, 1, 1)
LAST_DAY = dt.date(2030, 12, 31)
HOLIDAYS = (dt.date(2020, 1, 1), dt.date(2020, 12, 25), dt.date(2020, 12, 26))

# The member that stands for an unknown date.
UNKNOWN = {
    "date_key": -1,
    "full_date": None,
    "day_of_week": 0,
    "day_name": "Unknown",
    "day_of_month": 0,
    "day_of_year": 0,
    "week_of_year": 0,
    "week_iso": 0,
    "month_number": 0,
    "month_name": "Unknown",
    "quarter": 0,
    "year": 0,
    "year_month": "0000-00",
    "year_quarter": "0000-Q0",
    "is_weekend": False,
    "is_holiday_de": False,
    "fiscal_year": 0,
    "fiscal_quarter": 0,
    "fiscal_month": 0,
}


def date_dim(
    spark: SparkSession,
    first: dt.date = FIRST_DAY,
    last: dt.date = LAST_DAY,
    holidays: Sequence[dt.date] = HOLIDAYS,
    unknown: bool = True,
) -> DataFrame:
    """One row per day, plus the unknown member. The fiscal year is the year."""
    spine = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))).alias("full_date")
    )
    d = F.col("full_date")
    facts = {
        "date_key": date_key(d),
        "full_date": d,
        "day_of_week": iso_weekday(d),
        "day_name": F.date_format(d, "EEEE"),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "month_number": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "year_month": F.date_format(d, "yyyy-MM"),
        "is_weekend": iso_weekday(d) > 5,
        "is_holiday_de": d.isin(*holidays) if holidays else F.lit(False),
    }
    facts["week_iso"] = facts["week_of_year"]
    facts["year_quarter"] = F.date_format(d, "yyyy-'Q'Q")
    for part, source in (("year", "year"), ("quarter", "quarter"), ("month", "month_number")):
        facts[f"fiscal_{part}"] = facts[source]
    days = spine.select(*[facts[name].alias(name) for name in UNKNOWN])
    if not unknown:
        return days
    nullable = StructType([StructField(f.name, f.dataType) for f in days.schema])
    return days.unionByName(spark.createDataFrame([UNKNOWN], nullable))
