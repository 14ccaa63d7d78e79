"""Date series and the calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.functions.columns import date_key

# Date ranges of the two calendar editions.
WIDE_RANGE = (dt.date(2000, 1, 1), dt.date(2030, 12, 31))
COURSE_RANGE = (dt.date(2000, 1, 1), dt.date(2030, 1, 1))
# Fixed value: days from a date to the same day of its fiscal year.
FISCAL_SHIFT_DAYS = 89


def explode_days(bounds: DataFrame, start: str, end: str, name: str = "day") -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    step = F.expr("interval 1 day")
    return bounds.select(F.explode(F.sequence(F.col(start), F.col(end), step)).alias(name))


def date_range(spark: SparkSession, first: dt.date, last: dt.date, name: str = "day") -> DataFrame:
    bounds = spark.range(1).select(F.lit(first).alias("start"), F.lit(last).alias("end"))
    return explode_days(bounds, "start", "end", name)


def calendar_attributes(days: DataFrame, day: str = "day", edition: str = "wide") -> DataFrame:
    """Calendar columns for a table of dates.

    The ``course`` edition names the key and the day of month differently and has no quarter and
    no flags. Fiscal quarter equals calendar quarter while the fiscal year is shifted; both are
    kept as they are defined.
    """
    d = F.col(day)
    week_start = F.date_sub(d, F.weekday(d))
    wide = edition == "wide"
    columns: dict[str, Column] = {
        "_tf_dim_calendar_sk" if wide else "_tf_dim_calendar_id": date_key(d),
        "cal_date": d,
        "cal_year": F.year(d),
        "cal_month": F.month(d),
        "cal_day_of_month" if wide else "calendar_day_of_month": F.dayofmonth(d),
        "cal_date_full": F.date_format(d, "EEEE MMMM dd yyyy"),
        "cal_day_name": F.date_format(d, "EEEE"),
        "cal_week_start": week_start,
        "cal_week_end": F.date_add(week_start, 6),
        "cal_week_day": F.weekday(d) + 1,
        "cal_week_of_year": F.weekofyear(d),
        "cal_month_year": F.date_format(d, "MMMM yyyy"),
        "cal_month_name": F.date_format(d, "MMMM"),
        "cal_first_day_of_month": F.date_add(F.last_day(F.add_months(d, -1)), 1),
        "cal_last_day_of_month": F.last_day(d),
    }
    if wide:
        columns["cal_quarter"] = F.quarter(d)
    columns["cal_fiscal_quarter"] = F.quarter(d)
    columns["cal_fiscal_year"] = F.year(F.date_add(d, FISCAL_SHIFT_DAYS))
    if wide:
        columns["cal_is_weekend"] = F.weekday(d) >= 5
        columns["cal_is_month_start"] = F.dayofmonth(d) == 1
        columns["cal_is_month_end"] = d == F.last_day(d)
    return days.select(*[value.alias(name) for name, value in columns.items()])


def calendar_dimension(spark: SparkSession, load_date: dt.datetime | str, edition: str = "wide",
                       first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The calendar table of an edition with its load time columns; ``first`` and ``last`` widen its range."""
    least, greatest = WIDE_RANGE if edition == "wide" else COURSE_RANGE
    first, last = min(first or least, least), max(last or greatest, greatest)
    now = F.lit(str(load_date)).cast("timestamp")
    days = date_range(spark, first, last)
    return calendar_attributes(days, edition=edition).withColumns({"_tf_create_date": now, "_tf_update_date": now})
