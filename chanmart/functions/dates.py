"""Date helpers for the date dimension and the daily reports.

All of them work on DATE / TIMESTAMP_NTZ values, so no result depends on the
session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date spine spans day 0 .. day 365*5 after the first message.
SPINE_DAYS = 365 * 5
# Fixed value: day and month names are blank-padded to this width.
NAME_WIDTH = 9


def day_of(ts: Column) -> Column:
    """timestamp -> date (``date(ts)``)."""
    return F.to_date(ts)


def as_of_date(as_of: str | _dt.date | None) -> Column:
    """The spine's upper bound: a literal date, or today when not given."""
    if as_of is None:
        return F.current_date()
    return F.lit(as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)))


def day_of_week(d: Column) -> Column:
    """Sunday = 0 .. Saturday = 6."""
    return (F.dayofweek(d) - 1).cast("int")


def padded_day_name(d: Column) -> Column:
    return F.rpad(F.date_format(d, "EEEE"), NAME_WIDTH, " ")


def padded_month_name(d: Column) -> Column:
    return F.rpad(F.date_format(d, "MMMM"), NAME_WIDTH, " ")


def date_attributes(d: Column) -> list[Column]:
    """The date dimension's attribute columns for a DATE column ``d``."""
    return [
        F.year(d).cast("int").alias("year"),
        F.month(d).cast("int").alias("month"),
        F.dayofmonth(d).cast("int").alias("day"),
        day_of_week(d).alias("day_of_week"),
        padded_day_name(d).alias("day_name"),
        padded_month_name(d).alias("month_name"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
        F.quarter(d).cast("int").alias("quarter_of_year"),
    ]
