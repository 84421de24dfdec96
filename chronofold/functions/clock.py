"""Time expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(time: Column) -> Column:
    return time.cast("date")


def second_of_day(time: Column) -> Column:
    return F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, both first cut to the second."""
    days = F.datediff(day_of(end), day_of(start)).cast("bigint")
    return days * 86400 + second_of_day(end) - second_of_day(start)


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes from start to end; halves go to the even minute."""
    return F.bround(seconds_between(start, end) / F.lit(60.0)).cast("int")


def second_text(time: Column) -> Column:
    """``2024-01-31 08:15:07``, the fraction cut off."""
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def hour_number(time: Column) -> Column:
    """Hours since 1970."""
    return F.datediff(day_of(time), F.lit("1970-01-01").cast("date")) * 24 + F.hour(time)


def micros_of_hour(time: Column) -> Column:
    """Microseconds since the full hour."""
    return F.minute(time).cast("bigint") * 60_000_000 + (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("bigint")
