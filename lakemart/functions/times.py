"""Time functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart.functions.keys import as_col

HELSINKI = "Europe/Helsinki"


def from_millis(value: Column | str) -> Column:
    """Epoch milliseconds to a timestamp of whole seconds (integer division)."""
    return F.timestamp_seconds(F.call_function("div", as_col(value).cast("bigint"), F.lit(1000)))


def helsinki_wall_clock(value: Column) -> Column:
    """Read the UTC wall clock of an instant as Helsinki local time."""
    return F.to_utc_timestamp(value, HELSINKI)


def helsinki_wall_text(value: Column) -> Column:
    """Wall clock that a Helsinki reader sees for an instant."""
    return F.from_utc_timestamp(value, HELSINKI)


def add_days(value: Column, days: Column | int) -> Column:
    return value + F.make_interval(days=F.lit(days) if isinstance(days, int) else days)


def seconds_of_day(value: Column) -> Column:
    return F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)


def at_time(day: Column, hour: int, minute: int = 0, second: int = 0) -> Column:
    """The given day at the given time of day."""
    return F.make_timestamp(
        F.year(day), F.month(day), F.dayofmonth(day), F.lit(hour), F.lit(minute), F.lit(second).cast("decimal(8,6)")
    )


def iso_text(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSS")


def season_of(day: Column, last_spring_month: int) -> Column:
    """'kevat' up to the given month of the year, 'syksy' after it."""
    return F.when(F.month(day) <= last_spring_month, F.lit("kevat")).when(day.isNotNull(), F.lit("syksy"))
