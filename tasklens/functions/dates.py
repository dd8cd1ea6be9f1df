"""Calendar parts. Marts use weeks that start on Sunday, the lookahead uses weeks that start on Monday."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_TRUNCATIONS = {"MINUTE": "minute", "HOUR": "hour", "DAY": "day", "MONTH": "month", "QUARTER": "quarter", "YEAR": "year"}


def as_date(value: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def wall_time(value: dt.datetime | str) -> Column:
    """Literal of a wall-clock time. It goes by its text, so no zone can shift it."""
    return F.lit(str(value)).cast("timestamp_ntz")


def sunday_week(day: Column) -> Column:
    return F.date_sub(day, F.dayofweek(day) - 1)


def monday_week(day: Column) -> Column:
    return F.trunc(day, "week")


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def iso_weekday(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return (F.weekday(day) + 1).cast("bigint")


def due_day_parts(day: str = "due_date_day") -> list[Column]:
    """Week, weekday name, month number and day number derived from a day column."""
    d = F.col(day)
    return [
        sunday_week(d).alias("due_date_week"),
        weekday_name(d).alias("due_date_day_of_week_name"),
        F.month(d).cast("bigint").alias("due_date_month_num"),
        F.dayofmonth(d).cast("bigint").alias("due_date_day_of_month_num"),
    ]


def time_interval(c: Column | str, interval: str) -> Column:
    """A date column at one of the offered intervals: truncations, or numbers and names of parts."""
    col = F.col(c) if isinstance(c, str) else c
    if interval == "RAW":
        return col
    if interval in _TRUNCATIONS:
        return F.date_trunc(_TRUNCATIONS[interval], col).cast("timestamp_ntz")
    if interval == "WEEK":
        return sunday_week(col.cast("date")).cast("timestamp_ntz")
    if interval == "DAY_OF_WEEK_NAME":
        return weekday_name(col)
    numbers = {
        "DAY_OF_WEEK_INDEX": F.dayofweek(col),
        "DAY_OF_MONTH_NUM": F.dayofmonth(col),
        # Days before the first Sunday of the year are in week 0.
        "WEEK_NUM": F.floor((F.dayofyear(col) + 7 - F.dayofweek(col)) / 7),
        "MONTH_NUM": F.month(col),
        "QUARTER_NUM": F.quarter(col),
        "YEAR_NUM": F.year(col),
    }
    return numbers[interval].cast("bigint")


# The intervals every date column offers.
TIME_INTERVALS = [
    "RAW", "DAY", "HOUR", "MINUTE", "WEEK", "MONTH", "QUARTER", "YEAR", "DAY_OF_WEEK_INDEX", "DAY_OF_WEEK_NAME",
    "DAY_OF_MONTH_NUM", "WEEK_NUM", "MONTH_NUM", "QUARTER_NUM", "YEAR_NUM",
]
