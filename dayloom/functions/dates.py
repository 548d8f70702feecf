"""Day arithmetic on DateType columns and ``yyyy-MM-dd`` labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The day label format and the size of the weekly grid.
DAY_FORMAT = "yyyy-MM-dd"
DAYS_PER_WEEK = 7
HOURS_PER_DAY = 24
SLOTS_PER_WEEK = DAYS_PER_WEEK * HOURS_PER_DAY


def day_label(day: Column | str) -> Column:
    return F.date_format(day, DAY_FORMAT)


def date_add_str(day: Column | str, n: Column | int) -> Column:
    """The label ``n`` days after (before, if negative) a day given as a label or a date."""
    return day_label(F.date_add(F.to_date(day), n))


def is_weekday(day: Column | str) -> Column:
    """True from Monday to Friday."""
    return F.weekday(F.to_date(day)) < 5


def iso_dow(ts: Column | str) -> Column:
    """ISO day of week: Monday is 1, Sunday 7."""
    return (F.weekday(ts) + 1).cast("bigint")


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(ts).cast("bigint")
