"""Day strings (yyyyMMdd), epoch milliseconds and holidays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = "yyyyMMdd"


def _millis(text: Column) -> Column:
    return F.timestamp_millis(text.try_cast("double").cast("bigint"))


def day_of_week(millis: Column) -> Column:
    """Short weekday of an epoch-millisecond text; null when it is not a number."""
    return F.date_format(_millis(millis), "E")


def shift_day(day: Column, days: int | Column) -> Column:
    return F.date_format(F.date_add(F.to_date(day, DAY), days), DAY)


def next_days(day: Column, count: int) -> Column:
    """The day and the days after it, ``count`` in all."""
    first = F.to_date(day, DAY)
    return F.transform(F.sequence(first, F.date_add(first, count - 1)), lambda d: F.date_format(d, DAY))


def day_gap(start: Column, end: Column) -> Column:
    return F.date_diff(F.to_date(end, DAY), F.to_date(start, DAY))


def format_day(millis: Column) -> Column:
    return F.date_format(_millis(millis), DAY)


def format_time(millis: Column) -> Column:
    return F.date_format(_millis(millis), "MM/dd HH:mm:ss")


def calendar_days(calendar: DataFrame) -> DataFrame:
    """One row per day and whether it is a holiday, from (type, start, last).

    ``last`` is the number of days. A day listed as both is a holiday.
    """
    first = F.to_date("start", DAY)
    days = calendar.filter(F.col("last").cast("int") > 0).select(
        F.explode(F.sequence(first, F.date_add(first, F.col("last").cast("int") - 1))).alias("_d"),
        (F.col("type") == "holiday").alias("_h"))
    return days.groupBy(F.date_format("_d", DAY).alias("_day")).agg(F.max("_h").alias("_listed"))


def holiday_flag(df: DataFrame, day: str, calendar: DataFrame, name: str = "holiday") -> DataFrame:
    """Whether a day is free: listed holiday, then listed workday, then weekend."""
    joined = df.join(calendar_days(calendar), F.col(day) == F.col("_day"), "left")
    weekend = F.weekday(F.to_date(F.col(day), DAY)) >= 5
    return joined.withColumn(name, F.coalesce(F.col("_listed"), weekend)).drop("_day", "_listed")
