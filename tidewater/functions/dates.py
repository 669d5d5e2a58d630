"""Calendar helpers with the source database's conventions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour days in ``later - earlier``, truncated toward zero.

    This is ``extract(day from ts - ts)`` of the source, which is not a
    calendar-day difference: two hours across midnight give 0.
    """
    return F.extract(F.lit("DAY"), later - earlier).cast("int")


def month_start(ts: Column) -> Column:
    """date_trunc('month', ts)::date"""
    return F.trunc(ts, "month")


def dow_sunday0(d: Column) -> Column:
    """extract(dow): 0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(d) - 1


def padded_day_name(d: Column) -> Column:
    """to_char(d, 'Day'): English day name blank-padded to 9 characters."""
    return F.rpad(F.date_format(d, "EEEE"), 9, " ")


def padded_month_name(d: Column) -> Column:
    """to_char(d, 'Month'): English month name blank-padded to 9 characters."""
    return F.rpad(F.date_format(d, "MMMM"), 9, " ")


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day in [start, end) (end exclusive), column ``date_day``."""
    bounds = spark.range(1).select(F.lit(start).alias("s"), F.lit(end).alias("e"))
    return spine_from_bounds(bounds)


def spine_from_bounds(bounds: DataFrame, start: str = "s", end: str = "e") -> DataFrame:
    """Explode a one-row frame of [start, end) bounds into daily rows.

    The output size is the number of calendar days between the bounds, so it
    is bounded by the calendar, not by the data volume.
    """
    return bounds.where(F.col(start) < F.col(end)).select(
        F.explode(F.sequence(F.col(start), F.date_sub(F.col(end), 1), F.expr("interval 1 day"))).alias("date_day")
    )


def ntz(value: dt.datetime | dt.date) -> Column:
    """A zone-less timestamp literal."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return F.expr(f"timestamp_ntz'{value.isoformat(sep=' ')}'")
