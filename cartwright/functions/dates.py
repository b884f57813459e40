"""Date arithmetic that counts crossed boundaries, and the daily calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed: 00:00:59 to 00:01:01 counts as one.

    Computed from calendar fields, so it never depends on the session zone.
    """

    def minute_of_day(ts: Column) -> Column:
        return F.hour(ts) * 60 + F.minute(ts)

    days = F.datediff(end, start).cast("long")
    return days * 1440 + minute_of_day(end) - minute_of_day(start)


def years_between(start: Column, end: Column) -> Column:
    """New Year boundaries crossed: 2000-12-31 to 2024-01-01 counts as 24."""
    return (F.year(end) - F.year(start)).cast("long")


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("date_day"))
