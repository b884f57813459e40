"""Incremental lower bounds: newest value in the target, minus some days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = dt.datetime(1970, 1, 1)


def max_timestamp(target: DataFrame | None, column: str) -> dt.datetime:
    """Newest timestamp in the target; the epoch when there is none.

    One aggregate over one column.  The result becomes a literal, which then
    reaches the file scan of the source as a pushed filter.
    """
    if target is None:
        return EPOCH
    newest = target.agg(F.max(F.col(column).try_cast("timestamp_ntz"))).first()[0]
    return EPOCH if newest is None else newest


def lower_bound(newest: dt.datetime, days: int) -> dt.datetime:
    return newest if newest == EPOCH else newest - dt.timedelta(days=days)


def is_recent(column: str, newest: dt.datetime, days: int) -> Column:
    """At or after ``newest`` minus ``days``; NULL where text is no timestamp.

    Text is compared as what it parses to, so every spelling that staging
    accepts is found.
    """
    start = F.lit(lower_bound(newest, days)).cast("timestamp_ntz")
    return F.col(column).try_cast("timestamp_ntz") >= start


def lookback_filter(df: DataFrame, column: str, newest: dt.datetime, days: int) -> DataFrame:
    """Rows at or after ``newest`` minus ``days``; text timestamps are parsed."""
    return df.where(is_recent(column, newest, days))


def incremental_filter(
    df: DataFrame,
    target: DataFrame | None,
    column: str,
    lookback_days: int = 3,
    full_refresh: bool = False,
) -> DataFrame:
    """The part of ``df`` an incremental run has to process again.

    A first run, a full refresh and an existing but empty target take all rows.
    """
    if full_refresh or target is None:
        return df
    newest = max_timestamp(target, column)
    if newest == EPOCH:
        return df
    return lookback_filter(df, column, newest, lookback_days)
