"""Relative-time helpers: the ``NOW() - INTERVAL`` filters of the query catalogue.

``as_of`` is bound as a literal before planning, so the bound is a constant
that Catalyst pushes into the Parquet scan (row-group skipping) and, with
``prune_recent``, into partition pruning.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Query windows of the catalogue.
WINDOWS = {
    "1h": dt.timedelta(hours=1),
    "24h": dt.timedelta(hours=24),
    "7d": dt.timedelta(days=7),
    "14d": dt.timedelta(days=14),
    "30d": dt.timedelta(days=30),
    "8w": dt.timedelta(weeks=8),
}


def ntz_literal(value: dt.datetime) -> Column:
    """A zone-less timestamp literal (matches ``timestamp_ntz`` columns without a cast)."""
    return F.lit(value).cast("timestamp_ntz")


def resolve_as_of(df: DataFrame, ts: str = "event_timestamp") -> dt.datetime:
    """Latest event time of ``df``: a one-column global max (partial + final aggregate)."""
    row = df.agg(F.max(ts).alias("as_of")).first()
    value = row["as_of"] if row else None
    if value is None:
        return dt.datetime(1970, 1, 1)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def resolve_as_of_stored(stored: DataFrame, ts: str = "event_timestamp") -> dt.datetime:
    """Latest event time of the day-partitioned table, read from its newest day only.

    The first aggregate touches partition columns alone; the second scans one
    day's folders.
    """
    day = F.max(F.struct("year", "month", "day")).alias("d")
    newest = stored.select("year", "month", "day").distinct().agg(day).first()["d"]
    if newest is None:
        return dt.datetime(1970, 1, 1)
    return resolve_as_of(stored.filter(
        (F.col("year") == newest["year"]) & (F.col("month") == newest["month"]) & (F.col("day") == newest["day"])), ts)


def now_utc() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def lower_bound(as_of: dt.datetime, window: str | dt.timedelta) -> dt.datetime:
    width = WINDOWS[window] if isinstance(window, str) else window
    return as_of - width


def recent(df: DataFrame, as_of: dt.datetime, window: str | dt.timedelta,
           ts: str = "event_timestamp") -> DataFrame:
    """``WHERE ts >= as_of - window`` with a literal bound."""
    return df.filter(F.col(ts) >= ntz_literal(lower_bound(as_of, window)))


def prune_recent(df: DataFrame, as_of: dt.datetime, window: str | dt.timedelta,
                 ts: str = "event_timestamp") -> DataFrame:
    """``recent`` plus the implied predicate on the year/month/day partition columns.

    Catalyst cannot derive a partition predicate from a timestamp filter; the
    extra, logically redundant day predicate lets the scan skip whole
    partitions of the processed table.
    """
    bound = lower_bound(as_of, window)
    day_floor = dt.date(bound.year, bound.month, bound.day)
    day_col = F.make_date(F.col("year"), F.col("month"), F.col("day"))
    return recent(df, as_of, window, ts).filter(day_col >= F.lit(day_floor))
