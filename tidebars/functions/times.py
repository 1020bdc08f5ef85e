"""Zone-free times at the edge between Python values and columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def as_time(value) -> dt.datetime | None:
    """Naive datetime of an ISO text, date or datetime; zone-aware values are read as UTC."""
    if value is None:
        return None
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    elif not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time.min)
    return value.astimezone(dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value


def time_literal(value) -> Column:
    """Zone-free literal; goes by text, since a datetime literal would pass through the local zone."""
    return F.lit(as_time(value).isoformat(sep=" ")).cast("timestamp_ntz")
