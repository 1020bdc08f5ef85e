"""Read views: prices with states, stored averages, averages on the fly."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tidebars.operators.joins import nonempty_columns
from tidebars.operators.moving_averages import display_averages
from tidebars.schema import DEFAULT_DISPLAY_PERIODS, MA_COLS
from tidebars.sources.tables import TableStore


def day_bounds(first: dt.date, last: dt.date) -> tuple[dt.datetime, dt.datetime]:
    """First and last microsecond of a range of whole days."""
    return dt.datetime.combine(first, dt.time.min), dt.datetime.combine(last, dt.time.max)


def price_view(store: TableStore, symbol: str, first: dt.date, last: dt.date) -> DataFrame:
    """Bars of one symbol over whole days with their state, in time order."""
    start, end = day_bounds(first, last)
    return (
        store.read("bars", symbol, start, end)
        .select("timestamp", "open", "high", "low", "close", "volume", "market_state")
        .orderBy("timestamp")
    )


def stored_averages_view(store: TableStore, symbol: str) -> tuple[DataFrame, DataFrame]:
    """(wide bars of a symbol, names of its average columns that hold values)."""
    bars = store.wide(symbol)
    return bars.orderBy("timestamp"), nonempty_columns(bars, MA_COLS).select("column_name")


def live_averages_view(store: TableStore, symbol: str | None = None, periods=None) -> DataFrame:
    """Wide bars with averages of any periods computed on the fly."""
    return display_averages(store.wide(symbol), periods or DEFAULT_DISPLAY_PERIODS)


def ordered(df: DataFrame) -> DataFrame:
    """Total order by (symbol, timestamp), for output only."""
    return df.orderBy("symbol", F.col("timestamp"))
