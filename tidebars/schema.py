"""Column lists, Spark schemas and fixed parameters shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Required bar columns, in order.
BAR_COLS = ["symbol", "timestamp", "open", "high", "low", "close", "volume"]
PRICE_COLS = ["open", "high", "low", "close"]
NUMERIC_COLS = PRICE_COLS + ["volume"]
KEY = ["symbol", "timestamp"]

# Periods with stored columns, and the usual periods of the on-the-fly view.
STANDARD_PERIODS = [5, 10, 20, 50, 100, 200]
DEFAULT_DISPLAY_PERIODS = [7, 21, 60]

# Return lags used as model features.
LAGS = [0, 1, 2, 5, 10, 20]
FEATURE_COLS = [f"ret_lag_{k}" for k in LAGS]

MAX_SYMBOL_LENGTH = 10
DEFAULT_START = "1980-01-01"
STATE_WINDOW_DAYS = 365
CHUNK_DAYS = 365 * 5


def ma_columns(periods=None, kinds=("sma", "ema", "wma")) -> list[str]:
    """Column names ``sma_5 ... wma_200``: all periods of one kind, then the next kind."""
    return [f"{kind}_{p}" for kind in kinds for p in (periods or STANDARD_PERIODS)]


MA_COLS = ma_columns()

RAW_BARS_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        *[T.StructField(c, T.DoubleType()) for c in PRICE_COLS],
        T.StructField("volume", T.LongType()),
    ]
)

#: States lie in a table of their own, so that a state run rewrites no average; ``TableStore.read`` puts them beside the bars.
BARS_SCHEMA = T.StructType([*RAW_BARS_SCHEMA.fields, *[T.StructField(c, T.DoubleType()) for c in MA_COLS]])

STATES_SCHEMA = T.StructType([*RAW_BARS_SCHEMA.fields[:2], T.StructField("market_state", T.StringType())])

TRANSITIONS_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("from_state", T.StringType()),
        T.StructField("to_state", T.StringType()),
        T.StructField("prob", T.DoubleType()),
    ]
)

# A row for each symbol, kept up to date by every commit of raw bars: its latest bar, its number of bars, and the first bar
# since averages were last brought up to date (null: there is none).
MARKS_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("latest", T.TimestampNTZType()),
        T.StructField("n", T.LongType()),
        T.StructField("since", T.TimestampNTZType()),
    ]
)

# What the averages of a symbol go on from: its last averaged bar, the closes up to it that a frame may reach, the
# exponential averages at it.
TAILS_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("until", T.TimestampNTZType()),
        T.StructField("closes", T.ArrayType(T.DoubleType())),
        *[T.StructField(f"ema_{p}", T.DoubleType()) for p in STANDARD_PERIODS],
    ]
)

# A row for each folder of bars: how many it holds, and their first and last time.
SPANS_SCHEMA = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("first", T.TimestampNTZType()),
        T.StructField("last", T.TimestampNTZType()),
    ]
)

TABLE_SCHEMAS = {
    "raw_bars": RAW_BARS_SCHEMA,
    "bars": BARS_SCHEMA,
    "bar_states": STATES_SCHEMA,
    "transition_probs": TRANSITIONS_SCHEMA,
    "symbol_marks": MARKS_SCHEMA,
    "average_tails": TAILS_SCHEMA,
    "part_spans": SPANS_SCHEMA,
}
