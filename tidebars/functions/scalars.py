"""Column expressions: parsing, coercion, classification."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Accepted number and ISO timestamp texts.
NUMBER_PATTERN = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"
ISO_PATTERN = r"^\s*\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?\s*$"

# Symbol suffixes that already name an exchange.
EXCHANGE_SUFFIX_PATTERN = r"\.(us|de|pl|jp)$"

# Return thresholds of the market states.
STRONG_MOVE = 0.005
SLIGHT_MOVE = 0.001


def strip(c: Column) -> Column:
    """Remove all leading and trailing white space (``trim`` would keep tabs)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def to_number(c: Column, dtype: T.DataType) -> Column:
    """Double value of a column; unparsable text and NaN become null, infinities stay for the gate to report."""
    if isinstance(dtype, T.StringType):
        # The pattern admits no text for NaN; the cast ignores surrounding white space.
        return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        c = F.when(~F.isnan(c), c)
    return c.cast("double")


def to_bar_time(c: Column, dtype: T.DataType) -> Column:
    """Zone-free timestamp; text other than an ISO date or date-time becomes null."""
    if isinstance(dtype, T.StringType):
        return F.when(c.rlike(ISO_PATTERN), c.try_cast("timestamp_ntz"))
    return c.cast("timestamp_ntz")


def round_half_even(c: Column) -> Column:
    """Whole number, halves to even; infinite values are left to the quality gate as null."""
    return F.rint(c).try_cast("bigint")


def epoch_micros(c: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, whatever the session zone."""
    day = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = F.hour(c) * 3600 + F.minute(c) * 60
    sub_minute = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    return day * 86_400_000_000 + seconds.cast("bigint") * 1_000_000 + sub_minute


def period_return(close: Column, previous: Column) -> Column:
    """Return against the previous close, 0.0 when that close is zero, null without one."""
    return F.when(previous == 0, F.lit(0.0)).otherwise((close - previous) / F.nullif(previous, F.lit(0.0)))


def pct_change(close: Column, previous: Column) -> Column:
    """Feature return ``close / previous - 1``; null when the previous close is zero."""
    return close / F.nullif(previous, F.lit(0.0)) - 1


def classify_return(r: Column) -> Column:
    """Market state of a return; all bounds strict, NaN is Stable, null stays null."""
    number = F.when(~F.isnan(r), r)
    return F.when(r.isNotNull(), F.when(number > STRONG_MOVE, "Strong Up")
                  .when(number > SLIGHT_MOVE, "Slight Up")
                  .when(number < -STRONG_MOVE, "Strong Down")
                  .when(number < -SLIGHT_MOVE, "Slight Down")
                  .otherwise("Stable"))


def candidate_stems(symbol: Column) -> Column:
    """File stems to try for a symbol, in order: ``sym.us`` first unless a suffix is given."""
    low = F.lower(symbol)
    return F.when(low.rlike(EXCHANGE_SUFFIX_PATTERN), F.array(low)).otherwise(
        F.array(F.concat(low, F.lit(".us")), low)
    )
