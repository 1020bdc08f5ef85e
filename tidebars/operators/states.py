"""Period returns, market states and the feature table of the next-state model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from tidebars.functions.scalars import classify_return, pct_change, period_return
from tidebars.operators.runs import SymbolSizes, ordered_runs
from tidebars.schema import FEATURE_COLS, LAGS

FEATURE_TABLE = ["symbol", "timestamp", "market_state", *FEATURE_COLS, "target_state", "history"]


def period_returns(df: DataFrame, sizes: SymbolSizes | None = None) -> DataFrame:
    """Add ``ret``: change against the previous close; null on the first row of a symbol."""
    runs = ordered_runs(df, back=1, sizes=sizes)
    out = runs.df.withColumn("ret", period_return(F.col("close"), F.lag("close").over(runs.window)))
    return runs.finish(out)


def with_states(df: DataFrame, sizes: SymbolSizes | None = None) -> DataFrame:
    """Add ``ret`` and ``new_state``; both null on the first row, which never gets a state."""
    return period_returns(df, sizes).withColumn("new_state", classify_return(F.col("ret")))


def last_states(df: DataFrame, n: int = 5, state: str = "new_state") -> DataFrame:
    """The last ``n`` states of every symbol, numbered 1 for the newest."""
    candidates = df.filter(F.col(state).isNotNull()).select("symbol", "timestamp", F.col(state).alias("state"))
    newest = Window.partitionBy("symbol").orderBy(F.desc("timestamp"))
    # Catalyst applies the limit on each input partition first (window group limit), so at most n rows
    # per symbol and task are shuffled.
    return (
        candidates.withColumn("recency", F.row_number().over(newest))
        .filter(F.col("recency") <= n)
        .select("symbol", "recency", "timestamp", "state")
    )


def _add_features(df: DataFrame, w: WindowSpec, state: str) -> DataFrame:
    """Lagged returns, next state and ``history`` over one window order, so over one sort."""
    returns = df.select(
        "*",
        pct_change(F.col("close"), F.lag("close").over(w)).alias("_ret"),
        F.lag("close", max(LAGS) + 1).over(w).isNotNull().alias("history"),
        F.lead(state).over(w).alias("target_state"),
    )
    return returns.select(
        "*",
        *[(F.col("_ret") if k == 0 else F.lag("_ret", k).over(w)).alias(c) for k, c in zip(LAGS, FEATURE_COLS)],
    )


def lag_features(df: DataFrame, state: str = "market_state", sizes: SymbolSizes | None = None) -> DataFrame:
    """(symbol, timestamp, market_state, ret_lag_0.. ret_lag_20, target_state, history) for every bar.

    ``history`` says that enough earlier bars exist; a feature that is null in spite of it comes from
    a zero close. ``target_state`` is the state of the next bar.
    """
    slim = df.select("symbol", "timestamp", "close", F.col(state).alias("market_state"))
    runs = ordered_runs(slim, back=max(LAGS) + 1, ahead=1, sizes=sizes)
    return runs.finish(_add_features(runs.df, runs.window, "market_state")).select(*FEATURE_TABLE)


def classified_features(df: DataFrame, labels: str = "fresh", sizes: SymbolSizes | None = None) -> DataFrame:
    """States and features of bars in one pass: the feature table with ``ret`` and ``new_state``.

    The model's labels are the ``fresh`` states, or the ``stored`` ones the bars came with.
    """
    slim = df.select("symbol", "timestamp", "close", "market_state")
    runs = ordered_runs(slim, back=max(LAGS) + 1, ahead=1, sizes=sizes)
    w = runs.window
    classified = runs.df.withColumn("ret", period_return(F.col("close"), F.lag("close").over(w))).withColumn(
        "new_state", classify_return(F.col("ret"))
    )
    if labels == "fresh":
        classified = classified.withColumn("market_state", F.coalesce("new_state", "market_state"))
    out = runs.finish(_add_features(classified, w, "market_state"))
    return out.select(*FEATURE_TABLE, "ret", "new_state")


def training_rows(features: DataFrame) -> DataFrame:
    """Rows with every feature and a next state."""
    return features.dropna(subset=[*FEATURE_COLS, "target_state"])


def scoring_rows(features: DataFrame) -> DataFrame:
    """Rows with every feature and a current state; unlike training this keeps the last bar."""
    return features.dropna(subset=[*FEATURE_COLS, "market_state"])
