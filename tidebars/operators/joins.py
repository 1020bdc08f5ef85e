"""The joins behind the sinks: new rows, upserted averages, applied states, universe restriction.

No side is broadcast by hint. Spark picks the strategy from sizes, at run time under AQE, and splits
skewed partitions; all keys but the universe's are unique pairs, so they spread evenly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidebars.schema import BAR_COLS, KEY


def existing_keys(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Keys of ``stored`` that also come in. A small batch is the build side, so a large stored
    table is scanned (two columns) and not shuffled."""
    return stored.select(*KEY).join(incoming.select(*KEY), KEY, "left_semi")


def new_rows(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming rows whose (symbol, timestamp) is not stored: first write wins."""
    return incoming.join(existing_keys(incoming, stored), KEY, "left_anti")


def upsert_averages(bars: DataFrame, averages: DataFrame, columns: list[str]) -> DataFrame:
    """Full outer merge: stored bars keep their values and take every non-null average; averages of
    unknown bars are inserted with the bar they came from and no state."""
    old, new = bars.alias("old"), averages.alias("new")
    merged = old.join(new, KEY, "full_outer")
    picked = []
    for c in bars.columns:
        if c in KEY:
            picked.append(F.col(c))
        elif c in columns:
            picked.append(F.coalesce(F.nanvl(f"new.{c}", F.lit(None).cast("double")), f"old.{c}").alias(c))
        elif c in BAR_COLS:
            picked.append(F.coalesce(f"old.{c}", f"new.{c}").alias(c))
        else:
            picked.append(F.col(f"old.{c}"))
    return merged.select(*picked)


def apply_states(bars: DataFrame, states: DataFrame) -> DataFrame:
    """Set ``market_state`` where ``states`` has a non-null ``new_state``; all else is unchanged."""
    known = states.filter(F.col("new_state").isNotNull()).select(*KEY, "new_state")
    joined = bars.join(known, KEY, "left")
    return joined.withColumn("market_state", F.coalesce("new_state", "market_state")).select(*bars.columns)


def upsert_states(stored: DataFrame, states: DataFrame) -> DataFrame:
    """Stored states, those of bars with a non-null ``new_state`` set anew, and the states of bars that had none."""
    known = states.filter(F.col("new_state").isNotNull()).select(*KEY, "new_state")
    return stored.join(known, KEY, "full_outer").select(*KEY, F.coalesce("new_state", "market_state").alias("market_state"))


def restrict(df: DataFrame, universe: DataFrame | None) -> DataFrame:
    """Rows of the listed symbols."""
    return df if universe is None else matching(df, universe, "symbol")


def matching(df: DataFrame, listed: DataFrame, *columns: str) -> DataFrame:
    """Rows of ``df`` whose values in ``columns`` are listed."""
    return df.join(listed.select(*columns), list(columns), "left_semi").select(*df.columns)


def nonempty_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """(symbol, column) pairs with at least one value, from one aggregate."""
    counts = df.groupBy("symbol").agg(*[F.count(c).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in columns])
    return (
        counts.select("symbol", F.explode(pairs).alias("p"))
        .filter(F.col("p.n") > 0)
        .select("symbol", "p.column_name")
    )
