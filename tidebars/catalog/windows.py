"""Checked queries over returns, states and lag features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidebars.catalog import fixtures as fx
from tidebars.catalog.registry import query
from tidebars.catalog.sql import BAR
from tidebars.functions.times import time_literal
from tidebars.operators import states as st
from tidebars.operators.joins import matching, nonempty_columns, restrict
from tidebars.operators.moving_averages import standard_averages
from tidebars.operators.runs import ordered_runs
from tidebars.plans.views import day_bounds
from tidebars.schema import FEATURE_COLS, MA_COLS
from tidebars.sources.tables import in_range, latest_times, one_symbol

FEATURES = ", ".join(FEATURE_COLS)


@query("w01_returns", 'SELECT symbol, "timestamp", close, ret FROM returns', uses="returns")
def returns(spark, sf_dir):
    return st.period_returns(fx.smooth_bars(spark, sf_dir)).select("symbol", "timestamp", "close", "ret")


@query("w01_zero_close", """SELECT symbol, "timestamp", CASE WHEN p = 0 THEN 0.0 ELSE (close - p) / p END AS ret FROM (
  SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY "timestamp") AS p FROM (
    SELECT symbol, "timestamp", CASE WHEN close % 10 = 0 THEN 0 ELSE close END AS close FROM tick_bars))
WHERE p IS NOT NULL""", uses="tick_bars")
def zero_close(spark, sf_dir):
    ticks = fx.tick_bars(spark, sf_dir)
    ticks = ticks.withColumn("close", F.when(F.col("close") % 10 == 0, 0.0).otherwise(F.col("close")))
    return st.period_returns(ticks).filter(F.col("ret").isNotNull()).select("symbol", "timestamp", "ret")


@query("f01_states", 'SELECT symbol, "timestamp", state FROM states', uses="states")
def classified(spark, sf_dir):
    out = st.with_states(fx.smooth_bars(spark, sf_dir))
    return out.select("symbol", "timestamp", F.col("new_state").alias("state"))


@query("w13_rows_with_state", """SELECT symbol, "timestamp", state FROM states
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "timestamp") > 1""", uses="states")
def rows_with_state(spark, sf_dir):
    out = st.with_states(fx.smooth_bars(spark, sf_dir))
    return out.filter(F.col("new_state").isNotNull()).select("symbol", "timestamp", F.col("new_state").alias("state"))


def state_features(spark, sf_dir):
    """The feature table of the smoothed bars with the states of their own returns."""
    labelled = st.with_states(fx.smooth_bars(spark, sf_dir)).withColumnRenamed("new_state", "market_state")
    return st.lag_features(labelled)


@query("w02_pct_change", 'SELECT symbol, "timestamp", ret_lag_0 FROM features', uses="features")
def pct_change(spark, sf_dir):
    return state_features(spark, sf_dir).select("symbol", "timestamp", "ret_lag_0")


@query("w03_lagged_returns", f'SELECT symbol, "timestamp", {FEATURES} FROM features', uses="features")
def lagged(spark, sf_dir):
    return state_features(spark, sf_dir).select("symbol", "timestamp", *FEATURE_COLS)


@query("w04_next_state", 'SELECT symbol, "timestamp", market_state, target_state FROM features', uses="features")
def next_state(spark, sf_dir):
    return state_features(spark, sf_dir).select("symbol", "timestamp", "market_state", "target_state")


@query("w03_part_features", f"""SELECT symbol, "timestamp", {FEATURES} FROM (
  SELECT symbol, "timestamp", r AS ret_lag_0, {", ".join(f'lag(r, {k}) OVER w AS ret_lag_{k}' for k in (1, 2, 5, 10, 20))}
  FROM (SELECT symbol, "timestamp", close / lag(close) OVER (PARTITION BY symbol ORDER BY "timestamp") - 1 AS r FROM part_bars)
  WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")) WHERE ret_lag_20 IS NOT NULL""", uses="part_bars")
def part_features(spark, sf_dir):
    bars = fx.part_bars(spark, sf_dir).withColumn("market_state", F.lit("Stable"))
    return st.lag_features(bars).dropna(subset=FEATURE_COLS).select("symbol", "timestamp", *FEATURE_COLS)


@query("p16_complete_rows", f"""SELECT 'training' AS part, symbol, count(*) AS n FROM features
WHERE ret_lag_20 IS NOT NULL AND target_state IS NOT NULL GROUP BY symbol
UNION ALL SELECT 'scoring', symbol, count(*) FROM features WHERE ret_lag_20 IS NOT NULL AND market_state IS NOT NULL GROUP BY symbol""",
       uses="features")
def complete_rows(spark, sf_dir):
    features = state_features(spark, sf_dir)
    count = F.count(F.lit(1)).alias("n")
    parts = [(st.training_rows(features), "training"), (st.scoring_rows(features), "scoring")]
    a, b = [rows.groupBy("symbol").agg(count).withColumn("part", F.lit(name)) for rows, name in parts]
    return a.unionByName(b)


@query("o02_chronological", """SELECT symbol, "timestamp", close, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp") AS rn
FROM part_bars""", uses="part_bars")
def chronological(spark, sf_dir):
    runs = ordered_runs(fx.part_bars(spark, sf_dir))
    numbered = runs.df.withColumn("rn", F.row_number().over(runs.window).cast("bigint"))
    return runs.finish(numbered).select("symbol", "timestamp", "close", "rn")


@query("o03_latest_one", 'SELECT symbol, max("timestamp") AS latest FROM segment_bars GROUP BY symbol', uses="segment_bars")
def latest_one(spark, sf_dir):
    return latest_times(fx.segment_bars(spark, sf_dir))


@query("a01_latest_time", 'SELECT symbol, max("timestamp") AS latest FROM part_bars GROUP BY symbol', uses="part_bars")
def latest(spark, sf_dir):
    return latest_times(fx.part_bars(spark, sf_dir))


@query("o04_last_states", """SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) AS recency, "timestamp", state
FROM states WHERE state IS NOT NULL QUALIFY recency <= 5""", uses="states")
def last_states(spark, sf_dir):
    out = st.last_states(st.with_states(fx.smooth_bars(spark, sf_dir)))
    return out.withColumn("recency", F.col("recency").cast("bigint"))


@query("p09_time_range", f"""SELECT {BAR} FROM segment_bars
WHERE "timestamp" >= TIMESTAMP '1996-03-01' AND "timestamp" <= TIMESTAMP '2000-02-29'""", uses="segment_bars")
def time_range(spark, sf_dir):
    return in_range(fx.segment_bars(spark, sf_dir), "1996-03-01", "2000-02-29")


@query("p10_one_symbol", f"SELECT {BAR} FROM segment_bars WHERE symbol = 'MACHINERY'", uses="segment_bars")
def symbol_rows(spark, sf_dir):
    return one_symbol(fx.segment_bars(spark, sf_dir), "MACHINERY")


@query("p11_listed_values", f"""SELECT {BAR} FROM segment_bars WHERE symbol IN ('MACHINERY', 'BUILDING')
AND "timestamp" IN (SELECT o_orderdate FROM orders WHERE o_orderpriority = '1-URGENT')""", uses="segment_bars")
def listed_values(spark, sf_dir):
    days = fx.table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp")
    )
    listed = spark.createDataFrame([("MACHINERY",), ("BUILDING",)], "symbol string")
    return matching(restrict(fx.segment_bars(spark, sf_dir), listed), days, "timestamp")


@query("p14_trailing_year", f"""SELECT {BAR} FROM segment_bars
WHERE "timestamp" >= TIMESTAMP '2001-07-01' - INTERVAL 365 DAY AND "timestamp" <= TIMESTAMP '2001-07-01'""", uses="segment_bars")
def trailing_year(spark, sf_dir):
    end = dt.datetime(2001, 7, 1)
    return in_range(fx.segment_bars(spark, sf_dir), end - dt.timedelta(days=365), end)


@query("p15_whole_days", """SELECT symbol, "timestamp", close FROM tick_bars
WHERE "timestamp" >= TIMESTAMP '2024-01-05' AND "timestamp" < TIMESTAMP '2024-01-13'""", uses="tick_bars")
def whole_days(spark, sf_dir):
    bounds = day_bounds(dt.date(2024, 1, 5), dt.date(2024, 1, 12))
    return in_range(fx.tick_bars(spark, sf_dir), *bounds).select("symbol", "timestamp", "close")


@query("p17_nonempty_columns", """SELECT symbol, column_name FROM (
  SELECT DISTINCT symbol FROM part_bars) CROSS JOIN (
  SELECT unnest(['sma_5','sma_10','sma_20','ema_5','ema_10','ema_20','wma_5','wma_10','wma_20']) AS column_name)
WHERE NOT (column_name LIKE 'wma%' AND symbol LIKE '%7')""", uses="part_bars")
def nonempty(spark, sf_dir):
    averages = standard_averages(fx.part_bars(spark, sf_dir), [5, 10, 20])
    known = [c for c in MA_COLS if c in averages.columns]
    blanked = averages.withColumns({
        c: F.when(~F.col("symbol").endswith("7"), F.col(c)) if c.startswith("wma") else F.col(c) for c in known
    })
    return nonempty_columns(blanked, known)


@query("j05_universe", f"""SELECT {BAR} FROM segment_bars
WHERE symbol IN (SELECT c_mktsegment FROM customer WHERE c_mktsegment < 'G')""", uses="segment_bars")
def universe(spark, sf_dir):
    listed = fx.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("symbol")).filter(F.col("symbol") < "G").distinct()
    return restrict(fx.segment_bars(spark, sf_dir), listed)


@query("f04_zone_free_times", """SELECT o_orderkey, o_orderdate + INTERVAL 1 DAY AS next_ts,
       o_orderdate + INTERVAL 1 DAY > TIMESTAMP '2001-06-30 20:00:00' AS up_to_date FROM orders""")
def zone_free(spark, sf_dir):
    run_end = time_literal("2001-06-30T22:00:00+02:00")
    following = F.col("o_orderdate").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", following.alias("next_ts"), (following > run_end).alias("up_to_date")
    )
