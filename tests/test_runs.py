import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidebars.catalog import fixtures as fx
from tidebars.functions.scalars import epoch_micros
from tidebars.operators import states as st
from tidebars.operators import moving_averages as ma, runs as rn
from tidebars.operators.runs import ordered_runs, symbol_sizes
from tidebars.schema import FEATURE_COLS


def uneven_bars(spark):
    """One symbol with most rows, nearly all within a second, and two small ones."""
    rng = random.Random(5)
    start = dt.datetime(1969, 12, 31, 23, 59)
    rows = [("HOT", start + dt.timedelta(days=i), 10 + rng.random()) for i in range(200)]
    rows += [("HOT", start + dt.timedelta(days=77, seconds=3, microseconds=i), 10 + rng.random()) for i in range(1, 1500)]
    rows += [("B", start + dt.timedelta(hours=i), 20 + rng.random()) for i in range(60)]
    rows += [("C", start, 1.0)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double").withColumn(
        "market_state", F.lit(None).cast("string")
    )


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_epoch_micros(spark):
    df = spark.createDataFrame([(dt.datetime(1969, 12, 31, 23, 59, 59, 999999),), (dt.datetime(2024, 2, 29, 1, 2, 3, 4),)],
                               "t timestamp_ntz")
    got = [r[0] for r in df.select(epoch_micros(F.col("t"))).collect()]
    assert got == [-1, 1709168523000004]


@pytest.mark.parametrize("segment_rows", [40, 150, 700])
def test_split_frames_equal_whole_ones(spark, segment_rows):
    df = uneven_bars(spark)

    def frames(n):
        runs = ordered_runs(df, back=25, ahead=3, sizes=symbol_sizes(df, n))
        w = runs.window
        out = runs.df.select(
            "*",
            F.lag("close", 25).over(w).alias("old"), F.lead("close", 3).over(w).alias("coming"),
            F.max("close").over(runs.rows(-25, 3)).alias("top"), F.count("close").over(runs.rows(-25, 0)).alias("held"),
        )
        return runs, rows_of(runs.finish(out).drop("market_state"))

    whole, expected = frames(10**9)
    split, got = frames(segment_rows)
    assert not whole.split and split.split
    assert got == expected
    sizes = split.df.groupBy("symbol", "_seg").count().collect()
    assert len(sizes) > 4
    assert max(r["count"] for r in sizes) < 3 * segment_rows + 100


def test_states_and_features_do_not_depend_on_the_split(spark):
    df = uneven_bars(spark)
    assert rows_of(st.with_states(df)) == rows_of(st.with_states(df, symbol_sizes(df, 100)))
    whole, split = st.classified_features(df), st.classified_features(df, sizes=symbol_sizes(df, 100))
    key = ["symbol", "timestamp", *FEATURE_COLS, "new_state", "target_state"]
    as_text = lambda d: sorted(str(tuple(r)) for r in d.select(*key).collect())
    assert as_text(whole) == as_text(split)


def test_one_pass_features_equal_the_stepwise_ones(spark, sf_dir):
    bars = fx.smooth_bars(spark, sf_dir).withColumn("market_state", F.lit(None).cast("string"))
    stepwise = st.lag_features(st.with_states(bars), state="new_state")
    at_once = st.classified_features(bars).select(*stepwise.columns)
    assert at_once.exceptAll(stepwise).count() == 0 and stepwise.exceptAll(at_once).count() == 0


def test_results_do_not_depend_on_partitions_or_input_order(spark, sf_dir):
    bars = fx.smooth_bars(spark, sf_dir)
    expected = rows_of(st.with_states(bars))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 3)
    try:
        assert rows_of(st.with_states(bars.orderBy(F.rand(1)))) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize(
    "r, state",
    [(0.0051, "Strong Up"), (0.005, "Slight Up"), (0.001, "Stable"), (0.0, "Stable"), (-0.001, "Stable"),
     (-0.005, "Slight Down"), (-0.0051, "Strong Down"), (float("nan"), "Stable"), (None, None)],
)
def test_state_bounds(spark, r, state):
    from tidebars.functions.scalars import classify_return

    df = spark.createDataFrame([(r,)], "r double")
    assert df.select(classify_return(F.col("r"))).first()[0] == state


def test_chained_operators_share_one_look_at_the_sizes(spark, monkeypatch):
    df = uneven_bars(spark)
    looked = []
    monkeypatch.setattr(rn, "symbol_sizes", lambda d, n=None: looked.append(1) or symbol_sizes(d, n))
    sizes = symbol_sizes(df)
    out = st.with_states(df, sizes).transform(ma.moving_average("close", 5, sizes=sizes)).transform(ma.moving_average("close", 9, "ema", sizes=sizes))
    assert not looked and out.count() == df.count()
    st.with_states(df)
    assert len(looked) == 1
