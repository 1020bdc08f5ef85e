import datetime as dt

import numpy as np
import pandas as pd
import pytest

from tidebars.catalog import averages, fixtures as fx
from tidebars.operators import moving_averages as ma
from tidebars.operators.runs import symbol_sizes

DAY = dt.datetime(2020, 1, 1)


def frame(spark, series):
    rows = [(s, DAY + dt.timedelta(days=i), float(v), 1) for s, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double, volume long")


def column(df, name, symbol="A"):
    return [r[0] for r in df.filter(df.symbol == symbol).orderBy("timestamp").select(name).collect()]


def test_hand_vectors(spark):
    df = frame(spark, {"A": [10, 11, 12, 13, 14], "B": [7.0]})
    out = ma.add_averages(df, {"e": ("ema", "close", 3), "w": ("WMA", "close", 3), "s": ("sma", "close", 3)})
    assert column(out, "e") == pytest.approx([10, 10.5, 11.25, 12.125, 13.0625])
    assert column(out, "w") == pytest.approx([10, 32 / 3, 34 / 3, 37 / 3, 40 / 3])
    assert column(out, "s") == pytest.approx([10, 10.5, 11, 12, 13])
    assert column(out, "e", "B") == [7.0]


def pandas_averages(pdf, p):
    def weighted(v):
        k = np.arange(1, len(v) + 1)
        return (v * k).sum() / k.sum()

    return {
        f"sma_{p}": pdf.close.rolling(p, min_periods=1).mean(),
        f"ema_{p}": pdf.close.ewm(span=p, adjust=False).mean(),
        f"wma_{p}": pdf.close.rolling(p, min_periods=1).apply(weighted, raw=True),
    }


@pytest.mark.parametrize("segment_rows", [None, 300])
def test_matches_pandas_across_batches_and_segments(spark, segment_rows):
    rng = np.random.default_rng(3)
    lengths = {"A": 2500, "B": 7, "C": 900}
    df = frame(spark, {s: 50 + 10 * rng.random(n) for s, n in lengths.items()})
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 137)
    try:
        out = ma.standard_averages(df, sizes=segment_rows and symbol_sizes(df, segment_rows)).toPandas().sort_values(["symbol", "timestamp"])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert len(out) == sum(lengths.values())
    for s in lengths:
        got = out[out.symbol == s].reset_index(drop=True)
        for p in (5, 10, 20, 50, 100, 200):
            for name, expected in pandas_averages(got, p).items():
                np.testing.assert_allclose(got[name], expected, rtol=1e-12, err_msg=f"{s} {name}")


def test_period_one_constant_and_unknown_kind(spark):
    df = frame(spark, {"A": [3, 9, 4]})
    one = ma.add_averages(df, {k: (k, "close", 1) for k in ma.KINDS})
    for k in ma.KINDS:
        assert column(one, k) == [3, 9, 4]
    flat = ma.standard_averages(frame(spark, {"A": [5.0] * 300}))
    for name in flat.columns[4:]:
        assert column(flat, name) == pytest.approx([5.0] * 300, rel=1e-13)
    with pytest.raises(ValueError):
        ma.moving_average("close", 3, "hull")
    with pytest.raises(ValueError):
        ma.check_storable([5, 7])
    with pytest.raises(ValueError):
        ma.add_averages(df, {"x": ("sma", "close", 0)})


def test_short_plain_average_equals_kernel(spark, sf_dir):
    bars = fx.cent_bars(spark, sf_dir)
    jvm = ma.add_averages(bars, {"a": ("sma", "close", 20)})
    kernel = ma.add_averages(bars, {"b": ("sma", "close", 20), "e": ("ema", "close", 20)})
    joined = jvm.join(kernel, ["symbol", "timestamp"])
    assert joined.filter("a <> b").count() == 0
    assert joined.count() == bars.count()


def test_long_and_display_forms(spark, sf_dir):
    bars = fx.cent_bars(spark, sf_dir)
    n = bars.count()
    long = ma.averages_by_period(bars, [5, 7])
    assert long.columns == ["symbol", "timestamp", "period", "sma", "sma_volume", "ema", "ema_volume", "wma"]
    assert long.count() == 2 * n
    shown = ma.display_averages(bars, [3])
    assert {"disp_sma_3", "disp_ema_3"} <= set(shown.columns)


@pytest.mark.parametrize("per_batch", [2, 3, 10_000])
@pytest.mark.parametrize("bad", [None, float("nan"), float("inf")])
def test_one_rule_for_missing_values_and_no_leak(spark, per_batch, bad):
    """A row without a finite value counts in no frame, has no averages, and leaves other symbols alone."""
    series = {"A": [5, 6, 7, 8], "B": [1, bad, 3, 4], "C": [2, 2, 9]}
    rows = [(s, DAY + dt.timedelta(days=i), None if v is None else float(v), 1) for s, vs in series.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double, volume long").coalesce(1)
    old = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions")}
    for k, v in zip(old, (per_batch, 1)):
        spark.conf.set(k, v)
    try:
        jvm = ma.add_averages(df, {"s": ("sma", "close", 3)})
        kernel = ma.add_averages(df, {"s": ("sma", "close", 3), "e": ("ema", "close", 3), "w": ("wma", "close", 2)})
        for s in series:
            assert column(jvm, "s", s) == column(kernel, "s", s)
        assert column(kernel, "s", "B") == [1.0, None, 2.0, pytest.approx(8 / 3)]
        assert column(kernel, "e", "B") == [1.0, None, 2.0, 3.0] and column(kernel, "e", "A") == [5.0, 5.5, 6.25, 7.125]
        assert column(kernel, "e", "C") == [2.0, 2.0, 5.5]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_known_averages_are_gone_on_from(spark):
    rng = np.random.default_rng(4)
    df = frame(spark, {"A": 50 + 10 * rng.random(300), "B": [3.0, 4.0]})
    whole = ma.add_averages(df, {"e": ("ema", "close", 20)})
    known = whole.withColumnRenamed("e", "k").selectExpr("symbol", "timestamp", "close", "volume", "CASE WHEN timestamp < '2020-08-01' THEN k END AS k")
    again = ma.add_averages(known.filter("timestamp >= '2020-07-20'"), {"e": ("ema", "close", 20)}, known={"e": "k"})
    got = column(again, "e")
    assert got == pytest.approx(column(whole, "e")[-len(got):], rel=1e-12)


def test_exponential_averages_of_split_symbols_borrow_no_rows(spark, monkeypatch):
    rng = np.random.default_rng(2)
    closes = [float("nan") if i % 17 == 3 else float(v) for i, v in enumerate(rng.integers(1, 1000, 3000))]
    df = frame(spark, {"A": closes, "B": list(rng.integers(1, 50, 700)), "C": [3.0]})
    seen = []
    right = ma.ordered_runs
    monkeypatch.setattr(ma, "ordered_runs", lambda d, back=0, **how: seen.append(back) or right(d, back=back, **how))
    wanted = {"e": ("ema", "close", 200), "f": ("ema", "close", 1), "g": ("ema", "volume", 9), "s": ("sma", "close", 30), "w": ("wma", "close", 30)}
    split = ma.add_averages(df, wanted, symbol_sizes(df, 400))
    assert seen == [29]
    whole = ma.add_averages(df, wanted, symbol_sizes(df))
    key = lambda r: (r.symbol, r.timestamp)
    a, b = (sorted(d.collect(), key=key) for d in (split, whole))
    assert split.columns == whole.columns and len(a) == len(b) == 3701
    for x, y in zip(a, b):
        assert key(x) == key(y)
        for c in wanted:
            assert (x[c] is None) == (y[c] is None) and (x[c] is None or x[c] == pytest.approx(y[c], rel=1e-12)), (c, x, y)


def test_averages_in_a_row_shuffle_once(spark, sf_dir):
    bars = fx.part_bars(spark, sf_dir).localCheckpoint()
    sizes = ma.symbol_sizes(bars)
    out = bars.transform(ma.moving_average("close", 15, sizes=sizes)).transform(ma.moving_average("close", 15, "wma", sizes=sizes))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_rows_left_out_change_no_other(spark):
    rows = [(s, i, None if (i + len(s)) % 3 == 0 else float("nan") if i % 7 == 5 else float(i * i + len(s))) for s in ("A", "BB") for i in range(40)]
    wanted = {"sma_3": ("sma", "close", 3), "wma_4": ("wma", "close", 4), "ema_5": ("ema", "close", 5)}
    schema = "symbol string, timestamp int, close double"
    df = spark.createDataFrame(rows, schema)
    full = spark.createDataFrame([r for r in rows if r[2] is not None and r[2] == r[2]], schema)
    short = {"sma_3": wanted["sma_3"]}
    for names in (wanted, short):
        got = {(r.symbol, r.timestamp): [r[n] for n in names] for r in ma.add_averages(df, names).collect()}
        expected = {(r.symbol, r.timestamp): [r[n] for n in names] for r in ma.add_averages(full, names).collect()}
        assert len(got) == len(rows)
        for key, values in got.items():
            assert values == expected.get(key, [None] * len(names))


def test_named_averages_look_for_long_symbols_once(spark, sf_dir, monkeypatch):
    calls = []
    monkeypatch.setattr(ma, "symbol_sizes", lambda df, find=ma.symbol_sizes: calls.append(1) or find(df))
    assert averages.named_average(spark, sf_dir).columns == ["symbol", "timestamp", "sma_15", "wma_15", "ema_15"]
    assert len(calls) == 1
