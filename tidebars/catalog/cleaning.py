"""Checked queries over header normalisation, coercion, de-duplication and the quality gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebars.catalog import fixtures as fx
from tidebars.catalog.registry import query
from tidebars.catalog.sql import BAR, STATE_CASE
from tidebars.functions import scalars
from tidebars.operators import quality, sorted_keys
from tidebars.operators.states import with_states
from tidebars.plans.views import ordered
from tidebars.schema import BAR_COLS, KEY
from tidebars.session import scratch_dir
from tidebars.sources.landing import next_day


def _vendor_frame(spark, sf_dir):
    """Bars under vendor headers, with a column that has to go."""
    bars = fx.segment_bars(spark, sf_dir)
    return bars.select(
        F.col("timestamp").alias("Date"), F.col("open").alias("Open"), F.col("high").alias("High"),
        F.col("low").alias("Low"), F.col("close").alias("Close"), F.col("close").alias("Adj Close"),
        F.col("volume").alias("Volume"), F.col("symbol").alias("source_symbol"),
    )


@query("p01_headers", f"SELECT lower(symbol) AS symbol, \"timestamp\", open, high, low, close, volume FROM segment_bars", uses="segment_bars")
def headers(spark, sf_dir):
    return quality.normalize_headers(_vendor_frame(spark, sf_dir), F.lower("source_symbol"))


@query("p02_required_columns", f"SELECT {BAR} FROM segment_bars", uses="segment_bars")
def required(spark, sf_dir):
    bars = fx.segment_bars(spark, sf_dir).withColumnRenamed("timestamp", "Date")
    return quality.require_columns(bars).select(*BAR_COLS)


@query("p03_times", f"SELECT ordinal, \"timestamp\" FROM typed_rows WHERE \"timestamp\" IS NOT NULL", uses="coerced_rows")
def times(spark, sf_dir):
    dirty = fx.dirty_rows(spark, sf_dir)
    parsed = scalars.to_bar_time(F.col("timestamp"), dirty.schema["timestamp"].dataType)
    return dirty.select("ordinal", parsed.alias("timestamp")).filter(F.col("timestamp").isNotNull())


@query("p04_numbers", f"SELECT ordinal, close, raw_volume AS volume FROM typed_rows", uses="coerced_rows")
def numbers(spark, sf_dir):
    dirty = fx.dirty_rows(spark, sf_dir)
    return dirty.select("ordinal", *[scalars.to_number(F.col(c), dirty.schema[c].dataType).alias(c) for c in ("close", "volume")])


@query("p05_drop_nulls", f"SELECT ordinal, close FROM coerced_rows", uses="coerced_rows")
def drop_nulls(spark, sf_dir):
    return quality.coerce(fx.dirty_rows(spark, sf_dir), ("ordinal",)).select("ordinal", "close")


@query("p06_strip", f"SELECT symbol, count(*) AS n FROM typed_rows WHERE symbol IS NOT NULL GROUP BY symbol", uses="coerced_rows")
def strip_symbols(spark, sf_dir):
    return (
        fx.dirty_rows(spark, sf_dir).select(scalars.strip(F.col("symbol")).alias("symbol")).dropna()
        .groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    )


@query("p07_round_volume", f"SELECT ordinal, CAST(round_even(raw_volume, 0) AS BIGINT) AS volume FROM typed_rows WHERE raw_volume IS NOT NULL", uses="coerced_rows")
def round_volume(spark, sf_dir):
    dirty = fx.dirty_rows(spark, sf_dir)
    number = scalars.to_number(F.col("volume"), dirty.schema["volume"].dataType)
    return dirty.select("ordinal", scalars.round_half_even(number).alias("volume"))


@query("p08_bar_columns", f"SELECT {BAR} FROM coerced_rows", uses="coerced_rows")
def bar_columns(spark, sf_dir):
    return quality.coerce(fx.dirty_rows(spark, sf_dir))


@query("a02_keep_first", f"SELECT {BAR} FROM kept", uses="kept")
def keep_first(spark, sf_dir):
    return quality.keep_first(quality.coerce(fx.dirty_rows(spark, sf_dir), ("ordinal",)), "ordinal")


@query("a03_duplicate_keys", f"SELECT symbol, \"timestamp\", count(*) AS copies FROM order_rows GROUP BY ALL HAVING count(*) > 1", uses="order_rows")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(fx.order_rows(spark, sf_dir))


@query("a03_sorted_cells", """SELECT year("timestamp") AS year, sum(copies)::BIGINT AS n, min("timestamp") AS first_time, max("timestamp") AS last_time, max(copies) > 1 AS repeated
FROM (SELECT symbol, "timestamp", count(*) AS copies FROM order_rows GROUP BY ALL) GROUP BY ALL""", uses="order_rows")
def sorted_cells(spark, sf_dir):
    """Repeated keys by year, found by neighbours in files laid out by ranges of the key."""
    path, order = scratch_dir(spark, "sorted"), ["year", *KEY]
    rows = fx.order_rows(spark, sf_dir).select(*KEY, F.year("timestamp").alias("year"))
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    found = sorted_keys.stretches(spark.read.parquet(path), F.col("year"), F.lit(0))
    return sorted_keys.judged_cells(found).select(
        "year", "n", F.col("first").alias("first_time"), F.col("last").alias("last_time"), F.col("doubtful").alias("repeated"))


@query("o05_duplicate_sample", f"SELECT symbol, \"timestamp\", count(*) AS copies FROM order_rows GROUP BY ALL HAVING count(*) > 1 ORDER BY symbol, \"timestamp\" LIMIT 5", uses="order_rows")
def duplicate_sample(spark, sf_dir):
    return quality.duplicate_sample(fx.order_rows(spark, sf_dir))


def _faulty_bars(spark, sf_dir):
    """Bars where one symbol has negative prices and another negative volumes."""
    bars = fx.segment_bars(spark, sf_dir)
    odd_day = F.dayofmonth("timestamp") == 13
    return bars.withColumns({
        "low": F.when((F.col("symbol") == "BUILDING") & odd_day, -F.col("low")).otherwise(F.col("low")),
        "volume": F.when((F.col("symbol") == "MACHINERY") & odd_day, -F.col("volume")).otherwise(F.col("volume")),
    })


@query("a04_negative_checks", f"""SELECT symbol, count(*) AS n, min("timestamp") AS first_ts, max("timestamp") AS last_ts,
       bool_or(open < 0 OR high < 0 OR low < 0 OR close < 0) AS negative_price,
       bool_or(volume < 0) AS negative_volume, false AS not_finite FROM faulty GROUP BY symbol""", uses="faulty")
def negative_checks(spark, sf_dir):
    return quality.symbol_report(_faulty_bars(spark, sf_dir))


@query("a04_gate", f"SELECT {BAR} FROM faulty WHERE symbol NOT IN (SELECT symbol FROM faulty WHERE low < 0 OR volume < 0)", uses="faulty")
def gate(spark, sf_dir):
    return quality.gate(_faulty_bars(spark, sf_dir))[0]


@query("a05_column_types", f"SELECT {BAR} FROM coerced_rows", uses="coerced_rows")
def column_types(spark, sf_dir):
    return quality.require_bar_types(quality.coerce(fx.dirty_rows(spark, sf_dir)))


@query("a06_status", """SELECT l.symbol, coalesce(p.n, 0) AS n, coalesce(p.n, 0) > 0 AND p.reason IS NULL AS ok,
       CASE WHEN p.n IS NULL THEN 'empty' ELSE p.reason END AS reason
FROM (SELECT DISTINCT symbol FROM faulty UNION SELECT upper(n_name) FROM nation) l LEFT JOIN (
  SELECT symbol, count(*) AS n,
         CASE WHEN bool_or(low < 0) THEN 'negative_price'
              WHEN bool_or(volume < 0) THEN 'negative_volume' END AS reason
  FROM faulty GROUP BY symbol) p ON l.symbol = p.symbol""", uses="faulty")
def status(spark, sf_dir):
    bars = _faulty_bars(spark, sf_dir)
    names = fx.table(spark, sf_dir, "nation").select(F.upper("n_name").alias("symbol"))
    return quality.gate(bars, bars.select("symbol").unionByName(names))[1]


@query("a07_time_window", f"""SELECT symbol, min("timestamp") AS first_ts, max("timestamp") AS last_ts FROM segment_bars GROUP BY symbol
HAVING min("timestamp") < TIMESTAMP '1995-01-02' OR max("timestamp") > TIMESTAMP '2001-12-30'""", uses="segment_bars")
def time_window(spark, sf_dir):
    return quality.outside_window(fx.segment_bars(spark, sf_dir), "1995-01-02", "2001-12-30")


@query("a08_distinct_keys", f"""SELECT 'symbol' AS part, count(DISTINCT symbol) AS n FROM coerced_rows
UNION ALL SELECT 'timestamp', count(DISTINCT "timestamp") FROM coerced_rows""", uses="coerced_rows")
def distinct_keys(spark, sf_dir):
    rows = quality.coerce(fx.dirty_rows(spark, sf_dir))
    parts = [quality.distinct_values(rows, c).agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("part"), "n") for c in ("symbol", "timestamp")]
    return parts[0].unionByName(parts[1])


def _two_frames(spark, sf_dir):
    """Clean bars of the early years first, then dirty text rows of all years."""
    bars = fx.segment_bars(spark, sf_dir).filter(F.year("timestamp") <= 1998).withColumn("ordinal", F.lit(0).cast("bigint"))
    as_text = [F.col("symbol"), F.date_format("timestamp", "yyyy-MM-dd").alias("timestamp")]
    first = bars.select(*as_text, *[F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close", "volume")], "ordinal")
    return [first, fx.dirty_rows(spark, sf_dir)]


@query("u01_concat", """SELECT part, count(*) AS n, count(high) AS with_high, count(symbol) AS with_symbol FROM (
  SELECT 0 AS part, symbol, CAST(high AS VARCHAR) AS high FROM segment_bars WHERE year("timestamp") <= 1998
  UNION ALL SELECT 1, symbol, NULL FROM dirty_rows) GROUP BY part""", uses="segment_bars dirty_rows")
def concat(spark, sf_dir):
    first, second = _two_frames(spark, sf_dir)
    stacked = quality.concat_frames(spark, [first, second.drop("high")])
    return stacked.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.count("high").alias("with_high"), F.count("symbol").alias("with_symbol")
    )


@query("u02_combine_and_clean", f"""SELECT {BAR} FROM (
  SELECT 0 AS part, 0 AS ordinal, {BAR} FROM segment_bars WHERE year("timestamp") <= 1998
  UNION ALL SELECT 1, ordinal, {BAR} FROM coerced_rows)
QUALIFY row_number() OVER (PARTITION BY symbol, "timestamp" ORDER BY part, ordinal) = 1
ORDER BY symbol, "timestamp" """, uses="segment_bars coerced_rows")
def combine(spark, sf_dir):
    bars, _ = quality.combine_and_clean(spark, _two_frames(spark, sf_dir), order="ordinal")
    return bars.orderBy("symbol", "timestamp")


@query("o01_sorted", f"SELECT {BAR} FROM segment_bars ORDER BY symbol, \"timestamp\"", uses="segment_bars")
def sorted_bars(spark, sf_dir):
    return ordered(fx.segment_bars(spark, sf_dir))


@query("f01_state_counts", f"""SELECT symbol, {STATE_CASE} AS state, count(*) AS n
FROM returns WHERE ret IS NOT NULL GROUP BY ALL""", uses="returns")
def state_counts(spark, sf_dir):
    states = with_states(fx.smooth_bars(spark, sf_dir)).dropna(subset=["new_state"])
    return states.groupBy("symbol", F.col("new_state").alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query("f02_stems", """SELECT symbol, CASE WHEN regexp_matches(low, '\\.(us|de|pl|jp)$') THEN low ELSE low || '.us|' || low END AS stems, count(*) AS n
FROM (SELECT c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN '.Jp' ELSE '' END AS symbol, lower(symbol) AS low FROM customer) GROUP BY ALL""")
def stems(spark, sf_dir):
    suffix = F.when(F.col("c_custkey") % 2 == 0, ".Jp").otherwise("")
    names = fx.table(spark, sf_dir, "customer").select(F.concat("c_mktsegment", suffix).alias("symbol"))
    tries = F.array_join(scalars.candidate_stems(F.col("symbol")), "|").alias("stems")
    return names.groupBy("symbol", tries).agg(F.count(F.lit(1)).alias("n"))


@query("f03_dates", """SELECT o_orderkey, strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day,
       strftime(least(o_orderdate, TIMESTAMP '1998-06-30'), '%Y-%m-%d') AS capped,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS BIGINT) AS days_left FROM orders""")
def dates(spark, sf_dir):
    day = F.to_date(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format(next_day(day), "yyyy-MM-dd").alias("next_day"),
        F.date_format(F.least(day, F.lit("1998-06-30").cast("date")), "yyyy-MM-dd").alias("capped"),
        F.datediff(F.lit("2001-12-31").cast("date"), day).cast("bigint").alias("days_left"),
    )
