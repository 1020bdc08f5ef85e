"""Checked queries over whole jobs, run on stores filled from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebars.catalog import fixtures as fx
from tidebars.catalog.landing import _CHOSEN, land_scenario
from tidebars.catalog.registry import query
from tidebars.catalog.sql import STATE_CASE
from tidebars.catalog.storage import averages_sql, filled_store, new_store, whole_ema
from tidebars.plans import jobs
from tidebars.session import scratch_dir
from tidebars.sources.tables import cell_place
from tidebars.streaming.ingest import stream_increment


def _universe(spark, sf_dir):
    return fx.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("symbol")).distinct()


def _both(store):
    raw, bars = [store.read(t).select(F.lit(t).alias("part"), "symbol", "timestamp", "close", "volume") for t in ("raw_bars", "bars")]
    return raw.unionByName(bars)


_INCREMENT_SQL = f"""SELECT part, symbol, "timestamp", close, volume FROM ({_CHOSEN})
CROSS JOIN (SELECT unnest(['raw_bars', 'bars']) AS part)"""


@query("d02_backfill", _INCREMENT_SQL, uses="segment_bars")
def backfill(spark, sf_dir):
    store = new_store(spark)
    jobs.historical_backfill(store, land_scenario(spark, sf_dir), _universe(spark, sf_dir), "2001-12-31", "1995-01-01")
    return _both(store)


# Two symbols hold their years up to 1997 with other volumes; the increment adds only later bars. For the
# unknown symbols the start is open, so the primary file with early dates is in range.
_SECOND_RUN = f"""SELECT part, symbol, "timestamp", close,
       CASE WHEN symbol IN ('AUTOMOBILE', 'BUILDING') AND year("timestamp") <= 1997 THEN 1 ELSE volume END AS volume
FROM (SELECT * FROM ({_CHOSEN}) WHERE symbol <> 'FURNITURE'
      UNION ALL SELECT 0, symbol, "timestamp" - INTERVAL 20 YEAR, open, high, low, close, volume + 8000 FROM segment_bars WHERE symbol = 'FURNITURE'
      UNION ALL SELECT 1, symbol, "timestamp", open, high, low, close, volume + 7000 FROM segment_bars
      WHERE symbol = 'MACHINERY' AND year("timestamp") >= 2000)
CROSS JOIN (SELECT unnest(['raw_bars', 'bars']) AS part)"""


def _started_store(spark, sf_dir):
    store = new_store(spark)
    early = fx.segment_bars(spark, sf_dir).filter(
        F.col("symbol").isin("AUTOMOBILE", "BUILDING") & (F.year("timestamp") <= 1997)
    ).withColumn("volume", F.lit(1).cast("bigint"))
    store.commit(appends={"raw_bars": early, "bars": early})
    return store


@query("d01_daily_increment", _SECOND_RUN, uses="segment_bars")
def daily_increment(spark, sf_dir):
    """An unknown symbol has an open start and so one chunk; a second run inserts nothing."""
    store, landing, universe = _started_store(spark, sf_dir), land_scenario(spark, sf_dir), _universe(spark, sf_dir)
    jobs.daily_increment(store, landing, universe, "2001-12-31T23:50:00")
    jobs.daily_increment(store, landing, universe, "2001-12-31T23:50:00")
    return _both(store)


@query("d01_stream_increment", _SECOND_RUN, uses="segment_bars")
def stream(spark, sf_dir):
    store = _started_store(spark, sf_dir)
    running = stream_increment(store, land_scenario(spark, sf_dir), _universe(spark, sf_dir), "2001-12-31T23:50:00",
                               scratch_dir(spark, "stream"))
    running.awaitTermination()
    return _both(store)


@query("d01_status", """SELECT symbol, CAST(n AS BIGINT) AS n, n > 0 AS ok, CASE WHEN n = 0 THEN 'empty' END AS reason FROM (
  SELECT symbol, count(*) FILTER (year("timestamp") > 1997 OR symbol NOT IN ('AUTOMOBILE', 'BUILDING')) AS n
  FROM segment_bars WHERE symbol <> 'MACHINERY' OR year("timestamp") >= 2000 GROUP BY symbol)""", uses="segment_bars")
def increment_status(spark, sf_dir):
    store = _started_store(spark, sf_dir)
    result = jobs.daily_increment(store, land_scenario(spark, sf_dir), _universe(spark, sf_dir), "2001-12-31T23:50:00")
    return result.status


@query("d04_refresh_averages", averages_sql(), uses="cent_bars")
def refresh(spark, sf_dir):
    """Rebuilt twice, which must change nothing."""
    store = filled_store(spark, sf_dir)
    jobs.refresh_averages(store, _universe(spark, sf_dir), rebuild=True)
    jobs.refresh_averages(store, _universe(spark, sf_dir), rebuild=True)
    return whole_ema(store.wide().drop("market_state"))


@query("d04_refresh_new_years", averages_sql(), uses="cent_bars")
def refresh_new_years(spark, sf_dir):
    """Averages of the early years are stored before the later bars arrive; only later years are rewritten."""
    store, bars = new_store(spark), fx.cent_bars(spark, sf_dir)
    early = F.year("timestamp") <= 1999
    store.commit(appends={t: bars.filter(early) for t in ("raw_bars", "bars")})
    jobs.refresh_averages(store)
    store.commit(appends={t: bars.filter(~early) for t in ("raw_bars", "bars")})
    before = store.manifest()["tables"]["bars"]
    jobs.refresh_averages(store)
    after = store.manifest()["tables"]["bars"]
    if any(before[y] != after[y] for y in before if cell_place(y)[0] <= 1999):
        raise AssertionError("a year without new bars was rewritten")
    return whole_ema(store.wide().drop("market_state"))


@query("w12_refresh_status", """SELECT symbol, count(*) AS n, true AS ok, CAST(NULL AS VARCHAR) AS reason FROM cent_bars GROUP BY symbol
UNION ALL SELECT upper(n_name), 0, false, 'no_raw_bars' FROM nation""", uses="cent_bars")
def refresh_status(spark, sf_dir):
    names = fx.table(spark, sf_dir, "nation").select(F.upper("n_name").alias("symbol"))
    return jobs.refresh_averages(filled_store(spark, sf_dir), _universe(spark, sf_dir).unionByName(names)).status


def _transformed(spark, sf_dir):
    store = new_store(spark)
    bars = fx.smooth_bars(spark, sf_dir)
    store.commit(appends={"raw_bars": bars, "bars": bars})
    return store, jobs.transform_states(store, _universe(spark, sf_dir), "2001-06-01")


_YEAR_STATES = """SELECT s.symbol, s."timestamp", s.close, CASE WHEN r.ret > 0.005 THEN 'Strong Up' WHEN r.ret > 0.001 THEN 'Slight Up'
  WHEN r.ret < -0.005 THEN 'Strong Down' WHEN r.ret < -0.001 THEN 'Slight Down' WHEN r.ret IS NOT NULL THEN 'Stable' END AS market_state
FROM smooth_bars s LEFT JOIN (SELECT symbol, "timestamp", (close - p) / p AS ret FROM (
  SELECT symbol, "timestamp", close, lag(close) OVER (PARTITION BY symbol ORDER BY "timestamp") AS p FROM smooth_bars
  WHERE "timestamp" >= TIMESTAMP '2001-06-01' - INTERVAL 365 DAY AND "timestamp" <= TIMESTAMP '2001-06-01')) r
ON s.symbol = r.symbol AND s."timestamp" = r."timestamp" """


@query("d03_states", _YEAR_STATES, uses="smooth_bars")
def transform(spark, sf_dir):
    store, _ = _transformed(spark, sf_dir)
    return store.read("bars").select("symbol", "timestamp", "close", "market_state")


@query("d03_recent_states", f"""SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) AS recency, "timestamp", market_state AS state
FROM ({_YEAR_STATES}) WHERE market_state IS NOT NULL QUALIFY recency <= 5""", uses="smooth_bars")
def recent(spark, sf_dir):
    _, result = _transformed(spark, sf_dir)
    return result.recent_states().withColumn("recency", F.col("recency").cast("bigint"))


# Training labels of the window and, for each pair of them, whether the first is ever current.
_PAIRS = f"""FROM (WITH win AS (SELECT symbol, "timestamp", close FROM smooth_bars
  WHERE "timestamp" >= TIMESTAMP '2001-06-01' - INTERVAL 365 DAY AND "timestamp" <= TIMESTAMP '2001-06-01'), labelled AS (
  SELECT symbol, "timestamp", close, {STATE_CASE} AS state, r FROM (SELECT *, (close - p) / p AS ret, close / p - 1 AS r FROM (
    SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY "timestamp") AS p FROM win))), lagged AS (
  SELECT symbol, state, lead(state) OVER w AS target, lag(r, 20) OVER w AS oldest FROM labelled
  WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")), classes AS (
  SELECT DISTINCT symbol, target FROM lagged WHERE oldest IS NOT NULL AND target IS NOT NULL), known AS (
  SELECT * FROM classes WHERE symbol IN (SELECT symbol FROM classes GROUP BY symbol HAVING count(*) > 1))
SELECT a.symbol, a.target AS from_state, b.target AS to_state,
       NOT EXISTS (SELECT 1 FROM lagged l WHERE l.symbol = a.symbol AND l.state = a.target AND l.oldest IS NOT NULL) AS never_current
FROM known a JOIN known b ON a.symbol = b.symbol)"""


def _stored_pairs(store):
    return store.read("transition_probs").select("symbol", "from_state", "to_state", (F.col("prob") == 0).alias("never_current"))


@query("s16_transitions", _PAIRS, uses="smooth_bars")
def transitions(spark, sf_dir):
    store, _ = _transformed(spark, sf_dir)
    return _stored_pairs(store)


# The stored probabilities of a state that is ever current add up to one, those of another are all zero.
_ROW_SUMS = f"""SELECT symbol, from_state, CASE WHEN any_value(never_current) THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS total, count(*) AS n
FROM ({_PAIRS}) GROUP BY symbol, from_state"""


def _stored_row_sums(store):
    probs = store.read("transition_probs")
    return probs.groupBy("symbol", "from_state").agg(F.round(F.sum("prob"), 9).alias("total"), F.count("prob").alias("n"))


@query("s16_row_sums", _ROW_SUMS, uses="smooth_bars")
def stored_row_sums(spark, sf_dir):
    store, _ = _transformed(spark, sf_dir)
    return _stored_row_sums(store)


def _two_universes(spark, sf_dir):
    store, bars = new_store(spark), fx.smooth_bars(spark, sf_dir)
    store.commit(appends={"raw_bars": bars, "bars": bars})
    for symbol in ("BUILDING", "MACHINERY"):
        listed = bars.select("symbol").filter(F.col("symbol") == symbol).distinct()
        jobs.transform_states(store, listed, "2001-06-01")
    return store


@query("s16_two_universes", f"FROM ({_PAIRS}) WHERE symbol IN ('BUILDING', 'MACHINERY')", uses="smooth_bars")
def two_universes(spark, sf_dir):
    """Two runs on one symbol each; the first one's matrix stays."""
    return _stored_pairs(_two_universes(spark, sf_dir))


@query("s16_two_universes_row_sums", f"FROM ({_ROW_SUMS}) WHERE symbol IN ('BUILDING', 'MACHINERY')", uses="smooth_bars")
def two_universes_row_sums(spark, sf_dir):
    return _stored_row_sums(_two_universes(spark, sf_dir))


@query("d03_status", """SELECT symbol, count(*) FILTER ("timestamp" >= TIMESTAMP '2001-06-01' - INTERVAL 365 DAY AND "timestamp" <= TIMESTAMP '2001-06-01') > 0 AS held,
  CAST(NULL AS VARCHAR) AS absent FROM smooth_bars GROUP BY symbol UNION ALL SELECT upper(n_name), false, 'no_bars' FROM nation""", uses="smooth_bars")
def transform_status(spark, sf_dir):
    store, bars = new_store(spark), fx.smooth_bars(spark, sf_dir)
    store.commit(appends={"raw_bars": bars, "bars": bars})
    names = fx.table(spark, sf_dir, "nation").select(F.upper("n_name").alias("symbol"))
    status = jobs.transform_states(store, _universe(spark, sf_dir).unionByName(names), "2001-06-01").status
    absent = F.when(F.col("reason") == "no_bars", F.col("reason")).alias("absent")
    return status.select("symbol", (F.coalesce("reason", F.lit("")) != "no_bars").alias("held"), absent)


@query("d04_append_day", averages_sql(), uses="cent_bars")
def append_days(spark, sf_dir):
    """Averages are stored up to a day, then the last days come in one by one and go on from what is stored."""
    store, bars = new_store(spark), fx.cent_bars(spark, sf_dir)
    last = [r[0] for r in bars.select("timestamp").distinct().orderBy(F.desc("timestamp")).limit(2).collect()][::-1]
    store.commit(appends={t: bars.filter(F.col("timestamp") < last[0]) for t in ("raw_bars", "bars")})
    jobs.refresh_averages(store)
    for day in last:
        jobs.insert_bars(store, bars.filter(F.col("timestamp") == day))
        jobs.refresh_averages(store)
    return whole_ema(store.wide().drop("market_state"))


@query("d01_stream_in_parts", """SELECT symbol, "timestamp", close FROM segment_bars WHERE symbol IN ('AUTOMOBILE', 'BUILDING')""", uses="segment_bars")
def stream_in_parts(spark, sf_dir):
    """Tickers in several parts each, the later days in the parts that arrive first; a second run brings one ticker more."""
    folder, store, check = scratch_dir(spark, "landing"), new_store(spark), scratch_dir(spark, "stream")
    bars = fx.segment_bars(spark, sf_dir).filter("symbol IN ('AUTOMOBILE', 'BUILDING')").persist()
    text = [F.date_format("timestamp", "yyyy-MM-dd").alias("Date"), *[F.col(c.lower()).cast("string").alias(c) for c in ("Open", "High", "Low", "Close", "Volume")]]
    universe = bars.select("symbol").distinct()
    for symbol in ("BUILDING", "AUTOMOBILE"):
        own = bars.filter(F.col("symbol") == symbol)
        for part, cut in (("late", "timestamp >= '1999-01-01'"), ("early", "timestamp < '1999-01-01'")):
            own.filter(cut).select(*text).write.option("header", "true").csv(f"{folder}/primary/{part}/ticker={symbol.lower()}.us")
        stream_increment(store, folder, universe, "2001-12-31T23:50:00", check).awaitTermination()
    bars.unpersist()
    return store.read("bars").select("symbol", "timestamp", "close")


@query("d04_append_day_listed", averages_sql(), uses="cent_bars")
def append_days_listed(spark, sf_dir):
    """As d04_append_day, for lists: a day's refresh of some symbols, then of the others, and one that finds nothing to do."""
    store, bars = new_store(spark), fx.cent_bars(spark, sf_dir)
    last = [r[0] for r in bars.select("timestamp").distinct().orderBy(F.desc("timestamp")).limit(2).collect()][::-1]
    store.commit(appends={t: bars.filter(F.col("timestamp") < last[0]) for t in ("raw_bars", "bars")})
    symbols, some = _universe(spark, sf_dir), F.col("symbol").isin("BUILDING", "MACHINERY")
    jobs.refresh_averages(store, symbols)
    for day in last:
        jobs.insert_bars(store, bars.filter(F.col("timestamp") == day))
        for listed in (symbols.filter(some), symbols.filter(~some)):
            jobs.refresh_averages(store, listed)
    if jobs.refresh_averages(store, symbols).commit is not None:
        raise AssertionError("a refresh without new bars wrote something")
    return whole_ema(store.wide().drop("market_state"))


@query("d04_after_upkeep", averages_sql(), uses="cent_bars")
def refresh_after_upkeep(spark, sf_dir):
    """Days come in one by one, with the folders put together and the buckets dealt anew between them."""
    store, bars = new_store(spark), fx.cent_bars(spark, sf_dir)
    last = [r[0] for r in bars.select("timestamp").distinct().orderBy(F.desc("timestamp")).limit(3).collect()][::-1]
    store.commit(appends={t: bars.filter(F.col("timestamp") < last[0]) for t in ("raw_bars", "bars")})
    jobs.refresh_averages(store)
    for day, upkeep in zip(last, (lambda: jobs.compact(store, most_parts=1), lambda: jobs.rebucket(store, 40), lambda: None)):
        jobs.insert_bars(store, bars.filter(F.col("timestamp") == day))
        jobs.refresh_averages(store)
        upkeep()
    return whole_ema(store.wide().drop("market_state"))


@query("d03_states_after_upkeep", _YEAR_STATES, uses="smooth_bars")
def states_after_upkeep(spark, sf_dir):
    """States stored in two runs, then dealt to other buckets."""
    store, _ = _transformed(spark, sf_dir)
    jobs.transform_states(store, _universe(spark, sf_dir), "2001-06-01")
    jobs.rebucket(store, 3)
    return store.read("bars").select("symbol", "timestamp", "close", "market_state")


@query("a01_kept_latest", """SELECT symbol, max("timestamp") AS latest, count(*) AS n, min("timestamp") FILTER ("timestamp" >= TIMESTAMP '1998-01-01') AS since
FROM cent_bars GROUP BY symbol""", uses="cent_bars")
def kept_latest(spark, sf_dir):
    """The marks of every symbol: commits in two parts, the first with its averages."""
    store, bars = new_store(spark), fx.cent_bars(spark, sf_dir)
    early = F.col("timestamp") < "1998-01-01"
    store.commit(appends={t: bars.filter(early) for t in ("raw_bars", "bars")})
    jobs.refresh_averages(store)
    jobs.insert_bars(store, bars)
    return store.marks(_universe(spark, sf_dir))
