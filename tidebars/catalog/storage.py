"""Checked queries over the snapshot tables and the joins behind their sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidebars.catalog import fixtures as fx
from tidebars.catalog.averages import ema_query, sma_sql, wma_sql
from tidebars.catalog.registry import query
from tidebars.catalog.sql import BAR
from tidebars.operators import joins
from tidebars.operators import states as st
from tidebars.operators.moving_averages import standard_averages
from tidebars.plans import jobs, views
from tidebars.schema import BAR_COLS, MA_COLS, STANDARD_PERIODS
from tidebars.session import scratch_dir
from tidebars.sources.tables import TableStore, in_range


def new_store(spark: SparkSession) -> TableStore:
    return TableStore(spark, scratch_dir(spark, "tables")).initialize()


def filled_store(spark: SparkSession, sf_dir: str) -> TableStore:
    store = new_store(spark)
    bars = fx.cent_bars(spark, sf_dir)
    store.commit(appends={"raw_bars": bars, "bars": bars})
    return store


@query("s08_range_scan", f"""SELECT {BAR} FROM cent_bars WHERE symbol = 'BUILDING'
AND "timestamp" >= TIMESTAMP '1996-05-05' AND "timestamp" <= TIMESTAMP '2000-02-02'""", uses="cent_bars")
def range_scan(spark, sf_dir):
    return filled_store(spark, sf_dir).read("bars", "BUILDING", "1996-05-05", "2000-02-02").select(*BAR_COLS)


@query("s08_scan_inside_a_year", f"""SELECT {BAR} FROM cent_bars
WHERE "timestamp" >= TIMESTAMP '1997-05-05' AND "timestamp" <= TIMESTAMP '1997-06-20 12:00:00'""", uses="cent_bars")
def scan_inside_a_year(spark, sf_dir):
    """Bars of a few weeks from a store that was filled in three inserts; the folders of other times stay closed."""
    store, bars = new_store(spark), fx.cent_bars(spark, sf_dir)
    for months in ((1, 4), (5, 8), (9, 12)):
        jobs.insert_bars(store, bars.filter(F.month("timestamp").between(*months)))
    return store.read("raw_bars", start="1997-05-05", end="1997-06-20T12:00:00")


@query("s08_part_spans", """SELECT part, year("timestamp") AS year, count(*) AS n, min("timestamp") AS first_time, max("timestamp") AS last_time
FROM cent_bars CROSS JOIN (VALUES ('raw_bars'), ('bars')) AS t(part) GROUP BY ALL""", uses="cent_bars")
def part_spans(spark, sf_dir):
    """What the store notes of its folders, put together by table and year."""
    spans = filled_store(spark, sf_dir).read("part_spans")
    year = F.regexp_extract("part", "/year=([0-9]+)/", 1).cast("long")
    return spans.groupBy(F.substring_index("part", "/", 1).alias("part"), year.alias("year")).agg(
        F.sum("n").alias("n"), F.min("first").alias("first_time"), F.max("last").alias("last_time"))


@query("s09_ordered_scan", f"""SELECT {BAR} FROM cent_bars WHERE "timestamp" >= TIMESTAMP '1997-01-01' ORDER BY symbol, "timestamp" """, uses="cent_bars")
def ordered_scan(spark, sf_dir):
    return views.ordered(filled_store(spark, sf_dir).read("bars", start="1997-01-01").select(*BAR_COLS))


@query("s10_raw_history", f"SELECT {BAR} FROM cent_bars", uses="cent_bars")
def raw_history(spark, sf_dir):
    return filled_store(spark, sf_dir).read("raw_bars")


def averages_sql(bars="cent_bars"):
    """Every bar with its standard averages, exponential ones rounded to whole cents."""
    plain = ", ".join(f"{sma_sql(p)} AS sma_{p}, {wma_sql(p)} AS wma_{p}" for p in STANDARD_PERIODS)
    smooth = ema_query(bars, {f"ema_{p}": (p, "close") for p in STANDARD_PERIODS}, 0)
    return f"""SELECT a.*, {", ".join(f"e.ema_{p}" for p in STANDARD_PERIODS)}
FROM (SELECT {BAR}, {plain} FROM {bars}) a JOIN ({smooth}) e ON a.symbol = e.symbol AND a."timestamp" = e."timestamp" """


def whole_ema(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 0) for c in df.columns if c.startswith("ema_")})


@query("s11_wide_scan", averages_sql(), uses="cent_bars")
def wide_scan(spark, sf_dir):
    store = filled_store(spark, sf_dir)
    jobs.refresh_averages(store)
    return whole_ema(store.wide().drop("market_state"))


@query("s12_insert_both", """SELECT 'raw_bars' AS part, symbol, "timestamp", close + CASE WHEN year("timestamp") > 1997 THEN 7 ELSE 0 END AS close FROM cent_bars
UNION ALL SELECT 'bars', symbol, "timestamp", close + CASE WHEN year("timestamp") > 1997 OR symbol = 'BUILDING' THEN 7 ELSE 0 END FROM cent_bars""", uses="cent_bars")
def insert_both(spark, sf_dir):
    """Early bars stored (one symbol only raw), then all bars again with other closes: stored rows stay."""
    store, bars = new_store(spark), fx.cent_bars(spark, sf_dir)
    early = bars.filter(F.year("timestamp") <= 1997)
    store.commit(appends={"raw_bars": early, "bars": early.filter(F.col("symbol") != "BUILDING")})
    jobs.insert_bars(store, bars.withColumn("close", F.col("close") + 7))
    raw, market = [store.read(t).select(F.lit(t).alias("part"), "symbol", "timestamp", "close") for t in ("raw_bars", "bars")]
    return raw.unionByName(market)


@query("s13_upsert_averages", f"""SELECT m.symbol, m."timestamp", CASE WHEN m.symbol = 'MACHINERY' THEN m.open ELSE m.open + 3 END AS open, m.close,
       {", ".join(f"m.{c}" for c in MA_COLS)} FROM ({averages_sql()}) m""", uses="cent_bars")
def upsert_averages(spark, sf_dir):
    """Stored bars keep their own open and get averages of the raw closes; unknown bars are inserted."""
    store, bars = new_store(spark), fx.cent_bars(spark, sf_dir)
    known = bars.filter(F.col("symbol") != "MACHINERY").withColumn("open", F.col("open") + 3)
    store.commit(appends={"raw_bars": bars, "bars": known})
    jobs.refresh_averages(store)
    return whole_ema(store.read("bars").select("symbol", "timestamp", "open", "close", *MA_COLS))


_WINDOW_STATES = """SELECT symbol, "timestamp", CASE WHEN p = 0 THEN 0.0 ELSE (close - p) / p END AS ret FROM (
  SELECT symbol, "timestamp", close, lag(close) OVER (PARTITION BY symbol ORDER BY "timestamp") AS p FROM smooth_bars
  WHERE "timestamp" >= TIMESTAMP '2001-06-01' - INTERVAL 365 DAY AND "timestamp" <= TIMESTAMP '2001-06-01')"""


@query("s14_state_update", f"""SELECT s.symbol, s."timestamp", s.close, CASE WHEN r.ret > 0.005 THEN 'Strong Up' WHEN r.ret > 0.001 THEN 'Slight Up'
  WHEN r.ret < -0.005 THEN 'Strong Down' WHEN r.ret < -0.001 THEN 'Slight Down' WHEN r.ret IS NOT NULL THEN 'Stable' END AS market_state
FROM smooth_bars s LEFT JOIN ({_WINDOW_STATES}) r ON s.symbol = r.symbol AND s."timestamp" = r."timestamp" """, uses="smooth_bars")
def state_update(spark, sf_dir):
    store = new_store(spark)
    store.commit(appends={"bars": fx.smooth_bars(spark, sf_dir)})
    end = dt.datetime(2001, 6, 1)
    window = store.read("bars", start=end - dt.timedelta(days=365), end=end)
    touched = store.read("bars", start=dt.datetime(2000, 1, 1), end=dt.datetime(2001, 12, 31, 23, 59))
    store.commit(replaces={"bars": joins.apply_states(touched, st.with_states(window))})
    return store.read("bars").select("symbol", "timestamp", "close", "market_state")


@query("s15_narrow_volume", f"SELECT {BAR} FROM cent_bars", uses="cent_bars")
def narrow_volume(spark, sf_dir):
    """Files written with a 32-bit volume are widened on read; creating the tables twice changes nothing."""
    store = new_store(spark)
    early = F.year("timestamp") <= 1997
    bars = fx.cent_bars(spark, sf_dir)
    store.commit(appends={"raw_bars": bars.filter(early).withColumn("volume", F.col("volume").cast("int"))})
    store.initialize().commit(appends={"raw_bars": bars.filter(~early)})
    return store.read("raw_bars")


@query("j01_new_rows", f"SELECT {BAR} FROM cent_bars WHERE NOT (year(\"timestamp\") <= 1997 AND symbol <> 'FURNITURE')", uses="cent_bars")
def new_rows(spark, sf_dir):
    bars = fx.cent_bars(spark, sf_dir)
    stored = bars.filter((F.year("timestamp") <= 1997) & (F.col("symbol") != "FURNITURE"))
    return joins.new_rows(bars, stored).select(*BAR_COLS)


@query("j01_existing_keys", "SELECT symbol, \"timestamp\" FROM part_bars WHERE volume > 20 AND close > 3000000", uses="part_bars")
def existing_keys(spark, sf_dir):
    bars = fx.part_bars(spark, sf_dir)
    return joins.existing_keys(bars.filter(F.col("volume") > 20), bars.filter(F.col("close") > 3_000_000))


@query("j02_full_outer", f"""SELECT coalesce(b.symbol, a.symbol) AS symbol, coalesce(b."timestamp", a."timestamp") AS "timestamp",
       coalesce(b.open, a.open) AS open, coalesce(b.volume, a.volume) AS volume, a.sma_5, a.wma_5
FROM (SELECT * FROM part_bars WHERE volume > 10) b FULL JOIN (
  SELECT {BAR}, {sma_sql(5)} AS sma_5, {wma_sql(5)} AS wma_5 FROM part_bars WHERE volume < 40) a
ON a.symbol = b.symbol AND a."timestamp" = b."timestamp" """, uses="part_bars")
def full_outer(spark, sf_dir):
    bars = fx.part_bars(spark, sf_dir)
    averages = standard_averages(bars.filter(F.col("volume") < 40), [5])
    empty = {c: F.lit(None).cast("double") for c in ("sma_5", "ema_5", "wma_5")}
    merged = joins.upsert_averages(bars.filter(F.col("volume") > 10).withColumns(empty), averages, list(empty))
    return merged.select("symbol", "timestamp", "open", "volume", "sma_5", "wma_5")


@query("p18_keep_old_average", """SELECT symbol, "timestamp", CASE WHEN volume % 2 = 0 THEN close * 2 ELSE 1.0 END AS sma_5 FROM part_bars""", uses="part_bars")
def keep_old_average(spark, sf_dir):
    bars = fx.part_bars(spark, sf_dir)
    value = F.when(F.col("volume") % 2 == 0, F.col("close") * 2).when(F.col("volume") % 3 == 0, float("nan"))
    merged = joins.upsert_averages(bars.withColumn("sma_5", F.lit(1.0)), bars.withColumn("sma_5", value), ["sma_5"])
    return merged.select("symbol", "timestamp", "sma_5")


@query("j03_apply_states", """SELECT b.symbol, b."timestamp", coalesce(s.state, 'old') AS market_state
FROM smooth_bars b LEFT JOIN states s ON b.symbol = s.symbol AND b."timestamp" = s."timestamp" """, uses="smooth_bars states")
def apply_states(spark, sf_dir):
    bars = fx.smooth_bars(spark, sf_dir)
    applied = joins.apply_states(bars.withColumn("market_state", F.lit("old")), st.with_states(bars))
    return applied.select("symbol", "timestamp", "market_state")


@query("a11_row_counts", """SELECT 'raw_bars' AS part, count(*) AS n FROM cent_bars WHERE year("timestamp") <= 1997
UNION ALL SELECT 'bars', count(*) FROM cent_bars""", uses="cent_bars")
def row_counts(spark, sf_dir):
    bars = fx.cent_bars(spark, sf_dir)
    commit = new_store(spark).commit(appends={"raw_bars": bars.filter(F.year("timestamp") <= 1997), "bars": bars})
    return spark.createDataFrame(list(commit.rows.items()), "part string, n long")


@query("d05_price_view", """SELECT "timestamp", open, high, low, close, volume, CAST(NULL AS VARCHAR) AS market_state FROM cent_bars
WHERE symbol = 'HOUSEHOLD' AND "timestamp" >= TIMESTAMP '1997-01-01' AND "timestamp" < TIMESTAMP '1999-07-01' ORDER BY "timestamp" """, uses="cent_bars")
def price_view(spark, sf_dir):
    return views.price_view(filled_store(spark, sf_dir), "HOUSEHOLD", dt.date(1997, 1, 1), dt.date(1999, 6, 30))


@query("d06_live_view", f"""SELECT s.*, e.disp_ema_7, e.disp_ema_21, e.disp_ema_60 FROM (
  SELECT symbol, "timestamp", {sma_sql(7)} AS disp_sma_7, {sma_sql(21)} AS disp_sma_21, {sma_sql(60)} AS disp_sma_60 FROM cent_bars) s
JOIN ({ema_query("cent_bars", {f"disp_ema_{p}": (p, "close") for p in (7, 21, 60)}, 0)}) e
ON s.symbol = e.symbol AND s."timestamp" = e."timestamp" """, uses="cent_bars")
def live_view(spark, sf_dir):
    out = views.live_averages_view(filled_store(spark, sf_dir))
    return out.select("symbol", "timestamp", *[f"disp_sma_{p}" for p in (7, 21, 60)],
                      *[F.round(f"disp_ema_{p}", 0).alias(f"disp_ema_{p}") for p in (7, 21, 60)])


@query("d06_stored_view", f"SELECT * EXCLUDE (symbol) FROM ({averages_sql()}) WHERE symbol = 'FURNITURE'", uses="cent_bars")
def stored_view(spark, sf_dir):
    store = filled_store(spark, sf_dir)
    jobs.refresh_averages(store)
    bars, filled = views.stored_averages_view(store, "FURNITURE")
    names = [r.column_name for r in filled.collect()]
    return whole_ema(bars.select(*[c for c in BAR_COLS if c != "symbol"], *[c for c in MA_COLS if c in names]))
