"""Checked queries over landed files: scans, candidate names, fetch plan, chunks and source choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidebars.catalog import fixtures as fx
from tidebars.catalog.registry import query
from tidebars.operators.quality import coerce
from tidebars.plans import jobs
from tidebars.session import scratch_dir
from tidebars.sources import landing as landed
from tidebars.sources.tables import TableStore

START, END = "1995-01-01", "2001-12-31"

# Fixed values of the scenario, for the long range START..END: source, ticker, symbol, volume offset, first year.
SCENARIO = [
    ("primary", "automobile.us", "AUTOMOBILE", 1000, 1995),
    ("primary", "automobile", "AUTOMOBILE", 2000, 1995),
    ("primary", "building", "BUILDING", 3000, 1995),
    ("secondary", "automobile", "AUTOMOBILE", 4000, 1995),
    ("secondary", "furniture", "FURNITURE", 5000, 1995),
    ("secondary", "household", "HOUSEHOLD", 6000, 1995),
    ("secondary", "machinery", "MACHINERY", 7000, 2000),
]


def land_scenario(spark: SparkSession, sf_dir: str) -> str:
    """Write vendor files: a suffixed and a bare primary file, a primary file outside the range, one with
    an unreadable date, secondary files, and one that lacks a chunk."""
    folder = scratch_dir(spark, "landing")
    bars = fx.segment_bars(spark, sf_dir).persist()

    def text(df: DataFrame, ticker: str, offset: int, layout: list[str], shift_years: int = 0) -> DataFrame:
        day = F.add_months(F.col("timestamp").cast("date"), 12 * shift_years)
        values = {"Date": F.date_format(day, "yyyy-MM-dd"), "Open": F.col("open"), "High": F.col("high"), "Low": F.col("low"),
                  "Close": F.col("close"), "Adj Close": F.col("close") / 2, "Volume": F.col("volume") + offset}
        return df.select(F.lit(ticker).alias("ticker"), *[values[c].cast("string").alias(c) for c in layout])

    frames = {"primary": [], "secondary": []}
    for source, ticker, symbol, offset, first_year in SCENARIO:
        layout = landed.PRIMARY_LAYOUT if source == "primary" else landed.SECONDARY_LAYOUT
        own = bars.filter((F.col("symbol") == symbol) & (F.year("timestamp") >= first_year))
        frames[source].append(text(own, ticker, offset, layout))
    furniture = bars.filter(F.col("symbol") == "FURNITURE")
    frames["primary"].append(text(furniture, "furniture.us", 8000, landed.PRIMARY_LAYOUT, shift_years=-20))
    household = text(bars.filter(F.col("symbol") == "HOUSEHOLD"), "household.us", 9000, landed.PRIMARY_LAYOUT)
    broken_day = F.when(F.col("Date").endswith("-01-02"), "no date").otherwise(F.col("Date"))
    frames["primary"].append(household.withColumn("Date", broken_day))
    for source, parts in frames.items():
        stacked = parts[0]
        for part in parts[1:]:
            stacked = stacked.unionByName(part)
        stacked.write.partitionBy("ticker").option("header", "true").csv(f"{folder}/{source}")
    bars.unpersist()
    return folder


def _union_sql(source):
    return " UNION ALL ".join(
        f"SELECT '{ticker}' AS stem, \"timestamp\", open, high, low, close, volume + {offset} AS volume FROM segment_bars "
        f"WHERE symbol = '{symbol}' AND year(\"timestamp\") >= {first}"
        for s, ticker, symbol, offset, first in SCENARIO if s == source
    )


def _typed(rows: DataFrame) -> DataFrame:
    return coerce(rows.withColumn("symbol", F.col("stem")), ("stem",)).drop("symbol")


@query("s01_primary_scan", f"""{_union_sql("primary")}
UNION ALL SELECT 'furniture.us', "timestamp" - INTERVAL 20 YEAR, open, high, low, close, volume + 8000 FROM segment_bars WHERE symbol = 'FURNITURE'
UNION ALL SELECT 'household.us', "timestamp", open, high, low, close, volume + 9000 FROM segment_bars
WHERE symbol = 'HOUSEHOLD' AND strftime("timestamp", '%m-%d') <> '01-02'""", uses="segment_bars")
def primary_scan(spark, sf_dir):
    path = f"{land_scenario(spark, sf_dir)}/primary"
    return _typed(landed.scan_landing(spark, path, landed.PRIMARY))


@query("s03_secondary_scan", _union_sql("secondary"), uses="segment_bars")
def secondary_scan(spark, sf_dir):
    path = f"{land_scenario(spark, sf_dir)}/secondary"
    return _typed(landed.scan_landing(spark, path, landed.SECONDARY))


_NAMES_SQL = "SELECT DISTINCT c_mktsegment || CASE WHEN c_nationkey % 3 = 0 THEN '.DE' WHEN c_nationkey % 3 = 1 THEN '.X' ELSE '' END AS symbol FROM customer"


@query("s02_candidates", f"""WITH names AS ({_NAMES_SQL}), tagged AS (
  SELECT symbol, lower(symbol) AS low, regexp_matches(lower(symbol), '\\.(us|de|pl|jp)$') AS suffixed FROM names)
SELECT symbol, 0 AS source_rank, 0 AS pos, CASE WHEN suffixed THEN low ELSE low || '.us' END AS stem FROM tagged
UNION ALL SELECT symbol, 0, 1, low FROM tagged WHERE NOT suffixed
UNION ALL SELECT symbol, 1, 0, low FROM tagged""")
def candidates(spark, sf_dir):
    nation = F.col("c_nationkey") % 3
    suffix = F.when(nation == 0, ".DE").when(nation == 1, ".X").otherwise("")
    names = fx.table(spark, sf_dir, "customer").select(F.concat("c_mktsegment", suffix).alias("symbol")).distinct()
    return landed.candidates(names)


def _scenario_plan(spark, sf_dir, start=START):
    universe = fx.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("symbol")).distinct()
    nothing = spark.createDataFrame([], "symbol string, latest timestamp_ntz")
    return landed.fetch_plan(universe, nothing, END, start)


def _fetched(spark, sf_dir, start=START):
    rows = landed.landed_rows(landed.scan_sources(spark, land_scenario(spark, sf_dir)))
    fetched = landed.fetch(rows, _scenario_plan(spark, sf_dir, start))
    return coerce(fetched, ("source_rank",))


# What each symbol must be read from: the ``.us`` file before the bare one, the secondary where the primary
# is out of range or unreadable, and nothing for the symbol that lacks its first chunk.
_CHOSEN = """SELECT 0 AS source_rank, symbol, "timestamp", open, high, low, close, volume + 1000 AS volume FROM segment_bars WHERE symbol = 'AUTOMOBILE'
UNION ALL SELECT 0, symbol, "timestamp", open, high, low, close, volume + 3000 FROM segment_bars WHERE symbol = 'BUILDING'
UNION ALL SELECT 1, symbol, "timestamp", open, high, low, close, volume + 5000 FROM segment_bars WHERE symbol = 'FURNITURE'
UNION ALL SELECT 1, symbol, "timestamp", open, high, low, close, volume + 6000 FROM segment_bars WHERE symbol = 'HOUSEHOLD'"""


@query("s04_source_choice", _CHOSEN, uses="segment_bars")
def source_choice(spark, sf_dir):
    return _fetched(spark, sf_dir)


@query("s06_chunk_gate", f"""SELECT symbol, source_rank, count(*) AS n FROM ({_CHOSEN}) GROUP BY ALL""", uses="segment_bars")
def chunk_gate(spark, sf_dir):
    return _fetched(spark, sf_dir).groupBy("symbol", "source_rank").agg(F.count(F.lit(1)).alias("n"))


@query("s04_short_range", f"""SELECT * FROM ({_CHOSEN}) WHERE "timestamp" >= TIMESTAMP '1999-03-01'
UNION ALL SELECT 1, symbol, "timestamp", open, high, low, close, volume + 7000 FROM segment_bars
WHERE symbol = 'MACHINERY' AND year("timestamp") >= 2000""", uses="segment_bars")
def short_range(spark, sf_dir):
    return _fetched(spark, sf_dir, "1999-03-01")


@query("s05_chunks", """WITH plan AS (
  SELECT c_name AS symbol, min(o_orderdate) AS s, max(o_orderdate) AS e, date_diff('day', min(o_orderdate), max(o_orderdate)) AS days
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_name), starts AS (
  SELECT *, unnest(CASE WHEN days > 1825 THEN generate_series(0, days // 1826) ELSE [0] END) AS chunk FROM plan)
SELECT symbol, chunk, CAST(s + to_days(CAST(chunk * 1826 AS INTEGER)) AS TIMESTAMP) AS chunk_start,
       CAST(CASE WHEN days > 1825 THEN least(s + to_days(CAST(chunk * 1826 + 1825 AS INTEGER)), e) ELSE e END AS TIMESTAMP) AS chunk_end
FROM starts""")
def chunks(spark, sf_dir):
    customer = fx.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("symbol"))
    spans = fx.table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("symbol").agg(
        F.min("o_orderdate").cast("timestamp_ntz").alias("start_ts"), F.max("o_orderdate").cast("timestamp_ntz").alias("end_ts")
    )
    return landed.chunks(spans).withColumn("chunk", F.col("chunk").cast("bigint"))


@query("s07_universe", "SELECT DISTINCT c_name AS symbol FROM customer")
def universe(spark, sf_dir):
    path = scratch_dir(spark, "tickers")
    names = fx.table(spark, sf_dir, "customer").select("c_name", "c_custkey")
    line = F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit(" \t"), "c_name", F.lit("  "))).otherwise(F.col("c_name"))
    names.select(F.explode(F.array(line, F.lit(" "), F.col("c_name"))).alias("value")).write.text(path)
    return landed.read_universe(spark, path)


_LATEST = """SELECT c_name AS symbol, max(o_orderdate) AS latest FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_name"""


def _plan(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").cast("timestamp_ntz").alias("latest"))
    customer = fx.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("symbol"))
    latest = customer.join(orders, F.col("o_custkey") == F.col("c_custkey")).select("symbol", "latest")
    return landed.fetch_plan(customer.select("symbol"), latest, "2001-06-30T12:00:00")


@query("p12_next_start", f"""SELECT symbol, CAST(coalesce(date_trunc('day', latest + INTERVAL 1 DAY), TIMESTAMP '1980-01-01') AS TIMESTAMP) AS start_ts,
       TIMESTAMP '2001-06-30' AS end_ts FROM ({_LATEST})
WHERE latest IS NULL OR latest + INTERVAL 1 DAY <= TIMESTAMP '2001-06-30 12:00:00'""")
def next_start(spark, sf_dir):
    return _plan(spark, sf_dir)


@query("p13_up_to_date", f"SELECT symbol FROM ({_LATEST}) WHERE latest + INTERVAL 1 DAY > TIMESTAMP '2001-06-30 12:00:00'")
def up_to_date(spark, sf_dir):
    customer = fx.table(spark, sf_dir, "customer").select(F.col("c_name").alias("symbol"))
    return customer.join(_plan(spark, sf_dir), "symbol", "left_anti")


@query("s04_bad_file", """SELECT symbol, "timestamp", close, CAST(NULL AS VARCHAR) AS reason FROM segment_bars WHERE symbol IN ('AUTOMOBILE', 'BUILDING')
UNION ALL SELECT 'FURNITURE', CAST(NULL AS TIMESTAMP), CAST(NULL AS DOUBLE), 'unreadable_file'
UNION ALL SELECT 'HOUSEHOLD', CAST(NULL AS TIMESTAMP), CAST(NULL AS DOUBLE), 'empty'
UNION ALL SELECT 'MACHINERY', CAST(NULL AS TIMESTAMP), CAST(NULL AS DOUBLE), 'unreadable_file'""", uses="segment_bars")
def bad_file(spark, sf_dir):
    """One file without data, one with a wrong header and one that is empty, beside files with usual and swapped columns."""
    folder, bars = scratch_dir(spark, "landing"), fx.segment_bars(spark, sf_dir)
    cells = {"Date": F.date_format("timestamp", "yyyy-MM-dd"), "Open": F.col("open"), "High": F.col("high"), "Low": F.col("low"),
             "Close": F.col("close"), "Volume": F.col("volume")}
    for ticker, order in (("automobile.us", ["Date", "Open", "High", "Low", "Close", "Volume"]), ("building", ["Volume", "Close", "Low", "High", "Open", "Date"])):
        own = bars.filter(F.col("symbol") == ticker.split(".")[0].upper())
        names = [("Datetime" if n == "Date" and ticker == "building" else n) for n in order]
        own.select(*[cells[n].cast("string").alias(m) for n, m in zip(order, names)]).write.option("header", "true").csv(f"{folder}/primary/ticker={ticker}")
    for ticker, text in (("furniture.us", "No data"), ("machinery.us", "a,b,c\n1,2,3"), ("household.us", "")):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/primary/ticker={ticker}")
    universe = fx.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("symbol")).distinct()
    store = TableStore(spark, scratch_dir(spark, "tables")).initialize()
    result = jobs.daily_increment(store, folder, universe, END)
    stored = store.read("bars").select("symbol", "timestamp", "close", F.lit(None).cast("string").alias("reason"))
    failed = result.status.filter("reason IS NOT NULL").select("symbol", F.lit(None).cast("timestamp_ntz").alias("timestamp"),
                                                               F.lit(None).cast("double").alias("close"), "reason")
    return stored.unionByName(failed)


@query("a02_parts_in_order", """SELECT symbol, "timestamp", close FROM segment_bars WHERE symbol = 'BUILDING'""", uses="segment_bars")
def parts_in_order(spark, sf_dir):
    """A ticker in two parts with the same days: the first part counts, though the second is larger."""
    folder, bars = scratch_dir(spark, "landing"), fx.segment_bars(spark, sf_dir).filter("symbol = 'BUILDING'")
    text = [F.date_format("timestamp", "yyyy-MM-dd").alias("Date"), *[F.col(c.lower()).cast("string").alias(c) for c in ("Open", "High", "Low")]]
    for part, close, padding in (("a", F.col("close"), ""), ("b", F.lit(-1.0), " " * 40)):
        own = bars.select(*text, close.cast("string").alias("Close"), F.concat("volume", F.lit(padding)).alias("Volume"))
        own.coalesce(1).write.option("header", "true").option("ignoreTrailingWhiteSpace", "false").csv(f"{folder}/primary/{part}/ticker=building")
    store = TableStore(spark, scratch_dir(spark, "tables")).initialize()
    jobs.daily_increment(store, folder, bars.select("symbol").distinct(), END)
    return store.read("raw_bars").select("symbol", "timestamp", "close")
