"""Landed vendor files, ranked source choice and the long-range fetch plan.

Layout: ``<landing>/primary`` and ``<landing>/secondary`` hold one CSV per ticker (``aapl.us.csv``)
or one folder per ticker (``ticker=aapl.us/part-*.csv``).

A file is read by its own first line, whatever the order of its columns. One whose first line does not
name a time and the five value columns is unusable: it yields no rows and leaves other files alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from tidebars.functions.scalars import candidate_stems, strip, to_bar_time
from tidebars.functions.times import time_literal
from tidebars.operators.quality import TIME_HEADERS, VENDOR_HEADERS
from tidebars.schema import CHUNK_DAYS, DEFAULT_START

# CSV headers of the two vendor layouts.
PRIMARY_LAYOUT = ["Date", "Open", "High", "Low", "Close", "Volume"]
SECONDARY_LAYOUT = ["Date", "Open", "High", "Low", "Close", "Adj Close", "Volume"]
PRIMARY, SECONDARY = 0, 1

# Columns of a file that are looked at; vendor files have eight at most.
WIDEST = 16
# Order of landed lines: file, block of it, line.
LINE_ORDER = ["path", "block", "line"]
CSV_OPTIONS = {"header": "false", "recursiveFileLookup": "true"}
FILE_SCHEMA = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(WIDEST)])
LINES = "cells array<string>, path string, stem string, block bigint, source_rank int"


def _stem(path: Column) -> Column:
    """Ticker stem of a landed path: the file name, or the ``ticker=`` folder."""
    decoded = F.url_decode(path)
    folder = F.regexp_extract(decoded, r"/ticker=([^/]+)/[^/]*$", 1)
    file = F.regexp_extract(decoded, r"/([^/]+?)(\.csv)?$", 1)
    return F.lower(F.when(folder != "", folder).otherwise(file))


def file_lines(raw: DataFrame, rank: int) -> DataFrame:
    """Lines of files read with ``FILE_SCHEMA``, as text cells, with their file, ticker stem and block."""
    path = F.col("_metadata.file_path")
    return raw.select(F.array(*FILE_SCHEMA.names).alias("cells"), path.alias("path"), _stem(path).alias("stem"),
                      F.col("_metadata.file_block_start").alias("block"), F.lit(rank).alias("source_rank"))


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, stem) of the files of one source, from their listing alone; no folder, no files."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, stem string")
    return files.select("path", _stem(F.col("_metadata.file_path")).alias("stem"))


def scan_lines(spark: SparkSession, path: str, rank: int, wanted: DataFrame | None = None) -> DataFrame:
    """Lines of one source; no folder, no lines. ``wanted`` (stem, source_rank): only the files of these stems are opened.

    The driver holds the paths that are read, as Spark itself does.
    """
    paths: str | list[str] = path
    if wanted is not None:
        stems = wanted.filter(F.col("source_rank") == rank).select("stem").distinct()
        found = landed_files(spark, path).join(stems, "stem", "left_semi").select(F.regexp_replace("path", r"([\[\]{}*?\\])", r"\\$1"))
        paths = [r[0] for r in found.collect()]
        if not paths:
            return spark.createDataFrame([], LINES)
    try:
        raw = spark.read.schema(FILE_SCHEMA).options(**CSV_OPTIONS).csv(paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LINES)
    return file_lines(raw, rank)


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``line``, increasing within a block of a file; apply before anything that shuffles."""
    return lines.withColumn("line", F.monotonically_increasing_id())


def scan_sources(spark: SparkSession, landing: str, wanted: DataFrame | None = None) -> DataFrame:
    """Numbered lines of both landed sources, of the ``wanted`` (stem, source_rank) alone if given; source names follow the
    folder names."""
    primary = scan_lines(spark, f"{landing}/primary", PRIMARY, wanted)
    return number_lines(primary.unionByName(scan_lines(spark, f"{landing}/secondary", SECONDARY, wanted)))


def _heads(lines: DataFrame) -> DataFrame:
    """First line of every file and where it has each bar column, 0 where it lacks it."""
    first = lines.filter(F.col("block") == 0).groupBy("path", "stem", "source_rank").agg(F.min_by("cells", "line").alias("head"))
    names = F.transform("head", lambda c: F.regexp_replace(c, r"^[\ufeff\s]+|\s+$", ""))
    at = lambda wanted: F.coalesce(F.array_position(F.col("names"), wanted), F.lit(0)).cast("int")
    time = F.coalesce(*[F.nullif(at(h), F.lit(0)) for h in TIME_HEADERS], F.lit(0))
    places = {bar: at(vendor).alias(bar) for vendor, bar in VENDOR_HEADERS.items()}
    return first.withColumn("names", names).select(
        "path", "stem", "source_rank", "head", F.struct(time.alias("timestamp"), *places.values()).alias("at"))


def _readable() -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"at.{c}") > 0 for c in ("timestamp", *VENDOR_HEADERS.values())])


def landed_rows(lines: DataFrame) -> DataFrame:
    """Text bars of the readable files among numbered ``lines`` (no symbol yet)."""
    heads = _heads(lines).filter(_readable()).select("path", "head", "at")
    rows = lines.join(heads, "path").filter(~F.col("cells").eqNullSafe(F.col("head")))
    bar = [F.element_at("cells", F.col(f"at.{c}")).alias(c) for c in ("timestamp", *VENDOR_HEADERS.values())]
    return rows.select(*bar, "stem", "source_rank", *LINE_ORDER)


def unreadable_files(lines: DataFrame) -> DataFrame:
    """(path, stem, source_rank) of the files whose first line is no bar header."""
    return _heads(lines).filter(~_readable()).select("path", "stem", "source_rank")


def scan_landing(spark: SparkSession, path: str, rank: int) -> DataFrame:
    """Text bars of one source."""
    return landed_rows(number_lines(scan_lines(spark, path, rank)))


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """Ticker list: one symbol per line, blank lines and repeats ignored, no file means no symbols."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string")
    return lines.select(strip(F.col("value")).alias("symbol")).filter(F.length("symbol") > 0).distinct()


def candidates(universe: DataFrame, *keep: str) -> DataFrame:
    """(symbol, source_rank, pos, stem, ...): the file stems that may hold a symbol, in order of trial."""
    def tries(rank: int, stems: Column) -> Column:
        return F.transform(stems, lambda s, i: F.struct(F.lit(rank).alias("source_rank"), i.alias("pos"), s.alias("stem")))

    everything = F.concat(
        tries(PRIMARY, candidate_stems(F.col("symbol"))), tries(SECONDARY, F.array(F.lower("symbol")))
    )
    return universe.select("symbol", *keep, F.explode(everything).alias("c")).select("symbol", *keep, "c.*")


def fetch_plan(universe: DataFrame, latest: DataFrame, run_end, default_start: str | None = DEFAULT_START) -> DataFrame:
    """(symbol, start_ts, end_ts): from the day after the latest stored bar, or ``default_start``, to
    the day of the run. Symbols already up to date are left out; a null start means open."""
    end = time_literal(run_end)
    following = F.col("latest") + F.expr("INTERVAL 1 DAY")
    planned = universe.select("symbol").join(latest.select("symbol", "latest"), "symbol", "left")
    return planned.filter(F.col("latest").isNull() | (following <= end)).select(
        "symbol",
        F.coalesce(following.cast("date"), F.lit(default_start).cast("date")).cast("timestamp_ntz").alias("start_ts"),
        end.cast("date").cast("timestamp_ntz").alias("end_ts"),
    )


def next_day(day: Column, n: int = 1) -> Column:
    return F.date_add(day.cast("date"), n)


def _days() -> Column:
    return F.datediff(F.col("end_ts").cast("date"), F.col("start_ts").cast("date"))


def _chunk_count() -> Column:
    """Chunks of a range: one if it is short or open."""
    return F.when(_days() > CHUNK_DAYS, F.floor(_days() / (CHUNK_DAYS + 1)) + 1).otherwise(F.lit(1)).cast("int")


def _chunk_number(day: Column) -> Column:
    """The chunk of a day in the range, so that rows meet their chunk without a range join."""
    past = F.datediff(day.cast("date"), F.col("start_ts").cast("date"))
    return F.when(F.col("n_chunks") > 1, F.floor(past / (CHUNK_DAYS + 1))).otherwise(F.lit(0)).cast("int")


def chunks(plan: DataFrame) -> DataFrame:
    """Inclusive chunks of at most 1825 days after their first day; one chunk for a short or open range."""
    numbered = plan.withColumn("n_chunks", _chunk_count()).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
    start = next_day(F.col("start_ts"), F.col("chunk") * (CHUNK_DAYS + 1))
    last = F.col("end_ts").cast("date")
    end = F.when(F.col("n_chunks") > 1, F.least(next_day(start, CHUNK_DAYS), last)).otherwise(last)
    return numbered.select("symbol", "chunk", start.cast("timestamp_ntz").alias("chunk_start"), end.cast("timestamp_ntz").alias("chunk_end"))


def targets(plan: DataFrame) -> DataFrame:
    """The candidates of every planned symbol with its range and the number of chunks to fill."""
    return candidates(plan.withColumn("n_chunks", _chunk_count()), "start_ts", "end_ts", "n_chunks")


def wanted_lines(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """Lines of the files that may be read, so that no others are parsed further."""
    return lines.join(wanted.select("stem", "source_rank").distinct(), ["stem", "source_rank"], "left_semi").select(*lines.columns)


def _in_range() -> Column:
    ts, lo, hi = F.col("_ts"), F.col("start_ts"), F.col("end_ts")
    return ts.isNotNull() & (lo.isNull() | (ts >= lo)) & (hi.isNull() | (ts <= hi))


def choose_sources(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The one file each symbol is read from, as rows of ``wanted``; symbols without one are absent.

    The first primary candidate with rows in the range wins. Failing that the secondary source is
    taken if every chunk of the range has rows. A primary file with an unreadable date is passed over.
    Sources are never mixed. Rows are counted before anything of theirs is shuffled.
    """
    blank = F.coalesce(strip(F.col("timestamp")), F.lit("")) == ""
    file = ["symbol", "source_rank", "pos", "stem", "start_ts", "end_ts", "n_chunks"]
    per_chunk = (
        rows.select("stem", "source_rank", "timestamp", _row_time().alias("_ts"))
        .join(wanted, ["stem", "source_rank"])
        .groupBy(*file, F.when(_in_range(), _chunk_number(F.col("_ts"))).alias("chunk"))
        .agg(F.bool_or(F.col("_ts").isNull() & ~blank).alias("unreadable"))
    )
    per_file = per_chunk.groupBy(*file).agg(F.count("chunk").alias("filled"), F.bool_or("unreadable").alias("unreadable"))
    usable = F.when(
        F.col("source_rank") == PRIMARY, (F.col("filled") > 0) & ~F.col("unreadable")
    ).otherwise(F.col("filled") == F.col("n_chunks"))
    first = F.min_by(F.struct("source_rank", "pos", "stem", "start_ts", "end_ts"), F.struct("source_rank", "pos"))
    return per_file.filter(usable).groupBy("symbol").agg(first.alias("f")).select("symbol", "f.*")


def _row_time() -> Column:
    return to_bar_time(F.col("timestamp"), T.StringType())


def fetch(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Text bars of the planned symbols from their chosen file, within the planned range."""
    return (
        rows.withColumn("_ts", _row_time())
        .join(choose_sources(rows, targets(plan)).drop("pos"), ["stem", "source_rank"])
        .filter(_in_range())
        .select("symbol", "timestamp", "open", "high", "low", "close", "volume", "source_rank", *LINE_ORDER)
    )
