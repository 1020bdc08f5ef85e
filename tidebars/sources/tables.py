"""Snapshot tables on plain parquet with one atomic commit over several tables.

Bars lie in cells of a year and a bucket of symbols, in folders below a folder per version. A manifest
lists, for every table and cell, the folders that make up the current state. An insert adds a folder to
the cells it touches (``plans.jobs.compact`` puts folders together); an update writes the touched folders
anew, and neither changes a file that a reader may be using. One symbol is read from its bucket alone.
Publishing a manifest is one rename that fails if the version exists, so all tables of a commit appear
together or not at all, a job that dies leaves only unlisted folders, and of two writers the later one fails.

Tables with a row per symbol have a cell per bucket. One of them, ``symbol_marks``, is brought up to date by
the same commit that adds raw bars, so the latest bar of a symbol and whether it has bars without averages
are known without a look at the bars. The manifest also says which folders of bars are settled: every bar with a
usable close in them has its averages.

``part_spans`` has a row for each folder of bars: its number of rows, its first and its last time. It comes from the pass over
the written keys that looks for repeated ones, and tells which folders a range of times needs, which can hold a key of an
insert, and how many rows an update has to keep; no file is opened to learn this.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidebars.functions.times import as_time, time_literal
from tidebars.operators.joins import restrict
from tidebars.operators.quality import duplicate_sample
from tidebars.operators.sorted_keys import judged_cells, stretches
from tidebars.schema import BAR_COLS, KEY, MA_COLS, SPANS_SCHEMA, TABLE_SCHEMAS
from tidebars.session import small_frame

WHOLE = "all"
WHOLE_TABLES = ("transition_probs", "part_spans")
SYMBOL_TABLES = ("symbol_marks", "average_tails")
BAR_TABLES = ("raw_bars", "bars", "bar_states")
NO_YEAR = 0  # of the cells of a symbol table

BUCKETS = 16  # of symbols; ``plans.jobs.rebucket`` changes the number
# Averages hardly ever repeat, so building dictionaries for them is wasted work.
WRITE_OPTIONS = {"compression": "zstd", **{f"parquet.enable.dictionary#{c}": "false" for c in MA_COLS}}


class CommitError(RuntimeError):
    """A commit was refused; the tables are as they were."""


def in_range(df: DataFrame, start=None, end=None) -> DataFrame:
    """Inclusive time range, either bound optional."""
    if start is not None:
        df = df.filter(F.col("timestamp") >= time_literal(start))
    if end is not None:
        df = df.filter(F.col("timestamp") <= time_literal(end))
    return df


def one_symbol(df: DataFrame, symbol: str) -> DataFrame:
    return df.filter(F.col("symbol") == symbol)


def cell_place(cell: str) -> tuple[int, int]:
    """(year, bucket) of a cell."""
    year, bucket = cell.split("/")
    return int(year), int(bucket)


def latest_times(raw_bars: DataFrame) -> DataFrame:
    """Latest stored timestamp of every symbol."""
    return raw_bars.groupBy("symbol").agg(F.max("timestamp").alias("latest"))


def usable(close: Column) -> Column:
    """Whether averages count a bar with this close."""
    return F.coalesce((F.abs(close) < float("inf")) & ~F.isnan(close), F.lit(False))


def _with_states(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The frames to write, with the states of bars in a frame of their own."""
    bars = frames.get("bars")
    if bars is None or "market_state" not in bars.columns:
        return frames
    return frames | {"bar_states": bars.filter(F.col("market_state").isNotNull()).select(*KEY, "market_state")}


@dataclass(frozen=True)
class Span:
    """Rows of a folder of bars, its first and its last time."""

    n: int
    first: dt.datetime
    last: dt.datetime

    def meets(self, first: dt.datetime | None, last: dt.datetime | None) -> bool:
        return (first is None or self.last >= first) and (last is None or self.first <= last)


@dataclass(frozen=True)
class Commit:
    version: int
    rows: dict[str, int]


class TableStore:
    """The tables of ``schema.TABLE_SCHEMAS`` below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._spans: tuple[int, dict[str, Span]] = (-1, {})
        hadoop = spark._jvm.org.apache.hadoop
        self._path = hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- manifest ---------------------------------------------------------------------------

    def initialize(self, buckets: int = BUCKETS) -> "TableStore":
        """Create the tables, empty, unless they exist. Take more ``buckets`` the more symbols there are."""
        if self.manifest()["version"] < 0:
            self._publish(0, {name: {} for name in TABLE_SCHEMAS}, buckets, [])
        return self

    def manifest(self) -> dict:
        folder = self._path(f"{self.root}/_manifests")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        versions = sorted(n for n in names if n.endswith(".json") and not n.startswith((".", "_")))
        if not versions:
            return {"version": -1, "buckets": BUCKETS, "tables": {name: {} for name in TABLE_SCHEMAS}, "settled": []}
        stream = self._fs.open(self._path(f"{self.root}/_manifests/{versions[-1]}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, version: int, tables: dict, buckets: int, settled: Iterable[str]) -> None:
        jvm = self.spark._jvm
        final = self._path(f"{self.root}/_manifests/{version:010d}.json")
        draft = self._path(f"{self.root}/_manifests/_draft-{version:010d}-{id(self)}-{dt.datetime.now().timestamp()}")
        out = self._fs.create(draft, True)
        held = {p for cells in tables.values() for parts in cells.values() for p in parts}
        content = {"version": version, "buckets": buckets, "tables": tables, "settled": sorted(held.intersection(settled))}
        out.write(bytearray(json.dumps(content, indent=1).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            final.toUri(), self.spark._jsc.hadoopConfiguration()
        )
        no_options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(final), no_options)
        except Exception as error:
            raise CommitError(f"version {version} was published by another writer") from error

    # -- reading ----------------------------------------------------------------------------

    def spans(self, manifest: dict | None = None) -> dict[str, Span]:
        """``part_spans`` of the folders of a manifest, which names each of them already."""
        manifest = manifest or self.manifest()
        if self._spans[0] != manifest["version"]:
            paths = [f"{self.root}/{p}" for p in manifest["tables"].get("part_spans", {}).get(WHOLE, [])]
            held = self.spark.read.schema(SPANS_SCHEMA).parquet(*paths).collect() if paths else []
            self._spans = manifest["version"], {r.part: Span(r.n, r.first, r.last) for r in held}
        return self._spans[1]

    def row_count(self, table: str) -> int:
        """Stored rows of a table."""
        manifest = self.manifest()
        return self._rows_in(table, manifest["tables"].get(table, {}), self.spans(manifest))

    def _rows_in(self, table: str, parts: dict[str, list[str]], spans: dict[str, Span]) -> int:
        known = [spans.get(p) for held in parts.values() for p in held]
        return sum(s.n for s in known) if all(known) else self.part_rows(table, parts).count()

    def bucket(self, symbol: Column | str, manifest: dict) -> Column:
        return F.pmod(F.xxhash64(symbol), F.lit(manifest["buckets"])).cast("int")

    def buckets_of(self, symbols: DataFrame, manifest: dict) -> set[int]:
        """The buckets that hold the listed symbols, of which there are few."""
        return {r[0] for r in symbols.select(self.bucket("symbol", manifest)).distinct().collect()}

    def read(self, table: str, symbol: str | None = None, start=None, end=None) -> DataFrame:
        """Rows of a table; cells of other years and other buckets, and folders of other times, are not even listed.

        The declared schema is applied on read: older files with a narrower volume are widened and
        columns they lack are null.
        """
        return self._rows(self.manifest(), table, symbol, start, end)

    def _rows(self, manifest: dict, table: str, symbol=None, start=None, end=None, buckets: set[int] | None = None,
              states: bool = True) -> DataFrame:
        """``read`` at a manifest; bars without their states if these are not asked for."""
        lo, hi = as_time(start), as_time(end)
        if symbol is not None:
            place = self.spark.range(1).select(self.bucket(F.lit(symbol), manifest)).first()[0]
            buckets = {place} if buckets is None else buckets & {place}

        def wanted(cell: str) -> bool:
            if cell == WHOLE:
                return True
            year, bucket = cell_place(cell)
            timed = year == NO_YEAR or (lo is None or year >= lo.year) and (hi is None or year <= hi.year)
            return timed and (buckets is None or bucket in buckets)

        spans = self.spans(manifest) if table in BAR_TABLES and (lo or hi) else {}

        def rows(name: str) -> DataFrame:
            held = manifest["tables"].get(name, {})
            df = self.part_rows(name, {c: [p for p in held[c] if p not in spans or spans[p].meets(lo, hi)] for c in filter(wanted, held)})
            return in_range(df if symbol is None else one_symbol(df, symbol), start, end)

        df = rows(table)
        if table != "bars":
            return df
        if states and any(map(wanted, manifest["tables"].get("bar_states", {}))):
            df = df.join(rows("bar_states"), KEY, "left")
        else:
            df = df.withColumn("market_state", F.lit(None).cast("string"))
        return df.select(*BAR_COLS, "market_state", *MA_COLS)

    def cell_rows(self, manifest: dict, table: str, cells: Iterable[str]) -> DataFrame:
        """The stored rows of some cells of a table; cells that it lacks have none."""
        parts = manifest["tables"].get(table, {})
        return self.part_rows(table, {cell: parts.get(cell, []) for cell in cells})

    def part_rows(self, table: str, parts: dict[str, list[str]]) -> DataFrame:
        """The stored rows of some folders of some cells."""
        paths = [f"{self.root}/{p}" for cell in sorted(parts) for p in parts[cell]]
        schema = TABLE_SCHEMAS[table]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def marks(self, universe: DataFrame | None = None, manifest: dict | None = None) -> DataFrame:
        """``symbol_marks`` of the listed symbols, read from their buckets."""
        manifest = manifest or self.manifest()
        buckets = None if universe is None else self.buckets_of(universe, manifest)
        return restrict(self._rows(manifest, "symbol_marks", buckets=buckets), universe)

    def wide(self, symbol: str | None = None, start=None, end=None) -> DataFrame:
        """Bars with state and all stored averages."""
        return self.read("bars", symbol, start, end).select(*BAR_COLS, "market_state", *MA_COLS)

    # -- writing ----------------------------------------------------------------------------

    def commit(self, appends: dict[str, DataFrame] | None = None, replaces: dict[str, DataFrame] | None = None,
               base: dict | None = None, parts: dict[str, dict[str, list[str]]] | None = None,
               then: Callable[[dict[str, DataFrame], dict], tuple[dict[str, DataFrame], set[str]]] | None = None,
               ranged: bool = False) -> Commit:
        """Write new folders for every table given and publish them together.

        ``appends`` adds rows with new keys. ``replaces`` holds the complete new rows of every cell it touches, or of the
        folders that ``parts`` names for its cells. A key that would then be there twice refuses the commit. ``base`` is the
        manifest the caller computed from; publishing fails if it is no longer current. ``then`` makes further replaced tables
        from the rows just written, by table, and the folders by table and cell; and names folders that are now settled. ``ranged`` lays replaced rows out by ranges of
        (symbol, time), so that the files and row groups of a large cell hold few symbols each.

        States that come with bars go to their own table; a state is set or changed, never taken away.
        """
        base = base or self.manifest()
        version = base["version"] + 1
        state = {"buckets": base["buckets"], "tables": {n: {c: list(p) for c, p in parts.items()} for n, parts in base["tables"].items()}}
        tables, rows, fresh = state["tables"], {}, {}
        spans = dict(self.spans(base))
        for name, df in _with_states(appends or {}).items():
            written = self._stage(name, df, version, state)
            fresh[name] = self._staged(name, written)
            rows[name] = self._judge(name, written, state, spans)
            self._refuse_stored(name, written, tables.get(name, {}), fresh[name], spans)
            for cell, path in written.items():
                tables.setdefault(name, {}).setdefault(cell, []).append(path)
        for name, df in _with_states(replaces or {}).items():
            written = self._stage(name, df, version, state, ranged)
            fresh[name] = self._staged(name, written)
            rows[name] = self._judge(name, written, state, spans)
            kept = {}
            if name in BAR_TABLES:
                held = tables.get(name, {})
                gone = (parts or {}).get(name) or {c: held.get(c, []) for c in written}
                kept = {c: [p for p in held.get(c, []) if p not in gone.get(c, [])] for c in written}
                self._refuse_stored(name, written, kept, fresh[name], spans)
                before = self._rows_in(name, gone, spans)
                if rows[name] < before:
                    raise CommitError(f"{name}: {rows[name]} rows would replace {before}")
            for cell, path in written.items():
                tables.setdefault(name, {})[cell] = [*kept.get(cell, []), path]
        more = {"symbol_marks": self._marked(state, fresh["raw_bars"])} if "raw_bars" in fresh and not ranged and rows["raw_bars"] else {}
        settled = set(base["settled"])
        if then:
            further, done = then(fresh, tables)
            more, settled = more | further, settled | done
        if any(name in BAR_TABLES for name in fresh):
            more["part_spans"] = self._span_rows(tables, spans)
        for name, df in more.items():
            written = self._stage(name, df, version, state)
            tables.setdefault(name, {}).update({cell: [path] for cell, path in written.items()})
        self._publish(version, tables, base["buckets"], settled)
        return Commit(version, rows)

    def _marked(self, state: dict, added: DataFrame) -> DataFrame:
        """``symbol_marks`` of the buckets of the raw bars ``added``."""
        new = added.groupBy("symbol").agg(
            F.max("timestamp").alias("latest"), F.count(F.lit(1)).alias("n"),
            F.min(F.when(usable(F.col("close")), F.col("timestamp"))).alias("since"))
        old = self._rows(state, "symbol_marks", buckets=self.buckets_of(new, state))
        return old.unionByName(new).groupBy("symbol").agg(
            F.max("latest").alias("latest"), F.sum("n").alias("n"), F.min("since").alias("since"))

    def rewrite(self, buckets: int) -> Commit:
        """The same rows with another number of buckets, in one commit."""
        base = self.manifest()
        version, state, rows = base["version"] + 1, {"buckets": buckets}, {}
        tables = {name: {} for name in TABLE_SCHEMAS} | {n: base["tables"].get(n, {}) for n in WHOLE_TABLES}
        spans = dict(self.spans(base))
        for name in (*BAR_TABLES, *SYMBOL_TABLES):
            held = base["tables"].get(name, {})
            written = self._stage(name, self.cell_rows(base, name, held), version, state, ranged=True)
            rows[name], before = self._judge(name, written, state, spans), self._rows_in(name, held, spans)
            if rows[name] != before:
                raise CommitError(f"{name}: {rows[name]} rows written of {before}")
            tables[name] = {cell: [path] for cell, path in written.items()}
        written = self._stage("part_spans", self._span_rows(tables, spans), version, state)
        tables["part_spans"] = {cell: [path] for cell, path in written.items()}
        self._publish(version, tables, buckets, [])
        return Commit(version, rows)

    def _refuse_copies(self, name: str, df: DataFrame, most: int = 1) -> None:
        repeated = duplicate_sample(df, most=most).collect()
        if repeated:
            raise CommitError(f"{name}: repeated keys, e.g. {repeated}")

    def _judge(self, name: str, written: dict[str, str], manifest: dict, spans: dict[str, Span]) -> int:
        """Rows just written. Of bars, one pass over the sorted keys also adds to ``spans`` and refuses a key that is there twice;
        only cells in which sorted stretches meet, those of a hot symbol that Spark has split, have their keys grouped."""
        if name not in BAR_TABLES or not written:
            return self._staged(name, written).count()
        cells = judged_cells(stretches(self._staged(name, written), F.year("timestamp"), self.bucket("symbol", manifest))).collect()
        spans.update({written[f"{r.year}/{r.bucket}"]: Span(r.n, r.first, r.last) for r in cells})
        doubtful = {c: written[c] for r in cells if r.doubtful for c in [f"{r.year}/{r.bucket}"]}
        if doubtful:
            self._refuse_copies(name, self._staged(name, doubtful))
        return sum(r.n for r in cells)

    def _refuse_stored(self, name: str, written: dict[str, str], held: dict[str, list[str]], fresh: DataFrame,
                       spans: dict[str, Span]) -> None:
        """Refuse rows whose key a folder that stays has already; folders of other times cannot have it."""
        near = {}
        for cell, path in written.items():
            own = spans.get(path)
            near[cell] = [p for p in held.get(cell, []) if not own or p not in spans or spans[p].meets(own.first, own.last)]
        if any(near.values()):
            stored = self.part_rows(name, near).select(*KEY)
            self._refuse_copies(name, fresh.select(*KEY).join(stored, KEY, "left_semi"), most=0)

    def _span_rows(self, tables: dict, spans: dict[str, Span]) -> DataFrame:
        """``part_spans`` of the folders that ``tables`` names."""
        held = [p for name in BAR_TABLES for parts in tables.get(name, {}).values() for p in parts if p in spans]
        return small_frame(self.spark, [(p, spans[p].n, spans[p].first, spans[p].last) for p in held],
                           "part string, n long, first timestamp_ntz, last timestamp_ntz")

    def _staged(self, name: str, written: dict[str, str]) -> DataFrame:
        return self.cell_rows({"tables": {name: {c: [p] for c, p in written.items()}}}, name, written)

    def _stage(self, name: str, df: DataFrame, version: int, manifest: dict, ranged: bool = False) -> dict[str, str]:
        """Write one table's rows to an own folder; return its cell folders."""
        folder = f"{name}/v={version:010d}-{dt.datetime.now().strftime('%H%M%S%f')}"
        df = df.select(*[f.name for f in TABLE_SCHEMAS[name].fields if f.name in df.columns])
        if name in WHOLE_TABLES:
            df.sortWithinPartitions(df.columns[0]).write.parquet(f"{self.root}/{folder}")
            written = {WHOLE: folder}
        else:
            year = F.lit(NO_YEAR) if name in SYMBOL_TABLES else F.year("timestamp")
            placed = df.withColumns({"year": year, "bucket": self.bucket("symbol", manifest)})
            order = ["year", "bucket", *(c for c in KEY if c in df.columns)]
            # Rebalancing lets AQE split the files of a hot cell and merge those of small ones.
            placed = placed.repartitionByRange(*order) if ranged else placed.hint("rebalance", "year", "bucket")
            (
                placed.sortWithinPartitions(*order)
                .write.options(**WRITE_OPTIONS)
                .partitionBy("year", "bucket")
                .parquet(f"{self.root}/{folder}")
            )
            written = {}
            for status in self._fs.globStatus(self._path(f"{self.root}/{folder}/year=*/bucket=*")) or []:
                year, bucket = (p.split("=", 1)[1] for p in status.getPath().toString().rsplit("/", 2)[1:])
                written[f"{year}/{bucket}"] = f"{folder}/year={year}/bucket={bucket}"
        return written

    def make_folder(self, path: str) -> None:
        folder = self._path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(folder)

    def note(self, label: str, df: DataFrame) -> DataFrame:
        """``df`` written below the root and read again: the report of a job, which holds no cache."""
        path = f"{self.root}/_reports/{label}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
