"""The batch jobs: daily increment, backfill, moving-average refresh, state transform, upkeep of the stored files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window, functions as F

from tidebars.functions.times import as_time
from tidebars.operators.joins import new_rows, restrict, upsert_averages, upsert_states
from tidebars.operators.moving_averages import check_storable, standard_averages
from tidebars.operators.quality import clean, gate, judge
from tidebars.operators.runs import MIN_SEGMENT_ROWS, SymbolSizes
from tidebars.operators.states import classified_features, last_states, with_states
from tidebars.operators.transitions import fit_transitions, transition_probs
from tidebars.schema import BAR_COLS, DEFAULT_START, KEY, STANDARD_PERIODS, STATE_WINDOW_DAYS
from tidebars.session import scratch_run
from tidebars.sources import landing as landed
from tidebars.sources.tables import BAR_TABLES, Commit, TableStore, cell_place, usable


#: Closes that a stored tail holds: as many as the longest frame reaches back to.
TAIL_CLOSES = max(STANDARD_PERIODS) - 1
SMOOTHED = [f"ema_{p}" for p in STANDARD_PERIODS]
#: Folders of a cell before ``compact`` puts them together.
MOST_PARTS = 8


@dataclass(frozen=True)
class JobResult:
    """What a job did: the commit (none if nothing was written) and a status row per symbol."""

    commit: Commit | None
    status: DataFrame


def insert_bars(store: TableStore, bars: DataFrame) -> Commit:
    """Insert-only sink to both bar tables in one commit; stored rows never change."""
    base = store.manifest()
    span = bars.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).first()
    if span.lo is None:
        return Commit(base["version"], {"raw_bars": 0, "bars": 0})
    buckets = store.buckets_of(bars, base)
    appends = {
        name: new_rows(bars, store._rows(base, name, start=span.lo, end=span.hi, buckets=buckets)) for name in ("raw_bars", "bars")
    }
    return store.commit(appends=appends, base=base)


def ingest_lines(store: TableStore, scan: Callable[[DataFrame], DataFrame], universe: DataFrame, run_end,
                 default_start: str | None = DEFAULT_START) -> JobResult:
    """Plan, choose sources, clean and insert the landed lines of the listed symbols.

    ``scan`` gives the numbered lines, at least those of the (stem, source_rank) it is handed. The plan comes from the marks
    of the listed symbols, so no stored bar is read for it.
    """
    # The plan has a row per symbol and every step reads it; the lines of its files are read for their
    # headers, the choice and the fetch; the cleaned batch by the report and both inserts.
    caches = []

    def held(df: DataFrame) -> DataFrame:
        caches.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    try:
        plan = held(landed.fetch_plan(universe, store.marks(universe).select("symbol", "latest"), run_end, default_start))
        wanted = landed.targets(plan)
        own = held(landed.wanted_lines(scan(wanted), wanted))
        cleaned = held(clean(landed.fetch(landed.landed_rows(own), plan), *landed.LINE_ORDER))
        report = held(judge(cleaned))
        # Counting fills the caches, so that later joins are planned with their true sizes.
        report.count()
        bars, status = gate(cleaned, plan, report)
        unreadable = landed.unreadable_files(own).join(wanted, ["stem", "source_rank"]).select("symbol").distinct()
        status = status.join(unreadable.withColumn("_bad", F.lit(True)), "symbol", "left").withColumn(
            "reason", F.when((F.col("reason") == "empty") & F.col("_bad"), "unreadable_file").otherwise(F.col("reason"))
        ).drop("_bad")
        current = universe.select("symbol").join(plan.select("symbol"), "symbol", "left_anti").select(
            "symbol", F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("ok"), F.lit("up_to_date").alias("reason")
        )
        # The plan is relative to what is stored now, so the status is written before the insert.
        status = store.note("ingest", status.unionByName(current))
        commit = insert_bars(store, bars)
    finally:
        for cached in reversed(caches):
            cached.unpersist()
    return JobResult(commit, status)


def daily_increment(store: TableStore, landing: str, universe: DataFrame, run_end) -> JobResult:
    """Insert everything landed since each symbol's latest stored bar; unknown symbols from the start."""
    return ingest_lines(store, lambda wanted: landed.scan_sources(store.spark, landing, wanted), universe, run_end, default_start=None)


def historical_backfill(store: TableStore, landing: str, universe: DataFrame, run_end,
                        default_start: str = DEFAULT_START) -> JobResult:
    """As the daily increment, with an explicit first day for unknown symbols."""
    return ingest_lines(store, lambda wanted: landed.scan_sources(store.spark, landing, wanted), universe, run_end, default_start)


def _last_before(store: TableStore, base: dict, stale: DataFrame, latest: dict[int, int], n: int) -> DataFrame:
    """Key and close of the last ``n`` raw bars that averages count (``add_averages``) of each stale symbol before it gets stale.

    Cells are read backwards from the ``latest`` year in which a symbol of the bucket gets stale, twice as
    many years each time, and only those of buckets with a symbol that has fewer bars so far.
    """
    cells = base["tables"]["raw_bars"]
    below, span, needy, found = {b: y + 1 for b, y in latest.items()}, 2, stale, None
    while below:
        near = [c for c in cells for y, b in [cell_place(c)] if b in below and below[b] - span <= y < below[b]]
        rows = store.cell_rows(base, "raw_bars", near).select(*KEY, "close").join(needy, "symbol").filter(
            (F.col("timestamp") < F.col("since")) & usable(F.col("close"))).select(*KEY, "close")
        found = rows if found is None else found.unionByName(rows)
        below = {b: y - span for b, y in below.items()}
        older = {b for c in cells for y, b in [cell_place(c)] if b in below and y < below[b]}
        if not older:
            break
        counts = found.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
        needy = stale.join(counts, "symbol", "left").filter(F.coalesce("n", F.lit(0)) < n).select("symbol", "since")
        wanting = store.buckets_of(needy, base)
        below, span = {b: y for b, y in below.items() if b in older & wanting}, 2 * span
    newest = Window.partitionBy("symbol").orderBy(F.desc("timestamp"))
    return found.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n).drop("_rank")


def _tail_rows(tails: DataFrame) -> DataFrame:
    """The closes of ``average_tails`` as rows, a microsecond apart up to the last averaged bar, which has its exponential
    averages."""
    last = F.size("closes") - 1
    rows = tails.select("symbol", "until", *SMOOTHED, last.alias("last"), F.posexplode("closes").alias("pos", "close"))
    at = F.timestamp_micros(F.unix_micros(F.col("until").cast("timestamp")) - (F.col("last") - F.col("pos"))).cast("timestamp_ntz")
    settled = [F.when(F.col("pos") == F.col("last"), F.col(c)).alias(f"known_{c}") for c in SMOOTHED]
    return rows.select("symbol", at.alias("timestamp"), "close", *settled)


def _tails(rows: DataFrame) -> DataFrame:
    """``average_tails`` from the newest averaged bars of each symbol."""
    newest = Window.partitionBy("symbol").orderBy(F.desc("timestamp"))
    ranked = rows.filter(usable(F.col("close"))).withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= TAIL_CLOSES)
    closes = F.transform(F.array_sort(F.collect_list(F.struct("timestamp", "close"))), lambda r: r["close"])
    return ranked.groupBy("symbol").agg(F.max("timestamp").alias("until"), closes.alias("closes"),
                                        *[F.max_by(c, "timestamp").alias(c) for c in SMOOTHED])


def _settle_up(store: TableStore, base: dict, done: DataFrame, before: DataFrame | None, buckets: set[int]):
    """What a refresh of the symbols ``done`` writes beside the bars: their tails and marks, and the folders that need no
    further look. ``before``: averaged rows that the new bars go on from, if these are not whole histories."""
    def then(fresh: dict[str, DataFrame], tables: dict) -> dict[str, DataFrame]:
        symbols = done.select("symbol")
        wrote = fresh["bars"].select(*KEY, "close", *SMOOTHED)
        rows = restrict(wrote, symbols)
        if before is not None:
            rows = rows.unionByName(before.select(*KEY, "close", *[F.col(f"known_{c}").alias(c) for c in SMOOTHED]))
            rows = rows.groupBy(*KEY).agg(*[F.max(c).alias(c) for c in ("close", *SMOOTHED)])  # a late bar's cells hold both
        old = store._rows(base, "average_tails", buckets=buckets)
        tails = old.join(symbols, "symbol", "left_anti").unionByName(_tails(rows))
        marks = store._rows(base, "symbol_marks", buckets=buckets).join(symbols.withColumn("_done", F.lit(True)), "symbol", "left")
        marks = marks.withColumn("since", F.when(F.col("_done").isNull(), F.col("since"))).drop("_done").persist(StorageLevel.MEMORY_AND_DISK)
        waiting = store.buckets_of(marks.filter("since IS NOT NULL"), base)
        # a folder is settled if each of its bars that counts has averages
        year, bucket = F.year("timestamp").alias("year"), store.bucket("symbol", base).alias("bucket")
        lacking = fresh["bars"].filter(usable(F.col("close")) & F.col(SMOOTHED[0]).isNull()).select(year, bucket).distinct()
        lacking = {f"{r.year}/{r.bucket}" for r in lacking.collect()}  # a row for each cell at most
        settled = {p for c, held in tables["raw_bars"].items() if cell_place(c)[1] in buckets - waiting for p in held}
        settled |= {p for c, held in tables["bars"].items() if c not in lacking for p in held if p not in base["tables"]["bars"].get(c, [])}
        return {"average_tails": tails, "symbol_marks": marks}, settled

    return then


def _refresh_stale(store: TableStore, base: dict, universe: DataFrame | None, buckets: set[int] | None) -> Commit | None:
    """Averages from each listed symbol's first bar without them on, going on from its stored tail.

    The marks tell which symbols have such bars, so nothing is looked through to find them. Of a bucket whose new bars are
    all later than the averaged ones, only folders that no refresh has settled are read and rewritten. A late bar changes the
    averages after it: then the closes before it are read and the cells from its year on are rewritten.
    """
    marks = restrict(store._rows(base, "symbol_marks", buckets=buckets), universe).filter("since IS NOT NULL").select("symbol", "since", "n")
    tails = store._rows(base, "average_tails", buckets=buckets)
    stale = marks.join(tails, "symbol", "left").withColumn(
        "late", F.coalesce(F.col("since") <= F.col("until"), F.lit(False))).persist(StorageLevel.MEMORY_AND_DISK)
    caches = [stale]
    try:
        year = F.year("since")
        spans = stale.groupBy(store.bucket("symbol", base).alias("bucket")).agg(
            F.min(year).alias("first"), F.max(F.when(F.col("late"), year)).alias("latest"), F.min("since").alias("since"), F.max("n").alias("n")).collect()
        if not spans:
            return None
        first, latest = {r.bucket: r.first for r in spans}, {r.bucket: r.latest for r in spans if r.latest is not None}
        settled = set(base["settled"])

        def unsettled(table: str) -> dict[str, list[str]]:
            out = {}
            for cell, held in base["tables"][table].items():
                y, b = cell_place(cell)
                if y >= first.get(b, 10**9):
                    out[cell] = held if b in latest else [p for p in held if p not in settled]
            return {c: p for c, p in out.items() if p}

        since = stale.select("symbol", "since")
        raw = store.part_rows("raw_bars", unsettled("raw_bars")).filter(F.col("timestamp") >= F.lit(min(r.since for r in spans)))
        later = raw.join(since, "symbol").filter(F.col("timestamp") >= F.col("since"))
        before = _tail_rows(stale.filter(~F.col("late") & F.col("until").isNotNull()))
        if latest:
            late = since.join(stale.filter("late").select("symbol"), "symbol", "left_semi")
            found = _last_before(store, base, late, latest, TAIL_CLOSES).persist(StorageLevel.MEMORY_AND_DISK)
            caches.append(found)
            years = found.groupBy(store.bucket("symbol", base).alias("bucket")).agg(F.min(F.year("timestamp")).alias("year"))
            lowest = {r.bucket: r.year for r in years.collect()}
            held = [c for c in base["tables"]["bars"] for y, b in [cell_place(c)] if lowest.get(b, 10**9) <= y <= latest.get(b, 0)]
            stored = store.cell_rows(base, "bars", held).select(*KEY, *[F.col(c).alias(f"known_{c}") for c in SMOOTHED])
            before = before.unionByName(found.join(stored, KEY, "left"))
        # Read for the sizes of the symbols, by the kernel and for the new tails.
        before = before.persist(StorageLevel.MEMORY_AND_DISK)
        caches.append(before)
        rows = later.select(*BAR_COLS, F.lit(True).alias("fresh")).unionByName(
            before.withColumn("fresh", F.lit(False)), allowMissingColumns=True)
        # No symbol is hot if none has so many bars altogether.
        sizes = SymbolSizes([], MIN_SEGMENT_ROWS) if max(r.n for r in spans) <= MIN_SEGMENT_ROWS else None
        averages = standard_averages(rows, sizes=sizes, known={c: f"known_{c}" for c in SMOOTHED}).filter("fresh").drop(
            "fresh", *[f"known_{c}" for c in SMOOTHED])
        columns = [c for c in averages.columns if c not in BAR_COLS]
        own = unsettled("bars")
        bars = upsert_averages(store.part_rows("bars", own), averages, columns)
        return store.commit(replaces={"bars": bars}, base=base, parts={"bars": own},
                            then=_settle_up(store, base, stale, before, set(first)))
    finally:
        for cached in caches:
            cached.unpersist()


def refresh_averages(store: TableStore, universe: DataFrame | None = None, periods=None,
                     rebuild: bool = False) -> JobResult:
    """Bring the stored averages of the listed symbols up to date with their raw history.

    The daily case goes on from what is stored (see ``_refresh_stale``); ``rebuild``, or a choice of
    periods, recomputes whole histories of the listed symbols.
    """
    periods = check_storable(periods)
    base = store.manifest()
    buckets = None if universe is None else store.buckets_of(universe, base)
    if rebuild or periods != STANDARD_PERIODS:
        raw = restrict(store._rows(base, "raw_bars", buckets=buckets), universe)
        averages = standard_averages(raw, periods)
        columns = [c for c in averages.columns if c not in BAR_COLS]
        cells = [c for c in base["tables"]["bars"] if buckets is None or cell_place(c)[1] in buckets]
        bars = store.cell_rows(base, "bars", cells)
        then = None
        if periods == STANDARD_PERIODS:
            done = restrict(store._rows(base, "symbol_marks", buckets=buckets), universe)
            then = _settle_up(store, base, done, None, store.buckets_of(done, base))
        commit = store.commit(replaces={"bars": upsert_averages(bars, averages, columns)}, base=base, then=then)
    else:
        commit = _refresh_stale(store, base, universe, buckets)
    have = restrict(store._rows(base, "symbol_marks", buckets=buckets), universe).select("symbol", "n")
    listed = have if universe is None else universe.select("symbol").distinct().join(have, "symbol", "left")
    status = listed.select(
        "symbol", F.coalesce("n", F.lit(0)).alias("n"), F.col("n").isNotNull().alias("ok"),
        F.when(F.col("n").isNull(), "no_raw_bars").alias("reason"),
    )
    return JobResult(commit, status)


def compact(store: TableStore, most_parts: int = MOST_PARTS) -> Commit | None:
    """Put the folders of every cell with more than ``most_parts`` together, laid out by ranges of (symbol, time)."""
    base = store.manifest()
    full = {name: {c: list(p) for c, p in base["tables"].get(name, {}).items() if len(p) > most_parts} for name in BAR_TABLES}
    full = {name: cells for name, cells in full.items() if cells}
    if not full:
        return None
    known = set(base["settled"])

    def then(_: dict, tables: dict) -> tuple[dict[str, DataFrame], set[str]]:
        # what is put together from settled folders is settled
        return {}, {p for n, cells in full.items() for c, old in cells.items() if known.issuperset(old) for p in tables[n][c]}

    return store.commit(replaces={n: store.part_rows(n, cells) for n, cells in full.items()}, base=base, parts=full, then=then, ranged=True)


def rebucket(store: TableStore, buckets: int) -> Commit:
    """Deal the symbols to another number of buckets, as a store with more symbols needs."""
    return store.rewrite(buckets)


@dataclass(frozen=True)
class TransformResult(JobResult):
    """``status`` is that of the model per symbol; ``transitions`` is the stored matrix."""

    transitions: DataFrame
    window: DataFrame

    def recent_states(self, n: int = 5) -> DataFrame:
        """The last states of every symbol in this run, computed when asked for."""
        return last_states(with_states(self.window), n)


def transform_states(store: TableStore, universe: DataFrame | None, run_end, labels: str = "fresh") -> TransformResult:
    """Classify the trailing 365 days, store the states, fit the model, store its matrix. Scratch tables go at the end.

    Without a ``universe`` all symbols are in the run, and the stored matrices are those of this run.
    ``labels="fresh"`` trains on the states of this run; ``"stored"`` on those stored before it.
    """
    if labels not in ("fresh", "stored"):
        raise ValueError(f"labels must be fresh or stored: {labels}")
    with scratch_run(store.spark):
        return _transform_states(store, universe, run_end, labels)


def _transform_states(store: TableStore, universe: DataFrame | None, run_end, labels: str) -> TransformResult:
    end = as_time(run_end)
    start = end - dt.timedelta(days=STATE_WINDOW_DAYS)
    base = store.manifest()
    buckets = None if universe is None else store.buckets_of(universe, base)
    window = restrict(store._rows(base, "bars", start=start, end=end, buckets=buckets), universe)
    # Read by the fit, the scoring and the state update.
    features = classified_features(window, labels).persist(StorageLevel.MEMORY_AND_DISK)
    models = None
    try:
        models = fit_transitions(features).persist(StorageLevel.MEMORY_AND_DISK)
        known = models.select(
            "symbol", "n", (F.col("status") == "ok").alias("ok"),
            F.when(F.col("status") != "ok", F.col("status")).alias("reason"), "dropped",
        )
        if universe is not None:
            nothing = {"n": F.lit(0), "ok": F.lit(False), "dropped": F.lit(0)}
            known = universe.select("symbol").distinct().join(known, "symbol", "left").withColumn(
                "reason", F.when(F.col("n").isNull(), "no_bars").otherwise(F.col("reason"))
            ).withColumns({c: F.coalesce(c, v) for c, v in nothing.items()})
        status = store.note("transform", known.select("symbol", "n", "ok", "reason", "dropped"))
        # States have cells of their own: of these, only the years of the window, in buckets with a bar in it, are rewritten.
        own = store.buckets_of(features.select("symbol").distinct(), base)
        cells = [c for c in base["tables"].get("bar_states", {}) for y, b in [cell_place(c)] if start.year <= y <= end.year and b in own]
        states = upsert_states(store.cell_rows(base, "bar_states", cells), features)
        # A symbol of this run keeps no older matrix, one of another run keeps its own.
        matrix = transition_probs(features, models)
        if universe is not None:
            others = store._rows(base, "transition_probs").join(universe.select("symbol"), "symbol", "left_anti")
            matrix = matrix.unionByName(others)
        replaces = {"bar_states": states, "transition_probs": matrix}
        commit = store.commit(replaces=replaces, base=base)
    finally:
        features.unpersist()
        if models is not None:
            models.unpersist()
    return TransformResult(commit, status, store.read("transition_probs"), window.select(*KEY, "close"))
