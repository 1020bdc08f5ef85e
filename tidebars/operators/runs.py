"""Time-ordered windows per symbol that survive a symbol holding most of the rows.

``Window.partitionBy("symbol")`` puts a whole symbol into one task. Here a symbol with more than
``target`` rows is cut into consecutive time segments, and each segment also receives copies of the
rows its frames reach back to (or ahead to). Windows then run per (symbol, segment), the copies are
dropped afterwards, and the result is the same as that of the plain window.

What reaches the driver is bounded: ``target`` is at least 1/10,000 of all rows, so there are at most
10,000 hot symbols and a fixed number of histogram buckets, which also bounds the broadcast maps.

Finding the hot symbols is a job. Operators that follow each other on the same bars share one
``symbol_sizes`` (their ``sizes`` argument) instead of running it each.
"""

from __future__ import annotations

import bisect
import itertools
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from tidebars.functions.scalars import epoch_micros
from tidebars.session import small_frame

MIN_SEGMENT_ROWS = 2_000_000
MAX_SEGMENTS = 10_000
BUCKETS_PER_SEGMENT = 16


@dataclass(frozen=True)
class Runs:
    """A frame ready for ordered windows: use ``window`` (or ``rows``), then ``finish``."""

    df: DataFrame
    keys: tuple[str, ...]

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy("timestamp")

    def rows(self, start: int, end: int) -> WindowSpec:
        return self.window.rowsBetween(start, end)

    @property
    def split(self) -> bool:
        """Whether some symbol was cut into segments."""
        return "_seg" in self.keys

    def finish(self, df: DataFrame) -> DataFrame:
        """Drop the borrowed rows and helper columns."""
        if not self.split:
            return df
        return df.filter("_own").drop("_seg", "_own")


@dataclass(frozen=True)
class SymbolSizes:
    """The symbols with more than ``target`` rows, as (symbol, n, lo, hi) rows."""

    hot: list
    target: int
    forced: bool = False


def ordered_runs(df: DataFrame, back: int = 0, ahead: int = 0, sizes: SymbolSizes | None = None) -> Runs:
    """Prepare ``df`` for windows per symbol that reach ``back`` / ``ahead`` rows.

    (symbol, timestamp) must be unique. ``sizes``: what ``symbol_sizes`` found for the same rows.
    """
    sizes = sizes or symbol_sizes(df)
    # A segment much shorter than its borrowed rows would mostly recompute its neighbours.
    target = sizes.target if sizes.forced else max(sizes.target, 8 * (back + ahead))
    hot = [h for h in sizes.hot if h.n > target]
    if not hot:
        return Runs(df, ("symbol",))

    with_time = df.withColumn("_t", epoch_micros(F.col("timestamp")))
    bucketed, counts = _bucket(with_time, hot, target)
    placement = _place(counts, target, back, ahead)
    schema = "symbol string, _bucket long, _places array<struct<_seg:int,_own:boolean>>"
    places = small_frame(df.sparkSession, placement, schema)
    whole = F.array(F.struct(F.lit(0).alias("_seg"), F.lit(True).alias("_own")))
    spread = (
        bucketed.join(F.broadcast(places), ["symbol", "_bucket"], "left")
        .withColumn("_place", F.explode(F.coalesce("_places", whole)))
        .select(*df.columns, "_place._seg", "_place._own")
    )
    return Runs(spread, ("symbol", "_seg"))


def symbol_sizes(df: DataFrame, segment_rows: int | None = None) -> SymbolSizes:
    """Symbols with more rows than one segment should hold. ``segment_rows`` forces that size (tests)."""
    sizes = df.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("timestamp").alias("lo"),
        F.max("timestamp").alias("hi"),
    )
    if segment_rows is None:
        totals = sizes.agg(F.sum("n").alias("n"), F.max("n").alias("largest")).first()
        target = max(MIN_SEGMENT_ROWS, (totals.n or 0) // MAX_SEGMENTS)
        if (totals.largest or 0) <= target:
            return SymbolSizes([], target)
    else:
        target = segment_rows
    hot = sizes.filter(F.col("n") > target).select(
        "symbol", "n", epoch_micros(F.col("lo")).alias("lo"), epoch_micros(F.col("hi")).alias("hi")
    )
    return SymbolSizes(hot.collect(), target, segment_rows is not None)


def _bucket(df: DataFrame, hot, target: int):
    """Give rows of hot symbols a time bucket; split buckets until none exceeds ``target`` rows.

    Returns the frame with ``_bucket`` (the bucket's first microsecond, null for other symbols) and
    the exact row count of every bucket.
    """
    spark = df.sparkSession
    grid = []
    for h in hot:
        buckets = BUCKETS_PER_SEGMENT * -(-h.n // target)
        grid.append((h.symbol, None, h.lo, (h.hi - h.lo) // buckets + 1))
    df = df.withColumn("_bucket", F.lit(None).cast("long"))
    settled: dict[tuple[str, int], int] = {}
    while grid:
        cells = small_frame(spark, grid, "_sym string, _old long, _lo long, _width long")
        inside = (F.col("symbol") == F.col("_sym")) & F.col("_bucket").eqNullSafe(F.col("_old"))
        cut = F.col("_lo") + F.floor((F.col("_t") - F.col("_lo")) / F.col("_width")) * F.col("_width")
        df = (
            df.join(F.broadcast(cells), inside, "left")
            .withColumn("_fresh", F.col("_sym").isNotNull())
            .withColumn("_bucket", F.when(F.col("_fresh"), cut).otherwise(F.col("_bucket")))
            .drop("_sym", "_old", "_lo", "_width")
        )
        width = {(g[0], g[1]): g for g in grid}
        counted = df.filter("_fresh").groupBy("symbol", "_bucket").agg(F.count(F.lit(1)).alias("n")).collect()
        df = df.drop("_fresh")
        step = {}
        for g in width.values():
            step.setdefault(g[0], []).append((g[2], g[3]))
        for cellspec in step.values():
            cellspec.sort()
        grid = []
        for row in counted:
            starts = step[row.symbol]
            size = starts[bisect.bisect_right(starts, (row._bucket, float("inf"))) - 1][1]
            if row.n > target and size > 1:
                pieces = BUCKETS_PER_SEGMENT * -(-row.n // target)
                grid.append((row.symbol, row._bucket, row._bucket, size // pieces + 1 if size > pieces else 1))
            else:
                settled[(row.symbol, row._bucket)] = row.n
    return df, settled


def _place(counts: dict[tuple[str, int], int], target: int, back: int, ahead: int):
    """Join buckets into segments of about ``target`` rows and list who borrows which bucket."""
    placement = []
    ordered = sorted(counts.items())
    for symbol, group in itertools.groupby(ordered, key=lambda kv: kv[0][0]):
        buckets = [(key[1], n) for key, n in group]
        seg_of, seg, filled = [], 0, 0
        for _, n in buckets:
            if filled and filled + n > target:
                seg, filled = seg + 1, 0
            seg_of.append(seg)
            filled += n
        places = [[{"_seg": s, "_own": True}] for s in seg_of]
        for i in range(1, len(buckets)):
            if seg_of[i] == seg_of[i - 1]:
                continue
            need, j = back, i - 1
            while need > 0 and j >= 0:
                places[j].append({"_seg": seg_of[i], "_own": False})
                need -= buckets[j][1]
                j -= 1
            need, j = ahead, i
            while need > 0 and j < len(buckets):
                places[j].append({"_seg": seg_of[i - 1], "_own": False})
                need -= buckets[j][1]
                j += 1
        placement.extend((symbol, b, p) for (b, _), p in zip(buckets, places))
    return placement
