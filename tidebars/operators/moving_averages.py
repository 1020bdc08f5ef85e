"""Simple, exponential and linearly weighted moving averages for any set of periods.

All averages of a frame come from one shuffle and one sort by (symbol, timestamp). The sorted rows
stream through an Arrow kernel that keeps only the last ``max(period)`` values and one number per
exponential average, so memory does not grow with the length of a symbol. Windows of built-in
functions give the same values but cost about seven times as much (README, "Measured choices").

A row in which an averaged column is null, NaN or infinite is left out: it counts in no frame and its
averages are null.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from tidebars.functions import kernels
from tidebars.operators.runs import Runs, SymbolSizes, ordered_runs, symbol_sizes
from tidebars.schema import STANDARD_PERIODS
from tidebars.session import ship_package, small_frame

KINDS = ("sma", "ema", "wma")


def ema_reach(period: int) -> int:
    """Rows after which an older value's weight is below 1e-300, that is, no longer visible."""
    if period <= 1:
        return 1
    return math.ceil(300 * math.log(10) / -math.log1p(-2.0 / (period + 1.0)))


def _carries(runs: Runs, smoothed: list[tuple[str, int]]) -> DataFrame:
    """``symbol, _seg, timestamp, _carry_0, ...``: the exponential averages at the last row before each segment, in the order of
    ``smoothed`` (column, period).

    A segment takes the average before it to ``decay ** rows`` of that plus a weighted sum of its own rows. The sums of
    each segment are one aggregate; the chain over the segments, of which there are few, is followed on the driver.
    """
    w = Window.partitionBy(*runs.keys)
    numbered = runs.df.filter("_own").withColumns(
        {"_k": F.row_number().over(w.orderBy("timestamp")), "_m": F.count(F.lit(1)).over(w)})
    decays = [1.0 - 2.0 / (p + 1.0) for _, p in smoothed]
    sums = [F.sum(F.pow(F.lit(d), F.col("_m") - F.col("_k")) * F.col(c).cast("double")) * (1.0 - d) for (c, _), d in zip(smoothed, decays)]
    firsts = [F.min_by(F.col(c).cast("double"), "_k") for c, _ in smoothed]
    found = numbered.groupBy(*runs.keys).agg(
        F.max("_m").alias("m"), F.max("timestamp").alias("last"), F.array(*sums).alias("sums"), F.array(*firsts).alias("firsts"))
    out, symbol, carry, last = [], None, None, None
    for r in sorted(found.collect(), key=lambda r: (r.symbol, r._seg)):  # as many rows as segments and symbols beside hot ones
        if r.symbol != symbol:
            symbol, carry = r.symbol, r.firsts  # seeded as if the first value had always been there
        else:
            out.append((r.symbol, r._seg, last, *carry))
        carry = [d**r.m * e + s for d, e, s in zip(decays, carry, r.sums)]
        last = r.last
    columns = ", ".join(f"_carry_{i} double" for i in range(len(smoothed)))
    return small_frame(runs.df.sparkSession, out, f"symbol string, _seg int, timestamp timestamp_ntz, {columns}")


def _add_split(df: DataFrame, wanted: dict[str, tuple[str, str, int]], sizes: SymbolSizes, sound: Column) -> DataFrame | None:
    """Averages where symbols are cut into segments: a segment borrows no row for its exponential averages, only what the
    plain frames reach back to. None if no symbol is cut."""
    back = max([1, *(p - 1 for kind, _, p in wanted.values() if kind != "ema")])
    # Rows that count in no frame take no part, so that the borrowed ones are as many as frames need.
    runs = ordered_runs(df.filter(sound).drop(*wanted), back=back, sizes=sizes)
    if not runs.split:
        return None
    hot = [h.symbol for h in sizes.hot]
    smoothed = sorted({(col, p) for kind, col, p in wanted.values() if kind == "ema"})
    carries = _carries(Runs(runs.df.filter(F.col("symbol").isin(hot)), runs.keys), smoothed)
    rows = runs.df.join(F.broadcast(carries), ["symbol", "_seg", "timestamp"], "left")
    known = {name: f"_carry_{smoothed.index((col, p))}" for name, (kind, col, p) in wanted.items() if kind == "ema"}
    rows = rows.select(*runs.df.columns, *sorted(set(known.values())))
    done = runs.finish(_through_kernel(rows.withColumn("_sound", F.lit(True)), wanted, known, runs.keys)).drop(*known.values())
    return done.unionByName(df.filter(~sound).drop(*wanted), allowMissingColumns=True)


def _sound_first(keys: tuple[str, ...]) -> WindowSpec:
    """Runs by their keys alone, so that rows which a window has dealt by these are not shuffled again; rows left out come last."""
    return Window.partitionBy(*keys).orderBy(F.desc("_sound"), "timestamp")


def _through_kernel(rows: DataFrame, wanted: dict[str, tuple[str, str, int]], known: dict[str, str], keys: tuple[str, ...]) -> DataFrame:
    """``rows`` with the wanted columns; rows that are not ``_sound`` come last in their run, so no other row sees them."""
    ship_package(rows.sparkSession)
    window = _sound_first(keys)
    placed = rows.withColumn("_pos", F.when(F.col("_sound"), 1).otherwise(-1) * F.row_number().over(window)).drop("_sound")
    kept = [f for f in placed.schema.fields if f.name != "_pos"]
    schema = T.StructType(kept + [T.StructField(name, T.DoubleType()) for name in wanted])
    return placed.mapInArrow(_kernel(wanted, sorted({col for _, col, _ in wanted.values()}), known), schema)


def _check_periods(periods) -> list[int]:
    periods = sorted(set(int(p) for p in periods))
    if not periods or periods[0] < 1:
        raise ValueError(f"periods must be positive whole numbers: {periods}")
    return periods


def add_averages(df: DataFrame, wanted: dict[str, tuple[str, str, int]], sizes: SymbolSizes | None = None,
                 known: dict[str, str] | None = None) -> DataFrame:
    """Add the columns ``{name: (kind, value column, period)}``; same-named columns are replaced.

    ``known`` names, for exponential averages, columns with values that are settled already: where they
    are not null they are taken, and later rows go on from them.
    """
    wanted = {name: (kind.lower(), col, int(p)) for name, (kind, col, p) in wanted.items()}
    for kind, _, _ in wanted.values():
        if kind not in KINDS:
            raise ValueError(f"unknown moving average kind: {kind}")
    _check_periods(p for _, _, p in wanted.values())

    sources = sorted({col for _, col, _ in wanted.values()})
    sound = F.lit(True)
    for col in sources:
        value = F.col(col).cast("double")
        sound = sound & F.coalesce((F.abs(value) < float("inf")) & ~F.isnan(value), F.lit(False))
    sizes = sizes or symbol_sizes(df)
    if sizes.hot and not known and any(kind == "ema" for kind, _, _ in wanted.values()):
        split = _add_split(df, wanted, sizes, sound)
        if split is not None:
            return split
    back = max(ema_reach(p) if kind == "ema" else p - 1 for kind, _, p in wanted.values())
    runs = ordered_runs(df.drop(*wanted), back=back, sizes=sizes)
    rows = runs.df.withColumn("_sound", sound)
    if not known and all(kind == "sma" for kind, _, _ in wanted.values()) and sum(p for _, _, p in wanted.values()) <= 64:
        # Short plain averages alone stay in the JVM.
        window = _sound_first(runs.keys)
        out = rows.select("*", *[
            F.when(F.col("_sound"), F.avg(col).over(window.rowsBetween(-(p - 1), 0))).alias(name)
            for name, (_, col, p) in wanted.items()
        ])
        return runs.finish(out.drop("_sound"))
    return runs.finish(_through_kernel(rows, wanted, known or {}, runs.keys))


def _kernel(wanted, sources, known) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    framed = {c: sorted({p for k, col, p in wanted.values() if col == c and k != "ema"}) for c in sources}
    smoothed = {c: sorted({p for k, col, p in wanted.values() if col == c and k == "ema"}) for c in sources}
    keep = max((max(p) for p in framed.values() if p), default=1) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = {c: np.empty(0) for c in sources}
        tail_pos = np.empty(0, dtype=np.int64)
        carry = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            pos = batch.column("_pos").to_numpy(zero_copy_only=False).astype(np.int64)
            left_out = pos < 0
            pos = np.abs(pos)
            all_pos = np.concatenate([tail_pos, pos])
            done = {}
            for c in sources:
                x = np.where(left_out, 0.0, batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64))
                if framed[c]:
                    joined = np.concatenate([tail[c], x])
                    sums = kernels.trailing_sums(joined, all_pos, framed[c])
                    for p in framed[c]:
                        done["sma", c, p] = kernels.sma(sums, all_pos, p)[len(tail_pos):]
                        done["wma", c, p] = kernels.wma(sums, all_pos, p)[len(tail_pos):]
                    tail[c] = joined[-keep:] if keep else joined[:0]
                for p in smoothed[c]:
                    settled = [batch.column(known[n]).to_numpy(zero_copy_only=False).astype(np.float64)
                               for n, spec in wanted.items() if spec == ("ema", c, p) and n in known]
                    e = kernels.ema(x, pos, p, carry.get((c, p), 0.0), *settled[:1])
                    carry[c, p] = e[-1]
                    done["ema", c, p] = e
            if keep and any(framed.values()):
                tail_pos = all_pos[-keep:]
            columns = [batch.column(n) for n in batch.schema.names if n != "_pos"]
            names = [n for n in batch.schema.names if n != "_pos"]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(done[spec], mask=left_out) for spec in wanted.values()], names=names + list(wanted)
            )

    return run


def moving_average(column: str, period: int, kind: str = "sma", name: str | None = None, sizes: SymbolSizes | None = None):
    """One average by name (``sma`` / ``ema`` / ``wma`` in any case), for ``df.transform``."""
    if kind.lower() not in KINDS:
        raise ValueError(f"unknown moving average kind: {kind}")
    out = name or f"{kind.lower()}_{period}"
    return lambda df: add_averages(df, {out: (kind, column, period)}, sizes)


def standard_averages(df: DataFrame, periods=None, sizes: SymbolSizes | None = None, known: dict[str, str] | None = None) -> DataFrame:
    """The storable columns ``sma_p ema_p wma_p`` of the close for every period; ``known`` as in ``add_averages``."""
    periods = _check_periods(periods or STANDARD_PERIODS)
    wanted = {f"{kind}_{p}": (kind, "close", p) for kind in KINDS for p in periods}
    return add_averages(df, wanted, sizes, known)


def averages_by_period(df: DataFrame, periods=None) -> DataFrame:
    """All averages as one long table: a row per bar and period, close and volume."""
    periods = _check_periods(periods or STANDARD_PERIODS)
    slim = df.select("symbol", "timestamp", "close", "volume")
    wanted = {}
    for p in periods:
        for kind in KINDS:
            wanted[f"{kind}_{p}"] = (kind, "close", p)
        wanted[f"sma_volume_{p}"] = ("sma", "volume", p)
        wanted[f"ema_volume_{p}"] = ("ema", "volume", p)
    wide = add_averages(slim, wanted)
    per_period = F.array(*[
        F.struct(
            F.lit(p).alias("period"),
            *[F.col(f"{n}_{p}").alias(n) for n in ("sma", "sma_volume", "ema", "ema_volume", "wma")],
        )
        for p in periods
    ])
    return wide.select("symbol", "timestamp", F.explode(per_period).alias("m")).select("symbol", "timestamp", "m.*")


def display_averages(df: DataFrame, periods=None) -> DataFrame:
    """Simple and exponential averages computed on the fly, as ``disp_sma_p`` / ``disp_ema_p``."""
    periods = _check_periods(periods or STANDARD_PERIODS)
    wanted = {}
    for p in periods:
        wanted[f"disp_sma_{p}"] = ("sma", "close", p)
        wanted[f"disp_ema_{p}"] = ("ema", "close", p)
    return add_averages(df, wanted)


def check_storable(periods) -> list[int]:
    """Only the standard periods have storage columns."""
    periods = _check_periods(periods or STANDARD_PERIODS)
    extra = [p for p in periods if p not in STANDARD_PERIODS]
    if extra:
        raise ValueError(f"periods without a storage column: {extra}")
    return periods
