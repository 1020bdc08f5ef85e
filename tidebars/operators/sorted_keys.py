"""Repeated keys among rows that lie sorted in files, found by comparing neighbours; no row is shuffled.

The rows of a file, or of the part of a file that one task reads, form one ascending stretch of keys. Equal keys inside
a stretch are neighbours. Keys of two stretches can be equal only if the stretches meet, which their ends tell.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidebars.session import ship_package

_STRETCH = "year int, bucket int, file long, n long, low struct<s: string, t: long>, high struct<s: string, t: long>, copies long"
_ARROW = pa.schema([
    ("year", pa.int32()), ("bucket", pa.int32()), ("file", pa.int64()), ("n", pa.int64()),
    *((end, pa.struct([("s", pa.string()), ("t", pa.int64())])) for end in ("low", "high")), ("copies", pa.int64()),
    ("first", pa.timestamp("us")), ("last", pa.timestamp("us")),
])


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None  # the stretch that the next batch may go on with
    for batch in batches:
        if not batch.num_rows:
            continue
        symbol, time = batch.column(0), batch.column(1).cast(pa.int64()).to_numpy(zero_copy_only=False)
        places = [batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4)]
        equal = pc.equal(symbol[1:], symbol[:-1]).to_numpy(zero_copy_only=False).astype(bool)
        rises = pc.greater(symbol[1:], symbol[:-1]).to_numpy(zero_copy_only=False).astype(bool)
        again = equal & (time[1:] == time[:-1])
        begins = ~(rises | equal & (time[1:] >= time[:-1]))
        for place in places:
            begins |= place[1:] != place[:-1]
        starts = np.concatenate(([0], np.flatnonzero(begins) + 1))
        copies = np.add.reduceat(np.concatenate(([False], again & ~begins)).astype(np.int64), starts)
        done = []
        for start, stop, repeated in zip(starts.tolist(), [*starts[1:].tolist(), len(time)], copies.tolist()):
            own = {
                **dict(zip(("year", "bucket", "file"), (int(p[start]) for p in places))), "n": stop - start,
                "low": {"s": symbol[start].as_py(), "t": int(time[start])},
                "high": {"s": symbol[stop - 1].as_py(), "t": int(time[stop - 1])}, "copies": repeated,
                "first": int(time[start:stop].min()), "last": int(time[start:stop].max()),
            }
            if held and all(held[c] == own[c] for c in ("year", "bucket", "file")) and _key(held["high"]) <= _key(own["low"]):
                held = held | {
                    "n": held["n"] + own["n"], "high": own["high"], "first": min(held["first"], own["first"]),
                    "last": max(held["last"], own["last"]), "copies": held["copies"] + repeated + (held["high"] == own["low"]),
                }
                continue
            if held:
                done.append(held)
            held = own
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_ARROW)
    if held:
        yield pa.RecordBatch.from_pylist([held], schema=_ARROW)


def _key(end: dict) -> tuple[bytes, int]:
    return end["s"].encode(), end["t"]


def stretches(rows: DataFrame, year: Column, bucket: Column) -> DataFrame:
    """A row for each ascending stretch of the keys of ``rows``, which come straight from files: its cell (``year`` and
    ``bucket``), number of rows, ends, first and last time, and how many rows repeat the key before them.

    A null symbol counts as less than any other and equal to itself.
    """
    ship_package(rows.sparkSession)
    symbol = F.coalesce(F.concat(F.lit("1"), "symbol"), F.lit("0")).alias("symbol")
    file = F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("file")
    keys = rows.select(symbol, "timestamp", year.cast("int").alias("year"), bucket.cast("int").alias("bucket"), file)
    return keys.mapInArrow(_stretches, f"{_STRETCH}, first timestamp_ntz, last timestamp_ntz")


def judged_cells(found: DataFrame) -> DataFrame:
    """By cell: rows, first and last time, and whether a key may occur in it twice (``doubtful``).

    A key does if a stretch repeats it, and may if it lies where two stretches of the cell meet.
    """
    before = Window.partitionBy("year", "bucket").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    meets = F.coalesce(F.max("high").over(before) >= F.col("low"), F.lit(False))
    return found.withColumn("doubtful", meets | (F.col("copies") > 0)).groupBy("year", "bucket").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"), F.bool_or("doubtful").alias("doubtful"))
