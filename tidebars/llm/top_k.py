"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Vectors lie in blocks of integer components. The postings of a block, one for each vector and dimension, are cut into
segments by impact, the component's absolute value, from the largest to the smallest; as the vectors are dense, a segment is
a matrix with the other components zero. All queries of a batch add the segments to their scores in descending impact. After
each segment the components that are left bound what a score can still change (the norms of the query and of the rest of the
vector). Once few vectors can still belong to the k best of a query, they are scored exactly and the query ends there; no
query ends without that proof. Vectors that might tie count as possible members.

Queries meet blocks in tiles, each of at most sixteen blocks and eight batches of queries, both packed: a block is sent once
for each band of batches and a batch once for each group of blocks, and a tile returns the k best of a query, not those of
each block.

Vectors that are null or hold a null, a NaN or an infinity take no part, nor do rows with a null id. Missing dimensions count
as zero. Repeated query rows are one query; repeated candidates count each. Rows with the query's id are its own. Scores beyond
a long end at its limits.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidebars.llm.frames import pick, prepare, settle
from tidebars.session import small_frame

#: Vectors in a block, queries in a batch (about).
BLOCK, BATCH = 8_192, 1_024
#: Bounds of the segments, as shares of the largest impact of a block, largest first.
SEGMENTS = (0.25, 0.125, 0.0625)
#: Blocks and batches in a tile, at most.
TILE = 16, 8
#: Tasks that tiles are dealt to, at most.
_TASKS = 20_000
#: Numbers of rows that monotonically_increasing_id keeps for each task.
_PER_TASK = 1 << 33
#: A query ends early once at most this share of a block can still be among its best.
FEW = 0.02
_EXACT_32, _EXACT_64 = 1 << 24, 1 << 53

PACKED = "ids binary, parts binary, wide string, n int"


def pack(ids: list[int], rows: list[list[int]]) -> tuple[bytes, bytes, str, int]:
    """Ids and components of some vectors; shorter vectors are filled up with zeros."""
    dims = max(map(len, rows), default=0)
    least, most = min((min(r) for r in rows if r), default=0), max((max(r) for r in rows if r), default=0)
    wide = next(w for w in ("<i2", "<i4", "<i8") if np.iinfo(w).min <= least and most <= np.iinfo(w).max)
    matrix = np.zeros((len(rows), dims), dtype=wide)
    for place, row in zip(matrix, rows):
        place[: len(row)] = row
    return np.array(ids, dtype="<i8").tobytes(), matrix.tobytes(), wide, len(rows)


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["parts"], row["wide"]).reshape(row["n"], -1)


def _peak(matrix: np.ndarray) -> int:
    return max(abs(int(matrix.min())), abs(int(matrix.max()))) if matrix.size else 0


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    order = np.lexsort((ids[places], [-int(s) for s in scores[places]] if scores.dtype == object else -scores[places]))
    return places[order[:k]]


def search_block(queries: tuple[np.ndarray, np.ndarray], block: tuple[np.ndarray, np.ndarray], k: int, segments=SEGMENTS,
                 few: float = FEW) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query, ids and exact scores of its k best in the block."""
    (query_ids, q), (ids, x) = queries, block
    dims = max(q.shape[1], x.shape[1])
    q, x = (np.pad(m, ((0, 0), (0, dims - m.shape[1]))) for m in (q, x))
    peak = _peak(q) * _peak(x) * max(1, dims)
    if peak >= _EXACT_64:  # beyond exact floating point: whole numbers of any size
        whole = q.astype(object) @ x.astype(object).T
        out = []
        for own, row in zip(query_ids, whole):
            places = np.flatnonzero(ids != own)
            best = places[_best(row[places], ids[places], k)]
            limits = np.iinfo(np.int64)
            out.append((ids[best], np.array([min(max(int(s), limits.min), limits.max) for s in row[best]], dtype=np.int64)))
        return out
    real = np.float32 if peak < _EXACT_32 else np.float64
    q_real, x_real = q.astype(real), x.astype(real)
    impact, top = np.abs(x_real), _peak(x)
    cuts = [*(real(top * s) for s in segments if top * s >= 1), real(0)]
    scores = np.zeros((len(q), len(x)), dtype=real)
    open_rows, out = np.arange(len(q)), [None] * len(q)
    norms = np.sqrt((q_real.astype(np.float64) ** 2).sum(axis=1))
    order = np.argsort(ids, kind="stable")
    first, last = (np.searchsorted(ids[order], query_ids, side) for side in ("left", "right"))
    above = np.full(1, np.inf)[0]
    for cut in cuts:
        inside = impact < above if cut == 0 else (impact >= cut) & (impact < above)
        scores[open_rows] += q_real[open_rows] @ np.where(inside, x_real, 0).T
        above = cut
        if cut == 0 or len(x) <= k:
            continue
        rest = np.sqrt((np.where(impact < cut, x_real, 0).astype(np.float64) ** 2).sum(axis=1))
        still = []
        for row in open_rows:
            own = order[first[row] : last[row]]
            slack = (norms[row] * rest * (1 + 1e-6) + 1).astype(np.float64)
            low = scores[row] - slack
            low[own] = -np.inf
            least = np.partition(low, len(low) - k)[len(low) - k]
            possible = scores[row] + slack >= least
            possible[own] = False
            places = np.flatnonzero(possible)
            if len(places) > max(k, few * len(x)):
                still.append(row)
                continue
            exact = x[places].astype(np.int64) @ q[row].astype(np.int64)
            best = _best(exact, ids[places], k)
            out[row] = ids[places[best]], exact[best]
        open_rows = np.array(still, dtype=np.int64)
        if not len(open_rows):
            return out
    for row in open_rows:
        exact = scores[row]
        own = order[first[row] : last[row]]
        if len(own):
            places = np.delete(np.arange(len(ids)), own)
            best = places[_best(exact[places], ids[places], k)]
        else:
            best = _best(exact, ids, k)
        out[row] = ids[best], exact[best].astype(np.int64)
    return out


def _pack_blocks(size: int):
    def one(ids, rows):
        types = pa.binary(), pa.binary(), pa.string(), pa.int32()
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(pack(ids, rows), types)], names=["ids", "parts", "wide", "n"])

    def run(batches):
        ids, rows = [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            rows += batch.column(1).to_pylist()
            while len(ids) >= size:
                yield one(ids[:size], rows[:size])
                ids, rows = ids[size:], rows[size:]
        if ids:
            yield one(ids, rows)

    return run


def whole_vectors(table: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """``vec_id, parts``: floor(scale * component) of the vectors that take part."""
    rows = pick(table, vec_id, vector).toDF("vec_id", "vector").select("vec_id", F.col("vector").cast("array<double>").alias("vector"))
    sound = "vec_id IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    return rows.filter(sound).select("vec_id", F.transform("vector", lambda x: F.floor(x * scale)).alias("parts"))


def _pack_batch(rows):
    """The queries of a batch, packed like a block."""
    for group in rows:
        for row in group.to_pylist():
            values = pack([o["vec_id"] for o in row["own"]], [o["parts"] for o in row["own"]])
            types = pa.binary(), pa.binary(), pa.string(), pa.int32()
            yield pa.RecordBatch.from_arrays([pa.array([row["number"]], pa.int32()), *(pa.array([v], t) for v, t in zip(values, types))],
                                             names=["number", "ids", "parts", "wide", "n"])


def _meet(k: int):
    """The k best of each query of a tile's batches among the vectors of its blocks."""
    types = {"number": pa.int32(), "place": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()}

    def meet(blocks: pa.Table, batches: pa.Table) -> pa.Table:
        blocks, out = [unpack(b) for b in blocks.to_pylist()], {name: [] for name in types}
        for batch in batches.to_pylist() if blocks else []:
            ids, q = unpack(batch)
            for place, found in enumerate(zip(*(search_block((ids, q), block, k) for block in blocks))):
                vec_ids, scores = (np.concatenate(part) for part in zip(*found))
                best = np.lexsort((vec_ids, ~scores))[:k]
                fixed = batch["number"], place, ids[place]
                for name, values in zip(types, (*(np.full(len(best), v) for v in fixed), vec_ids[best], scores[best])):
                    out[name].append(values)
        return pa.table({name: pa.array(np.concatenate(out[name]) if out[name] else [], t) for name, t in types.items()})

    return meet


def top_k(table: DataFrame, every: int = 20, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 64,
          block: int = BLOCK, batch: int = BATCH, tile: tuple[int, int] = TILE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best partners, among all rows, of the rows whose id ``every`` divides."""
    spark = table.sparkSession
    prepare(spark)
    vectors = whole_vectors(table, vec_id, vector, scale)
    blocks = settle(vectors.mapInArrow(_pack_blocks(block), PACKED).withColumn("place", F.monotonically_increasing_id()), "vector-blocks")
    asked = settle(vectors.filter(F.col("vec_id") % every == 0).distinct(), "vector-queries")

    # the blocks that one task packed make groups of tile[0]; one number for each task comes to the driver
    task = F.floor(F.col("place") / _PER_TASK)
    sizes = sorted(tuple(r) for r in blocks.groupBy(task.alias("task")).agg(F.count("*")).collect())
    ends = list(itertools.accumulate(-(-n // tile[0]) for _, n in sizes))
    starts = small_frame(spark, [(t, end - -(-n // tile[0])) for (t, n), end in zip(sizes, ends)], "task bigint, first bigint")
    groups, batches = max([1, *ends]), max(1, -(-asked.count() // batch))
    bands = -(-batches // tile[1])
    packed = settle(
        asked.groupBy(F.pmod(F.xxhash64("vec_id", "parts"), F.lit(batches)).cast("int").alias("number"))
        .agg(F.collect_list(F.struct("vec_id", "parts")).alias("own")).mapInArrow(_pack_batch, f"number int, {PACKED}"), "query-batches")

    tasks = min(2 * groups * bands, _TASKS)
    every_band = blocks.withColumn("task", task).join(starts, "task").select(
        (F.col("first") + F.floor(F.col("place") % _PER_TASK / tile[0])).alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"), "ids", "parts", "wide", "n")
    every_group = packed.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("part"),
        F.floor(F.col("number") / tile[1]).cast("int").alias("band"), "number", "ids", "parts", "wide", "n")
    sides = [side.repartition(tasks, "part", "band").groupBy("part", "band") for side in (every_band, every_group)]
    found = sides[0].cogroup(sides[1]).applyInArrow(_meet(k), "number int, place bigint, query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("number", "place", "query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
