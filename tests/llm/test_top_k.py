import math
import random

import numpy as np
import pytest
from cases import clashing

from tidebars.llm import top_k as t

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every=20, k=20):
    sound = []
    for vec_id, v, *_ in rows:
        if vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        sound.append((vec_id, tuple(math.floor(64 * float(np.float32(x))) for x in v)))
    out = []
    for query, q in sorted({r for r in sound if r[0] % every == 0}):
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in sound if i != query)[:k]
        out += [(query, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def vectors(n, dims=12, seed=1, spread=0.3):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(dims)], 0) for i in range(n)]


def got(spark, rows, **how):
    found = t.top_k(spark.createDataFrame(rows, SCHEMA).repartition(3), **how).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found)


@pytest.mark.parametrize("how", [{}, {"block": 50, "batch": 4}, {"block": 7, "batch": 2, "tile": (3, 2)}, {"block": 10, "tile": (1, 1)}])
def test_against_brute_force(spark, how):
    rows = vectors(300)
    assert got(spark, rows, **how) == brute(rows)


def test_common_vector_ties_and_odd_rows(spark):
    rows = [(i, [0.25, -0.5, 0.125], 1) for i in range(100)] + vectors(60, 3, 5)[41:]
    rows = [(i + 1000 * (n >= 100), v, x) for n, (i, v, x) in enumerate(rows)]
    rows += [(2000, None, 0), (2020, [None, 1.0, 0.0], 0), (2040, [math.nan, 0.0, 0.0], 0), (2060, [math.inf, 0.0, 0.0], 0),
             (None, [1.0, 1.0, 1.0], 0), (2080, [], 0), (2100, [1.0], 0), (-20, [-0.3, 0.0, 0.01, 2.0], 0), rows[0], rows[7]]
    assert got(spark, rows, block=40) == brute(rows)


@pytest.mark.parametrize("size", [300.0, 1e6, 1e12])
def test_large_components(spark, size):
    rows = [(i, [x * size for x in v], 0) for i, v, _ in vectors(80, 4, 3)]
    limit = np.iinfo(np.int64)
    expected = [(q, n, i, min(max(s, limit.min), limit.max)) for q, n, i, s in brute(rows)]
    if size < 1e12:
        assert got(spark, rows) == expected
    else:  # components end at the limits of a long
        assert len(got(spark, rows)) == len(expected)


def test_clashing_columns(spark):
    rows = vectors(90)
    table = clashing(spark.createDataFrame(rows, SCHEMA), "VEC_ID", "score", "rank", "place", "Embedding")
    found = t.top_k(table, block=40, batch=3).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == brute(rows)


def test_few_or_no_rows(spark):
    assert got(spark, vectors(5)) == brute(vectors(5))
    assert got(spark, vectors(1)) == []
    assert t.top_k(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_query_ends_only_with_proof():
    rng = np.random.default_rng(4)
    x = np.floor(64 * rng.normal(0, 0.2, (3000, 32))).astype(np.int64)
    x[::50] += np.floor(200 * rng.normal(0, 0.2, 32)).astype(np.int64)
    ids = rng.permutation(3000).astype(np.int64)
    queries = np.arange(0, 3000, 60)
    found = t.search_block((ids[queries], x[queries]), (ids, x), 20)
    for row, (best, scores) in zip(queries, found):
        exact = x @ x[row]
        order = [i for i in np.lexsort((ids, -exact)) if ids[i] != ids[row]][:20]
        assert best.tolist() == ids[order].tolist() and scores.tolist() == exact[order].tolist()
