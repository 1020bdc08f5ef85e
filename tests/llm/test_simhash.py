import random

import numpy as np
import pytest
import xxhash
from cases import clashing, odd_documents, rows

from tidebars.llm import simhash as s


def brute_print(text, k=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {c: " " for c in (*range(9, 14), 32)}).split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """{print: smallest print reachable} over links of two bits or fewer."""
    left, out = sorted(prints), {}
    while left:
        todo, seen = [left[0]], {left[0]}
        while todo:
            x = todo.pop()
            near = [y for y in left if y not in seen and (x ^ y).bit_count() <= 2]
            seen.update(near)
            todo += near
        out |= dict.fromkeys(seen, min(seen))
        left = [x for x in left if x not in seen]
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def ball(n, seed, spread):
    rng = random.Random(seed)
    out, centre = set(), rng.getrandbits(64)
    while len(out) < n:
        out.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(spread + 1))))
    return out


@pytest.mark.parametrize("crowd", [s.CROWD, 2, 0])
def test_links_connect_what_brute_force_connects(spark, crowd):
    from tidebars.llm.components import connected

    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(150)} | ball(200, 1, 3) | ball(120, 2, 5)
    for p in list(prints)[:100]:
        prints.add(p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    df = spark.createDataFrame([(signed(p),) for p in prints], "print bigint")
    got = {r.node: r.root for r in connected(s.near_pairs(df, crowd)).collect()}
    groups = brute_components(prints)
    expected = {}
    for p, root in groups.items():
        expected.setdefault(root, set()).add(signed(p))
    for members in expected.values():
        if len(members) == 1:
            assert got.get(next(iter(members)), next(iter(members))) == next(iter(members))
        else:
            assert {got[m] for m in members} == {min(members)}


def test_all_two_bit_patterns_share_a_codeword():
    """The code is linear, so one word for each of the 2,048 syndromes stands for all words."""
    syndromes, words = np.unique(s._syndrome(np.arange(1 << 16)), return_index=True)
    assert len(syndromes) == 2048
    bits = [1 << a for a in range(23)]
    patterns = np.array([0, *bits, *(a | b for a in bits for b in bits if a < b)])
    rows, indices = (np.asarray(x, dtype=np.int64) for x in s.codeword_indices(words))
    own = np.unique(rows << 12 | indices)
    others = (words[:, None] ^ patterns).ravel()
    rows, indices = (np.asarray(x, dtype=np.int64) for x in s.codeword_indices(others))
    met = np.isin(rows // len(patterns) << 12 | indices, own)
    assert len(others) == 2048 * 277 and len(np.unique(rows[met])) == len(others)


def test_two_bits_share_a_codeword():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    other = words ^ (1 << rng.integers(0, 23, 3000)) ^ (1 << rng.integers(0, 23, 3000))
    keys = [{}, {}]
    for store, values in zip(keys, (words, other)):
        for row, index in zip(*s.codeword_indices(values)):
            store.setdefault(int(row), set()).add(int(index))
    assert all(keys[0][i] & keys[1][i] for i in range(3000))
    assert {len(v) for v in keys[0].values()} == {1, 6}


TEXTS = ["The quick brown fox jumps over the lazy dog " * 3, "the QUICK brown fox jumps over the lazy dog " * 3, "One two", "one\ttwo ",
         "single", "Été étÉ ÉTÉ a", "été étÉ ÉTÉ a", "to be or not to be that is the question"]


def test_query_columns_against_brute_force(spark):
    docs = odd_documents(spark, TEXTS)
    got = rows(s.simhash_components(clashing(docs, "print", "DOC_ID", "component_id")), "doc_id", "print", "component_id")
    all_rows = [(r.doc_id, brute_print(r.text)) for r in docs.collect()]
    roots = brute_components({p for _, p in all_rows})
    low = {}
    for doc_id, p in all_rows:
        if doc_id is not None:
            low[roots[p]] = min(low.get(roots[p], doc_id), doc_id)
    assert got == sorted(((i, signed(p), low.get(roots[p])) for i, p in all_rows), key=repr)


def test_one_of_each_component_stays(spark):
    docs = clashing(odd_documents(spark, TEXTS), "print", "component_id", "made")
    kept = s.drop_near_copies(docs)
    assert kept.columns == docs.columns
    linked = {(r.doc_id, r.component_id) for r in s.simhash_components(docs).collect()}
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted({c for _, c in linked}, key=repr)


def test_whole_table_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: (r.print, r.component_id) for r in s.simhash_components(docs).collect()}
    prints = {r.doc_id: brute_print(r.text) for r in docs.select("doc_id", "text").collect()}
    roots = brute_components(set(prints.values()))
    low = {}
    for i, p in sorted(prints.items()):
        low.setdefault(roots[p], i)
    assert got == {i: (signed(p), low[roots[p]]) for i, p in prints.items()}


def test_empty_table(spark):
    docs = odd_documents(spark, TEXTS).limit(0)
    assert s.simhash_components(docs).count() == 0 and s.drop_near_copies(docs).count() == 0
