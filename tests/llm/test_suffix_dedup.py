import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from cases import clashing, odd_documents, rows
from hypothesis import given, settings, strategies as st

from tidebars.llm import suffix_dedup as s
from tidebars.llm.queries import QUERIES


def brute(docs, length):
    """(id, bytes, removed, spans, kept) of (id, text) pairs by counting all windows."""
    data = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(hash(d[p : p + length]) for _, d in data for p in range(len(d) - length + 1))
    seen = Counter(d[p : p + length] for _, d in data for p in range(len(d) - length + 1) if seen[hash(d[p : p + length])] > 1)
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        runs = sum(1 for p in range(len(gone)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(d), sum(gone), runs, bytes(b for b, g in zip(d, gone) if not g)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in df.collect()), key=repr)


def test_query_equals_brute_force_on_the_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = sorted(((i, n, g, r, hashlib.sha256(k).hexdigest()) for i, n, g, r, k in brute(docs, 200)), key=repr)
    assert rows(QUERIES["op12_suffix_dedup"](spark, sf_dir), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected
    assert any(e[2] for e in expected)


def passages(seed=5):
    dice = random.Random(seed)
    word = lambda: "".join(dice.choice("abcdeé") for _ in range(dice.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, line = text(20), text(8)
    texts = [text(dice.randint(0, 60)) for _ in range(60)]
    texts = [t + shared + text(5) if i % 3 == 0 else line + t if i % 3 == 1 else t for i, t in enumerate(texts)]
    texts += texts[:4] + ["ab" * 200, "z" * 300, "z" * 41, texts[0][10:-10]]
    return texts


@pytest.mark.parametrize("sizes", [{}, {"file_bytes": 500, "shard_bytes": 2_000, "key_bytes": 300}, {"file_bytes": 1, "key_bytes": 1}])
def test_sizes_of_files_and_shards_do_not_matter(spark, sizes):
    docs = odd_documents(spark, passages())
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], 40)
    assert got(s.remove_repeats(clashing(docs, "kept", "file", "TEXT"), length=40, gram=8, **sizes)) == expected


def test_crowded_keys_meet_across_shards(spark):
    dice = random.Random(1)
    shared = "the very same line of about thirty-six"
    texts = ["".join(dice.choice("ab") for _ in range(6)) + shared + "".join(dice.choice("cd") for _ in range(6)) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert got(s.remove_repeats(docs, length=44, gram=16, key_bytes=600)) == brute(list(enumerate(texts)), 44)


def test_empty_table_and_short_texts(spark):
    docs = odd_documents(spark, ["short", "texts"])
    assert s.remove_repeats(docs.limit(0)).count() == 0
    assert {r.n_removed for r in s.remove_repeats(docs.filter("length(text) < 100 OR text IS NULL")).collect()} == {0}


@given(st.binary(max_size=400) | st.text("ab\0", max_size=300).map(str.encode))
@settings(max_examples=200, deadline=None)
def test_suffix_array(data):
    assert s.suffix_array(np.frombuffer(data, dtype=np.uint8)).tolist() == sorted(range(len(data)), key=lambda p: data[p:])


@given(st.lists(st.text("ab", min_size=6, max_size=40), min_size=1, max_size=12))
@settings(max_examples=200, deadline=None)
def test_classes_of_equal_windows(texts):
    bodies = [t.encode() for t in texts]
    order, of, size = s.repeated_windows(bodies, 6)
    data, ends = b"".join(bodies), np.cumsum([len(b) for b in bodies])
    own = {p: data[p : p + 6] for p in range(len(data)) if p + 6 <= ends[np.searchsorted(ends, p, "right")]}
    counts = Counter(own.values())
    assert sorted(order.tolist()) == sorted(own)
    assert [counts[own[p]] for p in order.tolist()] == size.tolist()


def test_a_sort_that_does_not_fit_packed_numbers(monkeypatch):
    monkeypatch.setattr(s, "_PACKED", 10)
    data = np.frombuffer(b"abracadabra" * 30, dtype=np.uint8)
    assert s.suffix_array(data).tolist() == sorted(range(len(data)), key=lambda p: bytes(data[p:]))
