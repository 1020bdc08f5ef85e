import random
import re
import zlib
from collections import Counter

import pytest
from cases import clashing, odd_documents, rows
from hypothesis import given, settings, strategies as st

from tidebars.llm import spelling as s
from tidebars.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(docs, worn=199, least=6, count=5):
    out = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if worn and h % worn == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= least and n >= count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_near(words):
    """By deleted letters: two words one edit apart share a word with one letter marked or gone."""
    by = {}
    for w in words:
        for i in range(len(w)):
            by.setdefault(w[:i] + "\0" + w[i + 1 :], set()).add(w)
            by.setdefault(w[:i] + w[i + 1 :], set()).add(w)
        by.setdefault(w, set()).add(w)
    near = {w: set() for w in words}
    for group in by.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    return near


def brute(words):
    near = brute_near(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda b: (-words[b], b), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), None if form[w] is None else words[form[w]]))
    return sorted(out, key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def test_query_equals_brute_force_on_the_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = rows(QUERIES["op11_spelling"](spark, sf_dir), *COLUMNS)
    assert got == brute(brute_words(docs)) and any(g[1] for g in got)


@given(st.lists(st.text("abé", min_size=1, max_size=7), min_size=1, max_size=80, unique=True))
@settings(max_examples=150, deadline=None)
def test_index_finds_the_words_one_edit_apart(words):
    index = s.PositionIndex(words)
    for i, w in enumerate(words):
        query, found = index.near(s.np.array([i]))
        assert set(query.tolist()) <= {i} and sorted(found.tolist()) == [j for j, v in enumerate(words) if one_edit(w, v)]


@pytest.mark.parametrize("tile,block", [(4096, 512), (7, 3), (1, 1)])
def test_tiles_and_blocks_of_any_size(spark, tile, block):
    dice = random.Random(3)
    words = {"".join(dice.choice("abc") for _ in range(dice.randint(6, 9))): dice.choice([5, 6, 40, 300]) for _ in range(600)}
    words |= {"long" * 5_000: 5, "long" * 5_000 + "s": 50, "é" * 6: 9, "é" * 7: 45}
    vocab = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert rows(s.group_variants(vocab, tile=tile, block=block), *COLUMNS) == brute(words)


def test_odd_documents(spark):
    texts = ["Spelling spelling SPELLING spellings", "Élève élèves " * 3, "speling " * 2 + "spelling " * 12, "a×b÷cdefg"]
    docs = odd_documents(spark, texts)
    expected = brute_words([(r.doc_id, r.text) for r in docs.collect()], worn=3, least=3, count=2)
    got = s.vocabulary(clashing(docs, "word", "n", "TEXT"), worn=3, least=3, count=2)
    assert {r.word: r.n for r in got.collect()} == expected
    assert s.group_variants(s.vocabulary(docs.limit(0))).count() == 0
