import hashlib
import re

import pytest
from cases import clashing, odd_documents, rows

from tidebars.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=13):
    words = plain_words(text)
    hit, found = set(), set()
    for item, body in items:
        if item is None or body is None:
            continue
        w = plain_words(body)
        k = min(window, len(w))
        wins = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in wins:
                found.add(str(item))
                hit.update(range(i, i + k))
    return len(words), len(hit), sorted(found)


TEXTS = [
    "before " + ITEM + " after", ITEM.upper().replace(" ", ", "), "x " * 400 + ITEM, "one two three four five six seven",
    "Éa été étà", "short item here", "nothing of the kind", " ".join(ITEM.split()[1:14]) + " " + " ".join(ITEM.split()[2:15]),
]
ITEMS = [(1, ITEM), (2, "Short  ITEM"), (10, ITEM + " sixteen"), (3, None), (4, ""), (None, "nothing of the kind"), (1, "été étà")]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


@pytest.mark.parametrize("block_chars", [d.BLOCK_CHARS, 60])
def test_against_brute_force(spark, benchmark, block_chars):
    docs = odd_documents(spark, TEXTS)
    got = rows(d.find_contamination(docs, benchmark, block_chars=block_chars), "doc_id", "n_words", "n_hit", "items")
    expected = sorted(((r.doc_id, *brute(r.text, ITEMS)) for r in docs.collect()), key=repr)
    assert got == expected


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(d.WindowSet, "_hash", lambda self, words, starts, size: words[starts].astype("uint64") % 2)
    items = [(str(i), t.encode()) for i, t in ITEMS if i is not None and t is not None]
    windows = d.WindowSet(items, 3)
    for text in [*TEXTS, "three four five one two", ""]:
        hit, found = windows.find(d.words_of(text.encode()))
        assert (len(hit), hit.sum(), found) == brute(text, ITEMS, 3)


def test_bytes_of_a_block():
    """A block of 4,500 items: some 400,000 windows of 30 bytes at most, beside the vocabulary."""
    import pickle
    import random

    draw = random.Random(5)
    vocabulary = [f"word{i}" for i in range(50_000)]
    items = [(str(i), " ".join(draw.choices(vocabulary, k=100)).encode()) for i in range(4_500)]
    windows = d.WindowSet(items, 13)
    held = sum(a.nbytes for _, layer in windows.layers for a in layer) + windows.words.nbytes
    assert held <= 30 * 4_500 * 88 and len(pickle.dumps(windows)) < 15_000_000
    hit, found = windows.find(d.words_of(b"x " + items[7][1] + b" y"))
    assert hit.sum() == 100 and found == ["7"]


def test_copies_of_an_item_are_held_once(spark, benchmark, monkeypatch):
    copies = spark.range(500).selectExpr("cast(1 AS bigint) AS item_id", f"'{ITEM}' AS text")
    docs, more = odd_documents(spark, TEXTS), benchmark.unionAll(copies)
    got = rows(d.find_contamination(docs, more, block_chars=1000), "doc_id", "n_words", "n_hit", "items")
    assert got == sorted(((r.doc_id, *brute(r.text, ITEMS)) for r in docs.collect()), key=repr)
    monkeypatch.setattr(d, "WindowSet", lambda items, window: len(items))
    assert list(d._blocks(more, "item_id", "text", 13, 1000)) == [sum(i is not None and t is not None for i, t in ITEMS)]


def test_removal_and_clashing_columns(spark, benchmark):
    docs = clashing(odd_documents(spark, TEXTS), "n_words", "hits", "made")
    whole = d.decontaminate(docs, benchmark)
    assert whole.columns == docs.columns
    bad = {i for i, t in enumerate(TEXTS) for n, h, _ in [brute(t, ITEMS)] if h and 20 * h >= n}
    assert {r.doc_id for r in whole.collect()} == {r.doc_id for r in docs.collect()} - bad
    cut = {r.doc_id: r.text for r in d.decontaminate(docs, benchmark, remove="spans").collect()}
    assert cut[0] == "before  after" and cut[6] == TEXTS[6] and cut[2] == "x " * 400


def test_empty_tables(spark, benchmark):
    docs = odd_documents(spark, TEXTS)
    assert d.find_contamination(docs.limit(0), benchmark).count() == 0
    assert {r.n_hit for r in d.find_contamination(docs, benchmark.limit(0)).collect()} == {0}


def test_query_digest(spark, sf_dir):
    from tidebars.llm.queries import QUERIES

    row = QUERIES["op1_decontamination"](spark, sf_dir).filter("n_items = 0").first()
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest()
