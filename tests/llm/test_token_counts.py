import functools
import random

import public_tokenizers
from cases import clashing, odd_documents
from test_bpe import TEXTS, random_texts

from tidebars.llm import pieces, token_counts as t

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.cache
def ranks():
    return t.read_ranks(PATH)


@functools.cache
def costs():
    return t.costs(ranks())


def brute(piece):
    best = [0]
    for end in range(1, len(piece) + 1):
        best.append(min(best[s] + costs()[piece[s:end]] for s in range(end) if piece[s:end] in costs()))
    return best[-1] & ((1 << t.COUNT_BITS) - 1)


def expected(text):
    own = [p.encode() for p in pieces.pieces(text or "")]
    return len(own), sum(map(brute, own))


def test_trie_against_brute_force():
    trie = t.PieceTrie(ranks(), most_nodes=500)  # begun anew many times
    rng = random.Random(8)
    for _ in range(400):
        piece = "".join(rng.choices(["th", "in", "er", "é", "x", "7"], k=rng.randrange(1, 9))).encode()
        assert trie.count(piece) == brute(piece)


def test_shared_prefixes_are_computed_once():
    trie = t.PieceTrie(ranks())
    trie.count(b"thinking")
    nodes = len(trie.least)
    trie.count(b"think")
    assert len(trie.least) == nodes
    trie.count(b"thinner")
    assert len(trie.least) == nodes + 3


def test_long_pieces_leave_no_nodes(monkeypatch):
    rng = random.Random(3)
    piece = "".join(rng.choices(["th", "in", "er", "é", "x"], k=900)).encode()
    expected = brute(piece)
    assert t.PieceTrie(ranks()).count(piece) == expected
    monkeypatch.setattr(t, "LONG", 500)
    trie = t.PieceTrie(ranks())
    assert trie.count(piece) == expected and trie.count(piece[:501]) == brute(piece[:501])
    assert len(trie.least) == 1


def test_texts_against_brute_force(spark):
    texts = TEXTS + random_texts(60, 5)
    docs = clashing(odd_documents(spark, texts), "n_tokens", "N_pieces")
    for row in t.count_tokens(docs, PATH).collect():
        if len(row.text or "") < 1000:
            assert (row.n_pieces, row.n_tokens) == expected(row.text), row.text
    assert t.count_tokens(docs.limit(0), PATH).count() == 0


def test_registered_query(spark, sf_dir):
    from tidebars.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    memo = functools.cache(brute)
    for row in QUERIES["op8_token_counts"](spark, sf_dir).collect():
        own = [p.encode() for p in pieces.pieces(texts[row.doc_id])]
        assert (row.n_pieces, row.n_tokens) == (len(own), sum(map(memo, own)))
