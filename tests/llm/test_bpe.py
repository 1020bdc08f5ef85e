import random

import numpy as np
import pytest
import public_tokenizers
from cases import clashing, odd_documents, rows
from tokenizers import Tokenizer

from tidebars.llm import bpe, pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def own_ids(text):
    return np.frombuffer(bpe.vocabulary(PATH).encode(text), dtype="<u4").tolist()


def random_texts(n, seed):
    rng = random.Random(seed)
    alphabets = ["abcdefghij ", "aAbB'st 12\n", "éèöß日本 \t  x", "".join(map(chr, range(1, 0x250))), "=-_/.$%! \r\n", "th er in on a "]
    out = []
    for _ in range(n):
        letters = rng.choice(alphabets)
        out.append("".join(rng.choice(letters) for _ in range(rng.randrange(60))))
    for _ in range(n // 4):
        out.append("".join(chr(c) for c in (rng.randrange(0x11000) for _ in range(30)) if not 0xD800 <= c < 0xE000))
    return out


TEXTS = ["Hello world", "it's  we'll \n\n don't", "  lead", "trail  ", "a\nb c", "a \nb", "x<|endoftext|> y <|endoftext|>", "<|endoftext|",
         "\x00nul a", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "1234567890 3.14", "😀 family 👨‍👩‍👧", "a\u0085b\x1cc d", "　wide"]


@pytest.mark.parametrize("text", TEXTS)
def test_cases_equal_the_library(text):
    assert own_ids(text) == library_ids(text)
    assert bpe.vocabulary(PATH).decode(bpe.vocabulary(PATH).encode(text)) == LIBRARY.decode(library_ids(text), skip_special_tokens=False)


def test_random_texts_equal_the_library():
    for text in random_texts(3000, 3):
        assert own_ids(text) == library_ids(text), repr(text)


def test_whole_tokens_and_one_long_piece():
    words = bpe.vocabulary(PATH)
    for token in list(words.ids)[::7]:
        assert words.encode_piece(token) == [words.ids[token]]
    rng = random.Random(1)
    text = "".join(rng.choice("etaoinshr") for _ in range(30_000))
    assert own_ids(text) == library_ids(text)


def test_keys_hold_the_pieces():
    plain = 0
    for text in random_texts(4000, 8) + TEXTS + ["a b\nc it's 12 x,y\nz", "a  b", "a\n\nb"]:
        found = pieces.keys(text)
        if found is not None:
            plain += 1
            assert [p for k in found for p in pieces.pieces(pieces.part(k))] == pieces.pieces(text)
    assert plain > 100


def test_decoding_any_ids():
    words, rng = bpe.vocabulary(PATH), random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(40))]
        assert words.decode(np.array(ids, dtype="<u4").tobytes()) == LIBRARY.decode(ids, skip_special_tokens=False)
    with pytest.raises(ValueError):
        words.decode(np.array([50257], dtype="<u4").tobytes())


def test_memo_forgets_and_stays_right():
    memo = pieces.Memo(str.upper, limit=3, longest=4)
    assert [memo[k] for k in ["a", "b", "c", "d", "a", "e", "f", "longer", "a"]] == list("ABCDAEF") + ["LONGER", "A"]
    assert len(memo) <= 3 and "longer" not in memo


def test_frames(spark):
    docs = odd_documents(spark, TEXTS[:8])
    got = rows(bpe.round_trip(clashing(docs, "TEXT_", "Ids", "decoded"), PATH), "doc_id", "n_tokens", "ids", "decoded")
    expected = [(r.doc_id, len(i := library_ids(r.text)), bytearray(np.array(i, dtype="<u4").tobytes()), r.text or "") for r in docs.collect()]
    assert got == sorted(expected, key=repr)
    back = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert back.columns == [*docs.columns, "n_tokens", "ids", "decoded"]
    assert all((r.text or "") == r.decoded for r in back.collect())
    assert bpe.round_trip(docs.limit(0), PATH).count() == 0


def test_registered_query(spark, sf_dir):
    import hashlib

    from tidebars.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op4_bpe"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = library_ids(texts[row.doc_id])
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
